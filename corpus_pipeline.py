"""A corpus pipeline of five stages; each reads the Parquet that the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm.common import table
from saldo.llm.decontamination import keep_clean
from saldo.llm.language_id import keep_known_language
from saldo.llm.line_dedup import drop_site_lines
from saldo.llm.piece_scan import encode_texts
from saldo.llm.simhash import keep_one_of_each
from saldo.session import scratch_path

# Languages are learned and near copies found by methods that SQL has no words for; the stages are
# tested against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return keep_known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go. Copies are still there, so two equal documents make no boilerplate."""
    out = drop_site_lines(docs, docs["source"], min_pages=10)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_texts(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
