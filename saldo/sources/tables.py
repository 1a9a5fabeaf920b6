"""Readers: Parquet folders, catalog tables, header files, remote queries."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saldo.sources.demo_views import RAW_TABLES, VIEWS, view_text


def catalog_tables(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """Tables by role from any catalog, e.g. ``{"operations": "cat.accounting.operations"}``."""
    return {role: spark.table(name) for role, name in names.items()}


def trim_keys(df: DataFrame, *columns: str, ignore_case: bool = False) -> DataFrame:
    """Text keys without trailing blanks (and in lower case on request), done once on load, so that
    joins compare them as the source database does and stay plain equalities."""
    clean = {c: F.rtrim(c) for c in columns}
    return df.withColumns({c: F.lower(v) if ignore_case else v for c, v in clean.items()})


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Rows given in code, with declared types."""
    return spark.createDataFrame(list(rows), schema)


def read_sheet(spark: SparkSession, path: str, schema: str | StructType, **options: str) -> DataFrame:
    """A sheet with a header line, delivered as CSV. Types are declared, never inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .options(**options)
        .csv(path)
    )


def remote_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """The result of a query that the remote database runs itself.

    For a large result give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that executors read in parallel; Spark then needs ``dbtable`` instead of
    ``query``, so the text is wrapped as a sub-select.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if "partitionColumn" in options:
        return reader.option("dbtable", f"({query}) q").load()
    return reader.option("query", query).load()


class DemoTables(Mapping):
    """Driver tables and the views over them, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.built = spark, folder.rstrip("/"), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            if name in VIEWS:
                text = view_text(name, "spark")
                needs = set(re.findall(r"\{(\w+)\}", text))
                self.built[name] = self.spark.sql(text, **{n: self[n] for n in needs})
            elif name in RAW_TABLES:
                self.built[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                raise KeyError(name)
        return self.built[name]

    def __iter__(self) -> Iterator[str]:
        return iter((*RAW_TABLES, *VIEWS))

    def __len__(self) -> int:
        return len(RAW_TABLES) + len(VIEWS)
