"""SimHash near-duplicates by pigeonhole blocks.

Fingerprint: 64 bits over word shingles hashed with XXH64. Two fingerprints that differ in at most
RADIUS = 4 bits agree in at least 3 of 7 blocks. Every distinct fingerprint is listed under each choice
of 3 blocks (35 keys of 27 or 28 bits), fingerprints under one key are joined, and a pair is
kept if its Hamming distance holds; a pair that shares several keys counts under the first only.

Scale: equal fingerprints are one entry, so copies cost nothing. Keys that only one fingerprint has
are dropped before the join, most of them by a bitmap of the shared keys before anything is shuffled. A key with more than CROWD fingerprints is not paired: fingerprints in
such a key are linked through midpoints instead. Two fingerprints differ in at most 4 bits exactly if some
point is at most 2 bits from both, so each lists the 2,081 points around it and is linked to the least
fingerprint of each point. That is exact and linear in their number. Links of a crowded fingerprint to
an uncrowded one share an uncrowded key, which the join covers.

Defined cases: null or empty text has fingerprint zero. A null doc_id gets a fingerprint and the least
known doc_id of its component, null if there is none. Repeated rows get one result row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm.bitmap import MASK, bitmap, passing
from saldo.llm.common import bound_batches
from saldo.llm.components import components
from saldo.session import staged

SHINGLE = 4
SEED = 42
RADIUS = 4
CROWD = 1000
WIDTHS = (10, 9, 9, 9, 9, 9, 9)
CHOICES = list(combinations(range(len(WIDTHS)), len(WIDTHS) - RADIUS))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of one text as a signed 64-bit number. Words are split at blanks and \\x09-\\x0D."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_digest
    shingles = range(max(1, len(words) - size + 1))
    hashes = b"".join([digest(join(words[i : i + size]), SEED) for i in shingles])
    table = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(table), 65536):
        ones += np.unpackbits(table[start : start + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(table)).tobytes(), "big", signed=True)


def fingerprint_of(spark: SparkSession, text: Column, size: int = SHINGLE) -> Column:
    """Fingerprint column of a text column."""
    bound_batches(spark)

    def batches(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(x, size) for x in batch], dtype="int64")

    batches.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(batches, "long")(text.cast("string"))


def block_keys(fp: Column) -> Column:
    """One key for each choice of blocks: the number of the choice above the bits of its blocks."""
    place, masks = 0, []
    for width in WIDTHS:
        mask = ((1 << width) - 1) << place
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
        place += width
    wide = [sum(masks[b] for b in choice) for choice in CHOICES]
    wide = [(m + (1 << 63)) % (1 << 64) - (1 << 63) for m in wide]
    keyed = [F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(m))) for i, m in enumerate(wide)]
    return F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask"), k.alias("key"))
                     for i, (m, k) in enumerate(zip(wide, keyed, strict=True))])


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def first_shared(a: Column, b: Column) -> Column:
    """Number of the first choice whose three blocks agree."""
    place, same = 0, []
    differ = a.bitwiseXOR(b)
    for width in WIDTHS:
        mask = ((1 << width) - 1) << place
        same.append(differ.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask)) == 0)
        place += width
    found = F.when(F.lit(False), F.lit(-1))
    for i, (x, y, z) in enumerate(CHOICES):
        found = found.when(same[x] & same[y] & same[z], F.lit(i))
    return found


def links(fingerprints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): pairs of distinct fingerprints (column `fp`, without repeats) at most RADIUS bits apart. Inside
    a crowded key the links named are enough to connect all that are that close."""
    listed = fingerprints.select("fp", F.explode(block_keys(F.col("fp"))).alias("k")).select(
        "fp", F.col("k.key").alias("key"), F.col("k.choice").alias("choice")
    )
    sizes = staged(listed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "block-sizes")
    shared = staged(likely_members(fingerprints, sizes).join(sizes, "key"), "block-members")
    paired = shared.where(F.col("n") <= crowd).select("fp", "key", "choice")
    other = paired.select(F.col("fp").alias("other"), "key")
    close = (distance(F.col("fp"), F.col("other")) <= RADIUS) & (F.col("fp") < F.col("other"))
    # a stray meeting of two hashed keys shares no choice and is covered by the pair's own one
    once = first_shared(F.col("fp"), F.col("other")) == F.col("choice")
    joined = paired.join(other, (paired["key"] == other["key"]) & close & once).select(
        F.col("fp").alias("a"), F.col("other").alias("b")
    )
    crowded = staged(shared.where(F.col("n") > crowd).select("fp").distinct(), "crowded")
    return joined.unionByName(midpoint_links(crowded))


def likely_members(fingerprints: DataFrame, sizes: DataFrame) -> DataFrame:
    """(fp, key, choice): every fingerprint under its keys that are in `sizes`, and few under others, so that the join with
    `sizes` moves what is shared instead of every key."""
    known = bitmap(sizes, F.col("key").bitwiseAND(F.lit(MASK)))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = np.array(batch["keys"].tolist(), np.int64).reshape(-1, len(CHOICES))
            row, choice = np.nonzero(passing(known.value, keys & MASK))
            yield pd.DataFrame({"fp": batch["fp"].to_numpy(np.int64)[row], "key": keys[row, choice], "choice": choice.astype(np.int32)})

    keys = F.transform(block_keys(F.col("fp")), lambda k: k["key"]).alias("keys")
    return fingerprints.select("fp", keys).mapInPandas(look, "fp long, key long, choice int")


def midpoint_links(crowded: DataFrame) -> DataFrame:
    """(a, b): each fingerprint with the least one around each of its midpoints."""
    bits = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    masks = [0, *bits, *(x ^ y for x, y in combinations(bits, 2))]
    masks = F.array(*[F.lit(m) for m in masks])
    points = crowded.select("fp", F.explode(masks).alias("m")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point")
    )
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    met = points.join(least.select("point", "a"), "point").where("a < fp")
    return met.select("a", F.col("fp").alias("b")).distinct()


def classes(fingerprints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(fp, class): every fingerprint of the column `fp` that is linked to another one, and its class."""
    distinct = staged(fingerprints.select("fp").distinct(), "fingerprints")
    found = components(links(distinct, crowd), "a", "b")
    return found.select(F.col("node").alias("fp"), F.col("least").alias("class"))


def group_documents(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """`rows` (columns `doc_id` and `fp`, staged) with `component_id`, the least doc_id of the class."""
    found = staged(classes(rows, crowd), "classes")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    per_class = least.join(found, "fp", "left").withColumn("class", F.coalesce("class", "fp"))
    least_of_class = staged(per_class.groupBy("class").agg(F.min("least").alias("component_id")), "class-ids")
    # only classes that differ from the fingerprint's own least document need the second join
    table = staged(
        per_class.select("fp", "class").join(least_of_class, "class").select("fp", "component_id"), "members"
    )
    return rows.join(table, "fp", "left")


def op7_simhash(documents: DataFrame) -> DataFrame:
    """Every document with its fingerprint and component."""
    spark = documents.sparkSession
    rows = staged(
        documents.select("doc_id", fingerprint_of(spark, F.col("text")).alias("fp")), "document-fingerprints"
    )
    grouped = group_documents(rows)
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """One document of each group: the least doc_id (unknown ids last), the first row among repeats."""
    spark, columns = documents.sparkSession, documents.columns
    marked = documents.withColumns({
        "__row": F.monotonically_increasing_id(), "__fp": fingerprint_of(spark, F.col("text"))
    })
    held = staged(marked, "marked-documents")
    slim = held.select(F.col("__fp").alias("fp"), F.struct(
        F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("__row").alias("row")
    ).alias("who"))
    found = staged(classes(slim), "classes")
    best = slim.groupBy("fp").agg(F.min("who").alias("who")).join(found, "fp", "left")
    first = best.groupBy(F.coalesce("class", "fp").alias("class")).agg(F.min("who").alias("who"))
    stay = first.select(F.col("who.row").alias("__row"))
    # row numbers, not texts, tell which rows go: few of them are broadcast below the planner's limit, and no text moves
    gone = staged(slim.select(F.col("who.row").alias("__row")).join(stay, "__row", "left_anti"), "gone-rows")
    return held.join(gone, "__row", "left_anti").select(*columns)
