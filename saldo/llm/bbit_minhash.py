"""MinHash near-duplicates with b-bit signatures.

A document's set holds its distinct word shingles, told apart by their 64-bit hash. Equal sets are one class from the
start. For every distinct set, BANDS bands of ROWS minima each are hashed to keys, and the low BIT bits of all minima are
packed into words. Sets that share a band key are candidates. The bit counts of two packed signatures estimate
their similarity: minima that differ agree by chance in one of 2 ** BIT cases, and that share is taken off. Candidates
whose estimate is too low for the threshold are dropped; the others are confirmed on the full sets.

What may be lost: at the threshold itself a pair shares no band with probability LOSS at most, and its estimate falls
below the limit with probability LOSS at most; above the threshold both are smaller. Everything else is exact.

Links that only join what is joined already are not looked for: components are the result. So a band key's members
are first linked to one of them, picked by chance for each key (a star, not all pairs). What one
component holds then needs no more. Only in keys whose members are still in several components, pairs across components
are compared: directly in keys of at most CROWD members, in larger ones if they share one of their rarest shingles, as
every pair at the threshold does.

Scale: signatures and keys are some 1 KB a distinct set; copies cost one row. Sets are built again, from the texts, for
the documents that are in a candidate pair or an open band, which a bounded bitmap lets through. A crowd of edited copies
costs its shingles once: those far from all others have too many shingles of their own to meet anyone, and the
others are mostly in one component.

Defined cases: null or empty text, or one without words, has an empty set and is linked with nothing. Repeated rows are
rows of their own with one component. A null doc_id gets the least known doc_id of its component, null if there is
none; `kept` is then true only if the component has no known doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import ceil, exp, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from saldo.llm.bitmap import MASK, bitmap, passing
from saldo.llm.common import bound_batches
from saldo.llm.components import components
from saldo.session import staged

SHINGLE = 3
SEED = 42
LEAST = 85  # hundredths of the union
ROWS = 5
BANDS = 40
BIT = 4
LOSS = 1e-10
CROWD = 16
PLANES = ROWS * BANDS
FIELDS = 64 // BIT
WORDS = ceil(PLANES / FIELDS)
LOW = sum(1 << BIT * i for i in range(FIELDS))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
FACTORS = np.random.default_rng(12).integers(0, 1 << 31, PLANES, np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes. Words are split at blanks and \\x09-\\x0D."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    join, digest = b" ".join, xxhash.xxh64_digest
    hashes = b"".join([digest(join(words[i : i + size]), SEED) for i in range(max(1, len(words) - size + 1))])
    return np.unique(np.frombuffer(hashes, np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of every plane, over a set of hashes; planes mix half a hash, which is fast."""
    out, half = np.full(PLANES, ~np.uint32(0)), hashes.astype(np.uint32)
    for start in range(0, len(half), 256):
        np.minimum(out, (half[start : start + 256, None] * FACTORS).min(axis=0), out=out)
    return out


def pack_low_bits(least: np.ndarray) -> np.ndarray:
    """BIT bits of every minimum, FIELDS to a word."""
    low = np.zeros(WORDS * FIELDS, np.uint64)
    low[:PLANES] = (least ^ least >> np.uint32(16)) & np.uint32((1 << BIT) - 1)
    return np.bitwise_or.reduce(low.reshape(WORDS, FIELDS) << np.arange(0, 64, BIT, dtype=np.uint64), axis=1)


def band_keys(least: np.ndarray) -> list[int]:
    """One signed key for each band."""
    return [xxhash.xxh64_intdigest(x.tobytes(), i) - (1 << 63) for i, x in enumerate(least.reshape(BANDS, ROWS))]


def set_key(hashes: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return xxhash.xxh3_128_digest(hashes.tobytes(), SEED)


@F.pandas_udf(ArrayType(LongType()))
def tokens(hashes: pd.Series) -> pd.Series:
    """The shingle hashes of a packed set."""
    return pd.Series([np.frombuffer(x, np.int64) for x in hashes])


def estimate(agree: float) -> float:
    """Similarity from the number of agreeing fields, corrected for agreement by chance."""
    chance = 2.0**-BIT
    return (agree / PLANES - chance) / (1 - chance)


def fewest_agreeing(least: int = LEAST, loss: float = LOSS) -> int:
    """The number of agreeing fields that a pair at the threshold reaches but for `loss` (Chernoff's bound)."""
    chance = 2.0**-BIT
    p, n = chance + (1 - chance) * least / 100, PLANES
    for m in range(int(p * n), 0, -1):
        q = m / n
        if exp(-n * (q * log(q / p) + (1 - q) * log((1 - q) / (1 - p)))) <= loss:
            return m
    return 0


def texts_of(documents: DataFrame) -> DataFrame:
    """(doc_id, name, text): ids go through Python as text, so that none of them becomes a float beside a null; `name` tells
    documents apart but for rare chance."""
    doc_id, text = F.col("doc_id").cast("string"), F.col("text").cast("string")
    return documents.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("name"), text.cast("binary").alias("text"))


def sketch(spark: SparkSession, documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, name, n, key, signature, bands) of every document; the last three null for empty sets."""
    bound_batches(spark)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, seen = [], {}
            for text in batch["text"]:
                hashes = shingle_set(text, size)
                key = set_key(hashes) if len(hashes) else None
                if key is not None and key not in seen:
                    least = minima(hashes)
                    seen[key] = (pack_low_bits(least).view(np.int64), np.array(band_keys(least), np.int64))
                out.append((len(hashes), key, *seen.get(key, (None, None))))
            yield pd.concat([batch[["doc_id", "name"]], pd.DataFrame(out, columns=["n", "key", "signature", "bands"], index=batch.index)], axis=1)

    found = texts_of(documents).mapInPandas(
        rows, "doc_id string, name long, n long, key binary, signature array<long>, bands array<long>"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))


def agreeing(a: Column, b: Column) -> Column:
    """Fields in which two packed signatures agree."""
    total = F.lit(PLANES)
    for i in range(WORDS):
        x = a[i].bitwiseXOR(b[i])
        any_bit = x
        for shift in range(1, BIT):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total - F.bit_count(any_bit.bitwiseAND(F.lit(LOW)))
    return total


def likely(pairs: DataFrame, sketches: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of set keys whose sizes and estimate allow the threshold."""
    sides = [sketches.select(F.col("key").alias(s), F.col("n").alias(f"{s}_n"), F.col("signature").alias(f"{s}_s")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    sizes = F.lit(100) * F.least("a_n", "b_n") >= F.lit(least) * F.greatest("a_n", "b_n")
    return both.where(sizes & (agreeing(F.col("a_s"), F.col("b_s")) >= fewest_agreeing(least))).select("a", "b")


def full_sets(documents: DataFrame, sketches: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(key, hashes) of the wanted keys, built from the texts."""
    spark = documents.sparkSession
    wanted = staged(sketches.select("key", "name").join(keys, "key", "left_semi"), "wanted-sets")
    allowed = bitmap(wanted, F.col("name").bitwiseAND(F.lit(MASK)))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"][passing(allowed.value, batch["name"].to_numpy() & MASK)]
            found = [x for x in map(shingle_set, texts, repeat(size)) if len(x)]
            yield pd.DataFrame({"key": [set_key(x) for x in found], "hashes": [x.tobytes() for x in found]})

    bound_batches(spark)
    built = texts_of(documents).select("name", "text").mapInPandas(rows, "key binary, hashes binary")
    built = built.join(wanted.select("key"), "key", "left_semi")
    return staged(built.dropDuplicates(["key"]), "full-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) that reach the threshold on their full sets, staged."""

    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * shared >= least * (len(x) + len(y) - shared))
        return pd.Series(out, dtype=bool)

    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("hashes").alias("x")), "a")
    both = both.join(sets.select(F.col("key").alias("b"), F.col("hashes").alias("y")), "b")
    return staged(both.where(close("x", "y")).select("a", "b"), "confirmed-pairs")


def in_order(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) once each, the smaller key first."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def rarest(members: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(token, key, weight, n, place): the shingles in which members of crowded band keys must meet a partner. A partner lacks at most
    n - ceil(n * least / 100) of a set's n shingles, so one more than those are enough; each set lists its rarest.
    Shingles that no other member has end there, and with them the sets that differ in more places than the threshold
    allows. `weight` is high for sets in the midst of a crowd, all of whose shingles are frequent."""
    held = members.join(sets, "key").select("key", F.explode(tokens(F.col("hashes"))).alias("token"))
    held = staged(held, "crowd-shingles")
    df = staged(held.groupBy("token").agg(F.count("*").alias("df")), "crowd-frequencies")
    rare = held.join(df, "token").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("all"))
    n = F.size("all")
    first = rare.select("key", n.alias("n"), F.slice("all", F.lit(1), n - F.ceil(n * least / 100).cast("int") + 1).alias("first"))
    weight = F.aggregate("first", F.lit(0).cast("long"), lambda total, t: total + t["df"])
    listed = first.select("key", "n", weight.alias("weight"), F.posexplode("first").alias("place", "t"))
    return staged(listed.where("t.df > 1").select("key", "n", "weight", "place", F.col("t.token").alias("token")), "crowd-prefixes")


def with_class(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of a set key with its present component."""
    found = staged(components(links, "a", "b"), "present-classes")
    held = rows.join(found.select(F.col("node").alias("key"), F.col("least").alias("class")), "key", "left")
    return staged(held.withColumn("class", F.coalesce("class", "key")), "classed")


def across(rows: DataFrame, group: str) -> DataFrame:
    """The rows of groups whose members are in several components."""
    several = rows.groupBy(group).agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    return staged(rows.join(staged(several.select(group), "open-groups"), group, "left_semi"), "open-rows")


def pairs_across(rows: DataFrame, group: str, least: int | None = None) -> DataFrame:
    """Pairs (a, b) of a group that are in different components. With `least`, `n` and `place` tell sizes and where the shared
    shingle stands: what stands behind it on the shorter side is all that two sets can share besides, if it is their first."""
    other = rows.select(*[F.col(c).alias(f"o_{c}") for c in rows.columns])
    apart = (rows[group] == other[f"o_{group}"]) & (rows["key"] < other["o_key"]) & (rows["class"] != other["o_class"])
    if least is not None:
        behind = F.least(rows["n"] - rows["place"], other["o_n"] - other["o_place"])
        apart = apart & (behind * (100 + least) >= (rows["n"] + other["o_n"]) * least)
    return rows.join(other, apart).select(F.col("key").alias("a"), F.col("o_key").alias("b")).distinct()


def classes(sketches: DataFrame, documents: DataFrame, least: int, size: int, crowd: int = CROWD) -> DataFrame:
    """(key, class): every set that is linked to another one, and the least key of its component."""
    listed = staged(sketches.select("key", F.explode("bands").alias("band")), "bands")
    pivot = listed.groupBy("band").agg(F.count("*").alias("m"), F.min_by("key", F.xxhash64("band", "key")).alias("pivot"))
    shared = staged(listed.join(staged(pivot.where("m > 1"), "shared-bands"), "band"), "band-members")
    stars = in_order(shared.select(F.col("key").alias("a"), F.col("pivot").alias("b")))
    stars = staged(likely(stars, sketches, least), "likely-stars")
    ends = stars.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    links = confirmed(stars, full_sets(documents, sketches, ends, size), least)
    # a star of two has been compared in whole
    open_ = across(with_class(shared.where("m > 2").drop("pivot"), links), "band")
    small, many = open_.where(F.col("m") <= crowd), staged(open_.where(F.col("m") > crowd).select("key").distinct(), "crowded-members")
    sets = full_sets(documents, sketches, open_.select("key").distinct(), size)
    listed = rarest(many, sets, least)
    # in crowds, a star around the most central set of each shingle first
    centre = staged(listed.groupBy("token").agg(F.max_by("key", F.struct("weight", "key")).alias("pivot")), "centres")
    starred = across(with_class(listed, links), "token").join(centre, "token")
    stars = in_order(starred.select(F.col("key").alias("a"), F.col("pivot").alias("b")))
    links = staged(links.unionByName(confirmed(likely(stars, sketches, least), sets, least)), "links")
    rest = pairs_across(small, "band").unionByName(pairs_across(across(with_class(listed, links), "token"), "token", least)).distinct()
    more = confirmed(likely(rest, sketches, least), sets, least)
    return components(links.unionByName(more), "a", "b").select(F.col("node").alias("key"), F.col("least").alias("class"))


def near_duplicates(documents: DataFrame, least: int = LEAST, size: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text)."""
    spark = documents.sparkSession
    every = staged(sketch(spark, documents, size), "document-sketches")
    rows = every.select("doc_id", "n", "key")
    one = every.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.min("name").alias("name"), F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
    )
    sketches = staged(one, "set-sketches")
    found = staged(classes(sketches, documents, least, size, crowd), "classes")
    per_set = sketches.select("key", "doc_id").join(found, "key", "left").withColumn("class", F.coalesce("class", "key"))
    lowest = staged(per_set.groupBy("class").agg(F.min("doc_id").alias("component_id")), "class-ids")
    named = staged(per_set.join(lowest, "class").select("key", "component_id"), "set-classes")
    out = rows.join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op12_bbit_minhash(documents: DataFrame) -> DataFrame:
    """Every document with its set's size and component."""
    return near_duplicates(documents.select("doc_id", "text"))


OP12_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM docs
), sizes AS (
  SELECT r, count(*) AS n FROM sets GROUP BY r
), links AS (
  SELECT a.r AS x, b.r AS y FROM sets a JOIN sets b ON a.s = b.s AND a.r < b.r JOIN sizes m ON m.r = a.r JOIN sizes n ON n.r = b.r
  GROUP BY a.r, b.r HAVING 100 * count(*) >= 85 * (any_value(m.n) + any_value(n.n) - count(*))
), ends AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(r, z) AS (
  SELECT r, r FROM docs UNION SELECT reached.r, ends.y FROM reached JOIN ends ON ends.x = reached.z
), least AS (
  SELECT reached.r, min(d.doc_id) AS component_id FROM reached JOIN docs d ON d.r = reached.z GROUP BY reached.r
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN least USING (r) LEFT JOIN sizes USING (r)
"""
