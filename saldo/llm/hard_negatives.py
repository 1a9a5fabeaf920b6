"""Hard negatives by Kronecker-packed integer products.

Products: vectors become whole numbers. A tile's candidates are made non-negative by a bias and laid into separate
fields of one wide integer, several candidates to an integer; so is the tile's anchor, by a bias of its own. One
multiplication by an anchor component then multiplies all fields at once. A field is as wide as the tile's
largest possible sum, so no sum carries into the next field; fields are cut apart by shifts and masks and the biases'
share is taken off. Up to 64 bits an integer is a numpy word; where one field needs more, it is a Python
integer, and the same steps hold for any size.

Two passes: the first finds the positives of every anchor, the second the negatives between the bounds that each
positive's score sets. Both compare the stated anchors with all rows, in blocks.

Scale: rows are dealt to buckets of about BLOCK rows by the hash of their id, so a label that a third of all rows
share changes nothing. A bucket is shuffled once; anchors (a hundredth of the rows) are packed in blocks of ANCHORS
and sent once to each bucket. A task holds one pair of blocks and SLICE anchors' scores, and returns at most
`positives`, or `negatives` for each positive, of every anchor. The work is that of anchors times rows.

Defined cases: a row with a null id, label or vector, or a null or non-finite component, takes no part. Rows that repeat a
vec_id count once, the one of the greatest label, then vector. Vectors meet only vectors of their own length; empty ones
have score 0. A scaled component, or a score, beyond a long counts as the nearest long. An anchor without
positives, or a positive without negatives, has no result row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saldo.llm.common import bound_batches
from saldo.session import staged

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LEAST, MOST = 30, 90
BLOCK = 16384
ANCHORS = 1024
SLICE = 32
WORD = 64
LONG = (-(1 << 63), (1 << 63) - 1)
PACKED = "block long, bucket long, dims int, ids binary, labels binary, body binary, kind string, low binary, high binary"


def packed_products(anchors: np.ndarray, rows: np.ndarray, step: int = SLICE) -> Iterator[tuple[slice, np.ndarray]]:
    """Exact inner products of whole-number vectors: (slice of anchors, its products with all rows)."""
    dims, n = anchors.shape[1], len(rows)
    if not dims:
        for start in range(0, len(anchors), step):
            part = slice(start, min(start + step, len(anchors)))
            yield part, np.zeros((part.stop - start, n), np.int64)
        return
    a_bias, r_bias = (-min(0, int(x.min())) for x in (anchors, rows))
    a_top, r_top = (int(x.max()) + b for x, b in ((anchors, a_bias), (rows, r_bias)))
    width = max(1, (dims * a_top * r_top).bit_length())
    narrow = width <= WORD and max(a_top, r_top) < 1 << 62
    kind, fields = (np.uint64, WORD // width) if narrow else (object, 4)
    groups = -(-n // fields)
    wide = np.zeros((dims, groups), kind)
    for field in range(fields):
        part = rows[field * groups : (field + 1) * groups].T
        biased = (part + r_bias).astype(kind) if narrow else part.astype(object) + r_bias
        wide[:, : part.shape[1]] |= biased << kind(field * width) if narrow else biased * (1 << field * width)
    mask = np.uint64((1 << width) - 1) if narrow else (1 << width) - 1
    exact = np.int64 if narrow and dims * max(a_bias, a_top) * max(r_bias, r_top) < 1 << 60 else object
    row_share = rows.astype(exact).sum(axis=1) * a_bias
    for start in range(0, len(anchors), step):
        part = slice(start, min(start + step, len(anchors)))
        few = anchors[part].astype(exact)
        biased = (few + a_bias).astype(kind)
        total = np.zeros((len(few), groups), kind)
        for j in range(dims):
            total += biased[:, j, None] * wide[j]  # every field of every integer at once
        apart = [(total >> (kind(f * width) if narrow else f * width)) & mask for f in range(fields)]
        sums = np.concatenate(apart, axis=1)[:, :n].astype(exact)
        own = few.sum(axis=1) * r_bias + dims * a_bias * r_bias
        scores = sums - row_share - own[:, None]
        yield part, np.clip(scores, *LONG).astype(np.int64) if exact is object else scores


def first_of(rows: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k of `rows` with the highest scores, ties to the smaller id."""
    if len(rows) > k:
        rows = rows[score[rows] >= np.partition(score[rows], -k)[-k]]
    # ~score turns the order around and cannot overflow
    return rows[np.lexsort((ids[rows], ~score[rows]))[:k]]


def packed(size: int):
    """Rows in the order of (bucket, length), packed into blocks of `size` vectors of one bucket and length."""

    def bytes_of(vectors: list[np.ndarray], dims: int) -> tuple[bytes, str]:
        body = np.array(vectors, np.int64).reshape(len(vectors), dims)
        top = max(abs(int(body.min())), abs(int(body.max()))) if body.size else 0
        kind = "int16" if top < 1 << 15 else "int32" if top < 1 << 31 else "int64"
        return body.astype(kind).tobytes(), kind

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held, key = TaskContext.get().partitionId() << 32, [], None

        def block():
            body, kind = bytes_of([x[2] for x in held], key[1])
            sides = [np.array([x[i] for x in held], np.int64).tobytes() for i in (0, 1, 3, 4)]
            row = (number, *key, sides[0], sides[1], body, kind, sides[2], sides[3])
            return pd.DataFrame([row], columns=[c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            for row in batch.itertuples(index=False):
                if held and (key != (row.bucket, row.dims) or len(held) >= size):
                    yield block()
                    number, held = number + 1, []
                key = (row.bucket, row.dims)
                scores = [] if row.scores is None else [int(x) for x in row.scores]
                low = [-(-LEAST * s // 100) for s in scores]
                high = [MOST * s // 100 for s in scores]
                held.append((row.vec_id, row.label, np.asarray(row.v, np.int64), low, high))
        if held:
            yield block()

    return pack


def blocks_of(rows: DataFrame, size: int) -> DataFrame:
    """(vec_id, label, v, bucket, scores) packed; a bucket's rows lie together."""
    dealt = rows.withColumn("dims", F.size("v")).repartition("bucket").sortWithinPartitions("bucket", "dims", "vec_id")
    return dealt.select("vec_id", "label", "v", "bucket", "dims", "scores").mapInPandas(packed(size), PACKED)


def unpack(ids: bytes, labels: bytes, body: bytes, kind: str, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(labels, np.int64), np.frombuffer(body, kind).reshape(len(ids), dims).astype(np.int64)


def tile_positives(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """(anchor_id, positive_id, score): each anchor's first k of a tile with its own label."""
    for batch in batches:
        for t in batch.itertuples():
            ids, labels, body = unpack(t.ids, t.labels, t.body, t.kind, t.dims)
            a_ids, a_labels, anchors = unpack(t.a_ids, t.a_labels, t.a_body, t.a_kind, t.dims)
            out = []
            for part, scores in packed_products(anchors, body):
                for anchor, label, score in zip(a_ids[part], a_labels[part], scores, strict=True):
                    best = first_of(np.flatnonzero((labels == label) & (ids != anchor)), score, ids, k)
                    out.append((np.full(len(best), anchor), ids[best], score[best]))
            yield pd.DataFrame(dict(zip(("anchor_id", "positive_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))


def tile_negatives(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """(anchor_id, place, negative_id, score): a tile's first k of another label within each positive's bounds."""
    for batch in batches:
        for t in batch.itertuples():
            ids, labels, body = unpack(t.ids, t.labels, t.body, t.kind, t.dims)
            a_ids, a_labels, anchors = unpack(t.a_ids, t.a_labels, t.a_body, t.a_kind, t.dims)
            low, high = (np.frombuffer(x, np.int64).reshape(len(a_ids), -1) for x in (t.low, t.high))
            out = [(np.zeros(0, np.int64),) * 4]
            for part, scores in packed_products(anchors, body):
                for i, score in zip(range(part.start, part.stop), scores, strict=True):
                    other = labels != a_labels[i]
                    for place, (least, most) in enumerate(zip(low[i], high[i], strict=True)):
                        best = first_of(np.flatnonzero(other & (score >= least) & (score <= most)), score, ids, k)
                        out.append((np.full(len(best), a_ids[i]), np.full(len(best), place), ids[best], score[best]))
            names = ("anchor_id", "place", "negative_id", "score")
            yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out, strict=True)), strict=True)))


def against_all(rows: DataFrame, anchors: DataFrame, buckets: int) -> DataFrame:
    """Tiles: every block of anchors beside every block of rows of the same vector length."""
    few = anchors.select(
        F.explode(F.expr(f"sequence(0L, {buckets - 1}L)")).alias("bucket"), "dims", "low", "high",
        *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "body", "kind")],
    )
    return few.join(rows.select("bucket", "dims", "ids", "labels", "body", "kind"), ["bucket", "dims"])


def usable(vector: Column) -> Column:
    """Not null, and all components are finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def mine(
    vectors: DataFrame, wanted: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every row of (vec_id, label, v)
    that `wanted` picks. The bounds of a negative are LEAST and MOST hundredths of the positive's score."""
    spark = vectors.sparkSession
    bound_batches(spark)
    good = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("v").cast("array<double>").alias("v"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    whole = good.withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE)))
    one = whole.groupBy("vec_id").agg(F.max(F.struct("label", "v")).alias("row"))
    once = staged(one.select("vec_id", "row.label", "row.v"), "whole-vectors")
    buckets = max(1, ceil(once.count() / block))
    spread = once.withColumns({
        "bucket": F.pmod(F.xxhash64("vec_id"), F.lit(buckets)), "scores": F.lit(None).cast("array<long>"),
    })
    rows = staged(blocks_of(spread, block), "row-blocks")
    asked = once.where(wanted)
    groups = max(1, ceil(asked.count() / ANCHORS))
    asked = asked.withColumn("bucket", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)))
    anchors = staged(blocks_of(asked.withColumn("scores", F.lit(None).cast("array<long>")), ANCHORS), "anchor-blocks")
    near = against_all(rows, anchors, buckets).mapInPandas(
        lambda batches: tile_positives(batches, positives), "anchor_id long, positive_id long, score long"
    )
    order = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id"))
    best = staged(near.withColumn("place", order - 1).where(F.col("place") < positives), "positives")
    # at most `positives` a row; places without a positive get bounds that nothing meets
    found = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.array_sort(F.collect_list(F.struct("place", "score"))).alias("s")
    )
    bounded = asked.join(staged(found, "positive-scores"), "vec_id").withColumn("scores", F.col("s.score"))
    # blocks hold anchors with equally many positives
    bounded = bounded.withColumn("bucket", F.col("bucket") * (positives + 1) + F.size("scores"))
    ready = staged(blocks_of(bounded, ANCHORS), "bounded-anchors")
    far = against_all(rows, ready, buckets).mapInPandas(
        lambda batches: tile_negatives(batches, negatives), "anchor_id long, place int, negative_id long, score long"
    )
    rank = F.row_number().over(W.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "negative_id"))
    kept = staged(far.withColumn("rank", rank).where(F.col("rank") <= negatives), "negatives")
    named = best.select("anchor_id", "place", "positive_id", F.col("score").alias("positive_score"))
    return kept.withColumnRenamed("score", "negative_score").join(named, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op13_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Anchors: every vec_id divisible by 100. Labels of every vec_id divisible by 7 move on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", label.alias("label"), F.col("embedding").alias("v"))
    return mine(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), once AS (
  SELECT vec_id, label, v FROM fine QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label DESC, v DESC) = 1
), parts AS (
  SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) AS dims FROM once
), anchors AS (
  SELECT * FROM parts WHERE vec_id % 100 = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, any_value(a.label) AS own, any_value(r.label) AS label,
    sum(a.x::HUGEINT * r.x)::BIGINT AS score
  FROM anchors a JOIN parts r ON r.i = a.i AND r.dims = a.dims AND r.vec_id <> a.vec_id
  GROUP BY a.vec_id, r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND label <> own
  AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""
