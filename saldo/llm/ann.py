"""Approximate nearest neighbours by multi-index hashing.

Codes: TABLES learned rotations (iterative quantization on a sample of at most SAMPLE vectors) give
one bit per dimension each. A code is split into substrings of 16 bits. If two codes differ in at most r bits, then at
least one substring differs in at most r / substrings bits, so probing, for each substring, every value within its
share of the radius retrieves every code within r. What is retrieved is checked for its whole distance, and
the true inner products of the original vectors rank it, in double precision.

The radius is learned: the distance that covers COVER of the true neighbours inside the sample, and also COVER
of the true neighbours that ASKED sample vectors have among all vectors of the block, whichever is wider. Where
a block has fewer than k codes in the radius, all its vectors are ranked.

Norms: largest inner products are not nearest directions when norms differ. The index is cut into blocks of
similar norm, the largest at most RATIO times the least, so a few long vectors get a block of their own. Inside
a block each vector gets one more coordinate that lifts it to the block's largest norm.

Scale: the index is cut into blocks of at most BLOCK vectors and BLOCK_BYTES, and the queries into groups of about
GROUP, or down to LEAST where that leaves under TILES pairs. A pair of a block and a group is one task's work and returns
k rows a query. A block travels in parts of PART_BYTES, once to each group, and a group's queries follow in packs of
QUERIES, so a row is never as large as a block, and a task holds one block, its codes and one batch. A query set that
grows with the table, against all its rows, is quadratic in the number of blocks; how many vectors
are ranked depends on how well the data separate at the radius.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do
vectors whose length is not the most frequent one. Rows that repeat a vec_id count once, the
greatest vector; a null vec_id takes no part. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import ceil

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saldo.llm.common import bound_batches
from saldo.session import staged

SAMPLE = 4096
TABLES = 4
COVER = 0.98
ASKED = 256
RATIO = 1.25
BITS = 16
BLOCK = 32768
BLOCK_BYTES = 16 << 20
PART_BYTES = 1 << 19
GROUP, LEAST = 4096, 256
QUERIES = 512
TILES = 24
DEALT = 4096
SLICE = 2048
ROUNDS = 15
COUNT = np.array([bin(i).count("1") for i in range(1 << BITS)], np.uint8)


@dataclass
class Codes:
    """Rotations (dimensions x bits), what the added coordinate weighs in each bit, and the radius."""

    rotation: np.ndarray
    lift: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray, longest: float) -> np.ndarray:
        """Substrings (rows x substrings) of vectors, lifted to the longest norm, SLICE rows at a time."""
        out = np.zeros((len(vectors), self.rotation.shape[1] // BITS), np.uint16)
        for rows in slices(len(vectors)):
            unit = vectors[rows] / (longest or 1.0)
            rest = np.sqrt(np.maximum(0.0, 1.0 - np.square(unit).sum(axis=1)))
            out[rows] = pack_bits(unit @ self.rotation + rest[:, None] * self.lift > 0)
        return out

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        return pack_bits(vectors @ self.rotation > 0)


def pack_bits(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.uint16)


def slices(rows: int) -> Iterator[slice]:
    return (slice(start, start + SLICE) for start in range(0, rows, SLICE))


def learn(sample: np.ndarray, k: int, blocks: int) -> Codes:
    """Rotations by iterative quantization, and the least radius from the sample's own neighbours."""
    rng, unit = np.random.default_rng(7), sample / np.linalg.norm(sample, axis=1, keepdims=True)
    dims, parts = unit.shape[1], []
    for _ in range(TABLES):
        turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        for _ in range(ROUNDS):
            left, _, right = np.linalg.svd(np.where(unit @ turn > 0, 1.0, -1.0).T @ unit)
            turn = (left @ right).T
        parts.append(turn)
    rotation = np.concatenate(parts, axis=1)
    spare = -rotation.shape[1] % BITS
    rotation = np.concatenate([rotation, rng.standard_normal((dims, spare)) / dims**0.5], axis=1)
    codes = Codes(rotation, rng.standard_normal(rotation.shape[1]) / dims**0.5, 0)
    length = np.linalg.norm(sample, axis=1)
    by_length = np.array_split(np.argsort(length, kind="stable"), min(blocks, 16, len(sample)))
    own = np.zeros((len(sample), rotation.shape[1] // BITS), np.uint16)
    for rows in chain.from_iterable(bands(x, length[x]) for x in by_length):  # lifted as in an index block
        own[rows] = codes.of(sample[rows], length[rows].max())
    asked, far = min(len(sample), ASKED), []
    for i, code in enumerate(codes.of_queries(sample[:asked])):
        near = np.multiply(sample, sample[i]).sum(axis=1)
        near[i] = -np.inf
        top = np.argsort(-near, kind="stable")[: min(k, len(sample) - 1)]
        far.append(COUNT[own[top] ^ code].sum(axis=1, dtype=np.int64))
    distances = np.concatenate(far) if far else np.zeros(0, int)
    codes.radius = int(np.quantile(distances, COVER)) if len(distances) else rotation.shape[1]
    return codes


def bands(rows: np.ndarray, length: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in the order of their norms, cut where a norm is over RATIO times the first of its part."""
    while len(rows):
        end = max(1, int(np.searchsorted(length, RATIO * length[0], side="right")))
        yield rows[:end]
        rows, length = rows[end:], length[end:]


def lifted(codes: Codes, vectors: np.ndarray) -> np.ndarray:
    """The codes of a block."""
    return codes.of(vectors, np.sqrt(max(np.square(vectors[rows]).sum(axis=1).max() for rows in slices(len(vectors)))))


def radius_of(
    codes: Codes, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, asked_ids: np.ndarray, asked: np.ndarray, k: int
) -> int:
    """The radius that covers COVER of the k nearest which the asked vectors have in a block with the codes `own`,
    `codes.radius` at least."""
    far = []
    for query_id, query, code in zip(asked_ids, asked, codes.of_queries(asked), strict=True):
        near = vectors @ query
        near[ids == query_id] = -np.inf
        others = len(ids) - np.count_nonzero(ids == query_id)
        if others:
            top = np.argpartition(-near, min(k, others) - 1)[: min(k, others)]
            far.append(COUNT[own[top] ^ code].sum(axis=1, dtype=np.int64))
    return max(codes.radius, int(np.ceil(np.quantile(np.concatenate(far), COVER)))) if far else codes.radius


class Index:
    """One block of vectors and their codes: the rows of each value of each substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, code: np.ndarray, radius: int) -> None:
        self.ids, self.vectors, self.code, self.radius = ids, vectors, code, radius
        self.words = np.ascontiguousarray(np.pad(self.code, ((0, 0), (0, -self.code.shape[1] % 4)))).view(np.uint64)
        self.listed = []
        for column in self.code.T:
            order = np.argsort(column, kind="stable")
            values, first = np.unique(column[order], return_index=True)
            self.listed.append((values, order, np.diff(np.append(first, len(order)))))

    def distance(self, code: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Bits in which rows differ from the code."""
        word = np.pad(code, (0, -len(code) % 4)).view(np.uint64)
        words = self.words if rows is None else self.words[rows]
        out = np.zeros(len(words), np.uint16)
        for i in range(words.shape[1]):
            out += np.bitwise_count(words[:, i] ^ word[i])
        return out

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows at most `radius` bits from the code, by probing every substring's share of the radius. Once
        the probes have retrieved most of the block, the whole block is checked instead."""
        parts = len(self.listed)
        share, more = divmod(radius, parts)
        seen = np.zeros(len(self.ids), bool)
        for i, (values, order, sizes) in enumerate(self.listed):
            reach = share if i <= more else share - 1  # shares that add up to radius - parts + 1 suffice
            if reach >= 0:
                seen[order[np.repeat(COUNT[values ^ code[i]] <= reach, sizes)]] = True
            if 2 * np.count_nonzero(seen) > len(seen):
                return np.flatnonzero(self.distance(code) <= radius)
        rows = np.flatnonzero(seen)
        return rows[self.distance(code, rows) <= radius]

    def nearest(self, query_id: int, query: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, inner products) of the k nearest that the code finds, ties to the smaller id."""
        rows = self.within(code, self.radius)
        rows = rows[self.ids[rows] != query_id]
        if len(rows) < k:
            rows = np.flatnonzero(self.ids != query_id)
        score = np.zeros(len(rows))
        for part in slices(len(rows)):
            score[part] = np.multiply(self.vectors[rows[part]], query).sum(axis=1)
        if len(rows) > k:  # all that reach the k-th score
            top = np.flatnonzero(score >= np.partition(score, -k)[-k])
            rows, score = rows[top], score[top]
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[best]], score[best]


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components are finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def packed(batches: Iterator[pd.DataFrame], size: int, ratio: float = np.inf) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(number, group, ids, vectors) of rows packed into blocks of at most `size` vectors of one group `g`. With a
    ratio, rows come in the order of their norms and a block ends before a norm over `ratio` times its first. The
    arrays are filled anew for the next block."""
    number, n, group, norm, most = TaskContext.get().partitionId() << 32, 0, 0, 0.0, np.inf
    ids, vectors = np.zeros(size, np.int64), np.zeros((0, 0))
    for batch in batches:
        for g, i, v in zip(batch["g"], batch["vec_id"], batch["v"], strict=True):
            if not len(vectors):
                vectors = np.zeros((size, len(v)))
            if ratio < np.inf:
                norm = np.linalg.norm(v)
            if n and (n == size or g != group or norm > most):
                yield number, group, ids[:n], vectors[:n]
                number, n = number + 1, 0
            if not n:
                group, most = g, ratio * norm if ratio < np.inf else ratio
            ids[n], vectors[n] = i, v
            n += 1
    if n:
        yield number, group, ids[:n], vectors[:n]


def search(vectors: DataFrame, wanted: Column, k: int, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every row of (vec_id, v) that `wanted` picks, its own
    vec_id left out."""
    spark = vectors.sparkSession
    bound_batches(spark)
    schema = "query_id long, vec_id long, score double"
    good = vectors.select("vec_id", F.col("v").cast("array<double>").alias("v")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    once = staged(good.groupBy("vec_id").agg(F.max("v").alias("v")), "vectors")
    sizes = once.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    once = once.where(F.size("v") == sizes["n"])
    drawn = once.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec_id", "v").collect()
    wide = 8 * max(1, sizes["n"])  # bytes of a vector
    block, part_rows = max(1, min(block, BLOCK_BYTES // wide)), max(1, PART_BYTES // wide)
    blocks = max(1, ceil(sizes["c"] / block))
    shared = spark.sparkContext.broadcast(learn(np.array([r["v"] for r in drawn]), k, blocks))
    first = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in drawn[:ASKED]]), np.array([r["v"] for r in drawn[:ASKED]])))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    # a range of norms that all rows share is spread by the hash of the id
    ordered = once.repartitionByRange(blocks, norm, F.xxhash64("vec_id")) if blocks > 1 else once.coalesce(1)
    ordered = ordered.sortWithinPartitions(norm, F.xxhash64("vec_id"), "vec_id")

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, _, ids, vectors in packed(batches, block, RATIO):
            own = lifted(shared.value, vectors)
            radius = radius_of(shared.value, own, ids, vectors, *first.value, k)
            for part, start in enumerate(range(0, len(ids), part_rows)):
                body = [x[start : start + part_rows].tobytes() for x in (ids, vectors, own)]
                yield pd.DataFrame([(number, part, *body, radius)], columns=["block", "part", "ids", "vectors", "codes", "radius"])

    parted = "block long, part long, ids binary, vectors binary, codes binary, radius int"
    index = staged(ordered.withColumn("g", F.lit(0)).mapInPandas(measured, parted), "index-blocks")
    left = [r["block"] for r in index.select("block").distinct().collect()]
    asked = once.where(wanted)
    asks = asked.count()
    groups = max(1, ceil(asks / GROUP), min(ceil(asks / LEAST), ceil(TILES / len(left))))

    def bundled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, group, ids, vectors in packed(batches, QUERIES):
            yield pd.DataFrame([(group, number, ids.tobytes(), vectors.tobytes())], columns=["g", "part", "ids", "vectors"])

    numbered = asked.select(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int").alias("g"), "vec_id", "v")
    queries = staged(
        numbered.repartition("g").sortWithinPartitions("g").mapInPandas(bundled, "g int, part long, ids binary, vectors binary"),
        "query-blocks",
    )
    spread = index.withColumns({"g": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), "asks": F.lit(False)})
    asking = queries.withColumns({"block": F.explode(F.array(*[F.lit(x) for x in left]).cast("array<long>")), "asks": F.lit(True)})
    # more partitions than tiles, as some get none; a group's queries come after the parts of the block
    dealt = min(4 * groups * len(left), max(DEALT, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    tiles = spread.unionByName(asking, allowMissingColumns=True).repartition(dealt, "block", "g")
    tiles = tiles.sortWithinPartitions("block", "g", "asks", "part")

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tile, held, index = None, [], None
        for batch in batches:
            for row in batch.itertuples():
                if tile != (row.block, row.g):
                    tile, held, index = (row.block, row.g), [], None
                if not row.asks:
                    held.append((row.ids, row.vectors, row.codes, row.radius))
                    continue
                if index is None:
                    *body, radius = zip(*held, strict=True)
                    ids, vectors, own = (np.frombuffer(b"".join(x), kind) for x, kind in zip(body, (np.int64, np.float64, np.uint16), strict=True))
                    index, held, body = Index(ids, vectors.reshape(len(ids), -1), own.reshape(len(ids), -1), int(radius[0])), [], None
                q_ids = np.frombuffer(row.ids, np.int64)
                asked = np.frombuffer(row.vectors).reshape(len(q_ids), -1)
                out = []
                for q, v, code in zip(q_ids, asked, shared.value.of_queries(asked), strict=True):
                    found, score = index.nearest(q, v, code, k)
                    out.append(pd.DataFrame({"query_id": q, "vec_id": found, "score": score}))
                yield pd.concat(out)

    found = tiles.mapInPandas(look_up, schema)
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_multi_index(embeddings: DataFrame, k: int = 20) -> DataFrame:
    """The 20 nearest of every vector whose vec_id is divisible by 20."""
    return search(embeddings.select("vec_id", F.col("embedding").alias("v")), F.col("vec_id") % 20 == 0, k)
