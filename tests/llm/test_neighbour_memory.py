"""What op9 holds and sends at once, independent of how large a block is."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("pandas")

from saldo.llm import ann


def test_a_block_is_coded_in_slices():
    rnd = np.random.default_rng(3)
    vectors = rnd.standard_normal((ann.BLOCK, 64))
    codes = ann.Codes(rnd.standard_normal((64, 256)), rnd.standard_normal(256), 0)
    tracemalloc.start()
    try:
        got = ann.lifted(codes, vectors)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 32 << 20  # over 200 MB at once before
    unit = vectors / np.linalg.norm(vectors, axis=1).max()
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.square(unit).sum(axis=1)))
    want = ann.pack_bits(unit @ codes.rotation + rest[:, None] * codes.lift > 0)
    assert got.dtype == want.dtype and np.mean(got == want) > 0.9999  # a product may round otherwise


def test_blocks_travel_in_parts_and_once_a_group(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    vectors = rnd.standard_normal((6000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<double>")
    kept, staged = {}, ann.staged
    monkeypatch.setattr(ann, "staged", lambda rows, name: kept.setdefault(name, staged(rows, name)))
    got = ann.search(df, F.col("vec_id") % 10 == 0, 20, sample=500)
    index, asked = kept["index-blocks"], kept["query-blocks"]
    assert index.agg(F.max(F.octet_length("vectors"))).first()[0] <= 1 << 19  # a whole block, 3 MB, before
    assert index.agg(F.sum(F.octet_length("ids"))).first()[0] == 6000 * 8
    assert asked.agg(F.sum(F.octet_length("ids"))).first()[0] == 600 * 8
    assert got.count() == 600 * 20 and got.select("query_id").distinct().count() == 600
    # with several blocks and groups every pair is looked at: neighbours come from all blocks
    monkeypatch.setattr(ann, "LEAST", 100)
    few = ann.search(df, F.col("vec_id") % 10 == 0, 20, block=1500, sample=500).collect()
    best = {}
    for r in few:
        best.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = 0
    for q, found in best.items():
        score = vectors @ vectors[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & set(found))
    assert len(best) == 600 and all(len(set(x)) == 20 for x in best.values()) and hits >= 0.95 * 20 * 600
