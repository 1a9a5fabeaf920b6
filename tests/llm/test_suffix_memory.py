"""What a task of op5 holds at once."""

from __future__ import annotations

import random
import tracemalloc
from itertools import pairwise

import numpy as np
import pandas as pd
import pytest
import zstandard

from saldo.llm import suffix_dedup


def peak(work) -> int:
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


@pytest.fixture(scope="module")
def shard():
    """A shard of the usual size: texts of which every second one holds a stretch of another."""
    rnd, texts = random.Random(4), []
    size = 0
    while size < suffix_dedup.SHARD_BYTES:
        text = "".join(rnd.choices("abcdefgh  \n", k=rnd.randint(0, 6000)))
        texts.append(text if len(texts) % 2 else text + "".join(texts[-1:])[:500])
        size += len(texts[-1])
    ends = np.cumsum([len(x) for x in texts])
    body = zstandard.ZstdCompressor().compress("".join(texts).encode())
    return pd.DataFrame({
        "shard": [1], "docs": [suffix_dedup.pack(np.arange(len(texts)), "<i8")], "ends": [suffix_dedup.pack(ends, "<i8")], "body": [body],
    })


def test_a_shard_is_read_in_blocks(shard):
    """Several arrays of eight bytes for each of the shard's 4 MB of places took 116 MB."""
    sent = pd.concat(suffix_dedup.send_anchors(1, 32)(iter([shard])))
    told = [{"bucket": b, "keys": k, "often": np.zeros(len(f), np.uint8).tobytes()} for b, k, f in zip(sent["bucket"], sent["keys"], sent["flags"], strict=True)]
    assert peak(lambda: [None for _ in suffix_dedup.send_anchors(1, 32)(iter([shard]))]) < 48 << 20
    dealt = shard.assign(found=[told])
    assert peak(lambda: [None for _ in suffix_dedup.send_segments(1, 64)(iter([dealt]))]) < 80 << 20


def test_marks_take_a_byte_a_place(shard):
    rnd = np.random.default_rng(2)
    begins = rnd.integers(0, suffix_dedup.SHARD_BYTES - 500, 20_000)
    stops = begins + rnd.integers(50, 500, len(begins))
    found = [{"begins": suffix_dedup.pack(begins, "<u4"), "stops": suffix_dedup.pack(stops, "<u4")}]
    marked = shard.assign(found=[found], giant=None, piece=None)
    assert peak(lambda: list(suffix_dedup.take_out(suffix_dedup.SHARD_BYTES, False)(iter([marked])))) < 24 << 20


def test_stretches_mark_what_they_cover():
    rnd = random.Random(8)
    for size in (0, 1, 40, 200):
        for n in (0, 1, 3, 12):
            pairs = [sorted(rnd.sample(range(size + 1), 2)) for _ in range(n if size else 0)]
            want = [any(a <= i < b for a, b in pairs) for i in range(size)]
            begins, stops = (np.array([p[k] for p in pairs], "<u4") for k in (0, 1))
            assert suffix_dedup.covered(size, begins, stops).tolist() == want


def test_runs_do_not_depend_on_blocks(monkeypatch):
    rnd = random.Random(9)
    data = np.frombuffer(bytes(rnd.choice(b"ab") for _ in range(900)) + b"c" * 900, np.uint8)
    ends = np.cumsum([0, 300, 20, 0, 49, 231, 50, 250, 900])
    monkeypatch.setattr(suffix_dedup, "RUN", 64)
    whole = suffix_dedup.runs(data, ends)
    keys, inside = suffix_dedup.anchors(data), np.ones(len(data) - 49, bool)
    for a, b in pairwise([0, *ends]):
        inside[max(a, b - 49) : b] = False
    assert [p for a, b in zip(*whole[1:], strict=True) for p in range(a, b)] == np.flatnonzero(inside).tolist()
    assert all((keys[a:b] == k).all() and b - a <= 64 for k, a, b in zip(*whole, strict=True))
    for block in (1, 7, 64, 1000):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        assert all((x == y).all() for x, y in zip(whole, suffix_dedup.runs(data, ends), strict=True))
