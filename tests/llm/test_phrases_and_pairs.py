"""Collocations, b-bit MinHash and hard negatives against brute force, with odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from saldo.llm import bbit_minhash, bitmap, collocations, hard_negatives

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_bitmap_lets_every_key_through(spark):
    keys = spark.range(500).select(F.concat(F.lit("k"), "id").cast("binary").alias("k"))
    words = bitmap.bitmap(keys, bitmap.bit_of(F.col("k"))).value
    assert all(bitmap.passes(words, f"k{i}".encode()) for i in range(500))
    assert sum(bitmap.passes(words, f"other{i}".encode()) for i in range(500)) < 5


# op11


def brute_collocations(rows, top, fewest):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) == 1 or a < fewest:
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in counts.items() if len(q) == 3 and b >= fewest and len(p) == 2 and p in (q[:2], q[1:])]
            if not any(100 * b >= 50 * a for b in longer):
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("top,wave,size", [(2000, 8000, 4 << 20), (7, 3, 300), (1, 1, 40)])
def test_op11_is_brute_force(spark, top, wave, size):
    rnd = random.Random(top)
    words = ["New", "new", "york", "CITY", "é", "日本", "a", "b", "of", "the", "\x0b", " ", "x y", "İ"]
    rows = []
    for _ in range(60):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "?"]) for _ in range(rnd.randint(0, 60)))
        rows.append((text, rnd.choice(["en", "en", "en", "fr", None, "und"])))
    rows += rows[:5] + [(None, "en"), ("", "fr"), ("word " * 3000, "long"), ("x" * 50_000 + " y", "long"), ("no end" * 5, None)]
    docs = spark.createDataFrame([(t, l, "p", 1) for t, l in rows], "text string, lang string, phrase string, f int").repartition(5)
    got = collocations.collocations(docs, top=top, fewest=3, wave=wave, size=size)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, top, 3)


def test_op11_opens_only_what_can_reach_the_top(spark):
    """Closed prefixes are not grown, and ties at the last place are all settled."""
    rows = [(f"a{i} b{i}. " * 5, "en") for i in range(30)] + [(f"hot x{i}. hot y{i}. " * 4, "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = collocations.collocations(docs, top=10, fewest=3, wave=2)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 10, 3)


def test_op11_slices_carry_words_over():
    words = collocations.Words()
    text = b"a b c a b c a b\nb c a b"
    want = Counter()
    for piece in text.split(b"\n"):
        p = piece.split()
        want.update(tuple(p[i : i + 3]) for i in range(len(p) - 2))
    got = Counter()
    for part in collocations.slices(text, 2):
        words.add(part)
        names = list(words.number)
        rows, f = words.counts(3)
        for row, n in zip(rows.tolist(), f.tolist(), strict=True):
            got[tuple(names[i] for i in row)] += n
        words = words.rest()
    assert got == want


class LocalTexts:
    """Texts whose tasks run in this process."""

    def __init__(self, spark, texts):
        self.spark, self.batch = spark, pa.RecordBatch.from_pylist([{"lang": "en", "text": t.encode()} for t in texts])

    def mapInArrow(self, work, schema):
        return self.spark.createDataFrame(pa.Table.from_batches(work(iter([self.batch]))))


def test_op11_hashes_words_and_no_pairs(spark, monkeypatch):
    """A slice's distinct words are hashed once each, whatever the number of its pairs; what the bitmaps hold still passes."""
    rnd = random.Random(2)
    names = [f"wé{i}" for i in range(200)]
    text = rnd.choices(names, k=6000)
    kept, opened = set(names[:150]), {(names[i], names[j]) for i in range(0, 150, 3) for j in range(0, 150, 5)}
    words = spark.createDataFrame([("en", w) for w in kept], "lang string, phrase string")
    pairs = spark.createDataFrame([("en", " ".join(p)) for p in opened], "lang string, phrase string")
    known, filter_ = bitmap.bitmap(words, collocations.word_bit()), bitmap.bitmap(pairs, collocations.pair_bit())
    calls, plain = [], xxhash.xxh64_intdigest
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *a: (calls.append(1), plain(*a))[1])
    found = collocations.count_phrases(LocalTexts(spark, ["  ".join(text)]), 3, known, filter_)
    want = Counter(t for t in zip(text, text[1:], text[2:], strict=False) if kept.issuperset(t) and (t[:2] in opened or t[1:] in opened))
    assert {tuple(r["phrase"].split(" ")): r["f"] for r in found.collect()} == want and len(want) > 100
    assert len(calls) <= 2 + len(names)


# op12


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute_near(rows):
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[top(i)].append(doc_id)
    least = {i: min((x for x in ids if x is not None), default=None) for i, ids in groups.items()}
    return sorted((str(d), len(s), str(least[top(i)]), d == least[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("crowd", [2, bbit_minhash.CROWD])
def test_op12_is_brute_force(spark, crowd):
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 200))]
        for _ in range(12):  # edits around the threshold, also of edited ones
            edited = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 20))):
                edited[rnd.randrange(len(edited))] = rnd.choice(vocabulary)
            texts.append(" ".join(edited))
            if rnd.random() < 0.3:
                base = edited
    shared = " ".join(rnd.choice(vocabulary) for _ in range(80))
    texts += [f"{shared} {rnd.choice(vocabulary)} {' '.join(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 40)))}" for _ in range(60)]
    texts += [None, "", " \t", "one", "ONE", "one two", "one  two", "a b c " * 20_000, "  é", texts[0].upper(), texts[0]]
    rows = [*enumerate(texts), (None, texts[0]), (None, "alone stands this text"), (None, None), (3, texts[3]), (3, "again an id")]
    docs = spark.createDataFrame([(d, t, 5, "k") for d, t in rows], "doc_id long, text string, n int, key string")
    got = bbit_minhash.near_duplicates(docs, crowd=crowd).collect()
    want = brute_near([(d, t) for d, t in rows])
    # rows with unknown ids are kept if nothing in their component is known
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == want


def test_op12_estimate_is_corrected():
    rng = np.random.default_rng(3)
    shared, one, two = (rng.integers(0, 1 << 63, n, np.uint64) for n in (800, 100, 100))
    packs = [bbit_minhash.pack_low_bits(bbit_minhash.minima(np.concatenate([shared, x]))) for x in (one, two)]
    differ, agree = packs[0] ^ packs[1], bbit_minhash.PLANES
    for word in differ.tolist():
        agree -= sum(word >> 4 * i & 15 != 0 for i in range(16))
    assert abs(bbit_minhash.estimate(agree) - 0.8) < 0.12
    assert bbit_minhash.estimate(bbit_minhash.PLANES) == 1.0
    assert bbit_minhash.estimate(bbit_minhash.fewest_agreeing()) < 0.7


# op13


def test_op13_packed_products_are_exact():
    rng = np.random.default_rng(1)
    for high in (1, 3, 300, 1 << 20, 1 << 31, 1 << 40, 1 << 62):
        for dims in (0, 1, 5, 64):
            a, r = rng.integers(-high, high + 1, (7, dims)), rng.integers(-(high // 2), high, (23, dims))
            plain = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in r] for p in a]
            want = np.array([[max(-(1 << 63), min((1 << 63) - 1, x)) for x in p] for p in plain], np.int64)
            assert (np.concatenate([s for _, s in hard_negatives.packed_products(a, r, 3)]) == want).all()


def brute_negatives(rows, positives, negatives):
    held = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        whole = [max(-(1 << 63), min((1 << 63) - 1, int(np.floor(256 * float(x))))) for x in v]
        held[vec_id] = max(held.get(vec_id, (label, whole)), (label, whole))
    out = []
    for anchor, (label, v) in held.items():
        if anchor % 100:
            continue
        score = {}
        for other, (_, w) in held.items():
            if other != anchor and len(v) == len(w):
                score[other] = max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(v, w, strict=True))))
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if held[i][0] == label][:positives]:
            far = [i for i in order if held[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(anchor, p, rank, i, score[p], score[i]) for rank, i in enumerate(far[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [40, hard_negatives.BLOCK])
def test_op13_is_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rnd = random.Random(13)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3, 9]), [rnd.choice([-0.5, 0.25, 0.5, 0.75, rnd.uniform(-1, 1)]) for _ in range(4)]) for i in range(0, 1500, 5)]
    rows += [(100, 9, [9.0, 1.0, 1.0, 1.0]), (100, 1, [0.5] * 4), rows[3], (None, 1, [1.0] * 4), (200_000, None, [1.0] * 4), (300_000, 1, None)]
    rows += [(i, 1, [1.0, bad, 1.0, 1.0]) for i, bad in ((400_000, None), (500_000, float("nan")), (600_000, float("inf")))]
    rows += [(i, i % 3, [float(i % 5), 1.0]) for i in range(10_000, 10_220, 4)] + [(20_000, 1, []), (20_001, 1, []), (20_002, 2, [])]
    rows += [(30_000 + i, i % 2, [1e30, -1e25, 1e17 * i]) for i in range(0, 120, 20)]
    rows += [(40_000 + 20 * i, i % 2, [1e7 - 6e5 * i, 1.0, -1.0, 0.5, 3.0]) for i in range(16)]  # beyond 64 bits a field
    frame = spark.createDataFrame([(i, l, v, 1, 2) for i, l, v in rows], "vec_id long, label int, embedding array<double>, bucket int, rank int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    named = frame.select("vec_id", label.alias("label"), F.col("embedding").alias("v"), "bucket", "rank")
    got = hard_negatives.mine(named, F.col("vec_id") % 100 == 0, 5, 10, block)
    want = brute_negatives(rows, 5, 10)
    assert len(want) > 100 and any(r[0] >= 30_000 for r in want)
    assert sorted(map(tuple, got.collect())) == want
