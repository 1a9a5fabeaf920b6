"""Language inference against EM written plainly, and what it holds at once."""

from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np

from saldo.llm import language_id
from saldo.llm.language_id import BUCKETS, PENALTY, ROUNDS, LanguageModel


def made_model(labels: int, seed: int = 1) -> LanguageModel:
    rnd = np.random.default_rng(seed)
    table = rnd.gamma(0.3, size=(BUCKETS, labels)) + 1e-3
    return LanguageModel([f"l{i:03d}" for i in range(labels)], np.log(table / table.sum(axis=0)).astype(np.float32))


def plain_units(text: str, model: LanguageModel) -> list[list[float]]:
    """Log-likelihood of each word, a word being the trigrams that begin between two blanks."""
    data, units = language_id.plain_bytes(text), []
    for i in range(len(data) - 2):
        if data[i] == 32:
            units.append([0.0] * len(model.labels))
        code = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
        row = model.weights[(code * 2654435761 & 0xFFFFFFFF) >> 16]
        units[-1] = [a + float(b) for a, b in zip(units[-1], row, strict=True)]
    return units


def plain_mix(units, allowed, share):
    share = [s + 1e-9 if a else 0.0 for s, a in zip(share, allowed, strict=True)]
    share = [s / sum(share) for s in share]
    for _ in range(ROUNDS):
        total = [0.0] * len(share)
        for u in units:
            top = max(u)
            part = [math.exp(x - top) * s for x, s in zip(u, share, strict=True)]
            whole = max(sum(part), 1e-300)
            total = [t + p / whole for t, p in zip(total, part, strict=True)]
        share = [t / len(units) for t in total]
    fit = sum(math.log(max(sum(math.exp(x - max(u)) * s for x, s in zip(u, share, strict=True)), 1e-300)) + max(u) for u in units)
    return share, fit


def plain_infer(text: str, model: LanguageModel) -> tuple[str, float, str]:
    units, k = plain_units(text, model), len(model.labels)
    n = len(units)
    share, _ = plain_mix(units, [True] * k, [1 / k] * k)
    alone = [sum(u[j] for u in units) for j in range(k)]
    first = max(range(k), key=lambda j: (alone[j], -j))
    order = [first, *(j for j in sorted(range(k), key=lambda j: (-share[j], j)) if j != first)]
    best, chosen, shares = alone[first], {first}, [float(j == first) for j in range(k)]
    for size in range(1, k):
        if share[order[size]] * n <= 0.5:
            break
        names = set(order[: size + 1])
        got, fit = plain_mix(units, [j in names for j in range(k)], share)
        if fit - size * PENALTY * math.log(n + 1) <= best:
            break
        best, chosen, shares = fit - size * PENALTY * math.log(n + 1), names, got
    j = max(range(k), key=lambda j: (shares[j], -j))
    return model.labels[j], (shares[j] * n + 0.5) / (n + 0.5 * k), ",".join(model.labels[c] for c in sorted(chosen))


def test_infer_equals_plain_em_whatever_the_slices():
    rnd, model = random.Random(4), made_model(4)
    letters = "abcdefgh éñ字が. 7"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 300))) for _ in range(40)]
    texts += ["x" * 1500, "字" * 500, "a", "a b", "Σα ΑΣ"]
    texts += ["".join(rnd.choice("ab") for _ in range(2500)) + " tail of words"]
    want = [plain_infer(t, model) if language_id.plain_bytes(t) else ("und", 0.0, "") for t in texts]
    for cells in (1 << 22, 6000, 1):
        got = language_id.infer(texts, model, cells)
        assert [(g[0], g[2]) for g in got] == [(w[0], w[2]) for w in want], cells
        assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-4), cells


def test_infer_holds_a_bounded_part_of_long_texts_and_many_labels():
    rnd, model = random.Random(5), made_model(60)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(500)]
    made = lambda size: " ".join(rnd.choice(words) for _ in range(size // 6))
    # the first label knows these words, so that few labels join
    buckets, _ = language_id.trigram_buckets(language_id.plain_bytes(made(1 << 16)))
    known = np.bincount(buckets, minlength=BUCKETS) + 0.1
    model.weights[:, 0] = np.log(known / known.sum())
    peaks = []
    for size in (1 << 15, 1 << 18):
        text = made(size)
        tracemalloc.start()
        assert language_id.infer([text], model, 1 << 16)[0][0] == "l000"
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    # all trigrams by all labels would be 63 MB; what grows are plain copies of the text itself
    assert peaks[0] < 8 << 20 and peaks[1] < peaks[0] + 12 * (1 << 18)
