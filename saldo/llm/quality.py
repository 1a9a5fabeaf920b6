"""Quality by a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or nothing on every document; most look for one defect and
say nothing where it is missing. Expectation-maximisation over the votes estimates each labeller's accuracy
(how often it is right when it votes, within BOUNDS) and the share of good documents, without any given label. The posteriors of a bounded sample of documents
train a logistic scorer over hashed trigrams of character classes, which then scores every document.

Scale: documents are summed per vote pattern before anything leaves the executors; there are at most
3 ** labellers patterns, whatever the corpus. The scorer is fitted on SAMPLE documents at most (those with the
least hash of their id), BUCKETS numbers each. Both scans read each text once, where it lies.

Defined cases: a null or empty text is bad: posterior and score 0. A null doc_id is carried. Repeated rows
get a result each. With no votes at all every posterior is the prior. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import bound_batches
from saldo.session import staged

BUCKETS = 4096
SAMPLE = 4096
KEEP = 0.5
BOUNDS = (0.7, 0.99)
SIGNS = b"#$%&*!|=_~^<>{}[]\\/+@"
NO_SIGNS = bytes(c for c in range(256) if c not in SIGNS)
NO_DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)
NO_CAPITALS = bytes(c for c in range(256) if not 65 <= c <= 90)
NO_LETTERS = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122 or c > 127))
# Character classes: capital, small or foreign letter, digit; blanks and signs stay what they are.
CLASSES = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c > 127 else 48 if 48 <= c <= 57 else c for c in range(256)
)


# First bytes of characters of three bytes; where they fill a text, blanks part clauses rather than words.
NOT_WIDE = bytes(c for c in range(256) if not 0xE0 <= c <= 0xEF)
ENDS = tuple(x.encode() for x in (".", "?", "!", ":", "。", "？", "！", "：", "．", "।", "۔", "؟", "។", "။", "።"))


def defect(value: float, bad: float) -> int:
    """-1 from `bad` on, else 0."""
    return -1 if value >= bad else 0


def repeats(words: list[bytes]) -> float:
    """Share of words that equal the one before."""
    return sum(map(eq, words, islice(words, 1, None))) / max(1, len(words))


def by_signs(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    return defect(len(data.translate(None, NO_SIGNS)) / len(data), 0.06)


def by_capitals(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    letters = len(data.translate(None, NO_LETTERS))
    return defect(len(data.translate(None, NO_CAPITALS)) / max(20, letters), 0.3)


def by_signed_words(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    signed = sum(w[-1] in SIGNS for w in words)
    return defect(signed / max(5, len(words)), 0.15)


def by_lone_signs(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    alone = sum(len(w) == 1 and w in SIGNS for w in words)
    return defect(alone / max(5, len(words)), 0.08)


def by_sentences(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    closed = sum(x.rstrip().endswith(ENDS) for x in lines)
    share = closed / max(1, len(lines))
    return 1 if share >= 0.7 else -1 if share <= 0.2 else 0


def by_repeated_lines(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    return defect(1 - len(set(lines)) / len(lines), 0.3) if len(lines) > 3 else 0


def by_commonest_word(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    return defect(Counter(words).most_common(1)[0][1] / len(words), 0.25) if len(words) > 20 else 0


def by_repeated_words(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    return defect(repeats(words), 0.15) if len(words) > 4 else 0


def by_word_length(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    if len(words) <= 4 or 6 * len(data.translate(None, NOT_WIDE)) > len(data):
        return 0
    return defect(abs(sum(map(len, words)) / len(words) - 6.5), 6)


def by_digits(data: bytes, words: list[bytes], lines: list[bytes]) -> int:
    return defect(len(data.translate(None, NO_DIGITS)) / len(data), 0.2)


LABELLERS = (
    by_signs, by_capitals, by_signed_words, by_lone_signs, by_sentences, by_repeated_lines, by_commonest_word,
    by_repeated_words, by_word_length, by_digits,
)


def votes(data: bytes, words: list[bytes]) -> int:
    """All votes on a text as one number in base 3 (0 bad, 1 nothing, 2 good); -1 if it has no word."""
    if not words:
        return -1
    lines = [x for x in data.split(b"\n") if x.strip()]
    pattern = 0
    for labeller in LABELLERS:
        pattern = 3 * pattern + 1 + labeller(data, words, lines)
    return pattern


def spread(patterns: np.ndarray) -> np.ndarray:
    """Votes (patterns x labellers) of pattern numbers."""
    powers = 3 ** np.arange(len(LABELLERS))[::-1]
    return patterns[:, None] // powers % 3


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of 'good' of each pattern, by EM from equal accuracies."""
    cast = spread(patterns) - 1
    accuracy, share = np.full(cast.shape[1], 0.85), 0.5
    posterior = np.full(len(patterns), share)
    for _ in range(rounds if len(patterns) else 0):
        odds = np.log(share / (1 - share)) + cast @ np.log(accuracy / (1 - accuracy))
        new = 1 / (1 + np.exp(-odds))
        right = np.where(cast > 0, new[:, None], 1 - new[:, None])
        weight = counts[:, None] * (cast != 0)
        accuracy = np.clip(((weight * right).sum(axis=0) + 1.6) / (weight.sum(axis=0) + 2), *BOUNDS)
        share = float(np.clip((counts @ new + 1) / (counts.sum() + 2), 0.05, 0.95))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return posterior


def features(data: bytes, words: list[bytes]) -> np.ndarray:
    """Square roots of the shares of hashed character-class trigrams and, last, of repeated words."""
    out = np.zeros(BUCKETS + 1, np.float32)
    wide = np.frombuffer(data.translate(CLASSES), np.uint8).astype(np.uint32)
    if len(wide) >= 3:
        code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
        bucket = (code * np.uint32(2654435761)) >> np.uint32(20)
        out[:BUCKETS] = np.sqrt(np.bincount(bucket, minlength=BUCKETS) / len(bucket))
    out[BUCKETS] = repeats(words) ** 0.5
    return out


def measured(texts) -> tuple[np.ndarray, list[np.ndarray]]:
    """Votes and features of texts."""
    cast, found = [], []
    for text in texts:
        data = text.encode("utf-8", "replace") if text else b""
        words = data.split()
        cast.append(votes(data, words))
        found.append(features(data, words))
    return np.array(cast, np.int64), found


def fit(table: np.ndarray, target: np.ndarray, rounds: int = 200, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by gradient descent with momentum."""
    weight, bias = np.zeros(table.shape[1], np.float32), 0.0
    speed, lift = np.zeros_like(weight), 0.0
    for _ in range(rounds if len(table) else 0):
        error = (1 / (1 + np.exp(-(table @ weight + np.float32(bias)))) - target).astype(np.float32)
        speed = np.float32(0.9) * speed - np.float32(2.0) * (error @ table / len(table) + np.float32(decay) * weight)
        lift = 0.9 * lift - 2.0 * error.mean()
        weight, bias = weight + speed, bias + lift
    return weight, bias


def quality(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, votes, posterior, score, keep) of every document."""
    spark = documents.sparkSession
    bound_batches(spark)
    kind = documents.schema["doc_id"].dataType.simpleString()
    slim = documents.select("doc_id", F.col("text").cast("string").alias("text"))

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [x.encode("utf-8", "replace") if x else b"" for x in batch["text"]]
            yield pd.DataFrame({"draw": batch["draw"], "votes": [votes(x, x.split()) for x in texts]})

    draw = F.xxhash64("doc_id", F.lit("sample"))
    cast = staged(slim.select(draw.alias("draw"), "text").mapInPandas(vote, "draw long, votes int"), "votes")
    counted = cast.where("votes >= 0").groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    patterns = np.array([r["votes"] for r in counted], np.int64)
    posterior = label_model(patterns, np.array([r["n"] for r in counted], float))
    chosen = cast.where("votes >= 0").orderBy("draw").limit(sample).agg(F.max("draw").alias("m")).first()["m"]

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cast, x = measured(batch["text"])
            yield pd.DataFrame({"votes": cast, "x": [v.tobytes() for v in x]})

    drawn = slim.where(draw <= F.lit(chosen if chosen is not None else 0)).select("text")
    rows = [r for r in drawn.mapInPandas(featured, "votes int, x binary").limit(sample).collect() if r["votes"] >= 0]
    table = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]) if rows else np.zeros((0, BUCKETS + 1), np.float32)
    weight, bias = fit(table, posterior[np.searchsorted(patterns, [r["votes"] for r in rows])] if rows else np.zeros(0))
    model = spark.sparkContext.broadcast((patterns, posterior, weight.astype(np.float32), bias))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, believed, w, b = model.value
        for batch in batches:
            cast, found = measured(batch["text"])
            empty = cast < 0
            at = np.searchsorted(known, np.where(empty, known[0] if len(known) else 0, cast))
            trust = np.where(empty, 0.0, believed[np.minimum(at, len(known) - 1)] if len(known) else 0.0)
            raw = np.array([x @ w for x in found], np.float64) + b
            grade = np.where(empty, 0.0, 1 / (1 + np.exp(-raw)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "votes": cast, "posterior": trust, "score": grade, "keep": grade >= KEEP})

    return slim.mapInPandas(score, f"doc_id {kind}, votes long, posterior double, score double, keep boolean")


def op3_quality(documents: DataFrame) -> DataFrame:
    """Every document with its label posterior, its score and whether it stays."""
    return quality(documents).select("doc_id", "posterior", "score", "keep")
