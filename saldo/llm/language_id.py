"""Language identification by multilingual mixture inference.

Each language has a distribution over hashed letter trigrams (of UTF-8 bytes, lower case, signs and
digits read as blanks), learned from all labelled training texts. In a document every word is a unit
whose likelihood under a language is that of its trigrams; expectation-maximisation estimates the
document's language proportions. The set of languages is chosen by penalised likelihood: languages
join in the order of their proportions while the likelihood gains more than PENALTY * log(words) each.
The prediction is the language with the largest proportion in the chosen set.

Scale: counts are summed per task, then by (language, bucket), BUCKETS rows a language at most, so a
common language meets no single task. The model is languages x BUCKETS numbers, whatever the size
of the corpus, and is broadcast. Documents are predicted where they are read, CELLS trigrams times labels at
a time whatever the lengths of texts and the number of labels.

Defined cases: `und` with score 0 if the text is null, empty or without letters, or if nothing could
be learned. Rows without text or label are not learned from. Ties go to the label that sorts first.
Only the text (and, in learning, its label) is read; other columns never matter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from saldo.llm.common import bound_batches, held_out

BUCKETS = 1 << 16
SMOOTH = 0.1
PENALTY = 2.0
ROUNDS = 6
FLOOR = 0.0
UNKNOWN = "und"
# Trigrams times labels that a task looks at together.
CELLS = 1 << 22
# ASCII signs and digits become blanks; letters and all bytes of other scripts stay.
BLANKS = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def plain_bytes(text: str | None) -> bytes:
    """Words between single blanks, a blank at both ends; empty if there is no letter."""
    if not text:
        return b""
    wide = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(BLANKS) + b" ", np.uint8)
    blank = wide == 32
    body = wide[np.append(True, ~(blank[1:] & blank[:-1]))].tobytes()
    if len(body) < 3 or (not re.search(rb"[a-z]", body) and not any(c.isalpha() for c in text)):
        return b""
    return body


def trigram_buckets(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at each position, and the positions of blanks (a word starts after each)."""
    b = np.frombuffer(data, np.uint8)
    wide = b.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(16), np.flatnonzero(b[:-2] == 32)


def slices(data: bytes, size: int) -> Iterator[bytes]:
    """A text in slices of `size` trigrams; every trigram is in one of them."""
    for low in range(0, len(data) - 2, size):
        yield data[low : low + size + 2]


def count_trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigram counts of a task by language: one row for each bucket met."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            for part in slices(plain_bytes(text), CELLS):
                buckets, _ = trigram_buckets(part)
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, np.int64)
                held[lang] += np.bincount(buckets, minlength=BUCKETS)
    for lang, counts in held.items():
        met = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": met, "n": counts[met]})


@dataclass
class LanguageModel:
    """Labels in order, and log-probabilities (buckets x labels)."""

    labels: list[str]
    weights: np.ndarray


def learn(labelled: DataFrame) -> LanguageModel:
    """Learn from the columns `text` and `lang` of all rows that have both."""
    bound_batches(labelled.sparkSession)
    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).dropna()
    counts = (
        rows.mapInPandas(count_trigrams, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    labels = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS, len(labels)))
    place = {lang: i for i, lang in enumerate(labels)}
    table[counts["bucket"].to_numpy(), counts["lang"].map(place).to_numpy(dtype=int)] = counts["n"]
    table += SMOOTH
    return LanguageModel(labels, np.log(table / table.sum(axis=0)).astype(np.float32))


def units_of(data: bytes, model: LanguageModel, cells: int) -> Iterator[np.ndarray]:
    """Log-likelihoods (words x labels) of a text's words, some words at a time. A word may go through several slices."""
    left = np.zeros(len(model.labels))
    for part in slices(data, max(256, cells // len(model.labels))):
        buckets, blanks = trigram_buckets(part)
        goes_on = not len(blanks) or blanks[0] > 0
        words = np.add.reduceat(model.weights[buckets], np.append(0, blanks) if goes_on else blanks, axis=0).astype(np.float64)
        if goes_on:
            words[0] += left
        elif left.any():
            yield left[None]
        left = words[-1]
        if len(words) > 1:
            yield words[:-1]
    yield left[None]


Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def ready(units: np.ndarray, owner: np.ndarray) -> Block:
    """Words' likelihoods relative to the best label, the logarithm of that label's, and the words' documents."""
    top = units.max(axis=1)
    return np.exp(units - top[:, None]), top, owner


def of_documents(blocks: Iterable[Block], chosen: np.ndarray, n: int) -> Iterator[Block]:
    """The words of the chosen ones of n documents, which are numbered anew."""
    place = np.full(n, -1)
    place[chosen] = np.arange(len(chosen))
    for odds, top, owner in blocks:
        keep = place[owner] >= 0
        if keep.any():
            yield odds[keep], top[keep], place[owner[keep]]


def add_up(total: np.ndarray, values: np.ndarray, owner: np.ndarray) -> None:
    """Add the values of words to the totals of their documents, whose words lie side by side."""
    new = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    total[owner[new]] += np.add.reduceat(values, new, axis=0)


def mix(blocks: Callable[[], Iterable[Block]], sizes: np.ndarray, allowed: np.ndarray, share: np.ndarray):
    """EM over documents: language shares (documents x labels) and log-likelihoods. Each round goes over the blocks of
    words and keeps sums only."""
    share = np.where(allowed, share + 1e-9, 0)
    share /= share.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        total = np.zeros(share.shape)
        for odds, _, owner in blocks():
            part = odds * share[owner]
            part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
            add_up(total, part, owner)
        share = total / sizes[:, None]
    fit = np.zeros(len(sizes))
    for odds, top, owner in blocks():
        add_up(fit, np.log(np.maximum((odds * share[owner]).sum(axis=1), 1e-300)) + top, owner)
    return share, fit


def languages_of(words: Callable[[], Iterable[tuple[np.ndarray, np.ndarray]]], blocks: Callable[[], Iterable[Block]], sizes: np.ndarray, k: int):
    """Chosen sets and shares (documents x labels)."""
    n = len(sizes)
    share, _ = mix(blocks, sizes, np.ones((n, k), bool), np.full((n, k), 1 / k))
    order = np.argsort(-share, axis=1, kind="stable")
    alone = np.zeros((n, k))
    for units, owner in words():
        add_up(alone, units, owner)
    first = alone.argmax(axis=1)
    # the best language alone opens the set; the others follow by their share
    rank = np.where(order == first[:, None], -1, np.arange(k))
    order = np.take_along_axis(order, np.argsort(rank, axis=1, kind="stable"), axis=1)
    allowed = np.zeros((n, k), bool)
    allowed[np.arange(n), first] = True
    best, chosen, shares = alone[np.arange(n), first], allowed.copy(), allowed.astype(float)
    growing = np.ones(n, bool)
    for size in range(1, k):
        allowed[np.arange(n), order[:, size]] = True
        idx = np.flatnonzero(growing & (share[np.arange(n), order[:, size]] * sizes > 0.5))
        if not len(idx):
            break
        got, fit = mix(lambda idx=idx: of_documents(blocks(), idx, n), sizes[idx], allowed[idx], share[idx])
        fit -= size * PENALTY * np.log(sizes[idx] + 1)
        better = fit > best[idx]
        growing[:] = False
        win = idx[better]
        growing[win] = True
        best[win] = fit[better]
        chosen[win], shares[win] = allowed[win], got[better]
    return chosen, shares


def infer(texts, model: LanguageModel, cells: int = CELLS) -> list[tuple[str, float, str]]:
    """(label, score, chosen set) of each text. What is held at once is bounded by `cells`, trigrams times labels: short
    texts go together, and a longer text is read in slices, again in each round."""
    out, k = [(UNKNOWN, 0.0, "")] * len(texts), len(model.labels)

    def settle(group: list[tuple[int, bytes]]) -> None:
        sizes = np.array([data.count(b" ") - 1 for _, data in group])
        if len(group[0][1]) * k > cells:
            def words():
                return ((u, np.zeros(len(u), np.int64)) for u in units_of(group[0][1], model, cells))

            def blocks():
                return (ready(*x) for x in words())
        else:
            held = np.concatenate([u for _, data in group for u in units_of(data, model, cells)]), np.repeat(np.arange(len(group)), sizes)
            made = ready(*held)
            words, blocks = lambda: [held], lambda: [made]
        chosen, shares = languages_of(words, blocks, sizes, k)
        smooth = (shares * sizes[:, None] + 0.5) / (sizes[:, None] + 0.5 * k)
        for row, (i, _) in enumerate(group):
            j = int(shares[row].argmax())
            out[i] = (model.labels[j], float(smooth[row, j]), ",".join(model.labels[c] for c in np.flatnonzero(chosen[row])))

    group: list[tuple[int, bytes]] = []
    filled = 0
    for i, text in enumerate(texts) if k else ():
        if data := plain_bytes(text):
            if group and filled + len(data) * k > cells:
                settle(group)
                group, filled = [], 0
            group.append((i, data))
            filled += len(data) * k
    if group:
        settle(group)
    return out


RESULT = StructType([
    StructField("lang", StringType()), StructField("score", DoubleType()), StructField("languages", StringType()),
])


def language_of(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """Struct (lang, score, languages) of a text column."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(infer(texts.tolist(), shared.value), columns=RESULT.names)

    return F.pandas_udf(predict, RESULT)(text.cast("string"))


def learn_outside(documents: DataFrame) -> LanguageModel:
    """Learn from the documents that are not held out."""
    return learn(documents.where(~held_out(F.col("doc_id"))))


def op4_language(documents: DataFrame) -> DataFrame:
    """Every document's language; the model never sees held-out rows."""
    model = learn_outside(documents)
    found = language_of(documents.sparkSession, model, F.col("text"))
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("p"))
    return rows.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.languages").alias("languages"),
    )


def keep_known_language(documents: DataFrame, floor: float = FLOOR) -> DataFrame:
    """Documents whose main language is known. No share is asked for unless a `floor` is given: the smoothed share
    falls with the number of labels and of languages in a text, so it says little about how clean a text is."""
    model = learn_outside(documents)
    found = language_of(documents.sparkSession, model, F.col("text"))
    return documents.where((found["lang"] != UNKNOWN) & (found["score"] >= floor))
