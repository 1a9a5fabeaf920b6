"""Benchmark decontamination: rare n-gram seeds join documents to test items, then Smith-Waterman alignment.

Words are runs of letters and digits in lower case; in scripts written without blanks each character is a word
of its own. A passage of a document is aligned with a test item (match +2, other word -1, gap -1). A document is
contaminated by an item if the local score reaches half of the item's perfect score, or 20 matched words; items of under
MIN_WORDS words must stand in it word for word.

Seeds are pairs of words that are neighbours or have one word between them. Take any alignment of score T, and
its matched words in order. A step from one to the next without another word between costs nothing, one with one word
between (replaced, left out or put in) costs 1, a longer one 2 or more; so T is at most 2 + 2 * (steps of the first kind) + (steps
of the second), and the two kinds of steps are pairs that item and text share. Each step begins at a place of the item
of its own. So the places of an item can be seeds with the weight T - 2 in all, and whatever seeds an item gives up, at a
loss of 2 a place, an alignment still holds the rest of that weight. An item gives up its most frequent pairs within
the benchmark, DROPPED of the weight; the rarer rest must be met. No alignment is lost, and what is found
in a document never depends on other documents.

Scale: documents are staged with row numbers, the only time they are read. One pass looks pairs up in a bitmap
of 4 MB, whatever the benchmark's size; its hits join the seeds by key, and are summed per document, item and
stretch of text. Two stretches side by side always hold a whole alignment. Only documents with a stretch of enough weight
are read again, by row number, and only those stretches are joined to their items and aligned. Nothing is collected but
the bitmap. Long texts are taken apart in segments.

Defined cases: null or empty texts, null or empty items and items without an id match nothing. Items with
equal words count as one, the least item_id. Repeated rows of documents give repeated results. A null doc_id is carried.
An empty benchmark gives an empty result. Pairs are told apart by 64-bit hashes, which only choose what is aligned; words are
aligned as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saldo.llm.bitmap import MASK, bitmap, passing
from saldo.llm.common import BATCH_ROWS, bound_batches
from saldo.session import staged

MIN_WORDS = 5
SHARE = 0.5
ENOUGH_WORDS = 20
MATCH, OTHER, GAP = 2, -1, -1
DROPPED = 2 / 3  # of an item's weight, given up by its most frequent pairs
SEGMENT = 1 << 19  # characters of a text handled at once
WORDS = 1 << 17  # words handled at once
# Scripts that are written without blanks: Thai, Lao, Burmese, Khmer, kana, Han.
NO_BLANKS = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e50-\u0e59\u0e81-\u0ecd\u0ed0-\u0edf\u1000-\u1049\u1050-\u109f\u1780-\u17d3\u17e0-\u17e9"
    "\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
    "\U0001b000-\U0001b16f\U00020000-\U000323af"
)
WORD = re.compile(rf"[{NO_BLANKS}]|[^\W_{NO_BLANKS}]+")
BLANK = re.compile(r"\s")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def segments(text: str | None) -> Iterator[list[str]]:
    """The words of a text in parts, cut at blanks."""
    at, text = 0, text or ""
    while at < len(text):
        cut = BLANK.search(text, at + SEGMENT) if at + SEGMENT < len(text) else None
        end = cut.start() + 1 if cut else len(text)
        yield words_of(text[at:end])
        at = end


def hashes(words: list[str]) -> np.ndarray:
    """A 64-bit number of each word, never 0."""
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    numbers = np.fromiter((xxhash.xxh64_intdigest(w) or 1 for w in distinct), np.uint64, len(distinct))
    return numbers[codes] if len(words) else np.empty(0, np.uint64)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One key for two words in order; a single word is paired with zeros."""
    with np.errstate(over="ignore"):
        mixed = first * np.uint64(0x9E3779B97F4A7C15) + second
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ mixed >> np.uint64(32)).view(np.int64)


def seeds_from(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words apart, keys, places) of all pairs that are neighbours or next but one, and of single words (0 apart). A word
    of number 0 is in no pair."""
    for apart in (0, 1, 2):
        first, second = numbers[: len(numbers) - apart], numbers[apart:]
        places = np.flatnonzero((first != 0) & (second != 0))
        other = second[places] if apart else np.zeros(len(places), np.uint64)
        yield apart, pair_keys(first[places], other), places


def needed(words: int) -> float:
    """The score that an item of so many words must reach."""
    return MATCH * words if words < MIN_WORDS else min(SHARE * MATCH * words, MATCH * ENOUGH_WORDS)


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local score and its (item, text) end, one row of cells at a time. Gaps along a row are a running
    maximum, as they cost the same per word."""
    steps = np.arange(1, len(text) + 1) * -GAP
    above, best = np.zeros(len(text) + 1, np.int64), (0, 0, 0)
    for i, word in enumerate(item, 1):
        cell = np.maximum(above[:-1] + np.where(text == word, MATCH, OTHER), above[1:] + GAP)
        np.maximum(cell, 0, out=cell)
        row = np.maximum.accumulate(cell + steps) - steps
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j + 1)
        above[1:] = row
    return best


def most(gains: np.ndarray) -> int:
    """The largest sum of a run of words, each +MATCH if it can match and OTHER if it cannot."""
    total = np.concatenate(([0], np.cumsum(np.where(gains, MATCH, OTHER))))
    return int((total - np.minimum.accumulate(total)).max())


def align(item: list[str], passage: list[str]) -> tuple[int, int, int] | None:
    """(score, first word, end word) of the best alignment, if it reaches the needed score. It is not
    computed where neither side can: a word that the other side lacks costs at least one, one that it holds gains at
    most MATCH."""
    number = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
    own = np.array([number[w] for w in item])
    text = np.array([number.get(w, 0) for w in passage])
    least = needed(len(item))
    if most(text > 0) < least or most(np.isin(own, text)) < least:
        return None
    score, end_item, end = smith_waterman(own, text)
    if score < least:
        return None
    back = smith_waterman(own[:end_item][::-1], text[:end][::-1])
    return score, end - back[2], end


def stretch(size: Column) -> Column:
    """Words of text that an alignment of the needed score spans at most: all words of the item and, for each point it
    can lose, one word more."""
    least = F.when(size < MIN_WORDS, MATCH * size).otherwise(F.least(SHARE * MATCH * size, F.lit(MATCH * ENOUGH_WORDS)))
    return (size + MATCH * size - F.floor(least)).cast("long")


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words, size): the distinct items, their words joined by blanks."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [[w for part in segments(t) for w in part] for t in batch["text"]]
            yield pd.DataFrame({"item_id": batch["item_id"], "words": [" ".join(w) for w in words], "size": [len(w) for w in words]})

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    rows = rows.mapInPandas(read, "item_id long, words string, size int").where("size > 0")
    rows = rows.groupBy("words", "size").agg(F.min("item_id").alias("item_id"))
    return staged(rows.withColumn("item", F.monotonically_increasing_id()), "test-items")


def seeds_of(items: DataFrame) -> DataFrame:
    """(key, item, place, apart, least, span): the pairs that an item keeps, the weight that a text must hold of them, and
    the words that an alignment spans at most."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.concat([
                pd.DataFrame({"item": item, "place": places, "apart": apart, "key": keys, "size": size})
                for item, words, size in zip(batch["item"], batch["words"], batch["size"], strict=True)
                for apart, keys, places in seeds_from(hashes(words.split(" "))) if (apart == 0) == (size == 1)
            ])

    every = staged(items.select("item", "words", "size").mapInPandas(pairs, "item long, place long, apart int, key long, size int"), "item-pairs")
    often = staged(every.groupBy("key").agg(F.count("*").alias("n")), "pair-counts")
    weight = F.when(F.col("size") < MIN_WORDS, MATCH * F.col("size")).otherwise(
        F.least(SHARE * MATCH * F.col("size"), F.lit(MATCH * ENOUGH_WORDS))) - MATCH
    # whole places are given up, the most frequent ones first: both pairs that begin there, for a weight of 2
    places = every.join(often, "key").groupBy("item", "place", "size").agg(F.max("n").alias("n"))
    order = F.row_number().over(W.partitionBy("item").orderBy(F.desc("n"), "place"))
    given_up = F.floor(weight * DROPPED / 2)
    kept = places.withColumns({"given_up": given_up, "order": order}).where("order > given_up").select(
        "item", "place", F.greatest(F.ceil(weight) - 2 * F.col("given_up"), F.lit(1)).cast("int").alias("least")
    )
    kept = staged(kept, "rare-places")
    return staged(
        every.join(kept, ["item", "place"]).select("key", "item", "place", "apart", "least", stretch(F.col("size")).alias("span")), "seeds"
    )


def hits_of(texts: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row, key, at, apart): the pairs of documents that may be seeds."""
    shared = bitmap(seeds, F.col("key").bitwiseAND(F.lit(MASK)))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, words, size = [], [], []
            for text in batch["text"]:
                size.append(0)
                for part in segments(text):
                    size[-1] += len(part)
                    words += part
                    if len(words) >= WORDS:
                        held.append(hashes(words))
                        words = []
            numbers = np.concatenate([*held, hashes(words)])
            row = np.repeat(batch["row"].to_numpy(np.int64), size)
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            for low in range(0, len(numbers), WORDS):
                some = slice(low, low + WORDS + 2)
                for apart, keys, at in seeds_from(numbers[some]):
                    found = passing(shared.value, keys & MASK) & (at < WORDS)
                    at, keys = at[found] + low, keys[found]
                    same = row[at] == row[at + apart]
                    yield pd.DataFrame({"row": row[at][same], "key": keys[same], "at": place[at][same], "apart": apart})

    return texts.select("row", "text").mapInPandas(look, "row long, key long, at long, apart int")


def candidates(texts: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row, spots): for each document that may hold an item, the items and the stretches (from, to) of its words."""
    met = hits_of(texts, seeds).join(seeds.withColumnRenamed("apart", "own"), "key").select(
        "row", "item", "place", "least", "span",
        F.when((F.col("apart") <= 1) & (F.col("own") <= 1), 2).otherwise(1).alias("weight"),
        F.explode(F.array(F.floor(F.col("at") / F.col("span")), F.floor(F.col("at") / F.col("span")) - 1)).alias("part"),
    ).where("part >= 0").repartition("row", "item", "part")
    at_place = met.groupBy("row", "item", "part", "place", "least", "span").agg(F.max("weight").alias("weight"))
    enough = at_place.groupBy("row", "item", "part", "least", "span").agg(F.sum("weight").alias("weight")).where("weight >= least")
    spot = F.struct(
        "item", F.greatest(F.col("part") * F.col("span"), F.lit(0)).alias("from"), ((F.col("part") + 2) * F.col("span")).alias("to")
    )
    return staged(enough.groupBy("row").agg(F.collect_list(spot).alias("spots")), "candidates")


def stretches(text: str, spots: list[tuple[int, int, int]]) -> list[list[str]]:
    """The words of a text between two places, for each (item, from, to)."""
    held, at = [[] for _ in spots], 0
    for words in segments(text):
        for out, (_, low, high) in zip(held, spots, strict=True):
            out += words[max(0, low - at) : max(0, high - at)]
        at += len(words)
    return held


def passages_of(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(row, item, at, passage): the words of each candidate's stretch."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[int, int, int, str]] = []
            for row, text, spots in zip(batch["row"], batch["text"], batch["spots"], strict=True):
                for part in range(0, len(spots), BATCH_ROWS):
                    some = [(s["item"], s["from"], s["to"]) for s in spots[part : part + BATCH_ROWS]]
                    for (item, low, _), words in zip(some, stretches(text, some), strict=True):
                        out.append((row, item, low, " ".join(words)))
                    if len(out) >= BATCH_ROWS:
                        yield pd.DataFrame(out, columns=["row", "item", "at", "passage"])
                        out = []
            yield pd.DataFrame(out, columns=["row", "item", "at", "passage"])

    return texts.join(found, "row").select("row", "text", "spots").mapInPandas(cut, "row long, item long, at long, passage string")


def matches(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, item_id, score, first_word, end_word): the items that the numbered texts hold."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for x in batch.itertuples():
                item = x.words.split(" ")
                best = align(item, x.passage.split(" "))
                if best:
                    rows.append((x.row, x.item, x.item_id, best[0] / (MATCH * len(item)), x.at + best[1], x.at + best[2]))
            yield pd.DataFrame(rows, columns=["row", "item", "item_id", "score", "first_word", "end_word"])

    bound_batches(texts.sparkSession)
    items = items_of(benchmark)
    passages = passages_of(texts, candidates(texts, seeds_of(items)))
    aligned = passages.join(items, "item").select("row", "item", "at", "passage", "words", "item_id").mapInPandas(
        score, "row long, item long, item_id long, score double, first_word long, end_word long"
    )
    best = aligned.groupBy("row", "item", "item_id").agg(
        F.max(F.struct("score", (-F.col("first_word")).alias("first"), (-F.col("end_word")).alias("end"))).alias("best")
    )
    return best.select("row", "item_id", "best.score", (-F.col("best.first")).alias("first_word"), (-F.col("best.end")).alias("end_word"))


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): documents and the items that they hold."""
    rows = staged(
        documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text")), "numbered-texts"
    )
    found = staged(matches(rows, benchmark), "matches")
    return rows.select("row", "doc_id").join(found, "row").select("doc_id", "item_id", "score", "first_word", "end_word")


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no test item."""
    held = staged(documents.withColumn("__row", F.monotonically_increasing_id()), "numbered-documents")
    texts = held.select(F.col("__row").alias("row"), F.col("text").cast("string").alias("text"))
    gone = staged(matches(texts, benchmark).select(F.col("row").alias("__row")).distinct(), "contaminated-rows")
    return held.join(gone, "__row", "left_anti").select(*documents.columns)


def op10_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document that holds a test item, with the item and the place."""
    return contaminated(documents, benchmark)
