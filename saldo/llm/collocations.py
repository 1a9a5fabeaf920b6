"""Phrase collocations by best-first branch and bound.

Everything is per language. Phrases grow from their prefixes: words to two words, two words to three. Counts bound
what a prefix can grow to. A phrase is never more frequent than its parts, so only words of at least FEWEST
occurrences are looked at in pairs. A two-word prefix xy cannot score more than 1000000 * f(xy) / f(x), nor can any
phrase xyz grown from it: its first cut gives f(xyz)^2 / (f(x) f(yz)) <= f(xyz) / f(x) <= f(xy) / f(x).

Waves: the two-word prefixes with the highest bounds are opened first. Opening xy counts all phrases xyz, which gives
their scores, and all phrases wxy, which together with xyz tell whether xy is dropped. When a language has TOP settled
survivors, the score of the TOP-th is a threshold: one more wave opens every prefix whose bound reaches it, ties
included, and what stays closed is below it. A language with fewer survivors is opened in whole. A wave is one
pass over the texts that counts only three-word phrases with an opened part, for all languages together.

Scale: a task turns texts into numbers of words, counts phrases with numpy in slices of SLICE bytes, and emits each
distinct phrase of a slice once; Spark adds them up with partial sums, so a frequent phrase or a hot language is one row a task.
Open prefixes reach the tasks as bounded bitmaps, and exactly by joins on their (language, phrase). Bounds and scores
are whole numbers up to a million, so thresholds come from one histogram row per language and value; the first TOP are
cut on the map side. The driver sees the bitmaps and one number a wave.

Defined cases: null or empty text has no words; a null language is `und`. Repeated rows count again. A language without
candidates has no result row, nor has an empty table. Scores use decimals of 38 digits, exact for counts below 10^15.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saldo.llm.bitmap import BITS, MASK, bitmap, passing
from saldo.llm.common import bound_batches
from saldo.session import staged

FEWEST = 10
TOP = 2000
SHARE = 50  # hundredths of a phrase's occurrences that lie in one longer phrase
WAVE = 4 * TOP
GROWTH = 8
UNIT = 1_000_000
SLICE = 4 << 20
STEP = 1 << 16  # bytes of text taken apart at once
FRAME = 1 << 16  # phrases emitted at once
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
# A-Z to lower case, every end of a piece to \n, tab to blank.
TABLE = bytes(10 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
BREAK = re.compile(rb"[ \n]")
COUNTED = "lang string, phrase binary, f long"
EMPTY, END = 0, 1  # numbers of what lies between two blanks in a row, and of an end of a piece; words follow


class Words:
    """Word occurrences of one language as numbers, END between pieces."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(None, {b"": EMPTY, b"\n": END})
        self.number.default_factory = self.number.__len__
        self.ids: list[int] = []
        self.size = 0
        self.carried = 0

    def add(self, text: bytes) -> None:
        """Add a slice of text that ends at a word's end. Only blanks and \\n are left as white space."""
        for part in slices(text, STEP):
            self.ids.extend(map(self.number.__getitem__, part.replace(b"\n", b" \n ").split(b" ")))
        self.size += len(text)

    def end(self) -> None:
        self.ids.append(END)

    def counts(self, length: int, keep_words: np.ndarray | None = None, opened=None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases of `length` words (rows of word numbers) and their counts. Those that end in
        what an earlier slice has counted are left out, as are those with a word not kept. `opened` tells of two columns of
        words which pairs are open; three words need an open part."""
        ids, base = np.array(self.ids, np.int64), len(self.number)
        ids = ids[ids != EMPTY]
        if len(ids) < length:
            return np.zeros((0, length), np.int64), np.zeros(0, np.int64)
        kept = np.ones(base, bool) if keep_words is None else keep_words.copy()
        kept[END] = False
        kept = kept[ids]
        fine = np.arange(length - 1, len(ids)) >= self.carried
        for i in range(length):
            fine &= kept[i : len(ids) - length + 1 + i]
        if opened is not None:
            at = np.flatnonzero(kept[:-1] & kept[1:])
            open_ = np.zeros(len(ids) - 1, bool)
            open_[at] = opened(ids[at], ids[at + 1])
            fine &= open_[:-1] | open_[1:]
        at = np.flatnonzero(fine)
        columns = [ids[at + i] for i in range(length)]
        code = columns[0]
        if length == 3:
            pairs, code = np.unique(columns[0] * base + columns[1], return_inverse=True)
        code = code if length == 1 else code * base + columns[-1]
        found, f = np.unique(code, return_counts=True)
        if length == 1:
            return found[:, None], f
        first = found // base
        rows = [first, found % base] if length == 2 else [pairs[first] // base, pairs[first] % base, found % base]
        return np.stack(rows, axis=1), f

    def rest(self) -> Words:
        """What phrases of the next slice may begin with: the last two words of an unfinished piece."""
        out, last = Words(), []
        for i in reversed(self.ids):
            if i == END or len(last) == 2:
                break
            if i != EMPTY:
                last.insert(0, i)
        texts = list(self.number)
        out.ids = [out.number[texts[i]] for i in last]
        out.carried = len(out.ids)
        return out


def slices(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of about `size` bytes, cut at blanks or ends of pieces."""
    start = 0
    while len(text) - start > size:
        cut = BREAK.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def counted(batches: Iterator[pa.RecordBatch], length: int, size: int, admit) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f): counts of a task's phrases, slice by slice. `admit(words, lang)` tells which words to keep and
    which pairs are open."""
    held: dict[str, Words] = defaultdict(Words)

    def out(lang: str) -> Iterator[pa.RecordBatch]:
        words = held[lang]
        texts = list(words.number)
        rows, f = words.counts(length, *admit(texts, lang))
        texts = pa.array(texts, pa.binary())
        for start in range(0, len(rows), FRAME):
            part = rows[start : start + FRAME]
            phrases = [texts.take(pa.array(part[:, i])) for i in range(length)]
            if length > 1:
                phrases = [pc.binary_join_element_wise(*phrases, pa.scalar(b" ", pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang), len(part)), *phrases, pa.array(f[start : start + FRAME], pa.int64())], ["lang", "phrase", "f"]
            )

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for part in slices(text.as_py().translate(TABLE), size):
                held[lang].add(part)
                if held[lang].size >= size:
                    yield from out(lang)
                    held[lang] = held[lang].rest()
            held[lang].end()
            if len(held) > 64:  # a bound for tables with very many languages
                for one in list(held):
                    yield from out(one)
                    del held[one]
    for lang in list(held):
        yield from out(lang)


def word_hashes(texts: list[bytes], lang: str) -> np.ndarray:
    """A hash of each (lang, word), as `word_hash` has it."""
    before = lang.encode() + b"\t"
    return np.fromiter((xxhash.xxh64_intdigest(before + w, 42) for w in texts), np.uint64, len(texts))


def pair_bits(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bits of (lang, pair) from the hashes of its words, as `pair_bit` has it."""
    return ((first ^ (second >> np.uint64(BITS))) & np.uint64(MASK)).astype(np.int64)


def word_hash(word: Column) -> Column:
    return F.xxhash64(F.concat(F.col("lang").cast("binary"), F.lit(b"\t"), word.cast("binary")))


def word_bit() -> Column:
    """The bit of (lang, phrase) for a phrase of one word: the lowest BITS of its hash."""
    return word_hash(F.col("phrase")).bitwiseAND(F.lit(MASK))


def pair_bit() -> Column:
    """The bit of (lang, phrase) for a phrase of two words: the lowest BITS of the first one's hash and the next
    ones of the second one's, so that tasks hash words and no pairs."""
    x, y = (word_hash(F.substring_index("phrase", " ", n)) for n in (1, -1))
    return x.bitwiseXOR(F.shiftrightunsigned(y, BITS)).bitwiseAND(F.lit(MASK))


def count_phrases(texts: DataFrame, length: int, words: Broadcast | None = None, pairs: Broadcast | None = None, size: int = SLICE) -> DataFrame:
    """(lang, phrase, f) over all texts: phrases whose words, and one of whose two-word parts, pass the bitmaps."""

    def admit(texts: list[bytes], lang: str):
        if words is None:
            return None, None
        hashes = word_hashes(texts, lang)
        kept = passing(words.value, (hashes & np.uint64(MASK)).astype(np.int64))

        def opened(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            return passing(pairs.value, pair_bits(hashes[first], hashes[second]))

        return kept, opened if pairs is not None else None

    rows = texts.mapInArrow(lambda batches: counted(batches, length, size, admit), COUNTED)
    # a slice's phrase is a whole string of the text, so it is valid text
    return rows.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f"))


def ratio(a: str, l: str, r: str) -> str:
    """floor(UNIT * a * a / (l * r)) in whole numbers of any size up to 38 digits."""
    wide = [f"cast({x} as decimal(16,0))" for x in (a, a, l, r)]
    return f"(cast({UNIT} as decimal(7,0)) * ({wide[0]} * {wide[1]})) div ({wide[2]} * {wide[3]})"


def reaching(rows: DataFrame, value: str, count: Column) -> DataFrame:
    """(lang, mark): the highest value that at least `count` rows of the language reach; no row for smaller languages."""
    per_value = rows.groupBy("lang", value).agg(F.count("*").alias("c"), F.max(count).alias("want"))
    above = F.sum("c").over(W.partitionBy("lang").orderBy(F.desc(value)))
    return per_value.withColumn("above", above).where("above >= want").groupBy("lang").agg(F.max(value).alias("mark"))


def pairs_of(words: DataFrame, texts: DataFrame, fewest: int, size: int) -> DataFrame:
    """(lang, phrase, a, l, r, score, bound) of all two-word candidates."""
    known = bitmap(words, word_bit())
    counts = count_phrases(texts, 2, known, size=size).where(F.col("f") >= fewest)
    held = staged(counts.withColumns({
        "x": F.substring_index("phrase", " ", 1), "y": F.substring_index("phrase", " ", -1),
    }).withColumnRenamed("f", "a"), "pairs")
    for word, f in (("x", "l"), ("y", "r")):
        held = held.join(words.select("lang", F.col("phrase").alias(word), F.col("f").alias(f)), ["lang", word])
    return held.select(
        "lang", "phrase", "a", "l", "r", F.expr(ratio("a", "l", "r")).alias("score"),
        F.expr(f"(cast({UNIT} as decimal(7,0)) * cast(a as decimal(16,0))) div cast(l as decimal(16,0))").alias("bound"),
    )


def triples_of(counts: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, head, tail, a, l, r, score, wave) of three-word candidates: the lowest-scoring cut, the first among equals. `wave` is
    the first in which a part is open, null if none is; `head_wave` that of the prefix."""
    part = [F.substring_index("phrase", " ", n) for n in (1, 2, -2, -1)]
    rows = counts.select("lang", "phrase", F.col("f").alias("a"), *[p.alias(c) for p, c in zip(part, ("x", "head", "tail", "z"), strict=True)])
    for c, table, extra in (("x", words, None), ("z", words, None), ("head", pairs, "wave"), ("tail", pairs, "wave")):
        f = "f" if extra is None else "a"
        more = [] if extra is None else [F.col(extra).alias(f"{c}_wave")]
        rows = rows.join(table.select("lang", F.col("phrase").alias(c), F.col(f).alias(f"f_{c}"), *more), ["lang", c])
    rows = rows.withColumns({"s1": F.expr(ratio("a", "f_x", "f_tail")), "s2": F.expr(ratio("a", "f_head", "f_z"))})
    first = F.col("s1") <= F.col("s2")
    return rows.select(
        "lang", "phrase", "head", "tail", "a", "head_wave", F.least("head_wave", "tail_wave").alias("wave"),
        F.when(first, F.col("f_x")).otherwise(F.col("f_head")).alias("l"),
        F.when(first, F.col("f_tail")).otherwise(F.col("f_z")).alias("r"), F.least("s1", "s2").alias("score"),
    )


def collocations(
    documents: DataFrame, top: int = TOP, fewest: int = FEWEST, share: int = SHARE, wave: int = WAVE, size: int = SLICE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of every language of (text, lang)."""
    spark = documents.sparkSession
    bound_batches(spark)
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).where("text is not null")
    every = staged(count_phrases(texts, 1, size=size), "words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = staged(every.where(F.col("f") >= fewest), "frequent-words")
    known = bitmap(words, word_bit())
    pairs = staged(pairs_of(words, texts, fewest, size), "pair-scores")
    opened, settled, triples, number, want = None, None, None, 0, wave
    while True:
        number += 1
        # a language with enough survivors opens what reaches their threshold, others their next prefixes; one
        # with no more than those is opened in whole
        goal = reaching(pairs, "bound", F.lit(want)).select("lang", F.col("mark").alias("goal"), F.lit(False).alias("done"))
        if settled is not None:
            goal = goal.join(settled, "lang", "full").select(
                "lang", F.coalesce("mark", "goal").alias("goal"), F.col("mark").isNotNull().alias("done")
            )
        goal = staged(goal, "wave-marks")
        fresh = pairs.join(goal, "lang", "left").where(F.col("bound") >= F.coalesce("goal", F.lit(0))).select("lang", "phrase")
        if opened is not None:
            fresh = fresh.join(opened.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
        fresh = staged(fresh.withColumn("wave", F.lit(number)), "opened")
        if not fresh.take(1):
            if not goal.where("not done").take(1):
                break
            want *= GROWTH  # ties have opened these prefixes before
            continue
        opened = fresh if opened is None else staged(opened.unionByName(fresh), "all-opened")
        marked = staged(pairs.join(opened, ["lang", "phrase"], "left"), "marked-pairs")
        filter_ = bitmap(fresh, pair_bit())
        counts = staged(count_phrases(texts, 3, known, filter_, size).where(F.col("f") >= fewest), "triples")
        # a phrase with a part opened before has been counted then
        grown = triples_of(counts, marked, words).where(F.col("wave") == number).drop("wave", "head_wave")
        grown = staged(grown, "triple-scores")
        triples = grown if triples is None else staged(triples.unionByName(grown), "all-triples")
        inside = triples.select("lang", "a", F.explode(F.array("head", "tail")).alias("phrase"))
        longest = staged(inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer")), "longest")
        survivors = marked.where("wave is not null").join(longest, ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))
        )
        columns = ("lang", "phrase", "a", "l", "r", "score")
        found = staged(survivors.select(*columns).unionByName(triples.select(*columns)), "survivors")
        settled = reaching(found, "score", F.lit(top))
        want *= GROWTH
    if triples is None:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = staged(found.withColumn("rank", rank).where(F.col("rank") <= top), "collocations")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_collocations(documents: DataFrame) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations(documents.select("text", "lang"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[:j], ' ') AND x.k = j
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:], ' ') AND y.k = c.k - j
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), longer AS (
  SELECT lang, part, max(a) AS f FROM (
    SELECT lang, a, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS part FROM candidates WHERE k = 3
  ) GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase AND s.k = 2
  WHERE g.f IS NULL OR 100 * g.f < 50 * s.a
)
SELECT lang, rank::INTEGER AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
