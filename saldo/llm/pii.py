"""Personal data: candidate spans, boosted trees over format and context, calibrated redaction.

High-recall generators propose spans that may overlap: the four base patterns (e-mail, address, card, phone)
with and without their checks, and two wider ones (spelled-out e-mail signs, phone numbers without a
country code). Boosted trees learn from format and context which candidates are right, and never see the labels' source:
a base candidate is right if it passes its check; a wider one, which has no check, if the corpus attests it, that is if
a checked base span somewhere has the same domain or the same last ten digits. On held-out documents the least score at
which PRECISION of the candidates are right is the threshold, one for each kind and form (base or wider). Where a form's
candidates show only one outcome, or too few are held out, it adds nothing. Base spans that pass their check always
stay; other candidates are added if they reach the threshold and overlap no base span. Everything on the tables is
DataFrame functions.

Scale: texts are read once, where they lie; what goes on are candidates with 24 characters before and 12
after. What base spans attest is one row for each domain or number, joined to the wider candidates alone. All features are small whole numbers, so the trees are fitted on counts per feature cell: CELLS
at most, whatever the corpus, and over all of it. The model goes back as one expression of CASE WHENs.
Patterns use possessive groups, so long runs cost neither stack nor repeated scans. A text's spans are put in order
by windows over that text alone.

Defined cases: a null or empty text has no span (digest of the empty string). Positions are code points, the end
excluded. A form with fewer than LEAST held-out candidates adds nothing. Repeated rows and null ids stay.
"""

from __future__ import annotations

from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saldo.llm.common import held_out
from saldo.session import staged

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the four kinds; possessive forms of the plain ones, with equal matches.
LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?i)(?<![{LOCAL}])[{LOCAL}]{{1,64}}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{{1,63}}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{{2,24}}+){{1,4}}+",
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
BEFORE, AFTER = 24, 12
FEATURES = ("kind", "form", "length", "digits", "signs", "left", "right", "topic")
LEVELS = (4, 2, 10, 21, 6, 5, 5, 5)
CELLS = 4 * 2 * 10 * 21 * 6 * 5 * 5 * 5
TREES, DEPTH, RATE = 30, 3, 0.3
PRECISION, LEAST = 0.98, 50


def candidates_of(text: Column, kind: str, pattern: str, base: bool, guard: Column) -> Column:
    """Array of the matches of a pattern, in order, with what stands around them and the gap since the last."""
    fits = F.when(guard, text)
    gaps, found = F.split(fits, pattern, -1), F.regexp_extract_all(fits, F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(gaps.alias("gap"), found.alias("match"), F.slice(gaps, 2, 2147483647).alias("next"))
    shaped = F.transform(F.filter(rows, lambda x: x["match"].isNotNull()), lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"), i.alias("number"),
        F.char_length(x["gap"]).alias("gap"), x["match"].alias("match"),
        F.right(x["gap"], F.lit(BEFORE)).alias("before"), F.left(x["next"], F.lit(AFTER)).alias("after"),
    ))
    return F.coalesce(shaped, F.array())


def all_candidates(text: Column) -> Column:
    digits, at = text.rlike("[0-9]"), text.contains("@")
    spelled = at | text.rlike(r"(?i)[(\[]at[)\]]")
    guards = {"email": at, "ip": digits & text.rlike(r"[0-9]\.[0-9]"), "card": digits, "phone": digits & text.contains("+")}
    arrays = [candidates_of(text, k, p, True, guards[k]) for k, p in BASE.items()]
    wide = {"email": spelled, "phone": digits & text.rlike(r"[0-9]{3}[ .-][0-9]{4}")}
    return F.concat(*arrays, *[candidates_of(text, k, p, False, wide[k]) for k, p in WIDE.items()])


def passes(kind: Column, match: Column) -> Column:
    """The check of a base match."""
    parts = F.transform(F.split(match, r"\."), lambda x: F.regexp_replace(x, "^0+", ""))
    ip = F.forall(parts, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255")))
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    # from the right, every second digit counts double, and 9 less if that has two digits
    one = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    twice = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    luhn = F.aggregate(F.sequence(F.lit(1), count), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, one(i)).otherwise(twice(one(i)))) % 10 == 0
    card = F.when(count.between(13, 19), luhn).otherwise(False)
    return F.when(kind == 0, True).when(kind == 1, ip).when(kind == 2, card).otherwise(count.between(9, 15))


def attested_by(kind: Column, match: Column) -> Column:
    """What a checked span must share with a wider candidate to attest it: the domain of an address, with its signs
    written out, or the last ten digits of a phone number."""
    address = F.substring_index(F.regexp_replace(F.lower(match), r" ?(?:@|\(at\)|\[at\]) ?", "@"), "@", -1)
    domain = F.regexp_replace(address, r" ?(?:\.|\(dot\)|\[dot\]) ?", ".")
    digits = F.regexp_replace(match, "[^0-9]", "")
    return F.when(kind == 0, domain).when((kind == 3) & (F.length(digits) >= 10), F.right(digits, F.lit(10)))


def side(char: Column) -> Column:
    """Class of a neighbouring character: none or blank, letter, digit, sign that joins, other."""
    return (
        F.when((char == "") | char.rlike(r"^\s$"), 0).when(char.rlike(r"^\p{L}$"), 1).when(char.rlike("^[0-9]$"), 2)
        .when(char.rlike(r"^[._/@:=+-]$"), 3).otherwise(4)
    )


def features(rows: DataFrame) -> DataFrame:
    """Format and context of candidates as small whole numbers."""
    before, match = F.lower("before"), F.col("match")
    topic = (
        F.when(before.rlike("token|key|secret|hash|sha|uuid"), 1).when(before.rlike("tel|phone|call|fax|mail|contact"), 2)
        .when(before.rlike("card|visa|pay|account|iban"), 3).when(before.rlike("version|release|build|section"), 4).otherwise(0)
    )
    plain = F.regexp_replace(match, "[^0-9]", "")
    return rows.withColumns({
        "form": F.when(F.col("base"), 0).otherwise(1),
        "length": F.least(F.floor(F.length("match") / 3), F.lit(9)).cast("int"),
        "digits": F.least(F.length(plain), F.lit(20)),
        "signs": F.least(F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")), F.lit(5)),
        "left": side(F.right("before", F.lit(1))), "right": side(F.left("after", F.lit(1))), "topic": topic,
    })


# ---- boosted trees on counts ---------------------------------------------------------------------

def grow(cells: np.ndarray, slope: np.ndarray, bend: np.ndarray, depth: int):
    """A tree on cells: a leaf value, or (feature, level, tree up to the level, tree above)."""
    value = -slope.sum() / (bend.sum() + 1.0)
    best, total = (1e-6, 0, 0), slope.sum() ** 2 / (bend.sum() + 1.0)
    if depth and len(cells) > 1:
        for f, levels in enumerate(LEVELS):
            g = np.cumsum(np.bincount(cells[:, f], slope, levels))[:-1]
            h = np.cumsum(np.bincount(cells[:, f], bend, levels))[:-1]
            gain = g**2 / (h + 1.0) + (slope.sum() - g) ** 2 / (bend.sum() - h + 1.0) - total
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
    if best[0] <= 1e-6:
        return float(value)
    low = cells[:, best[1]] <= best[2]
    parts = [grow(cells[m], slope[m], bend[m], depth - 1) for m in (low, ~low)]
    return (best[1], best[2], *parts)


def leaf(tree, cells: np.ndarray) -> np.ndarray:
    """Value of a tree for each cell."""
    if isinstance(tree, float):
        return np.full(len(cells), tree)
    f, level, low, high = tree
    return np.where(cells[:, f] <= level, leaf(low, cells), leaf(high, cells))


def boost(cells: np.ndarray, total: np.ndarray, good: np.ndarray) -> tuple[float, list]:
    """Log-odds of the start, and trees, by Newton steps on the logistic loss."""
    start = log((good.sum() + 0.5) / (total.sum() - good.sum() + 0.5))
    score, trees = np.full(len(cells), start), []
    for _ in range(TREES if len(cells) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = grow(cells, total * p - good, total * p * (1 - p), DEPTH)
        trees.append(tree)
        score += RATE * leaf(tree, cells)
    return start, trees


def chance(start: float, trees: list) -> Column:
    """The model as an expression over the feature columns."""
    def branch(tree) -> Column:
        if isinstance(tree, float):
            return F.lit(RATE * tree)
        f, level, low, high = tree
        return F.when(F.col(FEATURES[f]) <= level, branch(low)).otherwise(branch(high))

    score = sum((branch(t) for t in trees), F.lit(start))
    return 1 / (1 + F.exp(-score))


def thresholds(cells: np.ndarray, chances: np.ndarray, total: np.ndarray, good: np.ndarray) -> dict[tuple[int, int], float]:
    """For each kind and form the least chance down to which PRECISION of the candidates are right. A form whose candidates
    are all right or all wrong has none, since nothing tells the two apart."""
    out = {}
    for kind, form in np.ndindex(LEVELS[:2]):
        own = (cells[:, 0] == kind) & (cells[:, 1] == form)
        n = g = 0.0
        if not 0 < good[own].sum() < total[own].sum():
            continue
        for level in sorted({round(float(x), 12) for x in chances[own]}, reverse=True):
            at = own & (np.abs(chances - level) < 1e-9)
            n, g = n + total[at].sum(), g + good[at].sum()
            if g < PRECISION * n:
                break
            if n >= LEAST:
                out[kind, form] = level - 1e-9
    return out


# ---- the operator --------------------------------------------------------------------------------

def numbered(documents: DataFrame) -> DataFrame:
    return documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))


def labelled(rows: DataFrame) -> DataFrame:
    """The candidates that can be right or wrong, with the mark `good`: base ones by their check, wider ones that are free
    of checked spans by what checked spans attest."""
    known = rows.where("ok and key is not null").select("kind", "key").distinct().withColumn("attested", F.lit(True))
    wide = rows.where("not base and free").join(staged(known, "attested"), ["kind", "key"], "left")
    base = rows.where("base").select("held_out", *FEATURES, F.col("ok").alias("good"))
    return base.unionByName(wide.select("held_out", *FEATURES, F.coalesce("attested", F.lit(False)).alias("good")))


def find_personal_data(documents: DataFrame) -> DataFrame:
    """(row, doc_id, spans): every row of `documents` with its spans, structs (kind, start, end, base, chance, match)
    in the order of kind and start."""
    return spans_of(numbered(documents))


def spans_of(rows: DataFrame) -> DataFrame:
    """`find_personal_data` for rows that have their numbers."""
    held = staged(rows.select("row", "doc_id", held_out(F.col("doc_id")).alias("held_out"), all_candidates(F.col("text")).alias("found")), "candidates")
    each = held.where(F.size("found") > 0).select("row", "held_out", F.explode("found").alias("c")).select("row", "held_out", "c.*")
    before = W.partitionBy("row", "kind", "base").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    size = F.char_length("match")
    placed = each.withColumn("start", F.coalesce(F.sum(F.col("gap") + size).over(before), F.lit(0)) + F.col("gap"))
    placed = placed.withColumns({"end": F.col("start") + size, "ok": F.col("base") & passes(F.col("kind"), F.col("match"))})
    line = W.partitionBy("row").orderBy("start", F.desc("ok"), "end", "kind")
    sure_end = F.max(F.when(F.col("ok"), F.col("end"))).over(line.rowsBetween(W.unboundedPreceding, -1))
    sure_start = F.min(F.when(F.col("ok"), F.col("start"))).over(line.rowsBetween(1, W.unboundedFollowing))
    free = F.coalesce(sure_end <= F.col("start"), F.lit(True)) & F.coalesce(sure_start >= F.col("end"), F.lit(True))
    placed = placed.withColumns({"free": free, "key": attested_by(F.col("kind"), F.col("match"))})
    rows = staged(features(placed), "placed-candidates")
    counts = labelled(rows).groupBy("held_out", *FEATURES).agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("int")).alias("good")
    ).orderBy("held_out", *FEATURES).collect()
    cells = np.array([[r[f] for f in FEATURES] for r in counts], np.int64).reshape(-1, len(FEATURES))
    total, good = np.array([r["n"] for r in counts], float), np.array([r["good"] for r in counts], float)
    out = np.array([r["held_out"] for r in counts], bool)
    start, trees = boost(cells[~out], total[~out], good[~out])
    raw = start + RATE * sum((leaf(t, cells[out]) for t in trees), np.zeros(int(out.sum())))
    floor = F.lit(2.0)
    for (kind, form), value in thresholds(cells[out], 1 / (1 + np.exp(-raw)), total[out], good[out]).items():
        floor = F.when((F.col("kind") == kind) & (F.col("form") == form), F.lit(value)).otherwise(floor)
    scored = rows.withColumn("chance", chance(start, trees))
    alone = scored.where(F.col("ok") | F.col("free") & (F.col("chance") >= floor))
    # of added spans that overlap each other, the likelier stays
    added = ~F.col("ok")
    last_end = F.lag(F.when(added, F.col("end"))).over(line)
    last_chance, next_chance = F.lag("chance").over(line), F.lead("chance").over(line)
    next_start = F.lead(F.when(added, F.col("start"))).over(line)
    beaten = ((last_end > F.col("start")) & (last_chance >= F.col("chance"))) | ((next_start < F.col("end")) & (next_chance > F.col("chance")))
    kept = alone.withColumn("beaten", added & F.coalesce(beaten, F.lit(False))).where("not beaten")
    spans = kept.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("kind", "start", "end", F.col("ok").alias("base"), "chance", "match")
    )).alias("spans"))
    every = held.select("row", "doc_id").join(staged(spans, "spans"), "row", "left")
    return every.withColumn("spans", F.coalesce("spans", F.array()))


def span_text(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with every found span replaced by its kind in brackets. Spans that overlap are replaced
    together, by the kind of the one that starts first (the longest of those)."""
    # text and number are written together, so that a span cannot meet another row's text
    texts = staged(numbered(documents), "numbered-texts")
    found = spans_of(texts).select("row", "spans")
    names = F.array(*[F.lit(k) for k in KINDS])
    # from the last to the first by start; `open` is the union that may still grow to the left
    by_start = F.array_sort("spans", lambda a, b: F.when(
        a["start"] != b["start"], (b["start"] - a["start"]).cast("int")
    ).otherwise((a["end"] - b["end"]).cast("int")))

    def state(text: Column, kind: Column, start: Column, end: Column) -> Column:
        return F.struct(text.alias("t"), kind.cast("int").alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"))

    def closed(s: Column) -> Column:
        """The text with the open union replaced."""
        return F.when(s["start"].isNull(), s["t"]).otherwise(F.concat(
            F.substring(s["t"], F.lit(1), s["start"]), F.lit("["), F.get(names, s["kind"]), F.lit("]"),
            F.substring(s["t"], s["end"] + 1, F.length(s["t"])),
        ))

    cut = F.aggregate(
        by_start, state(F.col("text"), F.lit(None), F.lit(None), F.lit(None)),
        lambda s, x: F.when(x["end"] > s["start"], state(s["t"], x["kind"], x["start"], F.greatest(s["end"], x["end"].cast("int"))))
        .otherwise(state(closed(s), x["kind"], x["start"], x["end"])),
        closed,
    )
    return texts.join(found, "row", "left").select("doc_id", cut.alias("text"))


def op2_personal_data(documents: DataFrame) -> DataFrame:
    """Every document: base matches by kind with their digest, and all spans."""
    found = find_personal_data(documents)
    base = F.filter("spans", lambda x: x["base"])
    kinds = F.transform(base, lambda x: x["kind"])
    counts = [
        (F.size(base) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)
    ]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
