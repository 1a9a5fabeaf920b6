"""URL filters: a temporal join of captures with dated lists.

A list entry says that from its day on, a key has a verdict: 'block', 'allow' or 'lift' (no longer listed). A key is
a host, a parent domain of two labels or more, or a host with the first segment of a path. Entries of
one key become validity intervals: each holds until the next entry of the key. A capture is judged by the
intervals in force on its day: the most specific listed key decides (path, then longer domains first).

Scale: only (host, path key, day) and (key, day) meet the list, both reduced to distinct rows first, so a
host with a third of all captures weighs as many rows as it has days. An interval is listed under each month
that it touches, so the as-of join is an equality on (key, month) with at most 31 days on either side. The
window that closes intervals sees one row per key and day. Everything is DataFrame functions.

Defined cases: two entries of a key on one day count as the stronger one, block over allow over lift. A capture
without a readable http(s) host, or with one of over 253 characters, is 'unparsed'; one without a day is
judged by no entry. Entries without key, day or a known verdict are left out. Repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saldo.llm.line_dedup import host_of
from saldo.session import staged

STRENGTH = {"lift": 0, "allow": 1, "block": 2}
LONGEST_HOST = 253


def strength(verdict: Column) -> Column:
    return F.coalesce(*[F.when(verdict == name, F.lit(rank)) for name, rank in STRENGTH.items()])


def path_key(url: Column, host: Column) -> Column:
    """Host and first segment of the path; empty if there is no segment."""
    first = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*/([^/?#]+)", 1)
    return F.when(first != "", F.concat(host, F.lit("/"), first)).otherwise(F.lit(""))


def domains(host: Column) -> Column:
    """The host and its parents of at least two labels, each with its number of labels; an address in brackets is one label."""
    labels = F.when(host.startswith("["), F.array(host)).otherwise(F.split(host, r"\."))
    last = F.greatest(F.size(labels) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(
        F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key"), (F.size(labels) - i + 1).alias("rank")
    ))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, from_day, to_day, verdict): when each entry holds; to_day is excluded, null while it still holds."""
    days = (
        entries.select("key", "day", strength(F.col("verdict")).alias("s")).dropna()
        .groupBy("key", "day").agg(F.max("s").alias("s"))
    )
    until = F.lead("day").over(W.partitionBy("key").orderBy("day"))
    names = F.create_map(*[F.lit(x) for name, rank in STRENGTH.items() for x in (rank, name)])
    closed = days.withColumn("to_day", until).where(F.col("s") > 0)
    return closed.select("key", F.col("day").alias("from_day"), "to_day", names[F.col("s")].alias("verdict"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """`captures` (url, day and any other columns) with the verdict and the key that decided. Columns of these
    names that captures already have are replaced."""
    captures = captures.drop("verdict", "rule")
    marked = captures.withColumn("__host", F.when(F.length(host_of(F.col("url"))) <= LONGEST_HOST, host_of(F.col("url"))))
    marked = marked.withColumn("__path", path_key(F.col("url"), F.col("__host")))
    visits = staged(
        marked.select("__host", "__path", F.col("day").alias("__day")).dropna().distinct(), "visits"
    )
    keys = visits.withColumn("k", F.explode(F.concat(
        domains(F.col("__host")),
        F.when(F.col("__path") != "", F.array(F.struct(F.col("__path").alias("key"), F.lit(LONGEST_HOST).alias("rank"))))
        .otherwise(F.array()),
    ))).select("__host", "__path", "__day", F.col("k.key").alias("key"), F.col("k.rank").alias("rank"))
    asked = keys.select("key", F.col("__day").alias("asked")).distinct().withColumn("month", F.trunc("asked", "month"))
    last = visits.agg(F.max("__day")).first()[0]
    listed = intervals(entries).where(F.col("from_day") <= F.lit(last)) if last else intervals(entries).limit(0)
    listed = listed.withColumn("month", F.explode(F.sequence(
        F.trunc("from_day", "month"), F.trunc(F.least(F.date_sub("to_day", 1), F.lit(last)), "month"), F.expr("interval 1 month")
    )))
    in_force = staged(
        asked.join(listed, ["key", "month"])
        .where("from_day <= asked and (to_day is null or asked < to_day)").select("key", F.col("asked").alias("__day"), "verdict"),
        "in-force",
    )
    decided = staged(
        keys.join(in_force, ["key", "__day"]).groupBy("__host", "__path", "__day")
        .agg(F.max(F.struct("rank", "verdict", "key")).alias("__best")), "decided",
    )
    out = marked.withColumn("__day", F.col("day")).join(decided, ["__host", "__path", "__day"], "left")
    verdict = F.when(F.col("__host").isNull(), "unparsed").otherwise(F.coalesce("__best.verdict", F.lit("none")))
    return out.select(*captures.columns, verdict.alias("verdict"), F.col("__best.key").alias("rule"))


def _digit(text: Column, place: int) -> Column:
    """A number below 65,536 from the digest of a text."""
    return F.conv(F.substring(F.md5(text), place, 4), 16, 10).cast("int")


def demo_day(text: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), _digit(text, 1) % 366)


def demo_entries(pages: DataFrame) -> DataFrame:
    """A list feed that grows with the pages: every page reports its host, its first folder or its parent domain,
    with a verdict and a day taken from a digest of its address."""
    url = F.col("url")
    host, seed = host_of(url), F.concat(url, F.lit("#"), F.col("page_id").cast("string"))
    labels = F.split(host, r"\.")
    parent = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.size(labels)), ".")
    kind, mood = _digit(seed, 5) % 8, _digit(seed, 9) % 10
    key = F.when(kind == 0, parent).when((kind <= 4) & (path_key(url, host) != ""), path_key(url, host)).otherwise(host)
    verdict = F.when(mood <= 3, "block").when(mood == 4, "allow").otherwise("lift")
    return pages.select(key.alias("key"), demo_day(seed).alias("day"), verdict.alias("verdict"))


def op1_url_filter(pages: DataFrame) -> DataFrame:
    """Every page with its fetch day (from a digest of its address) and the verdict of that day."""
    captures = pages.select("page_id", "url", demo_day(F.concat(F.lit("fetched "), "url")).alias("day"))
    return judge(captures, demo_entries(pages))


OP1_SQL = r"""
WITH h AS (
  SELECT row_number() OVER () AS r, page_id, url,
    regexp_replace(regexp_extract(lower(url), '^https?://(?:[^/?#@]*@)?(\[[^/?#@\]]*\]|[^/?#:@\[\]]+)', 1), '\.+$', '') AS found
  FROM pages
), p AS (
  SELECT r, page_id, url, CASE WHEN length(found) BETWEEN 1 AND 253 THEN found END AS host,
    regexp_extract(url, '^[A-Za-z]+://[^/?#]*/([^/?#]+)', 1) AS seg,
    md5('fetched ' || url) AS f, md5(url || '#' || page_id) AS s
  FROM h
), q AS (
  SELECT *, DATE '2024-01-01' + (('0x' || substr(f, 1, 4))::INT % 366) AS day,
    CASE WHEN seg <> '' THEN host || '/' || seg ELSE '' END AS path,
    CASE WHEN starts_with(host, '[') THEN [host] ELSE string_split(host, '.') END AS labels
  FROM p
), entries AS (
  SELECT CASE WHEN ('0x' || substr(s, 5, 4))::INT % 8 = 0
        THEN array_to_string(labels[greatest(len(labels) - 2, 1):], '.')
      WHEN ('0x' || substr(s, 5, 4))::INT % 8 <= 4 AND path <> '' THEN path ELSE host END AS key,
    DATE '2024-01-01' + (('0x' || substr(s, 1, 4))::INT % 366) AS day,
    CASE WHEN ('0x' || substr(s, 9, 4))::INT % 10 <= 3 THEN 2 WHEN ('0x' || substr(s, 9, 4))::INT % 10 = 4 THEN 1 ELSE 0 END AS s
  FROM q
), days AS (
  SELECT key, day, max(s) AS s FROM entries WHERE key IS NOT NULL AND day IS NOT NULL GROUP BY key, day
), keys AS (
  SELECT r, day, array_to_string(labels[i:], '.') AS key, len(labels) - i + 1 AS rank
  FROM (SELECT r, day, labels, unnest(range(1, greatest(len(labels) - 1, 1) + 1)) AS i FROM q WHERE host IS NOT NULL) z
  UNION ALL SELECT r, day, path, 253 FROM q WHERE host IS NOT NULL AND path <> ''
), now AS (
  SELECT k.r, k.key, k.rank, arg_max(d.s, d.day) AS s
  FROM keys k JOIN days d ON d.key = k.key AND d.day <= k.day GROUP BY k.r, k.key, k.rank
), best AS (
  SELECT r, arg_max(s, rank) AS s, arg_max(key, rank) AS key FROM now WHERE s > 0 GROUP BY r
)
SELECT page_id, url, day, CASE WHEN host IS NULL THEN 'unparsed' WHEN best.s = 2 THEN 'block' WHEN best.s = 1 THEN 'allow' ELSE 'none' END AS verdict,
  best.key AS rule
FROM q LEFT JOIN best USING (r)
"""
