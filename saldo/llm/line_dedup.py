"""Site-relative line frequency: lines that many pages of one site share are boilerplate.

A line is dropped from a page if the pages of its site that hold it are more than `ratio` of all pages of that site, and
`min_pages` at least (2: a line that one page holds is shared with none). Everything is DataFrame functions.

Scale: a page counts a line once, and counts combine on the map side before (site, line) is shuffled,
so neither a large site nor a very common line meets in one task. A line is known by a 64-bit hash, which
only has to tell the few boilerplate lines of a site from its other lines. The boilerplate lines of a
site are at most (mean distinct lines of its pages) / `ratio`, which bounds the list that is joined to
each page; pages stay whole in that join and are never taken apart and put together again.

Defined cases: a null text or a null site passes unchanged and is not counted. Lines are compared
without blanks at both ends; blank lines are never counted or dropped. Repeated rows count as pages
of their own. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.session import staged

RATIO = 0.1
MIN_PAGES = 2
SITE, LINES = "__site_of_page", "__boilerplate_of_site"


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(
    pages: DataFrame, site: Column, text: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(`__site_of_page`, `__boilerplate_of_site`: keys of the site's boilerplate lines)."""
    known = pages.select(site.alias(SITE), text.alias("t")).where(
        F.col(SITE).isNotNull() & F.col("t").isNotNull()
    )
    totals = known.groupBy(SITE).agg(F.count("*").alias("pages"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.trim(x) != "")
    counts = (
        known.select(SITE, F.explode(F.array_distinct(F.transform(lines, line_key))).alias("line"))
        .groupBy(SITE, "line").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    shared = counts.join(totals, SITE).where(F.col("n") > ratio * F.col("pages"))
    return shared.groupBy(SITE).agg(F.collect_list("line").alias(LINES))


def drop_site_lines(
    pages: DataFrame, site: Column, text: str = "text", ratio: float = RATIO,
    min_pages: int = MIN_PAGES, dropped: str | None = None,
) -> DataFrame:
    """`pages` with boilerplate lines taken out of the column `text`; the count of dropped lines goes
    to the column `dropped`, if one is named."""
    known = staged(boilerplate(pages, site, F.col(text), ratio, min_pages), "site-lines")
    lines = F.split(F.col(text), "\n")
    bad = lambda x: F.array_contains(F.col(LINES), line_key(x))
    found = F.col(LINES).isNotNull() & F.col(text).isNotNull()
    columns = {text: F.when(found, F.array_join(F.filter(lines, lambda x: ~bad(x)), "\n")).otherwise(F.col(text))}
    if dropped:
        columns[dropped] = F.when(found, F.size(F.filter(lines, bad))).otherwise(F.lit(0))
    joined = pages.withColumn(SITE, site).join(known, SITE, "left")
    return joined.withColumns(columns).drop(SITE, LINES)


def host_of(url: Column) -> Column:
    """Lower-case host of an http(s) address, without user, port and closing dots; an address in brackets stays whole.
    Null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^https?://(?:[^/?#@]*@)?(\[[^/?#@\]]*\]|[^/?#:@\[\]]+)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """Visible text of a page: scripts, styles and comments go, inline tags go, any other tag ends a
    line, five entities are decoded, blank lines go."""
    bare = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    bare = F.regexp_replace(bare, r"(?i)</?(?:a|b|i|em|strong|span|u)(?:[ \t\r\n][^>]*)?>", "")
    bare = F.regexp_replace(bare, r"<[^>]*>", "\n")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(sign))
    lines = F.transform(F.split(bare, "\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def op6_site_lines(pages: DataFrame) -> DataFrame:
    """Every page with its host, its text without boilerplate, and how many lines went."""
    text = staged(
        pages.select("page_id", host_of(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text")), "page-text"
    )
    out = drop_site_lines(text, F.col("host"), "text", dropped="n_dropped")
    return out.select("page_id", "host", "text", F.col("n_dropped").cast("long").alias("n_dropped"))


OP6_SQL = r"""
WITH raw AS (
  SELECT row_number() OVER () AS r, page_id,
    nullif(regexp_replace(regexp_extract(lower(url), '^https?://(?:[^/?#@]*@)?(\[[^/?#@\]]*\]|[^/?#:@\[\]]+)', 1), '\.+$', ''), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'),
      '(?i)</?(?:a|b|i|em|strong|span|u)(?:[ \t\r\n][^>]*)?>', '', 'g'),
      '<[^>]*>', chr(10), 'g') AS bare
  FROM pages
), lines AS (
  SELECT r, page_id, host, list_filter(list_transform(string_split(
    replace(replace(replace(replace(replace(bare, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
      '&nbsp;', ' '), '&amp;', '&'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls
  FROM raw
), totals AS (
  SELECT host, count(*) AS pages FROM lines WHERE host IS NOT NULL AND ls IS NOT NULL GROUP BY host
), counts AS (
  SELECT host, l, count(*) AS n
  FROM (SELECT DISTINCT r, host, unnest(ls) AS l FROM lines WHERE host IS NOT NULL) q
  GROUP BY host, l
), bad AS (
  SELECT c.host, list(l) AS ls FROM counts c JOIN totals t ON t.host = c.host
  WHERE n >= 2 AND n > 0.1 * pages GROUP BY c.host
)
SELECT page_id, x.host,
  array_to_string(list_filter(x.ls, lambda v: NOT coalesce(list_contains(b.ls, v), false)), chr(10)) AS text,
  coalesce(len(list_filter(x.ls, lambda v: coalesce(list_contains(b.ls, v), false))), 0)::BIGINT AS n_dropped
FROM lines x LEFT JOIN bad b ON b.host = x.host
"""
