"""Lines that stand on a large share of a site's pages. DataFrame functions only.

A page's lines are the runs of text between block-level tags and line breaks, without tags, trimmed, blank ones left
out. A site is the host of the URL in lower case; pages without one (or with a NULL URL) form the site ''. For each
site and line the pages that contain it are counted, once per page; lines on more than `ratio` of the site's pages, and
on `least` pages at least, are dropped wherever they stand on that site.

Lines are counted by two hashes (96 bits), combined in the map tasks first. A page has finitely many lines, so a site
has at most (its mean number of lines per page) / ratio dropped lines: they travel as one list per site, once for each
`together` pages of the site, so that about so many pages meet in one task however large the site is. NULL html has no
lines. Equal rows count as pages of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import written

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
#: Removed with what they enclose, in turn.
HIDDEN = (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->")
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|"
    r"main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
)
TAG = r"<[^>]*>"
RATIO, LEAST, TOGETHER = 0.3, 3, 4000


def page_lines(html: Column) -> Column:
    text = F.coalesce(html, F.lit(""))
    for hidden in HIDDEN:
        text = F.regexp_replace(text, hidden, " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    return F.filter(F.transform(F.split(text, "[\r\n]+"), lambda x: F.trim(x)), lambda x: x != "")


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(lines: DataFrame, totals: DataFrame, ratio: float, least: int) -> DataFrame:
    """One row per site with lines to drop: site, their hashes, and the site's salts. `lines`: site and the lines of each
    page; `totals`: pages and salts of each site."""
    hashes = F.array_distinct(F.transform("lines", _hash))
    counts = lines.select("site", F.explode(hashes).alias("line")).groupBy("site", "line").agg(F.count(F.lit(1)).alias("on"))
    often = counts.filter(F.col("on") >= least).join(totals, "site").filter(F.col("on") > ratio * F.col("pages"))
    return often.groupBy("site", "salts").agg(F.collect_list("line").alias("drop"))


def line_dedup(
    pages: DataFrame,
    ratio: float = RATIO,
    least: int = LEAST,
    together: int = TOGETHER,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Per page: page_id, host, n_lines, n_removed, and the lines kept."""
    url, html = F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    site = F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))).alias("site")
    totals = pages.select(site).groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    totals = written(totals.withColumn("salts", F.ceil(F.col("pages") / together)), "site-pages")
    lines = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        site,
        page_lines(html).alias("lines"),
        F.xxhash64(html, url, f"`{id_col}`").alias("spread"),
    )
    drop = boilerplate(lines.select("site", "lines"), totals, ratio, least)
    drop = drop.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    # sites of one salt need none: the others are few
    large = totals.filter("salts > 1").select(F.col("site").alias("large"), "salts")
    lines = lines.join(large, F.col("site") == F.col("large"), "left")
    lines = lines.withColumn("salt", F.pmod("spread", F.coalesce("salts", F.lit(1)).cast("long")))
    met = lines.select("page_id", "site", "lines", "salt").join(drop, ["site", "salt"], "left")
    kept = F.filter("lines", lambda x: ~F.coalesce(F.array_contains("drop", _hash(x)), F.lit(False)))
    return met.withColumn("kept", kept).select(
        "page_id",
        F.col("site").alias("host"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        "kept",
    )


def digest(result: DataFrame) -> DataFrame:
    return result.select("page_id", "host", "n_lines", "n_removed", F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


ORACLE = (
    r"""
WITH stripped AS (
  SELECT page_id, lower(coalesce(regexp_extract(url, '{host}', 1), '')) AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '{script}', ' ', 'g'), '{style}', ' ', 'g'), '{comment}', ' ', 'g'), '{block}', chr(10), 'g'), '{tag}', '', 'g') AS body
  FROM pages),
lined AS (
  SELECT page_id, host, list_filter(list_transform(regexp_split_to_array(body, '[\r\n]+'), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM stripped),
totals AS (SELECT host, count(*) AS pages FROM lined GROUP BY host),
held AS (
  SELECT host, line, count(*) AS on_pages FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lined) GROUP BY host, line),
dropped AS (
  SELECT h.host, list(h.line) AS lines FROM held h JOIN totals t USING (host)
  WHERE h.on_pages >= 3 AND h.on_pages > 0.3 * t.pages GROUP BY h.host),
cleaned AS (
  SELECT l.page_id, l.host, l.lines, list_filter(l.lines, lambda x: NOT coalesce(list_contains(d.lines, x), false)) AS kept
  FROM lined l LEFT JOIN dropped d USING (host))
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM cleaned
""".replace("{host}", HOST).replace("{script}", HIDDEN[0]).replace("{style}", HIDDEN[1]).replace("{comment}", HIDDEN[2])
    .replace("{block}", BLOCK).replace("{tag}", TAG)
)
