"""Line deduplication by site-relative frequency.

Pages are grouped by host. For each line the number of the host's pages that contain it is
divided by the host's page total; a line over the boilerplate ratio is dropped from all pages of
that host, every occurrence of it.

Only (host, 64-bit line hash) rows are counted, each once a page, combined before the shuffle;
the lines to drop meet thin (page, position) rows, and a page's text moves once, to meet its own
dropped positions.

Defined cases: a null or empty page has no lines; pages whose url has no host are grouped as one
host without name; a host of fewer than ``min_pages`` pages keeps all lines; repeated rows count
as pages and are cleaned alike; an empty table gives an empty result; extra columns are kept
(those named like the added ones are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import land, packed, unpacked

MAX_RATIO, MIN_PAGES = 0.3, 3

#: Applied in order to html: what has no text, block ends, other tags.
_HTML = (
    (r"(?is)<script\b.*?</script\s*>", "\n"),
    (r"(?is)<style\b.*?</style\s*>", "\n"),
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|"
     r"pre|section|table|td|th|title|tr|ul)\b[^>]*>", "\n"),
    (r"(?s)<[^>]*>", ""),
)
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def host_of(url: Column) -> Column:
    """Host of a url in lower case, "" where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def html_lines(html: Column) -> Column:
    """Visible lines of a page: trimmed, inner spaces made one, empty ones left out."""
    out = F.coalesce(html, F.lit(""))
    for pattern, by in _HTML:
        out = F.regexp_replace(out, pattern, by)
    for name, char in _ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    lines = F.split(F.regexp_replace(out, r"[ \t\r\f\x0B]+", " "), "\\n")
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != F.lit(""))


def boilerplate(pages: DataFrame, host: str, lines: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(_host, _line) hashes of lines that too many pages of their host contain."""
    totals = pages.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("_total"))
    seen = pages.select(F.col(host).alias("_on"), F.explode(F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))).alias("_line"))
    counts = seen.groupBy("_on", "_line").agg(F.count(F.lit(1)).alias("_pages"))
    return (counts.join(land(totals, "line_hosts"), F.col("_on") == F.col("_host"))
            .where((F.col("_total") >= min_pages) & (F.col("_pages") >= 2) & (F.col("_pages") > max_ratio * F.col("_total")))
            .select("_host", "_line"))


def drop_boilerplate(pages: DataFrame, host: Column, lines: Column, id_col: str = "page_id", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``dedup_host``, ``dedup_text`` (kept lines), ``dedup_lines`` and ``dedup_dropped`` (counts)."""
    split = packed(pages, _id=F.col(id_col), dedup_host=host, _lines=lines)
    split = split.withColumn("_key", F.xxhash64(F.col("_id").isNull(), "_id", "dedup_host", F.concat_ws("\n", "_lines")))
    thin = land(split.select("_key", "dedup_host", F.transform("_lines", lambda x: F.xxhash64(x)).alias("_hashes")), "line_pages")
    hashed = thin.select("dedup_host", F.col("_hashes").alias("_lines"))
    drop = land(boilerplate(hashed, "dedup_host", "_lines", max_ratio, min_pages), "line_drop")
    rows = thin.select("_key", "dedup_host", F.posexplode("_hashes").alias("_pos", "_hash"))
    at = (rows.join(drop, (F.col("dedup_host") == F.col("_host")) & (F.xxhash64(F.col("_hash")) == F.col("_line")))
          .groupBy(F.col("_key").alias("_page")).agg(F.collect_set("_pos").alias("_at")))
    joined = split.join(land(at, "line_positions"), F.col("_key") == F.col("_page"), "left")
    kept = F.filter("_lines", lambda x, i: ~F.coalesce(F.array_contains("_at", i), F.lit(False)))
    cleaned = (joined.withColumn("_kept", kept)
               .withColumn("dedup_text", F.concat_ws("\n", "_kept"))
               .withColumn("dedup_lines", F.size("_lines").cast("long"))
               .withColumn("dedup_dropped", (F.size("_lines") - F.size("_kept")).cast("long")))
    return unpacked(cleaned, "dedup_host", "dedup_text", "dedup_lines", "dedup_dropped")


def query(pages: DataFrame) -> DataFrame:
    """op7 over all pages: what is left of each page's lines."""
    parsed = land(pages.select("page_id", host_of(F.col("url")).alias("host"), html_lines(F.col("html")).alias("lines")), "line_parsed")
    out = drop_boilerplate(parsed, F.col("host"), F.col("lines"))  # html is parsed once, its lines are read twice
    return out.select("page_id", F.col("dedup_host").alias("host"), F.col("dedup_lines").alias("n_lines"),
                      F.col("dedup_dropped").alias("n_dropped"), F.col("dedup_text").alias("text"))


def _sql() -> str:
    html = "coalesce(html, '')"
    for pattern, by in _HTML:
        html = f"regexp_replace({html}, '{pattern}', {'chr(10)' if by else repr(by)}, 'g')"
    for name, char in _ENTITIES:
        html = "replace({}, '{}', '{}')".format(html, name, char.replace("'", "''"))
    html = rf"regexp_replace({html}, '[ \t\r\f\x0B]+', ' ', 'g')"
    return rf"""
WITH p AS (
  SELECT page_id, row_number() OVER () AS rid,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(list_transform(string_split({html}, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM pages),
t AS (SELECT host, count(*) AS total FROM p GROUP BY host),
l AS (SELECT rid, host, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM p),
c AS (SELECT host, line, count(DISTINCT rid) AS n FROM l GROUP BY host, line),
b AS (SELECT host, line FROM c JOIN t USING (host) WHERE total >= {MIN_PAGES} AND n >= 2 AND n > {MAX_RATIO}::DOUBLE * total),
k AS (SELECT rid, count(*) FILTER (b.line IS NOT NULL) AS n_dropped,
             coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (b.line IS NULL), '') AS text
      FROM l LEFT JOIN b USING (host, line) GROUP BY rid)
SELECT page_id, host, len(ls)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(text, '') AS text
FROM p LEFT JOIN k USING (rid)
"""


SQL = _sql()
