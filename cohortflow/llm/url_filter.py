"""URL filters: allow and block rules, and link-graph propagation for hosts that no rule settles.

A rule is a host and a path prefix; it fits its host and all subdomains, and the longest that fits a
url decides (of equal length the longer host, then block). Pages that a rule settles make their hosts
seeds, weighted by their pages. Over the host edges two personalised PageRanks run side by side:
trust walks from the allowed seeds along the links, distrust from the blocked seeds against them (who
links to a bad host is suspect). A host is blocked if its share of all distrust exceeds its share of
all trust by more than an even share of one host.

Host edges are hyperlinks between hosts (``hyperlinks``, each pair once) and, both ways, a host and
its nearest crawled parent domain (they have one owner). Mass is counted in whole units, so sums do
not depend on their order and reruns agree to the last digit. A walk that meets a host without links
ends there; that scales all scores alike.

Defined cases: a null url, or one without ``://``, has an empty host and path, takes part in no edge
and gets the verdict of an unknown host (allow), as do hosts that no mass reaches; repeated rows count
as pages and are judged alike; null or empty html has no links; an empty table gives an empty result;
extra columns are kept (those named like the added ones are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import land, packed, unpacked

Rule = tuple[str, str, str]  # verdict, host, path prefix

RULES: tuple[Rule, ...] = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
                           ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Rules are configuration: more than this many are refused, so a host's list of rules stays small.
MAX_RULES = 10_000
#: Per cent of a host's mass that follows its links; after ROUNDS steps under 1 % still walks.
DAMPING, ROUNDS = 85, 30
#: Steps in one plan: the edges' exchange is made once a plan and reused by its steps.
ROUNDS_PER_WRITE = 5
#: Mass of all seeds together, in units; times 100 it still fits a long.
UNITS = 10 ** 17 // 2
#: The longest host name that DNS allows; longer ones have no parent domain.
MAX_HOST = 253

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"://([^/?#]*)([^?#]*)"
#: The host part of a link that names one (with a scheme or ``//``).
_LINK = (r"<[Aa][ \t\r\n\f/](?:[^<>]*?[ \t\r\n\f/\"'])?[Hh][Rr][Ee][Ff][ \t\r\n\f]*=[ \t\r\n\f]*[\"']?[ \t\r\n\f]*"
         r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#\"'<> \t\r\n\f]+)")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def _parents(host: Column, first: int, most: int | Column) -> Column:
    """Domains of a host from its own labels, without the ``first`` leading ones, at most ``most`` labels each."""
    labels = F.split(host, r"\.")
    cuts = F.sequence(F.greatest(F.lit(first), F.size(labels) - F.lit(most)), F.size(labels) - 1)
    all_cuts = F.when(F.size(labels) > first, cuts).otherwise(F.array().cast("array<int>"))
    return F.transform(all_cuts, lambda i: F.concat_ws(".", F.slice(labels, i + 1, F.size(labels))))


def rules_by_host(hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(_rule_host, _rules): for each host in ``hosts`` that some rule fits, those rules, the deciding one first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MAX_RULES} are allowed")
    if any(v not in ("allow", "block") for v, _, _ in rules):
        raise ValueError("a rule allows or blocks")
    spark = hosts.sparkSession
    rows = [(h.lower(), p, h.lower() + p, v, -len(h + p), -len(h)) for v, h, p in rules]
    table = spark.createDataFrame(rows, "on string, path string, rule string, verdict string, by_length int, by_host int")
    labels = max((h.count(".") + 1 for _, h, _ in rules), default=1)
    fits = hosts.select("host", F.explode(_parents(F.col("host"), 0, labels)).alias("on")).join(table, "on")
    order = F.struct("by_length", "by_host", F.col("verdict") == "allow", "path", "rule", "verdict")
    return (fits.groupBy(F.col("host").alias("_rule_host"))
            .agg(F.sort_array(F.collect_set(order)).alias("_rules")))


def hyperlinks(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): distinct links between different hosts, from the anchors of the pages' html."""
    found = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), 1)
    links = pages.select(host_of(F.col(url_col)).alias("src"),
                         F.explode(F.array_distinct(F.transform(found, lambda h: F.translate(h, _UPPER, _LOWER)))).alias("dst"))
    return links.where("src <> '' AND dst <> '' AND src <> dst").distinct()


def site_edges(hosts: DataFrame) -> DataFrame:
    """(src, dst), both ways: a host and its nearest parent domain among ``hosts``."""
    named = hosts.where((F.col("host") != "") & (F.length("host") <= MAX_HOST)).select("host")
    up = named.select("host", F.posexplode(_parents(F.col("host"), 1, F.size(F.split("host", r"\.")))).alias("_up", "_parent"))
    near = (up.join(named.select(F.col("host").alias("_parent")), "_parent")
            .groupBy("host").agg(F.min_by("_parent", "_up").alias("_parent")))
    pairs = near.select(F.col("host").alias("src"), F.col("_parent").alias("dst"))
    return pairs.union(pairs.select("dst", "src"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) in units, from seeds (host, allowed, blocked: page counts) over edges (src, dst).

    One state row a host and kind holds the mass still walking and the mass that stayed. A step is a
    join with the edges and a sum: distrust has the edges turned round, and an edge to itself (degree
    0) carries what stays. A hub's edges are split by the adaptive skew join, and what a hub receives
    is summed before the shuffle. Each written state cuts the lineage.
    """
    pairs = edges.select("src", "dst").where("src <> dst").distinct()
    pairs = land(pairs.select(F.lit("trust").alias("kind"), "src", "dst")
                 .union(pairs.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))),
                 "url_pairs")
    degree = pairs.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("deg"))
    totals = seeds.agg(F.sum("allowed").alias("trust"), F.sum("blocked").alias("distrust")).first()
    start = None
    for kind, count in (("trust", "allowed"), ("distrust", "blocked")):
        unit = UNITS // max(1, totals[kind] or 0)
        part = seeds.where(F.col(count) > 0).select(F.lit(kind).alias("kind"), "host",
                                                    (F.col(count) * F.lit(unit)).cast("long").alias("moving"),
                                                    F.lit(0).cast("long").alias("stayed"))
        start = part if start is None else start.union(part)
    state = land(start, "url_state_0")
    nodes = pairs.select("kind", "src").union(state.select("kind", "host")).union(pairs.select("kind", "dst")).distinct()
    steps = land(pairs.join(degree, ["kind", "src"])
                 .union(nodes.select("kind", "src", F.col("src").alias("dst"), F.lit(0).cast("long"))), "url_steps")
    goes = F.expr(f"moving * {damping} div 100")
    for done in range(rounds):
        keeps = F.col("deg") == 0
        state = (state.withColumnsRenamed({"kind": "_kind", "host": "_host"})
                 .join(steps, (F.col("_kind") == F.col("kind")) & (F.col("_host") == F.col("src")))
                 .where(keeps | (F.col("moving") > 0))
                 .select("kind", F.col("dst").alias("host"),
                         F.when(keeps, F.lit(0)).otherwise(F.expr(f"moving * {damping} div 100 div deg")).alias("moving"),
                         F.when(keeps, F.col("stayed") + F.col("moving") - goes).otherwise(F.lit(0)).alias("stayed"))
                 .groupBy("kind", "host").agg(F.sum("moving").alias("moving"), F.sum("stayed").alias("stayed")))
        if (done + 1) % ROUNDS_PER_WRITE == 0 or done + 1 == rounds:
            state = land(state, f"url_state_{done + 1}")
    mass = F.col("moving") + F.col("stayed")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, mass).otherwise(F.lit(0)))
    return state.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def host_scores(scores: DataFrame, n_hosts: int) -> DataFrame:
    """``scores`` with the shares of trust and distrust and ``blocked``: the threshold by host.

    ``n_hosts`` is the number of hosts of the crawl; an even share of one is the margin.
    """
    total = scores.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    share = lambda col, all_: F.col(col).cast("double") / F.lit(float(max(1, all_ or 0)))
    return (scores.withColumn("trust_share", share("trust", total["t"])).withColumn("distrust_share", share("distrust", total["d"]))
            .withColumn("blocked", F.col("distrust_share") > F.col("trust_share") + F.lit(1.0 / max(1, n_hosts))))


def judge(pages: DataFrame, edges: DataFrame | None = None, rules: Sequence[Rule] = RULES, url_col: str = "url") -> DataFrame:
    """``pages`` with ``filter_host``, ``filter_path``, ``filter_rule`` and ``filter_verdict``.

    ``edges`` are the links (src, dst) between hosts. Urls are read for the host counts, the seeds
    and the result; page rows meet one row a host, in joins whose size Spark checks and whose hot
    host the adaptive skew join splits.
    """
    url = F.col(url_col)
    hosts = land(pages.groupBy(host_of(url).alias("host")).agg(F.count(F.lit(1)).alias("pages")), "url_hosts")
    fits = land(rules_by_host(hosts, rules), "url_rules")
    rows = packed(pages, filter_host=host_of(url), filter_path=path_of(url))
    placed = rows.join(fits, F.col("filter_host") == F.col("_rule_host"), "left").withColumn(
        "_hit", F.get(F.filter("_rules", lambda r: F.startswith(F.col("filter_path"), r["path"])), F.lit(0)))
    seeds = land(placed.where(F.col("_hit").isNotNull()).groupBy(F.col("filter_host").alias("host")).agg(
        F.count_if(F.col("_hit.verdict") == "allow").alias("allowed"),
        F.count_if(F.col("_hit.verdict") == "block").alias("blocked")), "url_seeds")
    links = site_edges(hosts)
    if edges is not None:
        links = edges.select("src", "dst").where("src <> '' AND dst <> ''").union(links)
    scores = land(host_scores(propagate(links, seeds.where("host <> ''")), hosts.where("host <> ''").count()), "url_scores")
    bad = scores.where("blocked").select(F.col("host").alias("_bad"))
    judged = placed.join(bad, F.col("filter_host") == F.col("_bad"), "left")
    verdict = F.coalesce(F.col("_hit.verdict"), F.when(F.col("_bad").isNotNull(), "block").otherwise("allow"))
    return unpacked(judged.withColumn("filter_rule", F.col("_hit.rule")).withColumn("filter_verdict", verdict),
                    "filter_host", "filter_path", "filter_rule", "filter_verdict")


def query(pages: DataFrame) -> DataFrame:
    """Contract of op11 over all pages."""
    return judge(pages.select("page_id", "url"), hyperlinks(pages)).select(
        "page_id", F.col("filter_host").alias("host"), F.col("filter_path").alias("path"),
        F.col("filter_rule").alias("rule"), F.col("filter_verdict").alias("verdict"))


def _sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    lower = lambda x: f"translate({x}, '{_UPPER}', '{_LOWER}')"
    link = _LINK.replace("'", "''")
    return rf"""
WITH RECURSIVE
p AS (
  SELECT page_id, html, row_number() OVER () AS rid, {lower("regexp_extract(coalesce(url, ''), '" + _URL + "', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '{_URL}', 2) AS path FROM pages),
rules(verdict, h, pre) AS (VALUES {rules}),
fit AS (
  SELECT rid, arg_min(h || pre, (-length(h || pre), -length(h), verdict = 'allow')) AS rule,
         arg_min(verdict, (-length(h || pre), -length(h), verdict = 'allow')) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY rid),
hosts AS (SELECT host, list_slice(string_split(host, '.'), 2, NULL) AS up FROM p WHERE host <> '' GROUP BY host),
parents AS (
  SELECT host, unnest(list_transform(range(1, len(up) + 1), lambda i: array_to_string(list_slice(up, i, NULL), '.'))) AS parent,
         unnest(range(1, len(up) + 1)) AS lvl FROM hosts WHERE length(host) <= {MAX_HOST}),
near AS (SELECT parents.host, arg_min(parent, lvl) AS parent FROM parents JOIN hosts ON parent = hosts.host GROUP BY parents.host),
links AS (
  SELECT host AS src, {lower("unnest(regexp_extract_all(coalesce(html, ''), '" + link + "', 1))")} AS dst FROM p
  UNION ALL SELECT host, parent FROM near UNION ALL SELECT parent, host FROM near),
pairs AS (SELECT DISTINCT src, dst FROM links WHERE src <> '' AND dst <> '' AND src <> dst),
e AS (
  SELECT kind, src, dst, count(*) OVER (PARTITION BY kind, src) AS deg
  FROM (SELECT 'trust' AS kind, src, dst FROM pairs UNION ALL SELECT 'distrust', dst, src FROM pairs)),
seeds AS (
  SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n
  FROM fit JOIN p USING (rid) WHERE host <> '' GROUP BY ALL),
units AS (SELECT kind, {UNITS} // sum(n)::BIGINT AS unit FROM seeds GROUP BY kind),
walk AS (
  SELECT 0 AS k, kind, host, (n * unit)::BIGINT AS r FROM seeds JOIN units USING (kind)
  UNION ALL
  SELECT k + 1, e.kind, dst, sum(r * {DAMPING} // 100 // deg)::BIGINT FROM walk JOIN e ON walk.kind = e.kind AND walk.host = e.src
  WHERE k < {ROUNDS} AND r > 0 GROUP BY k, e.kind, dst),
mass AS (SELECT kind, host, sum(CASE WHEN k < {ROUNDS} THEN r - r * {DAMPING} // 100 ELSE r END)::BIGINT AS m FROM walk GROUP BY kind, host),
share AS (SELECT kind, host, m::DOUBLE / greatest(1, sum(m) OVER (PARTITION BY kind))::BIGINT::DOUBLE AS s FROM mass),
bad AS (
  SELECT d.host FROM (SELECT * FROM share WHERE kind = 'distrust') d LEFT JOIN (SELECT * FROM share WHERE kind = 'trust') t USING (host)
  WHERE d.s > coalesce(t.s, 0) + 1.0::DOUBLE / (SELECT count(*) FROM hosts))
SELECT page_id, p.host, path, rule, coalesce(verdict, CASE WHEN bad.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fit USING (rid) LEFT JOIN bad ON p.host = bad.host
"""


SQL = _sql()
