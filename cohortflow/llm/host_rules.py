"""Host-level quality rules with rates shrunk by an empirical beta prior (native).

Every document is measured in its own row: words, word characters, symbols, repeated lines
and words in repeated 3-word windows. Each rule's failures are counted by host; a beta prior,
fitted to the hosts' rates by moments, pulls the rate of a small host to the common one. A
host whose shrunk rate of a rule passes the limit is rejected and with it all its documents;
a document that fails the base rule is rejected whatever its host.

Defined cases: a null or blank text has no words and fails the base rule; a null host is a
host of its own; repeated rows are measured and counted each; an empty table gives an empty
result; extra columns are kept and never read (those named like the added ones are replaced). Repeated windows are found by 64-bit hashes of
their three words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import SPACES, land, unpacked, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rules counted by host: name -> condition on the measured columns.
HOST_RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > 3 * n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
}
MAX_HOST_RATE = 0.5


def _later(array: str, by: int = 1) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(F.col(array), by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def measure(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """The measures of each text beside ``keys``; arrays stay inside the row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(*keys, text.alias("_t"))
    df = df.select(
        *keys, words(F.col("_t")).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: F.translate(x, SPACES, "") != F.lit("")).alias("_lines"),
        F.length(F.translate("_t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    window = lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
    df = df.select(
        *keys, F.size("_w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), window)).alias("_h"))
    # (hash, start) in order of hash, only where some window repeats
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_p", F.when(repeats, F.array_sort(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_h")
    # equal neighbours are repeated windows; the last one has no next and zips with null
    df = df.withColumn("_next", F.zip_with("_p", _later("_p"), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))))
    df = df.withColumn("_kept", F.zip_with("_next", F.concat(F.array(F.lit(False)), F.slice("_next", 1, F.size("_next") - 1)),
                                           lambda a, b: a | b))
    df = df.withColumn("_starts", F.sort_array(F.filter(
        F.zip_with("_p", "_kept", lambda p, k: F.when(k, p["i"])), lambda i: i.isNotNull()))).drop("_p", "_next", "_kept")
    # the starts cover three words each, fewer where the next one comes sooner
    covers = F.zip_with("_starts", _later("_starts"), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    covered = F.aggregate(covers, F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_starts")


def host_verdicts(measured: DataFrame, host_col: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row a host: documents, and whether any rule's shrunk failure rate passes ``max_rate``.

    The prior of a rule comes from the hosts' rates: mean ``m`` over all documents and variance
    ``v`` between hosts weighted by their documents; ``m (1 - m) / v - 1`` prior documents, at
    least 1 and at most 1,000,000 (rates that do not differ, or a single host).
    """
    hosts = land(measured.groupBy(F.col(host_col).alias("_host")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.expr(rule)).alias(f"f_{name}") for name, rule in HOST_RULES.items()]), "rule_hosts")
    prior = hosts.agg(
        *[(F.sum(f"f_{r}") / F.sum("n")).alias(f"m_{r}") for r in HOST_RULES],
        *[(F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n")) / F.sum("n")
           - F.pow(F.sum(f"f_{r}") / F.sum("n"), F.lit(2))).alias(f"v_{r}") for r in HOST_RULES]).first()
    bad = F.lit(False)
    for r in HOST_RULES:
        m, v = prior[f"m_{r}"] or 0.0, prior[f"v_{r}"] or 0.0
        strength = min(1e6, max(1.0, m * (1 - m) / v - 1)) if v > 1e-12 else 1e6
        bad = bad | ((F.col(f"f_{r}") + F.lit(m * strength)) / (F.col("n") + F.lit(strength)) > F.lit(max_rate))
    return hosts.withColumn("host_bad", bad)


#: Columns that ``apply_rules`` adds.
RULES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "host_bad", "kept")


def apply_rules(docs: DataFrame, host_col: str = "source", text_col: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the measures, the base rule, the host's verdict and the final one (``RULES``).

    The text is read once: its measures are written beside the document's ``columns`` (all by default;
    a few keep what is written thin), and the host aggregate and the join back read that table. A verdict
    is one row a host; the join is broadcast only if the size of that written table allows it, else the
    adaptive skew join splits a hot host.
    """
    kept = docs.columns if columns is None else list(columns)
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    thin = measure(docs.select(row, F.col(host_col).alias("_host_of"), F.col(text_col).alias("_text")), ["_row", "_host_of"], "_text")
    thin = land(thin.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                                | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))), "rule_measures")
    verdicts = land(host_verdicts(thin, "_host_of").select("_host", "host_bad"), "rule_verdicts")
    judged = (thin.join(verdicts, F.col("_host_of").eqNullSafe(F.col("_host")), "left")
              .withColumn("kept", ~F.col("base_failed") & ~F.col("host_bad")))
    return unpacked(judged, *RULES)


def query(docs: DataFrame) -> DataFrame:
    """Contract of op10 over all documents."""
    return apply_rules(docs, columns=["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                        "base_failed", "kept", "host_bad")


SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws,
         row_number() OVER () AS rid
  FROM documents),
win AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
ln AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM w)
  WHERE regexp_matches(l, '[^ 	-
]') GROUP BY rid),
m AS (
  SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(ln.n_lines, 0)::BIGINT AS n_lines, coalesce(ln.n_dup, 0)::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN ln USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (
  SELECT source, rule, count(*) AS n, sum(fails::INT) AS f FROM (
    SELECT source, 'base' AS rule, base_failed AS fails FROM b
    UNION ALL SELECT source, 'symbols', 10 * n_symbols > 3 * n_words FROM b
    UNION ALL SELECT source, 'dup_lines', 2 * n_dup_lines > n_lines FROM b) GROUP BY source, rule),
pr AS (
  SELECT rule, sum(f)::DOUBLE / sum(n) AS m,
         sum((f * f)::DOUBLE / n) / sum(n) - (sum(f)::DOUBLE / sum(n)) ** 2 AS v FROM f GROUP BY rule),
st AS (SELECT rule, m, CASE WHEN v > 1e-12 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS k FROM pr),
h AS (SELECT source, bool_or((f + m * k) / (n + k) > 0.5) AS host_bad FROM f JOIN st USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_bad AS kept, host_bad
FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.source
"""
