"""Small documents with every awkward case, and plain reference computations."""

from __future__ import annotations

import random

import duckdb

from cohortflow.llm.registry import ORACLE, QUERIES
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like those the operators use inside or add.
CLASH = ("_id", "_row", "_th", "fp", "root", "shard", "slot", "mix_reps", "_size", "_key", "host", "score", "_y", "n", "th", "doc")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(("ba", "do", "ri", "ne", "su", "ko", "tal", "mer")) for _ in range(r.randint(1, 3)))
                    for _ in range(n))


ITEM = prose(900, 30)


def rows() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empty, blank, very long, ties, repeats, copies, passages."""
    base = [(i, prose(i, 60 + i), ("en", "de", None)[i % 3], ("a", "a", "a", "b", "c")[i % 5]) for i in range(1, 31)]
    near = prose(7, 67).rsplit(" ", 1)[0] + " mertal"
    return [*base,
            (40, None, "en", "a"), (41, "", "en", None), (42, " \t\n ", None, "a"), (43, None, None, None),
            (44, prose(44, 20_000), "en", "b"), (45, prose(3, 63), "de", "c"), (46, prose(3, 63), "de", "a"),
            (47, near, "en", "a"), (48, "ünïcödé 日本語 текст", "en", "b"), (49, "one", "en", "b"), (50, "one two", "en", "b"),
            (51, prose(51, 400) + " " + ITEM + " " + prose(52, 400), "en", "a"),
            (52, " ".join(ITEM.split()[:26]).upper(), "en", "a"), (53, " ".join(ITEM.split()[:12]), "en", "a"),
            (60, prose(60, 70), "en", "a"), (60, prose(60, 70), "en", "a"), (61, prose(61, 70), "en", "a"), (61, prose(62, 70), "en", "a"),
            (None, prose(70, 70), "en", "b"), (None, prose(70, 70), "en", "b"), (None, prose(5, 65), "en", "b")]


def documents(spark, clash: bool = True, data: list[tuple] | None = None):
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in (rows() if data is None else data)], DOCS)
    df = df.repartition(4)
    return df.selectExpr("*", *[f"'x' as `{c}`" for c in CLASH]) if clash else df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def as_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def key(r) -> tuple:
    return (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["text"] is None)


def matches_sql(spark, name: str, sf_dir: str = SF) -> bool:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    cols, want = [c[0] for c in cur.description], None
    want = cur.fetchall()
    return sorted(df.columns) == sorted(cols) and digest(df.columns, got)[0] == digest(cols, want)[0]


def groups_of(n: int, links) -> list[int]:
    """Smallest member reachable, by plain union-find."""
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]
