from __future__ import annotations

import re
from collections import Counter, defaultdict

from cohortflow.llm import host_rules, line_dedup
from pyspark.sql import functions as F
from tests.llm.helpers import documents, empty, matches_sql, prose, rows


def measures(text: str | None) -> tuple:
    t = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(wins)
    covered = {i + k for i, w in enumerate(wins) if many[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


HARD = ["a b c a b c", "x x x x x x", "a\nb\na\n\n \na", "#*$%&|<> !", "a b c d a b c e a b c", "\x0b\x0ca\x1fb", "é é　x", "a b a b a",
        " ".join(["p q r s"] * 500), "l1\n" * 40]


def test_measures_follow_their_definitions(spark):
    data = [*rows(), *((100 + i, t, "en", "z") for i, t in enumerate(HARD))]
    got = host_rules.measure(documents(spark, data=data), ["doc_id", "text"]).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == measures(r["text"]), r["doc_id"]


def test_host_verdicts_reach_their_documents(spark):
    good = [(i, prose(i, 80), "en", f"h{i % 5}") for i in range(100)]
    bad = [(200 + i, prose(i, 80 if i < 8 else 10), "en", "junk") for i in range(40)]
    lone = [(300, prose(1, 10), "en", "small"), (301, prose(2, 90), "en", None)]
    docs = documents(spark, data=[*good, *bad, *lone])
    got = {r["doc_id"]: r for r in host_rules.query(docs).collect()}
    assert all(got[i]["kept"] for i in range(100)) and got[301]["kept"]
    assert not any(got[200 + i]["kept"] for i in range(40))       # the host goes with its few good pages
    assert got[200]["host_bad"] and not got[200]["base_failed"]
    assert got[300]["base_failed"] and not got[300]["kept"]


def test_rules_of_awkward_rows(spark):
    got = host_rules.query(documents(spark)).collect()
    assert len(got) == len(rows())
    assert all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (40, 41, 42, 43))
    assert host_rules.query(empty(spark)).collect() == []


def test_documents_keep_their_columns(spark):
    docs = documents(spark).selectExpr("*", "1 as kept", "2 as _host_of", "3 as _h")
    out = host_rules.apply_rules(docs)
    assert out.columns == [c for c in docs.columns if c not in host_rules.RULES] + list(host_rules.RULES)
    got = out.collect()
    assert sorted(repr((r["doc_id"], r["text"])) for r in got) == sorted(repr(r[:2]) for r in rows())
    assert all(r["_host_of"] == 2 and r["_h"] == 3 and r["kept"] in (True, False) for r in got)


def test_rules_match_sql(spark):
    assert matches_sql(spark, "op10_host_rules")


PAGES = "page_id long, url string, html string"


def clean(pages: list[tuple]) -> dict:
    host = lambda u: (re.match(r"[A-Za-z][\w+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", u or "") or [None, ""])[1].lower()
    lines = {i: [x.strip(" ") for x in re.sub(r"<[^>]*>", "\n", h or "").split("\n") if x.strip(" ")] for i, (_, _, h) in enumerate(pages)}
    total, count = Counter(host(u) for _, u, _ in pages), defaultdict(Counter)
    for i, (_, u, _) in enumerate(pages):
        count[host(u)].update(set(lines[i]))
    out = []
    for i, (p, u, _) in enumerate(pages):
        h = host(u)
        kept = [x for x in lines[i] if not (total[h] >= 3 and count[h][x] >= 2 and count[h][x] > 0.3 * total[h])]
        out.append((p, h, len(lines[i]), len(lines[i]) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_common_to_a_site_go(spark):
    hot = [(i, f"https://Big.example/{i}", f"<p>menu</p><p>{prose(i, 8)}</p><p>menu</p><li>{'often' if i % 2 else 'x'}</li>") for i in range(60)]
    rest = [(100 + i, f"http://u@s{i % 4}.example:80/p", f"<p>menu</p><p>own {i}</p>") for i in range(10)]
    odd = [(200, None, "<p>a</p>"), (201, "", None), (202, "no url", ""), (203, "http://big.example", "menu"), (None, "http://big.example", "menu"),
           (204, "http://long.example", "<p>" + prose(1, 20_000) + "</p>"), (5, "https://big.example/5", hot[5][2]), (5, "https://big.example/5", hot[5][2])]
    pages = [*hot, *rest, *odd]
    df = spark.createDataFrame(pages, PAGES).repartition(3)
    got = line_dedup.query(df.withColumn("_key", F.lit(1)).withColumn("_lines", F.lit("x"))).collect()
    assert sorted((tuple(r) for r in got), key=repr) == clean(pages)
    assert line_dedup.query(spark.createDataFrame([], PAGES)).collect() == []


def test_extra_columns_stay(spark):
    df = spark.createDataFrame([(1, "http://h/", "<p>a</p>", 7, 8)], PAGES + ", _pos int, dedup_text int")
    out = line_dedup.drop_boilerplate(df, line_dedup.host_of(F.col("url")), line_dedup.html_lines(F.col("html")))
    assert out.columns == ["page_id", "url", "html", "_pos", "dedup_host", "dedup_text", "dedup_lines", "dedup_dropped"]
    assert out.first()["_pos"] == 7 and out.first()["dedup_text"] == "a"


def test_lines_match_sql(spark):
    assert matches_sql(spark, "op7_line_dedup")
