from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import url_filter
from tests.llm.helpers import matches_sql

PAGES = "page_id long, url string, html string"


def place(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")


def rule_of(host, path, rules=url_filter.RULES):
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, None)


def brute(pages):
    """Verdicts by plain walks over a dictionary graph, with the same whole units."""
    placed = [(i, *place(u)) for i, u, _ in pages]
    hosts = {h for _, h, _ in placed if h}
    edges = set()
    for (_, h, _), (_, _, html) in zip(placed, pages):
        for link in re.findall(r"<a\s[^<>]*?href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'<>\s]+)", html or "", re.I):
            edges.add((h, link.lower()))
    for h in hosts:
        up = h.split(".")
        near = next((p for p in (".".join(up[i:]) for i in range(1, len(up))) if p in hosts), None)
        if near:
            edges |= {(h, near), (near, h)}
    edges = {(a, b) for a, b in edges if a and b and a != b}
    shares = {}
    for kind, wanted in (("trust", "allow"), ("distrust", "block")):
        out = defaultdict(list)
        for a, b in edges:
            out[a if kind == "trust" else b].append(b if kind == "trust" else a)
        seeds = Counter(h for _, h, p in placed if h and rule_of(h, p)[1] == wanted)
        unit = url_filter.UNITS // max(1, sum(seeds.values()))
        moving, score = {h: n * unit for h, n in seeds.items()}, Counter()
        for _ in range(url_filter.ROUNDS):
            after = Counter()
            for h, m in moving.items():
                score[h] += m - m * 85 // 100
                for to in out[h]:
                    after[to] += m * 85 // 100 // len(out[h])
            moving = after
        score.update(moving)
        total = max(1, sum(score.values()))
        shares[kind] = defaultdict(float, {h: s / total for h, s in score.items()})
    bad = {h for h in shares["distrust"] if shares["distrust"][h] > shares["trust"][h] + 1 / max(1, len(hosts))}
    return sorted(((i, h, p, rule_of(h, p)[0], rule_of(h, p)[1] or ("block" if h in bad else "allow")) for i, h, p in placed), key=repr)


def link(*to):
    return "".join(f"<p><a class='x' HREF=\"https://{t}/p?q#f\">t</a>" for t in to)


FARM = [(i, f"https://bad{i}.example.org/es/{i}", link("hub.net", f"bad{(i + 1) % 6}.example.org")) for i in range(6)]
SUSPECT = [(10 + i, f"http://feeder.net/{i}", link("bad1.example.org", "bad2.example.org", "bad3.example.org")) for i in range(3)]
GOOD = [(20 + i, f"https://good{i}.org/a", link("friend.net", "www.friend.net")) for i in range(6)]
OTHER = [(30, "https://friend.net/x", link("good1.org")), (31, "https://www.friend.net/", ""), (32, "https://blog.deep.www.friend.net/x", None),
         (33, "https://lonely.net/x", "<a href='/rel'>r</a><a href=//LONELY.net/y>"), (34, "https://hub.net/", "")]
ODD = [(40, None, link("bad1.example.org")), (41, "", None), (42, "no url", ""), (43, "://", ""), (44, "x://y", ""), (45, "http://é.com/fr/é?x", ""),
       (46, "HTTP://A.Example.ORG:80/en/1", ""), (47, "http://org/en/1", ""), (48, "https://xorg/a", ""), (49, "https://a.com?u=http://b.org/x", ""),
       (50, "https://u@" + "a." * 400 + "com/fr/", ""), (51, "https://example.org/en/12", ""), (52, "https://example.org/es", ""),
       (None, "https://good1.org/a", ""), (53, "https://..org/", ""), (54, "https://h.net/\n/://z", "<a <a <a href=" + "<a x" * 5000)]
ALL = [*FARM, *SUSPECT, *GOOD, *OTHER, *ODD, FARM[1], FARM[1]]


def frame(spark, pages):
    return spark.createDataFrame(pages, PAGES).repartition(3)


def test_verdicts_follow_plain_walks(spark):
    got = [tuple(r) for r in url_filter.query(frame(spark, ALL)).collect()]
    assert sorted(got, key=repr) == brute(ALL)
    verdict = {r[0]: r[4] for r in got}
    assert verdict[10] == "block"                       # links to blocked hosts, trusted by none
    assert verdict[30] == verdict[31] == verdict[33] == verdict[34] == verdict[40] == "allow"


def test_longest_rule_wins_and_ties_block(spark):
    rules = (*url_filter.RULES, ("allow", "example.org", "/es/"), ("allow", "org", "/es/123456789"), ("block", "good1.org", "/a/"))
    pages = frame(spark, [(1, "https://w.example.org/es/123456789", ""), (2, "https://example.org/es/1", ""), (3, "https://good1.org/a/b", ""),
                          (4, "https://good1.org/b", "")])
    got = {r["page_id"]: (r["filter_rule"], r["filter_verdict"]) for r in url_filter.judge(pages, rules=rules).collect()}
    assert got == {1: ("org/es/123456789", "allow"), 2: ("example.org/es/", "block"), 3: ("good1.org/a/", "block"), 4: ("org/", "allow")}
    with pytest.raises(ValueError):
        url_filter.judge(pages, rules=[("allow", "org", f"/{i}") for i in range(url_filter.MAX_RULES + 1)])


def test_columns_stay_and_empty_tables(spark):
    pages = frame(spark, ALL[:3]).selectExpr("*", *[f"1 as `{c}`" for c in ("host", "_row", "on", "kind", "filter_host", "_bad")])
    out = url_filter.judge(pages, url_filter.hyperlinks(pages))
    assert out.columns == ["page_id", "url", "html", "host", "_row", "on", "kind", "_bad", "filter_host", "filter_path", "filter_rule",
                           "filter_verdict"]
    assert out.first()["_row"] == 1 and out.count() == 3
    assert url_filter.query(spark.createDataFrame([], PAGES)).collect() == []
    assert url_filter.judge(frame(spark, [(1, None, None)])).first()["filter_verdict"] == "allow"


def test_a_hub_keeps_its_mass(spark):
    """Nothing is lost but what ends at hosts without links: a ring with a hub keeps all units up to rounding."""
    ring = [(f"h{i}", f"h{(i + 1) % 50}") for i in range(50)] + [("hub", f"h{i}") for i in range(50)] + [(f"h{i}", "hub") for i in range(50)]
    edges = spark.createDataFrame(ring, "src string, dst string")
    seeds = spark.createDataFrame([("hub", 3, 0), ("h1", 1, 2)], "host string, allowed long, blocked long")
    total = url_filter.propagate(edges, seeds).agg(F.sum("trust"), F.sum("distrust")).first()
    assert all(url_filter.UNITS * 0.999999 < t <= url_filter.UNITS for t in total)


def test_url_filter_matches_sql(spark):
    assert matches_sql(spark, "op11_link_graph")
