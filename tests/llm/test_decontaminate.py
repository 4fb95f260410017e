from __future__ import annotations

import math
import re

from hypothesis import given
from hypothesis import strategies as st

from cohortflow.llm import decontaminate as D
from pyspark.sql import functions as F
from tests.llm.helpers import ITEM, documents, empty, matches_sql, prose, rows

ITEMS = [(1, ITEM), (2, prose(901, 40)), (3, prose(7, 67)[:150]), (4, "one two"), (5, "日本語"), (6, None), (7, " "), (8, ITEM), (None, ITEM),
         (9, prose(44, 20_000)[5000:5600]), (10, "Ünïcödé, 日本語!"), (1, prose(902, 8))]


def grams(text, k):
    w = re.findall(r"\w+", (text or "").lower())
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = set()
    for item, text in items:
        k = min(5, len(re.findall(r"\w+", (text or "").lower())))
        own = grams(text, k) if k else set()
        for doc, body in docs:
            n = len(own & grams(body, k)) if k else 0
            if own and n >= 0.8 * len(own) - 1e-9:
                out.add((doc, item, n, len(own), n / len(own)))
    return sorted(out, key=repr)


def items_of(spark, data=ITEMS):
    return spark.createDataFrame(data, "item_id long, text string").withColumn("h", F.lit("x")).withColumn("must", F.lit(0))


def test_pairs_equal_brute_force(spark):
    w = ITEM.split()
    spread = " ".join(f"{' '.join(w[i:i + 15])} {prose(300 + i, 300)}" for i in (0, 11))  # an item in two far pieces
    data = [*rows(), (80, spread, "en", "a"), (81, " ".join(w[:24]) + " x y z", "en", "a")]
    got = D.query(documents(spark, data=data), items_of(spark)).collect()
    assert sorted({tuple(r) for r in got}, key=repr) == brute([(r[0], r[1]) for r in data], ITEMS)
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert {(51, 1), (52, 1), (80, 1), (44, 9), (48, 10), (48, 5), (50, 4)} <= pairs
    assert not {53, 40, 41, 42, 81} & {d for d, _ in pairs}


def test_many_copies_and_a_common_passage(spark):
    common = prose(950, 25)
    items = [(i, f"{common} {prose(960 + i, 12)}") for i in range(20)] + [(99, common)]
    docs = [(i, f"{prose(i, 30)} {common} {prose(2000 + i, 30)}", "en", "a") for i in range(200)]
    docs += [(1000 + i, f"{prose(i, 20)} {items[i % 20][1]}", "en", "a") for i in range(60)]
    got = D.query(documents(spark, data=docs), items_of(spark, items)).collect()
    assert sorted({tuple(r) for r in got}, key=repr) == brute([(r[0], r[1]) for r in docs], items)


def test_cleaning_keeps_the_rest(spark):
    docs = documents(spark)
    bad = {d for d, *_ in brute([(r[0], r[1]) for r in rows()], ITEMS)}
    out = D.clean(docs, items_of(spark))
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted((r[0] for r in rows() if r[0] not in bad), key=repr)


def test_empty_tables(spark):
    assert D.query(empty(spark), items_of(spark)).collect() == []
    assert D.query(documents(spark), items_of(spark, [(1, None)])).collect() == []
    assert D.clean(documents(spark), items_of(spark).limit(0)).count() == len(rows())


def test_pairs_match_sql(spark):
    assert matches_sql(spark, "op4_decontamination")


@given(st.integers(1, 5000), st.floats(0.5, 1.0))
def test_a_sketch_cannot_be_missed(q, threshold):
    """Whatever shingles are missing, a containing document holds ``must`` of the sketch."""
    k = min(q, D.sketch_size(q, threshold))
    may_miss = q - D.needed(q, threshold)
    assert k - may_miss >= 1
    assert D.needed(q, threshold) >= threshold * q - 1e-6 and D.needed(q, threshold) <= max(1, math.ceil(threshold * q))
