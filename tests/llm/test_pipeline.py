from __future__ import annotations

import sys
from collections import Counter

import corpus_pipeline as P
import __spark_entry__ as E
from cohortflow.llm import decontaminate, mixing, quality, registry, simhash
from tests.llm.helpers import DOCS, SF, documents, empty, key
from tests.llm.test_classifiers import corpus
from tests.llm.test_decontaminate import ITEMS


def folder(spark, tmp_path, docs, labels, items) -> str:
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def bag(df) -> Counter:
    return Counter(key(r) for r in df.select("doc_id", "text").collect())


def test_every_stage_decides_on_all_its_input(spark, tmp_path):
    """Awkward rows and extra columns through all stages, each held against its operator's plain result."""
    from tests.llm.helpers import rows
    data, labels = corpus()
    odd = [(None if r[0] is None else 2000 + r[0], *r[1:]) for r in rows()]
    d = folder(spark, tmp_path, documents(spark, data=[*data, *odd]), labels, ITEMS)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    table = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, docs, d)
        if name != "sharding":
            assert out.columns == docs.columns
        out = P.land(out, f"test_{name}")
        before, after = bag(docs), bag(out)
        if name == "quality":
            scored = quality.query(docs, table("labels")).collect()
            want = Counter(r["doc_id"] for r in scored if r["predicted"])
            assert Counter(r["doc_id"] for r in out.select("doc_id").collect()) == want and len(out.columns) == len(docs.columns)
            junk = {i for i in range(0, 900, 9)}
            kept = {r["doc_id"] for r in out.select("doc_id").collect()}
            assert len(kept & junk) <= 3 and len([i for i in range(900) if i not in junk and i not in kept]) <= 3
        elif name == "near_duplicates":
            marked = simhash.near_duplicates(docs).collect()
            assert sum(after.values()) == len({r["root"] for r in marked}) and not after - before
        elif name == "decontamination":
            bad = {(r["doc"], r["th"]) for r in decontaminate.contained(docs, table("benchmark")).collect()}
            assert 2051 in {i for i, _ in bad} and sum(after.values()) == sum(before.values()) - len(bad)
        elif name == "mixing":
            reps = Counter()
            for r in mixing.mix(docs).collect():
                reps[key(r)] += r["mix_reps"]
            assert after == Counter({k: n for k, n in reps.items() if n})
        else:
            assert after == before and out.groupBy("shard", "slot").count().where("count > 1").count() == 0
        docs = out


def test_pipeline_over_the_smallest_tables(spark):
    out = E.queries()["pipeline"](spark, SF)
    assert out.columns == [f.split()[0] for f in DOCS.split(", ")] + ["shard", "slot"]
    total = out.count()
    assert 0 < total and out.select("doc_id").distinct().count() <= total
    assert "pipeline" not in E.oracle_sql() and P.ORACLE_SQL is None


def test_pipeline_of_nothing(spark, tmp_path):
    d = folder(spark, tmp_path, empty(spark), [], [])
    assert P.run(spark, d).collect() == []


def test_ten_operators_are_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert set(registry.ORACLE) == {"op4_decontamination", "op7_line_dedup", "op8_source_mixing", "op9_chat_parts", "op10_host_rules",
                                    "op11_link_graph", "op12_fill_in_middle"}


def test_entry_works_without_the_subpackage(monkeypatch):
    for name in ("cohortflow.llm", "cohortflow.llm.registry", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    assert "pipeline" not in E.queries() and not any(n.startswith("op1_") for n in E.queries())
    assert "mart_retention_overall" in E.queries()
