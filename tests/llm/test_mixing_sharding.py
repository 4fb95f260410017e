from __future__ import annotations

from collections import Counter, defaultdict

from cohortflow.llm import mixing, sharding
from pyspark.sql import functions as F
from tests.llm.helpers import documents, empty, key, matches_sql, prose, rows


def words(text):
    return len((text or "").split())


def shares(sizes: dict, total: float) -> dict:
    """Clamp and reshare until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    full, left = set(), total
    while True:
        free = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not over:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * level for s in names}
        full.update(over)
        left = total - sum(2.0 * sizes[s] for s in full)


def test_sources_come_near_their_targets(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    assert [c for c in mixed.columns if c not in mixing.MIX] == [c for c in docs.columns if c not in mixing.MIX]
    out = mixed.collect()
    assert len(out) == len(rows())
    sizes = defaultdict(int)
    for r in rows():
        sizes[r[3]] += words(r[1])
    want = shares(dict(sizes), 1.5 * sum(sizes.values()))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r["mix_size"] == words(r["text"]) and r["mix_source_size"] == sizes[r["source"]]
        assert abs(r["mix_target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["mix_reps"] <= 2
        taken[r["source"]] += r["mix_reps"] * r["mix_size"]
        largest[r["source"]] = max(largest[r["source"]], r["mix_size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 140  # repeated rows of an id are taken alike
    again = sorted((key(r), r["mix_reps"]) for r in mixing.mix(documents(spark)).collect())
    assert again == sorted((key(r), r["mix_reps"]) for r in out)


def test_repeats_are_rows(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    reps = {}
    for r in mixed.collect():
        reps[key(r)] = reps.get(key(r), 0) + r["mix_reps"]
    plain = mixing.mixture(docs)
    assert plain.columns == docs.columns
    assert Counter(key(r) for r in plain.collect()) == Counter({k: n for k, n in reps.items() if n})


def test_mixing_of_nothing(spark):
    assert mixing.query(empty(spark)).collect() == []
    blank = documents(spark, data=[(1, None, "en", "a"), (2, "", "en", None)])
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in mixing.query(blank).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_mixing_matches_sql(spark):
    assert matches_sql(spark, "op8_source_mixing")


def test_water_level_with_many_full_sources(spark):
    sizes = {f"s{i:02d}": (i * 37) % 101 + 1 for i in range(40)} | {None: 5000, "zz": 0}
    df = spark.createDataFrame(list(sizes.items()), "_source string, source_size long")
    got = {r["_source"]: r["target"] for r in mixing.water_fill(df, (5, 2, 1), 1.5, 2.0).collect()}
    want = shares(sizes, 1.5 * sum(sizes.values()))
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_shards_have_equal_bytes(spark):
    data = [(i, prose(i % 90, 5 + i * 7 % 90), ("en", "de", None)[i % 3], "hot" if i % 3 else f"s{i % 8}") for i in range(3000)]
    out = sharding.query(documents(spark, data=data)).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(3000))
    text = {r[0]: r[1] for r in data}
    size, slots = Counter(), defaultdict(list)
    for r in out:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 16 and r["law"] == "bytes" and r["grown_shard"] is None
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(size) == list(range(40))
    assert max(size.values()) < 1.1 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_awkward_rows(spark):
    docs = documents(spark)
    out = sharding.shard(docs, sharding.byte_size(F.col("text"), 16), 4)
    assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c not in ("shard", "slot")]
    got = out.collect()
    assert Counter(key(r) for r in got) == Counter(key(r) for r in docs.collect())
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < 4
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.query(empty(spark)).collect() == []
    one = documents(spark, data=[(1, None, None, None)])
    assert [(r["size"], r["slot"], r["text_crc32"]) for r in sharding.query(one).collect()] == [(16, 0, 0)]


def test_documents_without_ids_or_with_one_id_keep_the_laws(spark):
    """A source of null ids, and one that shares an id: targets are met, shards are near equal."""
    null = [(None, prose(i, 10), "en", "null") for i in range(300)]
    same = [(7, prose(1000 + i, 10), "en", "same") for i in range(300)]
    rest = [(i + 100, prose(2000 + i, 10), "de", "rest") for i in range(600)]
    docs = documents(spark, data=[*null, *same, *rest])
    taken, target = Counter(), {}
    for r in mixing.mix(docs).collect():
        taken[r["source"]] += r["mix_reps"] * r["mix_size"]
        target[r["source"]] = r["mix_target"]
    assert all(abs(taken[s] - t) <= 5 for s, t in target.items())   # half a document
    size = Counter()
    for r in sharding.query(documents(spark, data=[(None, prose(i, 10), "en", "a") for i in range(4000)])).collect():
        size[r["shard"]] += r["size"]
    assert len(size) == 40 and max(size.values()) < 1.1 * min(size.values())


def test_cuts_follow_a_plain_tree(spark):
    """The tree's cuts against a plain recursion over the documents' own coordinates."""
    data = [(i, prose(i, 3 + i * 13 % 60), ("en", "de", "fr")[i % 3], f"s{i % 5}") for i in range(300)]
    docs = documents(spark, clash=False, data=data)
    thin = sharding.land(sharding.keyed(docs, sharding.byte_size(F.col("text"), 16), F.xxhash64("text"), "doc_id", "lang", "source")
                         .select("_size", *[f"_{k}{i}" for i in range(3) for k in "bt"]), "test_thin")
    tree = sharding.fit(thin, 8)
    points = [(r["_size"], *[(r[f"_b{i}"], r[f"_u{i}"]) for i in range(3)]) for r in sharding._coordinates(thin, tree.places).collect()]
    total = sum(p[0] for p in points)
    spans = [max(p[1 + i][0] for p in points) - min(p[1 + i][0] for p in points) or 1 for i in range(3)]
    cell = -(-total // sharding.CELLS)

    def split(inside, first, shards):
        if shards == 1:
            return {first: sorted(p[0] for p in inside)}
        width = [(max(p[1 + i][0] for p in inside) - min(p[1 + i][0] for p in inside)) / spans[i] for i in range(3)]
        d = max(range(3), key=lambda i: (width[i], i))
        want, run, best = sum(p[0] for p in inside) * (shards // 2) / shards, 0, None
        for c in sorted({p[1 + d][1] // cell for p in inside}):
            run += sum(p[0] for p in inside if p[1 + d][1] // cell == c)
            best = min(best, (abs(run - want), c)) if best else (abs(run - want), c)
        cut = (best[1] + 1) * cell
        return split([p for p in inside if p[1 + d][1] < cut], first, shards // 2) | split(
            [p for p in inside if p[1 + d][1] >= cut], first + shards // 2, shards - shards // 2)

    got = defaultdict(list)
    for r in sharding.shard(docs, sharding.byte_size(F.col("text"), 16), 8).select("shard", "text").collect():
        got[r["shard"]].append(len(r["text"].encode()) + 16)
    assert {k: sorted(v) for k, v in got.items()} == split(points, 0, 8)
