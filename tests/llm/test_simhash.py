from __future__ import annotations

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortflow.llm import simhash
from cohortflow.llm.bitslice import groups, within
from cohortflow.llm.components import components
from tests.llm.helpers import as_rows, documents, empty, groups_of, key, rows

PRINTS = st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=150, unique=True)


def near(seed: int, n: int, flips: int) -> np.ndarray:
    """Fingerprints in a ball: a centre with up to ``flips`` bits turned."""
    r = np.random.default_rng(seed)
    centre = int(r.integers(0, 2**63))
    out = {centre}
    while len(out) < n:
        x = centre
        for b in r.choice(64, r.integers(1, flips + 1), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    return np.array(sorted(out), np.uint64)


@settings(max_examples=40, deadline=None)
@given(PRINTS, st.integers(0, 5), st.integers(0, 2**32))
def test_planes_compare_like_popcounts(prints, radius, seed):
    block = np.unique(np.concatenate([np.array(prints, np.uint64), near(seed, 20, 6)]))
    got = np.unpackbits(within(block, block, radius).view(np.uint8), axis=1, bitorder="little")
    want = np.bitwise_count(block[:, None] ^ block[None, :]) <= radius
    assert (got[:, :len(block)].astype(bool) == want).all()
    assert not got[:, len(block):].any()


def test_groups_hold_all_links_without_listing_them():
    block = np.unique(np.concatenate([near(1, 300, 4), near(2, 200, 2), near(3, 50, 1)]))
    links = groups(block, 3)
    assert len(links) < len(block)
    close = np.argwhere(np.bitwise_count(block[:, None] ^ block[None, :]) <= 3)
    assert groups_of(len(block), links) == groups_of(len(block), close.tolist())


def slow_print(text: str | None) -> int:
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashed = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def test_fingerprint_follows_its_definition():
    for r in rows():
        if len(r[1] or "") < 5000:
            assert simhash.fingerprint((r[1] or "").encode()) == slow_print(r[1])
    assert simhash.fingerprint("É a b".encode()) == slow_print("É a b")


def test_components_are_classes_of_links(spark):
    data = rows()
    got = simhash.near_duplicates(documents(spark)).collect()
    assert len(got) == len(data)
    prints = [slow_print(r[1]) if len(r[1] or "") < 5000 else simhash.fingerprint(r[1].encode()) for r in data]
    close = [(i, j) for i in range(len(data)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    top = groups_of(len(data), close)
    least = {g: min((data[i][0] for i in range(len(data)) if top[i] == g and data[i][0] is not None), default=None) for g in set(top)}
    want = sorted(((r[0], prints[i], least[top[i]]) for i, r in enumerate(data)), key=repr)
    assert sorted(((r["_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=repr) == want


def test_one_document_of_each_component_stays(spark):
    docs = documents(spark)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    out = kept.collect()
    marked = simhash.near_duplicates(docs).collect()
    assert len(out) == len({r["root"] for r in marked})
    ids = [r["doc_id"] for r in out]
    assert 46 not in ids and 45 not in ids and 3 in ids     # copies of 3
    assert ids.count(60) == 1 and ids.count(40) == 1 and not {41, 42, 43} & set(ids)  # repeats; no words at all
    assert {key(r) for r in out} <= {key(r) for r in docs.collect()}


def test_empty_table(spark):
    assert simhash.query(empty(spark)).collect() == []
    assert simhash.deduplicate(empty(spark)).collect() == []


def test_hot_bucket_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 64)
    monkeypatch.setattr(simhash, "PACK", 100)
    block = np.unique(np.concatenate([near(5, 400, 3), near(6, 30, 2)]))
    df = spark.createDataFrame([(int(x),) for x in block.view(np.int64)], "fp long")
    links = [(r["u"], r["v"]) for r in simhash.near_links(df).collect()]
    at = {int(x): i for i, x in enumerate(block.view(np.int64))}
    close = np.argwhere(np.bitwise_count(block[:, None] ^ block[None, :]) <= 3).tolist()
    assert groups_of(len(block), [(at[u], at[v]) for u, v in links]) == groups_of(len(block), close)


def test_connected_components(spark):
    r = np.random.default_rng(9)
    links = [(int(a), int(b)) for a, b in r.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 240)] + [(300, i) for i in range(301, 360)]
    got = dict(as_rows(components(spark.createDataFrame(links, "u long, v long"))))
    top = groups_of(400, links)
    named = {x for link in links if link[0] != link[1] for x in link}
    assert got == {x: top[x] for x in named}
