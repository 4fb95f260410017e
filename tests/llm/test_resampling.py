from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortflow.llm import resampling
from tests.llm.helpers import ITEM, documents, empty, prose, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text) -> tuple[int, list[str]]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


def brute(docs: list[tuple], target: list[str], buckets=10_000) -> list[tuple]:
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, grams(text)[1]))
    for text in target:
        t.update(map(bucket, grams(text)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for doc_id, text in docs:
        n, found = grams(text)
        weight = sum(gain(bucket(g)) for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for place, r in enumerate(fit[:25 * len(fit) // 100], 1):
        ranks.setdefault(r, []).append(place)
    done = Counter()
    rows_out = []
    for r in out:
        mine = ranks.get(r, [])
        rows_out.append((r[0], *r[2:], mine[done[r]] if done[r] < len(mine) else None))
        done[r] += 1
    return sorted(rows_out, key=repr)


APPEND = resampling._Append()
HARD = [(300, "É é ß 日本 x1-y2 Aa\x00B", None, None), (301, "K ſ İ " * 30, None, None), (302, "1 " * 50, None, None), (303, "-- ..", None, None),
        (304, "x" * 200_000 + " tail " + "y" * 70_000, None, None), (305, prose(9, 60_000).upper(), None, None)]
DATA = [*rows(), *HARD, *((400 + i, prose(i % 7, 30), "en", "a") for i in range(60)), *[(500, prose(3, 40), "en", "a")] * 80]
TARGET = [ITEM, prose(3, 90), None, "", "É é tal"]


def target(spark, texts=TARGET):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_scores_and_ranks_follow_the_definition(spark):
    got = sorted((tuple(r) for r in resampling.query(documents(spark, data=DATA), target(spark)).collect()), key=repr)
    assert got == brute([r[:2] for r in DATA], TARGET)
    ranks = sorted(r[4] for r in got if r[4] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 30


def test_drawn_documents_keep_their_columns(spark):
    docs = documents(spark, data=DATA).selectExpr("*", "1 as rank", "2 as weight", "3 as dsir_rank")
    out = resampling.resample(docs, target(spark))
    assert out.columns == [c for c in docs.columns if c != "dsir_rank"] + ["dsir_weight", "dsir_score", "dsir_rank"]
    want = [(r[0], r[2], r[3], r[4]) for r in brute([r[:2] for r in DATA], TARGET) if r[4] is not None]
    assert sorted((r["doc_id"], r["dsir_weight"], r["dsir_score"], r["dsir_rank"]) for r in out.collect()) == sorted(want)


def test_the_draw_leans_to_the_target(spark):
    docs = [(i, prose(i, 50) if i % 2 else " ".join(f"w{(i * 7 + k) % 90}" for k in range(50)), "en", "a") for i in range(400)]
    out = resampling.resample(documents(spark, clash=False, data=docs), target(spark, [prose(1000 + i, 60) for i in range(40)])).collect()
    assert len(out) == 100 and sum(r["doc_id"] % 2 for r in out) > 80


def test_empty_tables(spark):
    assert resampling.query(empty(spark), target(spark)).collect() == []
    got = resampling.query(documents(spark, data=DATA[:30]), target(spark, [])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([r[:2] for r in DATA[:30]], [])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZé日9 -\n_😀ß", max_size=60), st.integers(1, 3), st.integers(1, 9))
def test_windows_over_offsets_are_the_runs_of_words(text, longest, piece):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    want = [zlib.crc32(" ".join(words[i:i + k]).encode()) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    old, resampling.PIECE = resampling.PIECE, piece
    try:
        n, got = resampling.feature_hashes(resampling.splitter(), text, longest, resampling._WordCrc(), APPEND)
    finally:
        resampling.PIECE = old
    assert n == len(words) and sorted(got.tolist()) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=300), st.integers(0, 3))
def test_crc_of_joined_strings(left, right, zeros):
    right += b"\0" * (zeros * 40_000)
    got = APPEND(np.array([zlib.crc32(left)], np.uint32), np.array([zlib.crc32(right)], np.uint32), np.array([len(right)]))
    assert int(got[0]) == zlib.crc32(left + right)
