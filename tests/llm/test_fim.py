from __future__ import annotations

import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException

from cohortflow.llm import fim
from tests.llm.helpers import documents, empty, matches_sql, prose, rows

HARD = ["a", "é", "日本語", "😀😀", "<P", "x<", "<<<", "a<P>b", "<M>", "<S>x", "\x00\n", "S><P", "<P <S <M", "ab<", "<" * 30, "é" * 5000]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text) -> tuple:
    t = text or ""
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    a, b, c, o = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    lo, hi = sorted((a % (len(t) + 1), b % (len(t) + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return doc_id, len(t), "plain", None, None, t
    p, m, s = t[:lo], t[lo:hi], t[hi:]
    spm = o % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(t), "spm" if spm else "psm", lo, hi - lo, out


DATA = [*rows(), *((1000 + 50 * k + i, t, None, None) for i, t in enumerate(HARD) for k in range(8)), (2000, prose(1, 200_000), "en", "a")]


def test_every_document_follows_the_rule_and_comes_back(spark):
    docs = documents(spark, data=DATA)
    cut = fim.transform(docs)
    assert cut.columns == [*docs.columns, *fim.ADDED]
    got = sorted((tuple(r) for r in cut.select("doc_id", "fim_chars", "fim_form", "fim_prefix_chars", "fim_middle_chars", "text").collect()), key=repr)
    assert got == sorted((brute(r[0], r[1]) for r in DATA), key=repr)
    back = fim.restore(cut)
    assert sorted((repr((r["doc_id"], r["text"])) for r in back.collect())) == sorted(repr((r[0], r[1] or "")) for r in DATA)
    assert {r["fim_form"] for r in cut.collect()} == {"plain", "psm", "spm"}


def test_digests(spark):
    got = sorted((tuple(r) for r in fim.query(documents(spark, data=DATA)).collect()), key=repr)
    want = []
    for r in DATA:
        *head, out = brute(r[0], r[1])
        want.append((*head, sha(out), sha(r[1] or "")))
    assert got == sorted(want, key=repr)


def test_extra_columns_and_empty_tables(spark):
    docs = documents(spark, data=DATA[:5]).selectExpr("*", "7 as fim_form", "8 as `_text`")
    out = fim.transform(docs)
    assert out.columns == [c for c in docs.columns if c != "fim_form"] + list(fim.ADDED)
    assert out.first()["_text"] == 8
    assert fim.query(empty(spark)).collect() == []


def test_a_text_without_its_sentinels_is_an_error(spark):
    bad = documents(spark, clash=False, data=[(1, "no sentinel", "en", "a")]).selectExpr("*", "'psm' as fim_form")
    with pytest.raises(PythonException):
        fim.restore(bad).collect()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="aé日😀<PSM>", max_size=12)), st.integers(0, 20), st.integers(0, 20)), max_size=8),
       st.integers(0, 3))
def test_pieces_are_slices_at_code_points(data, skip):
    import numpy as np

    array = pa.array([t for t, _, _ in data], pa.string()).slice(min(skip, len(data)))  # a slice has an offset of its own
    data = data[min(skip, len(data)):]
    table = fim.PieceTable(array)
    lens = [len(t or "") for t, _, _ in data]
    a = np.array([min(x, n) for (_, x, _), n in zip(data, lens)], np.int64)
    b = np.array([min(max(x, y), n) for (_, x, y), n in zip(data, lens)], np.int64)
    table.cut(a).cut(b)
    for i, (t, _, _) in enumerate(data):
        t = t or ""
        parts = [b"".join(table.stream([p])).decode() for p in table.arrange(i, (0, 1, 2))]
        assert parts == [t[:a[i]], t[a[i]:b[i]], t[b[i]:]]


def test_fim_matches_sql(spark):
    assert matches_sql(spark, "op12_fill_in_middle")
