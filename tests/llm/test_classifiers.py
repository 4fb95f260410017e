from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import deobfuscate as D
from cohortflow.llm import quality, toxicity
from cohortflow.llm.labels import logistic
from tests.llm.helpers import documents, empty, prose, rows

LABELS = "doc_id long, quality int, toxic int"


def held(doc_id, folds, fold):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == fold


def junk(seed: int, n: int) -> str:
    r = random.Random(seed)
    kind = r.randrange(3)
    words = prose(seed, n).split()
    if kind == 0:
        return " ".join(w + r.choice(("%%%", "***", "###")) for w in words)
    return " ".join(w.upper() + "!!" for w in words) if kind == 1 else " ".join(w for w in words[:5] for _ in range(n // 5))


BAD = ("moron", "idiot", "scum")
DISGUISED = ("1d10t", "m0r0n", "s.c.u.m", "i d i o t", "morooooon", "$cum", "id|ot")


def corpus():
    """900 documents; every ninth is junk, every seventh toxic; both labels for two thirds of them."""
    r = random.Random(1)
    docs, labels = [], []
    for i in range(900):
        text = junk(i, 80) if i % 9 == 0 else prose(i, 80) + "."
        if i % 7 == 0:
            words = text.split()
            for _ in range(1 + i % 3):
                words.insert(r.randrange(len(words)), r.choice(BAD) if i % 2 else r.choice(BAD).upper())
            text = " ".join(words)
        docs.append((i, text, "en", f"s{i % 5}"))
        if i % 3:
            labels.append((i, int(i % 9 != 0), int(i % 7 == 0)))
    # i % 3 == 0 leaves no junk labelled, so junk gets labels too
    labels += [(i, 0, int(i % 7 == 0)) for i in range(0, 900, 9)]
    return docs, labels


def labels_of(spark, data):
    extra = [(None, 1, 1), (5000, 1, 0), (1, None, None)]
    return spark.createDataFrame([*data, *extra, *data[:10]], LABELS).withColumn("_y", F.lit("x")).withColumn("text", F.lit("y"))


def test_descent_reaches_the_optimum():
    """Against projected gradient steps on the same dual."""
    r = np.random.default_rng(3)
    rows_ = [np.unique(r.integers(0, 12, 5)).astype(np.int32) for _ in range(40)]
    y = np.where(r.random(40) < 0.5, 1, -1)
    ratio = np.zeros(quality.BUCKETS)
    ratio[:12] = r.normal(size=12)
    w = quality.descend(rows_, y, ratio, cost=0.7, epochs=3000)
    x = np.zeros((40, 13))
    for i, f in enumerate(rows_):
        x[i, f] = quality.unit(f, ratio)
    x[:, 12] = 1
    q = (y[:, None] * x) @ (y[:, None] * x).T
    a = np.zeros(40)
    for _ in range(200_000):
        a = np.clip(a - 0.01 * (q @ a - 1), 0, 0.7)
    primal = lambda v: 0.5 * v @ v + 0.7 * np.maximum(0, 1 - y * (x @ v)).sum()
    mine = np.append(w[:12], w[-1])
    assert primal(mine) <= primal((a * y) @ x) * 1.01 + 1e-6


def test_shapes_and_repeats_are_indicators():
    shapes = {quality._shape(w) for w in ("abc", "Abc", "ABC!!", "abc%%%", "abc,", "|", "123")}
    assert len(shapes) == 7
    assert quality._shape("abc%%%") == quality._shape("xyz%%%%%%")
    assert set(quality.indicators("a b")) != set(quality.indicators("a a"))
    assert len(quality.indicators("")) == 0 and len(quality.indicators(" \n")) == 0


def test_quality_of_held_out_documents(spark):
    docs, labels = corpus()
    out = quality.query(documents(spark, data=docs), labels_of(spark, labels)).collect()
    assert len(out) == 900
    for r in out:
        assert r["held_out"] == held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    known = {i: q for i, q, _ in labels}
    tested = [r for r in out if r["held_out"] and r["doc_id"] in known]
    assert sum(r["predicted"] == known[r["doc_id"]] for r in tested) >= 0.97 * len(tested)
    kept = quality.keep_good(documents(spark, data=docs), labels_of(spark, labels))
    assert kept.columns == documents(spark).columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in out if r["predicted"]}


@pytest.mark.parametrize("query", [quality.query, toxicity.query])
def test_awkward_rows_are_scored(spark, query):
    train = [(i, int(i % 2), int(i % 2)) for i in range(1, 31)]
    out = query(documents(spark), labels_of(spark, train)).collect()
    assert len(out) == len(rows()) and all(0 <= r["score"] <= 1 for r in out)
    by_id = {}
    for r in out:
        by_id.setdefault(r["doc_id"], []).append(r["score"])
    assert by_id[40] == by_id[41] == by_id[42] and by_id[45] == by_id[46]
    # no labels, one class only, no documents
    assert {r["predicted"] for r in query(documents(spark), labels_of(spark, train).limit(0)).collect()} <= {0, 1}
    ones = query(documents(spark), spark.createDataFrame([(i, 1, 0) for i in range(1, 31)], LABELS)).collect()
    assert {r["predicted"] for r in ones} == ({1} if query is quality.query else {0})
    assert query(empty(spark), labels_of(spark, train)).collect() == []


def test_toxicity_of_held_out_and_disguised_documents(spark):
    docs, labels = corpus()
    extra = [(1000 + i, f"{prose(i, 40)} {d} {prose(i + 50, 40)}", "en", "x") for i, d in enumerate(DISGUISED)]
    one = [(1200 + i, f"{prose(i, 30)} {w} {prose(i + 9, 30)}", "en", "x") for i, w in enumerate(BAD)]
    long = [*one, (1100, prose(77, 15_000) + " idiot, " + prose(78, 3000), "en", "x"), (1101, prose(77, 15_000), "en", "x")]
    out = {r["doc_id"]: r for r in toxicity.query(documents(spark, data=[*docs, *extra, *long]), labels_of(spark, labels)).collect()}
    assert all(r["held_out"] == held(i, 5, 0) for i, r in out.items())
    known = {i: t for i, _, t in labels}
    for y in (0, 1):
        tested = [r["predicted"] == y for i, r in out.items() if r["held_out"] and known.get(i) == y]
        assert sum(tested) >= 0.97 * len(tested)
    assert [d for i, d in enumerate(DISGUISED) if not out[1000 + i]["predicted"]] == []
    assert [w for i, w in enumerate(BAD) if not out[1200 + i]["predicted"]] == []    # a single word is enough
    assert out[1100]["predicted"] == 1 and out[1101]["predicted"] == 0


@pytest.fixture(scope="module")
def restorer():
    counts = np.zeros(D.SIZE ** D.ORDER, np.int64)
    for i in range(300):
        D.count_grams(prose(i, 100) + " the idiot and the moron are worthless scum", counts)
    return D.Restorer(D.language_model(counts))


def test_lattices_are_decoded(restorer):
    for disguised, word in (("1d10t", "idiot"), ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("m*r*n", "moron"), ("$cum", "scum"),
                            ("w0rthl3ss!!!", "worthless"), ("MORON".lower(), "moron"), ("m0r0n,", "moron"), ("ïdïot", "idiot")):
        assert word in restorer.word(disguised), disguised
    assert restorer.spaced("an i d i o t and m-o-r-o-n") == ["idiot", "moron"]


def test_clean_words_stay(restorer):
    for word in ("bado", "talmer,", "nesuko.", "(riko)", "ünï", "日本語", "dori%%%", "bado!!"):
        assert restorer.word(word)[0] == word.strip(D._EDGE)
    assert restorer.word("555-1234") == () and restorer.word("***") == ()


def test_search_equals_listing_all_paths(restorer):
    """Viterbi against every path of small lattices."""
    from itertools import product

    def price(said):
        s = p = 0.0
        s = 0
        for x in said:
            c = D.LETTERS.find(x) + 1
            if c or s % D.SIZE:
                p += float(restorer.prices[s * D.SIZE + c])
            s = (s * D.SIZE + c) % D.SIZE ** (D.ORDER - 1) if c else 0
        return p + (float(restorer.prices[s * D.SIZE]) if s % D.SIZE else 0.0)

    for word in ("1d10t", "m0r.n", "aab*", "$c*m", "s c u m"):
        runs = D._runs(word)
        ways = product(*(D._choices(c, n, 0 < i < len(runs) - 1) for i, (c, n) in enumerate(runs)))
        best = min(sum(c for _, c in w) + price("".join(x for x, _ in w)) for w in ways)
        got = D.viterbi(word, restorer.prices)
        again = product(*(D._choices(c, n, 0 < i < len(runs) - 1) for i, (c, n) in enumerate(runs)))
        assert min(sum(c for _, c in w) + price(got) for w in again if "".join(x for x, _ in w) == got) <= best + 1e-4


def test_long_spans_are_read_in_one_pass(restorer):
    """Words that cross any fixed cut stay whole, and several wild signs keep every path."""
    words = ["the", "idiot", "and", "the", "moron", "are", "worthless", "scum"] * 30
    spaced = " ".join(" ".join(w) for w in words)
    read = restorer.spaced(spaced)
    assert read.count("idiot") == read.count("moron") == read.count("worthless") == 30
    dotted = ".".join("worthless" * 20)
    assert restorer.word(dotted)[-20:] == ("worthless",) * 20


def test_no_path_is_pruned(restorer):
    """The optimum of a lattice with more states than any beam, by a plain pass over all of them."""
    word, plane = "w*r*h*l*s*", D.SIZE ** (D.ORDER - 1)
    runs = D._runs(word)
    dense = np.full(plane, np.inf)
    dense[0] = 0.0
    for i, (char, length) in enumerate(runs):
        step = np.full(plane, np.inf)
        for state in np.flatnonzero(np.isfinite(dense)):
            for letters, channel in D._choices(char, length, 0 < i < len(runs) - 1):
                s, p = int(state), dense[state] + channel
                for x in letters:
                    c = D.LETTERS.find(x) + 1
                    p += float(restorer.prices[s * D.SIZE + c]) if c or s % D.SIZE else 0.0
                    s = (s * D.SIZE + c) % plane if c else 0
                step[s] = min(step[s], p)
        dense = step
    best = min(p + (float(restorer.prices[s * D.SIZE]) if s % D.SIZE else 0.0) for s, p in enumerate(dense) if np.isfinite(p))
    assert abs(D.search(word, restorer.prices)[0] - best) < 1e-3


@pytest.fixture(scope="module")
def rude():
    counts = np.zeros(D.SIZE ** D.ORDER, np.int64)
    for i in range(300):
        D.count_grams(prose(i, 100) + " a stupid ass and an asshole, an idiot and a loser", counts)
    return D.Restorer(D.language_model(counts))


def test_every_token_has_a_lattice(rude):
    """Doubled letters, words of imitations only, imitating signs at an edge; the plain reading stays."""
    for disguised, word in (("stuupid", "stupid"), ("iddiott", "idiot"), ("455", "ass"), ("@$$", "ass"), ("10532", "loser"),
                            ("$tup1d", "stupid"), ("@55hole", "asshole"), ("!d10t", "idiot"), ("(!d!ot)", "idiot"), ("455.", "ass")):
        assert word in rude.word(disguised), (disguised, rude.word(disguised))
    for plain in ("stuupid", "iddiott", "asshole"):
        assert rude.word(plain)[0] == plain
    assert rude.word("idiot!")[0] == "idiot" and rude.word("!!!") == ()


def test_letters_and_chunks_set_apart_are_joined(rude):
    """Any spaces and signs between letters, an imitating sign first, chunks; plain words stay apart."""
    for apart in ("s t u p i d", "s  t  u  p  i  d", "s . t . u . p . i . d", "s\tt\tu\tp\ti\td", "s t u\np i d", "s\u00a0t\u00a0u p i d",
                  "$ t u p i d", "$ t u p ! d", "stu pid", "st up id", "s tu pid", "s t u p i d!", "s - t, u / p - i: d"):
        assert "stupid" in rude.spaced(f"bado {apart} nesuko"), (apart, rude.spaced(f"bado {apart} nesuko"))
    assert rude.spaced("bado id iot nesuko") == ["idiot"] and rude.spaced("bado ass hole, nesuko") == ["asshole"]
    assert rude.spaced("an and an and a ass") == [] and rude.spaced("") == []
    r = random.Random(4)
    for _ in range(300):  # cut where neighbours decide, or read whole: the same words
        chunks = ["".join(r.choice("adeinorstu") for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 8))]
        whole = [w for w in D.viterbi(" ".join(chunks), rude.prices).split() if len(w) > 2 and w not in chunks]
        assert [w for w in rude.spaced(" ".join(chunks)) if w not in chunks] == whole
    assert rude.joined(tuple("stupid")) == tuple(D.viterbi("s t u p i d", rude.prices).split())


def test_rare_words_are_kept_however_many_there_are(spark):
    """Words that pass the bound by their own counts stay, behind thousands of more frequent families."""
    r = random.Random(8)
    names = list(dict.fromkeys("".join(r.choice("bcdfgklmnprstvz") + r.choice("aeiou") for _ in range(5)) for _ in range(9000)))
    often, rare = names[:6000], names[6000:6020]
    docs, labels = [], []
    for i in range(120):  # each frequent word in 20 toxic documents, each rare one in 12
        words = often[i % 6 * 1000:i % 6 * 1000 + 1000] + ([] if i % 10 else rare)
        docs.append((i, " ".join(words), "en", "x"))
        labels.append((i, 1, 1))
    docs += [(1000 + i, prose(i, 30), "en", "x") for i in range(300)]
    labels += [(1000 + i, 1, 0) for i in range(300)]
    docs += [(2000 + i, f"{prose(i, 20)} {w} {prose(i + 7, 20)}", "en", "x") for i, w in enumerate(rare)]
    data = documents(spark, clash=False, data=docs)
    rows_ = data.join(spark.createDataFrame(labels, LABELS), "doc_id").selectExpr("doc_id AS _id", "text AS _text", "toxic AS _y")
    model = toxicity.fit(data, rows_)
    kept = {x["feature"] for x in model.kept.collect()}
    assert set(rare) <= kept and set(often) <= kept and len(kept) > 20_000
    out = toxicity.scored(data.where("doc_id >= 1000").select("doc_id", F.col("text").alias("_text")), model, "_text").collect()
    clean, toxic = ([x["score"] for x in out if (x["doc_id"] >= 2000) == y] for y in (False, True))
    assert len(toxic) == 20 and max(clean) < min(toxic), (max(clean), min(toxic))


def test_curve_orders_scores():
    r = np.random.default_rng(5)
    x = r.uniform(0, 5, (400, 2))
    y = x[:, 0] > 2.5
    a, _, c = logistic(x, y)
    assert a > 0 and np.mean((a * x[:, 0] + c > 0) == y) > 0.95
    a, b, _ = logistic(x, x[:, 0] - x[:, 1] > 0)         # what counts against the label is left out
    assert a > 0 and b == 0
    far = np.array([[0.0], [0.1], [9.0], [9.1]])         # separable rows have a fit too
    a, c = logistic(far, far[:, 0] > 5)
    assert 1 / (1 + np.exp(-(9 * a + c))) > 0.7 and 1 / (1 + np.exp(-c)) < 0.3


def test_chunks_of_any_length_are_joined():
    """A word cut anywhere between its letters is restored, in the midst of text and beside short words."""
    counts = np.zeros(D.SIZE ** D.ORDER, np.int64)
    bad = ("stupid", "pathetic", "worthless", "disgusting")
    for i in range(200):
        D.count_grams(prose(i, 100) + " you are a " + " and ".join(bad), counts)
    restorer = D.Restorer(D.language_model(counts))
    for apart in ("pathe tic", "pat hetic", "stupi d", "s tupid", "wor thless", "disgu sting", "dis gusting", "d i s g u s t i n g"):
        word = apart.replace(" ", "")
        for around in (apart, f"bado {apart} nesuko", f"you are a {apart}, and a {apart}!"):
            assert word in restorer.spaced(around), (around, restorer.spaced(around))
    assert restorer.spaced("you are a bado nesuko and a talmer") == []


def test_gaps_decided_at_once_equal_the_search(rude):
    """Chunks of all lengths, doubles, accents and imitations: the words of one search over the whole text."""
    r = random.Random(6)
    for _ in range(400):
        chunks = ["".join(r.choice("aeinorstlé") for _ in range(r.randint(1, 7))) for _ in range(r.randint(2, 9))]
        same = {*chunks, *map(D._base, chunks)}
        whole = [w for w in D.viterbi(" ".join(chunks), rude.prices).split() if len(w) > 2]
        assert [w for w in rude.spaced(" ".join(chunks)) if w not in same] == [w for w in whole if w not in same], chunks
    pieces = [["s", "tupid"], [], ["ass"], ["hole"], ["wor", "(", "thy"]]
    assert rude.set_apart(pieces) == [rude.spaced(" ".join(p), p) for p in pieces] and rude.set_apart([]) == []


def test_many_spans_are_searched_at_once(rude, monkeypatch):
    """All at once, halved where they are many, and cut where they are long: the readings of one search each."""
    r = random.Random(11)
    spans = ["".join(r.choice("aabdeiorsstupé$1!*. ") for _ in range(r.randint(0, 12))) for _ in range(400)] + ["w*r*h*l*s*", "日本!", "\U0001F600a"]
    one = [D.viterbi(span, rude._price) for span in spans]
    assert D.Lattices(rude.prices).search(spans) == one
    monkeypatch.setattr(D, "_MOST", 500)
    assert D.Lattices(rude.prices).search(spans) == one
    long = [" ".join(r.choice(("bado", "id iot", "stu pid", "n!ce", "aass")) for _ in range(60)), "s t u p i d " * 60]
    assert rude._readings([*long, "455"]) == [D.viterbi(span, rude._price) for span in (*long, "455")]


def test_texts_of_a_batch_are_restored_like_each_alone(rude):
    texts = ["Bado s t u p i d, nesuko", None, "", " \t\n", "$TUP1D and\x1fid iot!! ass hole", "stuupid stuupid (asshole) bado. ïdïot",
             "bado ass", "hole nesuko", "st up id!! 日本語 555-1234 m-o-r-o-n"]
    restorer = D.Restorer(rude.prices)
    for _ in range(2):  # again, from what is remembered
        for text, words in zip(texts, restorer.restored(pa.array(texts)).to_pylist()):
            pieces = (text or "").lower().split()
            alone = {*rude.spaced("", pieces)}.union(*map(rude.word, pieces))
            assert sorted(words.split()) == sorted(alone), text
    assert restorer.restored(pa.array([], pa.string())).to_pylist() == []


def test_features_pass_the_filter_by_their_crc():
    words = ["", "a", "idiot", "ïdïot", "日本語日本語日本語", "x" * 200, "stupidity"]
    assert toxicity.crc32(pa.array(words)).tolist() == [zlib.crc32(w.encode()) for w in words]
    assert toxicity.crc32(pa.array(words).slice(2), b"*").tolist() == [zlib.crc32(w.encode() + b"*") for w in words[2:]]


def test_feature_counts_equal_counting_each_text(spark):
    texts = [("idiot ïdïotisch stupidity", 1), ("idiotic idiots", 1), ("idiot stupidity bado", 0), ("", 1), ("nesukotalmer bado", 0), ("idiots idiot idioti", 0)]
    data = spark.createDataFrame(texts, "_text string, _y int")
    held = [(y, {f for w in t.split() for f in toxicity.features(w)}) for t, y in texts]
    counts = {r["feature"]: (r["toxic"], r["clean"]) for r in toxicity.label_counts(data).collect()}
    every = {f: tuple(sum(f in some for y, some in held if y == label) for label in (1, 0)) for _, some in held for f in some}
    assert counts == {f: n for f, n in every.items() if n[0] >= toxicity.MIN_TOXIC}
