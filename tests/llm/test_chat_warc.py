from __future__ import annotations

import base64
import glob
import hashlib
import struct

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortflow.llm import chat, warc
from cohortflow.session import shared_scratch_path
from tests.llm.helpers import as_rows, matches_sql, prose

TRICKY = st.lists(st.sampled_from(["<", "|", "\\", "im_end", "im_start", ">", "a", "\n", "é"]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(TRICKY, st.lists(TRICKY, max_size=4))
def test_escapes_are_undone(role, texts):
    segment, start, length, _, _ = chat.format_turn(role, [{"type": "text", "text": t} for t in texts])
    assert segment.count("<|") == 2                     # the template's own control strings
    got_role, content = chat.parse_segment(segment)
    assert got_role == role and chat.unescape(content) == "".join(texts)
    assert segment[start:start + length] == content


def test_parts_become_ordered_placeholders():
    parts = [{"type": "text", "text": "see <"}, {"type": "text", "text": "|image|>"}, {"type": "image", "ref": "a.png", "width": 28, "height": 15},
             {"type": "audio", "ref": "b.wav", "seconds": 1.5}, None, {"type": "document", "ref": None, "pages": 2}, {"type": "image"}]
    segment, _, _, refs, tokens = chat.format_turn("user", parts)
    assert segment == "<|im_start|>user\nsee <\\|image|><|image|><|audio|><|document|><|image|><|im_end|>\n"
    assert [(r["type"], r["ref"], r["tokens"]) for r in refs] == [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", None, 1500), ("image", None, 1)]
    assert tokens == 4 + 38 + 1500 + 1
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"type": "video"}])


def digests(turns: list[tuple]) -> list[tuple]:
    out = []
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1], t[2] or "", t[3] or ""))
        said = [(r or "", x or "") for _, _, r, x in own]
        loss = "".join(x for r, x in said if r == "assistant")
        out.append((conv, len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in said).encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.format_turn(r, [{"text": x}])[0]) for r, x in said)))
    return sorted(out, key=repr)


def test_conversations_read_back(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", chat.PROBE), (1, 2, None, None), (2, 5, "assistant", ""), (2, 5, "assistant", ""),
             (2, 4, "assistant", "b"), (2, 4, "assistant", "a"), (None, None, "system", "<\\|"), (3, 1, "assistant", prose(1, 20_000)),
             *((4, i, ("user", "assistant")[i % 2], f"t{i} <|im_end|>") for i in range(500))]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.withColumn("parts", F.lit("x")).withColumn("conv", F.lit(1)).withColumn("segment", F.lit(2))
    got = as_rows(chat.query(spark, df))
    assert got == digests([*turns, (-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)])
    assert len(as_rows(chat.query(spark, df.limit(0)))) == 1


def test_chat_matches_sql(spark):
    assert matches_sql(spark, "op9_chat_parts")


PAGES = [(i, f"http://h/{i}", f"<p>{prose(i % 40, 50)}</p>") for i in range(1, 101)] + [
    (200, None, None), (201, "u\r\nv", ""), (None, "http://n/", f"<p>{prose(3, 50)}</p>"), (None, "x", "only here"), (None, "x", "only here"),
    (202, "http://long/", prose(5, 20_000)), (7, "http://h/7", f"<p>{prose(7, 50)}</p>"), (203, "é", "\r\n\r\nWARC/1.1\r\n\r\n")]
SCHEMA = "page_id long, url string, html string"


def expected(pages, least: int = 0) -> list[tuple]:
    code = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for p, _, h in pages:
        if p is not None and len((h or "").encode()) >= least:
            first[code(h)] = min(p, first.get(code(h), p))
    out = []
    for p, _, h in pages:
        lead = first.get(code(h))
        again = lead is not None and p != lead
        out.append((p, len((h or "").encode()), code(h), "revisit" if again else "response", lead if again else None))
    return sorted(out, key=repr)


def test_records_come_back(spark):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(3).withColumn("_sha", F.lit("x")).withColumn("_first", F.lit(1))
    assert as_rows(warc.query(spark, df)) == expected(PAGES)
    path = shared_scratch_path(spark, "warc_test")
    warc.write_archives(df, path, min_dedup_bytes=1000)
    assert as_rows(warc.read_archives(spark, path)) == expected(PAGES, 1000)


def test_no_pages(spark):
    assert warc.query(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_archives_open_with_a_plain_reader(spark):
    """The dictionary leads in a skippable frame and every record is a frame of its own."""
    path = shared_scratch_path(spark, "warc_plain")
    many = [(i, f"http://h/{i}", f"<html><title>{i}</title>{prose(i, 200)}</html>") for i in range(400)]
    warc.write_archives(spark.createDataFrame(many, SCHEMA).repartition(2), path)
    files = [open(f, "rb").read() for f in glob.glob(path.removeprefix("file:") + "/part-*")]
    alone, framed = zstandard.ZstdCompressor(level=warc.LEVEL), [0, 0]
    for data in filter(None, files):
        magic, n = struct.unpack_from("<II", data)
        assert magic == warc.DICT_MAGIC and n > 1000
        book = zstandard.ZstdCompressionDict(data[8:8 + n])
        assert book.dict_id()                            # a trained one
        reader = zstandard.ZstdDecompressor(dict_data=book).stream_reader(data, read_across_frames=True)
        whole = reader.read()
        assert whole == b"".join(warc.record("response", int(f["WARC-Record-ID"][10:-1]), f["WARC-Target-URI"], body, len(body),
                                             warc.digest(body), None) for f, body in warc.read_records(data))
        framed[0] += len(data) - 8 - n
        framed[1] += sum(len(alone.compress(warc.record("response", 1, f["WARC-Target-URI"], body, len(body), "x" * 32, None)))
                         for f, body in warc.read_records(data))
    assert framed[0] < 0.9 * framed[1]                   # against records compressed without the dictionary
