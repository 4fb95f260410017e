"""WARC archives compressed record by record with a shared Zstandard dictionary.

A dictionary is trained on a bounded sample of the payloads. Each archive begins with a
skippable frame that holds it; every record is one frame of its own, so any record can be read
alone. Records whose payload equals that of a smaller page id are revisits without a body.

Spark writes the archives: a partition yields its frames and the text writer puts their raw
bytes one after the other, through the usual committer, to any file system. The writer ends
each value with a line feed, so each value ends with the header of a one-byte skippable frame
whose content is that line feed. Standard Zstandard readers skip it.

Defined cases: a null payload is empty; payloads of at least ``min_dedup_bytes`` bytes are
compared, smaller ones are always responses; every row that carries the smallest page id of its
payload is a response, also if the row repeats; rows without page id never lead a payload that
another row identifies; a null url is written as an empty target; an empty table gives no
archives and no records; extra columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import land, python_tasks
from cohortflow.session import shared_scratch_path

#: Skippable frames (Zstandard format): the dictionary's, and the one that takes a line feed.
DICT_MAGIC, FEED_MAGIC = 0x184D2A5D, 0x184D2A50
FEED = struct.pack("<II", FEED_MAGIC, 1)
DICT_BYTES = 64 << 10
#: Bound of the training sample: rows and bytes of each.
SAMPLE_ROWS, SAMPLE_BYTES = 1000, 8 << 10
LEVEL = 3
#: Bytes fed to the decompressor at once.
CHUNK = 16 << 10
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(pages: DataFrame, id_col: str, payload_col: str, dict_bytes: int = DICT_BYTES, rows: int = SAMPLE_ROWS) -> bytes:
    """Train on the heads of about ``rows`` payloads drawn by hash: some rows x 8 KB on the driver, at any size.

    Small tables cannot fill a trained dictionary; their sample itself is the (raw) content.
    """
    full = pages.where(F.octet_length(payload_col) > 0)
    draw = F.pmod(F.xxhash64(id_col, payload_col), F.lit(1 << 30))
    share = min(1 << 30, (rows << 30) // max(1, full.count()))
    head = F.substring(F.col(payload_col), 1, SAMPLE_BYTES).alias("head")
    drawn = full.where(draw < max(1, share)).select(draw.alias("_draw"), head).collect()
    sample = [bytes(r["head"]) for r in sorted(drawn, key=lambda r: (r["_draw"], bytes(r["head"])))]
    try:
        return zstandard.train_dictionary(dict_bytes, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[-dict_bytes:]


def record(kind: str, page_id, url: str, payload: bytes, payload_bytes: int, payload_digest: str, refers_to) -> bytes:
    """An uncompressed WARC/1.1 record."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", DATE), ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
              ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("X-Payload-Length", str(payload_bytes))]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(payload)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if len(rest) != n + 4:
        raise ValueError("record length")
    return fields, rest[:n]


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_dedup_bytes: int = 0, dict_bytes: int = DICT_BYTES) -> None:
    """Write ``path``/part-*: each partition is one archive.

    Only (id, digest) rows are aggregated for the first page of a payload; the payloads move once,
    in the join on the digest, whose hot digest the adaptive skew join splits.
    """
    spark = pages.sparkSession
    python_tasks(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("_payload"))
    dictionary = train(rows, "_id", "_payload", dict_bytes)
    rows = rows.withColumn("_sha", F.sha1("_payload"))
    first = (rows.where(F.octet_length("_payload") >= min_dedup_bytes).groupBy("_sha")
             .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    first = land(first, "warc_first")
    # the payload of a revisit is dropped before it reaches a writer
    again = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    joined = rows.join(first, "_sha", "left").select(
        "_id", "_url", F.when(~again, F.col("_payload")).alias("_payload"), "_sha",
        F.octet_length("_payload").cast("long").alias("_bytes"), F.when(again, F.col("_first")).alias("_refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = zstandard.ZstdCompressionDict(dictionary)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=content if dictionary else None, write_checksum=True)
        lead: list[bytes] = [struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary + FEED]
        for batch in batches:
            frames = lead
            lead = []
            for page_id, url, payload, sha, n, refers in zip(*(c.to_pylist() for c in batch.columns)):
                code = base64.b32encode(bytes.fromhex(sha)).decode()
                kind = "response" if refers is None else "revisit"
                frames.append(squeeze.compress(record(kind, page_id, url, payload or b"", n, code, refers)) + FEED)
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

    frames = joined.mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(path)


def read_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive in order: (header fields, body)."""
    if not archive:
        return
    magic, n = struct.unpack_from("<II", archive)
    if magic != DICT_MAGIC:
        raise ValueError("no leading dictionary frame")
    dictionary = archive[8:8 + n]
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    source = memoryview(archive)
    at = 8 + n
    while at < len(archive):
        magic, n = struct.unpack_from("<II", archive, at)
        if magic & 0xFFFFFFF0 == FEED_MAGIC:  # any skippable frame
            at += 8 + n
            continue
        one, raw = opener.decompressobj(), []
        while not one.eof:
            if at >= len(archive):
                raise ValueError("the archive ends inside a record")
            raw.append(one.decompress(source[at:at + CHUNK]))
            at = min(at + CHUNK, len(archive)) - len(one.unused_data)
        yield parse(b"".join(raw))


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row a record, read from the archives; a response's digest and length are those of its body."""
    python_tasks(spark)
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows = []
                for fields, body in read_records(archive.as_buffer().to_pybytes()):
                    code, n = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                    kind = fields["WARC-Type"]
                    if kind == "response" and (digest(body) != code or len(body) != n):
                        raise ValueError("the payload differs from its digest")
                    own, other = (fields.get(k, "<urn:page:>")[len("<urn:page:"):-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
                    rows.append((int(own) if own else None, n, code, kind, int(other) if other else None))
                cols = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return files.mapInArrow(run, READ)


def query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Contract of op3: write the archives to the shared folder, read them back."""
    path = shared_scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
