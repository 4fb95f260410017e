"""Fill-in-the-middle transformation on piece tables.

A batch of documents is a table of descriptors (buffer, start, length) over two buffers that never
change: the texts' UTF-8 bytes as Arrow holds them, and the sentinels. A cut splits a descriptor at a
code point, an arrangement puts the pieces and the sentinels in order, and only writing or hashing a
document reads its bytes, piece by piece. Restoring is the same on the transformed text: its
sentinels split it and the inverse arrangement puts the pieces back.

Texts that are empty or contain a sentinel stay plain, so a sentinel in a transformed text is one of
the three put there (none can arise across a border: ``<`` only starts one).

Defined cases: a null text is taken as empty; a null ``doc_id`` hashes as the empty string; repeated
rows are cut alike; an empty table gives an empty result; extra columns are kept (those named like the
added ones are replaced). Memory is one Arrow batch and its output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import python_tasks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Per cent of documents that are cut, and of the cut ones those in suffix-first order.
CUT_PERCENT, SPM_PERCENT, SEED = 90, 20, 1
#: Order of a form's pieces: sentinels by name, 0 prefix, 1 middle, 2 suffix.
ARRANGEMENTS = {"plain": (0,), "psm": (PREFIX, 0, SUFFIX, 2, MIDDLE, 1), "spm": (SUFFIX, 2, PREFIX, 0, MIDDLE, 1)}
TEXT, MARKS = 0, 1  # buffers
ADDED = ("fim_chars", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_sha256")


class PieceTable:
    """Documents as rows of descriptors over the texts' buffer and the sentinels' buffer."""

    marks = "".join(SENTINELS).encode()
    mark_at = {s: "".join(SENTINELS).index(s) for s in SENTINELS}

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        n = len(texts)
        at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
        self.texts, self.data = texts, memoryview(data) if data is not None else memoryview(b"")
        #: one descriptor a document at first
        self.buffer = np.full((n, 1), TEXT, np.int8)
        self.start, self.length = at[:-1].reshape(n, 1), np.diff(at).reshape(n, 1)
        raw = np.frombuffer(self.data, np.uint8)
        #: byte of every code point's start
        self.points = np.flatnonzero((raw & 0xC0) != 0x80)
        self.first = np.searchsorted(self.points, at[:-1])
        self.chars = np.searchsorted(self.points, at[1:]) - self.first

    def _byte(self, char: np.ndarray) -> np.ndarray:
        """Bytes before a document's code point number ``char`` (its length: the end)."""
        if not len(self.points):
            return np.zeros(len(char), np.int64)
        inside = char < self.chars
        point = self.points[np.where(inside, self.first + char, 0)]
        return np.where(inside, point - self.start[:, 0], self.length[:, -1] + self.start[:, -1] - self.start[:, 0])

    def cut(self, char: np.ndarray) -> "PieceTable":
        """Split the last descriptor of every document at a code point of its text."""
        border = self.start[:, 0] + self._byte(char)
        end = self.start[:, -1] + self.length[:, -1]
        self.buffer = np.column_stack([self.buffer, self.buffer[:, -1]])
        self.length = np.column_stack([self.length[:, :-1], border - self.start[:, -1], end - border])
        self.start = np.column_stack([self.start, border])
        return self

    def split_at(self, row: int, borders: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Descriptors of one document between byte ranges (begin, end) that are left out."""
        begin, end = int(self.start[row, 0]), int(self.start[row, -1] + self.length[row, -1])
        edges = [begin, *(begin + x for b in borders for x in b), end]
        return [(TEXT, edges[i], edges[i + 1] - edges[i]) for i in range(0, len(edges), 2)]

    def arrange(self, row: int, order: tuple) -> list[tuple[int, int, int]]:
        """Descriptors of a document in the given order of pieces and sentinels."""
        return [(MARKS, self.mark_at[p], len(p)) if isinstance(p, str) else
                (int(self.buffer[row, p]), int(self.start[row, p]), int(self.length[row, p])) for p in order]

    def stream(self, pieces: list[tuple[int, int, int]]) -> Iterator[memoryview | bytes]:
        """The bytes of descriptors, piece by piece, never joined."""
        for buffer, start, length in pieces:
            yield (self.marks if buffer == MARKS else self.data)[start:start + length]


def written(table: PieceTable, rows: list[list[tuple[int, int, int]]]) -> tuple[pa.Array, list[str]]:
    """The rows' texts and their SHA-256, both streamed from descriptors."""
    out, digests, offsets = bytearray(), [], [0]
    for pieces in rows:
        digest = hashlib.sha256()
        for part in table.stream(pieces):
            digest.update(part)
            out += part
        digests.append(digest.hexdigest())
        offsets.append(len(out))
    text = pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(np.asarray(offsets, np.int64)), pa.py_buffer(bytes(out)))
    return text.cast(pa.string()), digests


def _fixed_hash(id_col: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)


def _carried(docs: DataFrame, text_col: str) -> tuple[Column, list[str]]:
    own = [c for c in docs.columns if c != text_col]
    return (F.struct(*[F.col(f"`{c}`") for c in own]) if own else F.struct(F.lit(1).alias("_"))).alias("_row"), own


def _returned(df: DataFrame, docs: DataFrame, own: list[str], text_col: str, added: tuple[str, ...]) -> DataFrame:
    """The columns of ``docs`` in their order, the text replaced, then the added ones."""
    back = [F.col("_text").alias(text_col) if c == text_col else F.col(f"_row.`{c}`") for c in docs.columns if c not in added]
    return df.select(*back, *[F.col(f"_{c}").alias(c) for c in added])


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut_percent: int = CUT_PERCENT,
              spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """``docs`` with the text transformed, and ``fim_chars`` (code points of the text as it was), ``fim_form``,
    ``fim_prefix_chars``, ``fim_middle_chars`` (null where plain) and ``fim_sha256`` (of the new text).

    Cuts, form and order come from the hash of seed and id alone.
    """
    python_tasks(docs.sparkSession)
    row, own = _carried(docs, text_col)
    thin = docs.select(row, _fixed_hash(F.col(id_col), seed).alias("_h"), F.col(text_col).alias("_in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = PieceTable(batch.column(2))
            h = np.array([[int(x[i:i + 8], 16) for i in (0, 8, 16, 24)] for x in batch.column(1).to_pylist()],
                         np.int64).reshape(-1, 4)
            n = table.chars
            a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
            low, high = np.minimum(a, b), np.maximum(a, b)
            marked = np.zeros(len(n), bool)
            for s in SENTINELS:
                marked |= pc.match_substring(table.texts, s).to_numpy(zero_copy_only=False)
            plain = (n == 0) | marked | (h[:, 2] % 100 >= cut_percent)
            form = np.where(plain, "plain", np.where(h[:, 3] % 100 < spm_percent, "spm", "psm"))
            low, high = np.where(plain, n, low), np.where(plain, n, high)
            table.cut(low).cut(high)
            text, digests = written(table, [table.arrange(i, ARRANGEMENTS[f]) for i, f in enumerate(form.tolist())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), text, pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
                 pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain), pa.array(digests, pa.string())],
                ["_row", "_text", *(f"_{c}" for c in ADDED)])

    kind = thin.schema["_row"].dataType.simpleString()
    out = thin.mapInArrow(run, f"_row {kind}, _text string, _fim_chars long, _fim_form string, _fim_prefix_chars long, "
                               "_fim_middle_chars long, _fim_sha256 string")
    return _returned(out, docs, own, text_col, ADDED)


def restore(docs: DataFrame, text_col: str = "text", form_col: str = "fim_form") -> DataFrame:
    """``docs`` with the text as it was before ``transform``, read from the new text and its form alone, and
    ``fim_restored_sha256``. A text that does not have its form's sentinels raises an error."""
    python_tasks(docs.sparkSession)
    row, own = _carried(docs, text_col)
    thin = docs.select(row, F.col(form_col).alias("_form"), F.col(text_col).alias("_in"))

    def pieces(table: PieceTable, i: int, form: str) -> list[tuple[int, int, int]]:
        order = ARRANGEMENTS[form]
        if form == "plain":
            return table.arrange(i, order)
        start, end = int(table.start[i, 0]), int(table.start[i, 0] + table.length[i, 0])
        data, at, borders = bytes(table.data[start:end]), 0, []
        for mark in (p for p in order if isinstance(p, str)):
            at = data.index(mark.encode(), at)
            borders.append((at, at + len(mark)))
            at += len(mark)
        found = table.split_at(i, borders)[1:]  # nothing stands before the first sentinel
        inverse = sorted(zip((p for p in order if not isinstance(p, str)), found))
        return [piece for _, piece in inverse]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = PieceTable(batch.column(2))
            text, digests = written(table, [pieces(table, i, f) for i, f in enumerate(batch.column(1).to_pylist())])
            yield pa.RecordBatch.from_arrays([batch.column(0), text, pa.array(digests, pa.string())],
                                             ["_row", "_text", "_fim_restored_sha256"])

    kind = thin.schema["_row"].dataType.simpleString()
    out = thin.mapInArrow(run, f"_row {kind}, _text string, _fim_restored_sha256 string")
    return _returned(out, docs, own, text_col, ("fim_restored_sha256",))


def query(docs: DataFrame) -> DataFrame:
    """Contract of op12: every document transformed, and restored from output and form."""
    return restore(transform(docs.select("doc_id", "text"))).select(
        "doc_id", F.col("fim_chars").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"), F.col("fim_sha256").alias("output_sha256"),
        F.col("fim_restored_sha256").alias("restored_sha256"))


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
         sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
             ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS o FROM d),
f AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= {CUT_PERCENT} THEN 'plain'
                  WHEN o < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM k),
x AS (SELECT *, substr(t, 1, lo) AS p, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM x
"""
