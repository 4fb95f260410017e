"""Chat formatting of typed content parts.

A turn's content is a list of parts (text, image, audio, document). A visitor walks them in
order: text goes through the template's escape, every other part becomes a placeholder, its
reference is recorded and its expanded token count added. A turn is formatted in its own row,
so a conversation is never held whole: its output is the concatenation of its segments in
order of ``seq``. The reader parses segments back and streams each conversation's digests.

The template is ``<|im_start|>role\\n content <|im_end|>\\n``. Inside texts and roles a
backslash is put behind every ``<`` that ``|`` follows, at once or after backslashes; so no
text contains a control string, and taking one backslash away there restores it. Adjacent
text parts are joined before that. In roles, backslashes and line ends are escaped too.

Defined cases: a null text or role is empty, a null part list is a turn without content; turns
are ordered by turn (nulls first), role and text, so ties and repeated rows have one order and
each stays a turn; a null conv_id is a conversation; an empty table gives no conversations;
extra columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import land, python_tasks

START, END = "<|im_start|>", "<|im_end|>"
#: Role under the loss mask.
LOSS_ROLE = "assistant"
#: Placeholder of each part type, and its expanded tokens: fixed, by pixels, by seconds, by pages.
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PATCH, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 14, 25, 750
PART = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class PartVisitor:
    """Flattens the parts of one turn into text with ordered placeholders."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.text: list[str] = []  # adjacent text parts, not yet escaped
        self.refs: list[dict] = []
        self.tokens = 0

    def visit(self, part: dict | None) -> None:
        kind = (part or {}).get("type") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown part type {kind!r}")
        method(part or {})

    def visit_text(self, part: dict) -> None:
        self.text.append(part.get("text") or "")

    def content(self) -> str:
        self.out.append(escape("".join(self.text)))
        self.text = []
        return "".join(self.out)

    def visit_image(self, part: dict) -> None:
        across, down = (-(-(part.get(side) or 0) // PATCH) for side in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, -int(-(part.get("seconds") or 0.0) * TOKENS_PER_SECOND // 1))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * TOKENS_PER_PAGE)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.out += [escape("".join(self.text)), PLACEHOLDERS[kind]]
        self.text = []
        self.refs.append({"type": kind, "ref": part.get("ref"), "tokens": max(1, tokens)})
        self.tokens += max(1, tokens)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, int, int, list[dict], int]:
    """Segment, start and length of its content in code points, attachments, their tokens."""
    visitor = PartVisitor()
    for part in parts or []:
        visitor.visit(part)
    head = f"{START}{escape_role(role or '')}\n"
    content = visitor.content()
    return f"{head}{content}{END}\n", len(head), len(content), visitor.refs, visitor.tokens


def text_parts(text: Column) -> Column:
    """A content list of a single text part."""
    fields = {"text": text.cast("string"), "type": F.lit("text")}
    names = [f.split(":") for f in PART[len("array<struct<"):-2].split(",")]
    return F.array(F.struct(*[fields.get(n, F.lit(None).cast(t)).cast(t).alias(n) for n, t in names]))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         parts_col: str = "parts") -> DataFrame:
    """A row a turn: conv, order columns, ``segment``, ``loss`` span (start, length) or null, attachments.

    Row by row, without a shuffle. ``loss`` covers an assistant turn's content.
    """
    python_tasks(turns.sparkSession)
    thin = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                        F.col(parts_col).cast(PART).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, parts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            done = [format_turn(r, p) for r, p in zip(roles, parts)]
            loss = [{"start": s, "length": n} if r == LOSS_ROLE else None for r, (_, s, n, _, _) in zip(roles, done)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in done], pa.string()),
                 pa.array(loss, pa.struct([("start", pa.int32()), ("length", pa.int32())])),
                 pa.array([x[3] for x in done], pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()),
                                                                    ("tokens", pa.int64())]))),
                 pa.array([x[4] for x in done], pa.int64())],
                ["conv", "turn", "segment", "loss", "attachments", "attachment_tokens"])

    kinds = {c: thin.schema[c].dataType.simpleString() for c in ("conv", "turn")}
    return thin.mapInArrow(run, f"conv {kinds['conv']}, turn {kinds['turn']}, segment string, "
                                "loss struct<start:int,length:int>, "
                                "attachments array<struct<type:string,ref:string,tokens:bigint>>, attachment_tokens long")


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and content (still escaped) of a formatted turn."""
    if not (segment.startswith(START) and segment.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    role, _, content = segment[len(START):-len(END) - 1].partition("\n")
    return unescape_role(role), content


class _Reader:
    """Digests of one conversation, fed turn by turn."""

    def __init__(self) -> None:
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, segment: str, span: dict | None) -> None:
        role, content = parse_segment(segment)
        text = unescape(content)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if span is not None:
            learned = unescape(segment[span["start"]:span["start"] + span["length"]])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode("utf-8", "surrogatepass"))

    def row(self, conv) -> tuple:
        return (conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


READ = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its segments.

    Segments are sorted by conversation inside partitions and streamed: the memory is one
    running digest, however many turns a conversation has.
    """
    kind = formatted.schema["conv"].dataType.simpleString()
    rows = (formatted.select("conv", "turn", "segment", "loss").repartition("conv")
            .sortWithinPartitions("conv", "turn", "segment").select("conv", "segment", "loss"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], list(READ))

        reader, conv, done, conv_type = None, None, [], None
        for batch in batches:
            conv_type = batch.column(0).type
            for c, segment, span in zip(*(col.to_pylist() for col in batch.columns)):
                if reader is None or c != conv:
                    if reader is not None:
                        done.append(reader.row(conv))
                    reader, conv = _Reader(), c
                reader.feed(segment, span)
            if len(done) >= 1000:
                yield out(done)
                done = []
        if reader is not None:
            yield out([*done, reader.row(conv)])

    return rows.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long")


PROBE = f"{END}{START}assistant ok"


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Contract of op9: all conversations and conversation -1, formatted, written, read back."""
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    formatted = format_conversations(turns.withColumn("parts", text_parts(F.col("text"))))
    return read_conversations(land(formatted, "chat_segments"))


SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS esc,
             regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS erole FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, erole, esc)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, esc) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('{START}' || erole || chr(10) || esc || '{END}' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
