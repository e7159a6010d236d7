"""Chat formatting with typed content parts.

A turn's content is a list of typed parts: text, image, audio or document. A visitor
flattens the parts in order: text is escaped, any other part becomes a placeholder, is
recorded as an attachment (place, reference) and stands for as many tokens as its kind
expands to. Texts side by side are escaped as one, so that no control string forms at a seam;
``read_parts`` gives back texts and placeholders apart. Turns are framed as ``### Role: text</turn>``; inside texts the backslash and
the first character of every control string are escaped, which ``read_back`` undoes.

Defined results: NULL text or content is empty; a NULL role is written as ``null`` with a
mark and read back as NULL; turns are ordered by number, NULL first, ties by role and text;
repeated turns all count; a conversation without rows does not exist; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm.rows import named

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: What a part of each kind expands to, in tokens, and its placeholder.
KINDS = {"image": 256, "audio": 128, "document": 512}
CONTROL = re.compile(r"\\|###|</turn>|<(?=(?:image|audio|document)\|)")
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\]|\\.)*?)</turn>\n", re.S)
FORMATTED = (
    "conv_id long, formatted string, loss array<struct<start:long,end:long>>, "
    "attachments array<struct<turn:long,place:long,kind:string,reference:string,tokens:long>>, "
    "attachment_tokens long"
)


def escape(text: str) -> str:
    """A backslash before each backslash and control string."""
    return CONTROL.sub(lambda found: "\\" + found.group(), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _escape_role(role: str | None) -> str:
    return "\\0" if role is None else escape(role).replace(":", "\\:")


def _read_role(role: str) -> str | None:
    return None if role == "\\0" else unescape(role)


@dataclass
class Visitor:
    """Collects the text and the attachments of one turn."""

    turn: int
    pieces: list[str] = field(default_factory=list)
    attachments: list[tuple] = field(default_factory=list)
    length: int = 0
    waiting: list[str] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def visit_text(self, part: dict) -> None:
        self.waiting.append(part.get("text") or "")

    def flush(self) -> None:
        """Texts that stand side by side are escaped together."""
        self._add(escape("".join(self.waiting)))
        self.waiting = []

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"unknown content part: {part.get('type')}")

    def _attach(self, part: dict) -> None:
        self.flush()
        kind, reference = part["type"], part.get("reference") or ""
        tokens = KINDS[kind] * max(1, part.get("units") or 1)
        self.attachments.append((self.turn, self.length, kind, reference, tokens))
        self._add(f"<{kind}|{len(self.attachments)}|{tokens}>")

    visit_image = visit_audio = visit_document = _attach


def format_turns(turns: list[tuple], loss_role: str = "assistant") -> tuple:
    """Formatted text, loss spans, attachments and their tokens of one conversation.

    ``turns``: role and content, where content is text or a list of parts.
    """
    out, loss, attachments, at = [], [], [], 0
    for number, (role, content) in enumerate(turns):
        visitor = Visitor(number)
        for part in content if isinstance(content, list) else [{"text": content}]:
            visitor.visit(part)
        visitor.flush()
        head, body = f"{OPEN}{_escape_role(role)}{COLON}", "".join(visitor.pieces)
        start = at + len(head)
        if role == loss_role:
            loss.append((start, start + len(body)))
        attachments += [(t, start + p, k, r, n) for t, p, k, r, n in visitor.attachments]
        out += [head, body, CLOSE]
        at = start + len(body) + len(CLOSE)
    return "".join(out), loss, attachments, sum(a[4] for a in attachments)


BODY_PART = re.compile(r"<(image|audio|document)\|([0-9]+)\|([0-9]+)>|((?:\\.|(?!<(?:image|audio|document)\|).)+)", re.S)


def read_parts(body: str) -> list[str | tuple[str, int, int]]:
    """Texts and placeholders (kind, number in the turn, tokens) of a turn's body, in order."""
    return [
        unescape(found[4]) if found[4] is not None else (found[1], int(found[2]), int(found[3]))
        for found in BODY_PART.finditer(body)
    ]


def bodies(formatted: str) -> list[str]:
    """What stands between the marks of each turn, as it is written."""
    return [found[2] for found in TURN.finditer(formatted)]


def read_back(formatted: str) -> list[tuple[str | None, str]]:
    """Roles and texts of a formatted conversation; placeholders stay in the texts."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"not a turn at {at}")
        turns.append((_read_role(found.group(1)), unescape(found.group(2))))
        at = found.end()
    return turns


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    found = [("turn", pa.int64()), ("place", pa.int64()), ("kind", pa.string())]
    found += [("reference", pa.string()), ("tokens", pa.int64())]
    kinds = [pa.string(), spans, pa.list_(pa.struct(found)), pa.int64()]
    for batch in batches:
        made = []
        for turns in batch.column("turns").to_pylist():
            contents = [(t["role"], t["text"] if t["parts"] is None else t["parts"]) for t in turns]
            text, loss, attachments, tokens = format_turns(contents)
            loss = [{"start": a, "end": b} for a, b in loss]
            attachments = [dict(zip([n for n, _ in found], a)) for a in attachments]
            made.append((text, loss, attachments, tokens))
        columns = list(zip(*made)) if made else [()] * 4
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
        names = ["conv_id", "formatted", "loss", "attachments", "attachment_tokens"]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *arrays], names)


def format_conversations(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    parts: str | None = None,
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss, attachments, attachment_tokens``.

    ``parts`` names a column of typed parts (``array<struct<type, text, reference, units>>``)
    that stands in for the text where it is not NULL. A conversation becomes one string, so
    its own turns, and nothing else, come together in a task.
    """
    own = named(rows, conv_id=conv_id, turn=turn, role=role, text=text)
    none = F.lit(None).cast("array<struct<type:string,text:string,reference:string,units:long>>")
    own = own.withColumn("parts", none) if parts is None else named(
        rows, conv_id=conv_id, turn=turn, role=role, text=text, parts=parts
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "parts")))
    whole = own.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(turns.alias("turns"))
    return whole.mapInArrow(_formatted, FORMATTED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            text = row["formatted"]
            turns = read_back(text)
            whole = "".join(f"{role or ''}\n{said}\n" for role, said in turns)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in row["loss"])
            shas = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
            values = (row["conv_id"], len(turns), shas[0], len(loss), shas[1], len(text))
            rows.append(dict(zip(names, values)))
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(DIGEST_SCHEMA))


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)
DIGEST_SCHEMA = [
    (name, pa.string() if kind == "string" else pa.int64())
    for name, kind in (part.split() for part in DIGEST.split(", "))
]


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back, as counts and hashes."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(_digest, DIGEST)
