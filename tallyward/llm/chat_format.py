"""Chat formatting with a grammar round trip.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  A deterministic parser
reads the rendered turn again; if what it recovers differs from the source, the text is
escaped (one backslash more in every ``<\\...\\|``) and rendered anew, so ordinary texts
stay as they are and every text comes back exactly.

Turns are rendered where they lie, one row each, so that a conversation of any length
needs no more memory than its longest turn.  The joined segments of a conversation in
turn order are its formatted text; `read_back` parses exactly those.

NULL text and NULL role count as empty.  Repeated rows are turns of their own; turns
with equal numbers follow in the order of their rendered segments, a NULL number comes first,
and rows with a NULL conversation id form one conversation.  A very long turn is rendered
whole.  Further columns are left out, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyward.llm.common import texts_of

START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose texts are learned from.
LEARNED = ("assistant",)

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

SEGMENTS = "conv_id long, turn long, segment string, loss_start long, loss_end long"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered text; ValueError if it does not follow the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = rendered.find("\n", at)
        end = rendered.find(END + "\n", line + 1)
        if line < 0 or end < 0:
            raise ValueError(f"the turn at {at} does not end")
        role, text = rendered[at + len(START) : line], rendered[line + 1 : end]
        if START in role + text or END in role + text:
            raise ValueError(f"a control string inside the turn at {at}")
        turns.append((unescape(role).replace("\\n", "\n").replace("\\\\", "\\"), unescape(text)))
        at = end + len(END) + 1
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment and the span of its text, escaped until it reads back."""
    for level in (0, 1):
        name = escape(role.replace("\\", "\\\\").replace("\n", "\\n")) if level else role
        body = escape(text) if level else text
        segment = f"{START}{name}\n{body}{END}\n"
        try:
            if parse(segment) == [(role, text)]:
                start = len(START) + len(name) + 1
                return segment, start, start + len(body)
        except ValueError:
            pass
    raise ValueError(f"a turn of role {role!r} cannot be rendered")


def format_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn: its segment of the formatted text, and the code points of the
    segment to learn from (empty span for other roles)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for role_, text_ in zip(texts_of(batch.column(2)), texts_of(batch.column(3)), strict=True):
                segment, start, end = render(role_, text_)
                rows.append((segment, start, end) if role_ in LEARNED else (segment, start, start))
            segments, starts, ends = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(segments, pa.string()),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv_id", "turn", "segment", "loss_start", "loss_end"],
            )

    chosen = turns.select(F.col(conv).cast("long"), F.col(turn).cast("long"), role, text)
    return chosen.mapInArrow(run, SEGMENTS)


class _Digest:
    """Running digests of one conversation, read from its segments."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, end: int) -> None:
        for role, text in parse(segment):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        learned = unescape(segment[start:end])
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())
        self.chars += len(segment)

    def row(self) -> tuple:
        return (
            self.conv_id, self.n_turns, self.turns.hexdigest(),
            self.loss_chars, self.loss.hexdigest(), self.chars,
        )


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation what a parser finds in its formatted text.

    A conversation's segments reach one task in order and are read one by one; only
    running digests are kept, however long it is.
    """
    names = [field.split()[0] for field in DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Digest | None = None
        for batch in batches:
            done = []
            for conv_id, segment, start, end in zip(
                *[batch.column(at).to_pylist() for at in (0, 2, 3, 4)], strict=True
            ):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv_id)
                current.add(segment, start, end)
            if done:
                yield _table(done)
        if current is not None:
            yield _table([current.row()])

    def _table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=names)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.mapInArrow(run, DIGESTS)
