"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>\\n"

Neither a role nor a text may contain "<|", the beginning of every control string; the parser
rejects it. A rendered turn is parsed again and compared with its source. If they differ, the
conflicting content is escaped and the turn is rendered anew, until they are identical: control
strings in a text get one backslash more between "<" and "|" (so "<|" never appears inside a text
and the escape can be undone one level at a time), and reserved characters of a role are
percent-coded. So the marks of a formatted turn are its own, one of each.

Turns are rendered in parallel, one row each. Reading back streams the formatted turns of each
conversation, in order, through the same parser; memory is bounded by one turn, so a conversation
with very many turns needs no group in memory (its digest is sequential by nature).

Defined results: rows are ordered by turn (null first), then by formatted text; a null text or
role is empty; a null conversation id is a conversation of its own; repeated rows are repeated
turns; extra columns are ignored; an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tectonic.llm.common import prepare

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
ROLE_CODES = {"%": "%25", "\n": "%0A", "<": "%3C"}


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return "".join(ROLE_CODES.get(c, c) for c in role)


def unescape_role(role: str) -> str:
    return re.sub("%25|%0A|%3C", lambda m: {v: k for k, v in ROLE_CODES.items()}[m[0]], role)


class Parser:
    """Deterministic incremental parser: feed text, get the completed turns as
    (role, text, start and length of the raw text)."""

    def __init__(self):
        self.rest, self.consumed = "", 0

    def feed(self, piece: str) -> Iterator[tuple[str, str, int, int]]:
        self.rest += piece
        while self.rest:
            if not self.rest.startswith(START[:len(self.rest)]):
                raise ValueError("a turn must begin with its start mark")
            line = self.rest.find("\n", len(START))
            if line < 0:
                return
            if "<|" in self.rest[len(START):line]:
                raise ValueError("a role must not contain <|")
            close = self.rest.find("<|", line + 1)
            if close < 0 or len(self.rest) < close + len(END) + 1:
                return
            if not self.rest.startswith(END + "\n", close):
                raise ValueError("a text must not contain <| and a turn must end with its end mark and a line feed")
            yield (unescape_role(self.rest[len(START):line]), unescape(self.rest[line + 1:close]),
                   self.consumed + line + 1, close - line - 1)
            self.rest, self.consumed = self.rest[close + len(END) + 1:], self.consumed + close + len(END) + 1


def parse(text: str) -> list[tuple[str, str, int, int]] | None:
    """All turns of a formatted text, or None if it doesn't follow the grammar."""
    parser = Parser()
    try:
        turns = list(parser.feed(text))
    except ValueError:
        return None
    return None if parser.rest else turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and start and length of its raw text."""
    escaped = escape(text)
    for own_role, own_text in ((role, text), (role, escaped), (escape_role(role), escaped)):
        out = f"{START}{own_role}\n{own_text}{END}\n"
        turns = parse(out)
        if turns is not None and len(turns) == 1 and turns[0][:2] == (role, text):
            return out, *turns[0][2:]
    raise ValueError("the turn can't be read back")


def _render_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [render(role or "", text or "")
               for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        loss = [length if role == LEARNED_ROLE else 0
                for role, (_, _, length) in zip(batch.column(2).to_pylist(), out)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.string()),
             pa.array([o[1] for o in out], pa.int64()), pa.array(loss, pa.int64())],
            ["conv_id", "turn", "formatted", "loss_start", "loss_length"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, formatted text, and the loss mask inside it (the raw text
    of the turns to learn: start and length in code points, 0 if none)."""
    prepare(conversations.sparkSession)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text") \
        .mapInArrow(_render_rows, "conv_id long, turn long, formatted string, loss_start long, loss_length long")


class _Reading:
    def __init__(self, conv_id):
        self.conv_id, self.parser = conv_id, Parser()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, formatted: str, loss_start: int, loss_length: int) -> None:
        self.formatted_chars += len(formatted)
        masked = unescape(formatted[loss_start:loss_start + loss_length])
        for role, text, _, _ in self.parser.feed(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())

    def row(self) -> tuple:
        if self.parser.rest:
            raise ValueError("the conversation ends inside a turn")
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.formatted_chars)


READ_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], READ_NAMES)

    current = None
    for batch in batches:
        done = []
        for conv, formatted, start, length in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if current is None or current.conv_id != conv:
                if current is not None:
                    done.append(current.row())
                current = _Reading(conv)
            current.add(formatted, start, length)
        if done:
            yield out(done)
    if current is not None:
        yield out([current.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, recovered from the formatted turns."""
    prepare(formatted.sparkSession)
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted") \
        .select("conv_id", "formatted", "loss_start", "loss_length") \
        .mapInArrow(_read_rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long")
