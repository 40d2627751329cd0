"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``. A
deterministic parser reads the result back; where what it recovers is not the
source, the conflicting content is escaped once more, until it is. Escaping
puts ``2k + 1`` escape characters before a control string that has ``k`` of them
in the source, and doubles those that end a role or text, so it is reversible.

Rendering is one pass over the rows. For what is read per conversation the
rendered turns are brought together by conversation and sorted by Spark, and a
streaming parser goes through them: a task holds one turn at a time, however
long a conversation is.

Cases: null roles and texts are empty; turns are ordered by turn (nulls first),
then role and text; repeated rows are turns of their own; texts are whole; an
empty table gives an empty result; a null conversation id is a conversation;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.textblock import quoted

OPEN, CLOSE, ESCAPE = "<|im_start|>", "<|im_end|>", "\\"
# Control strings of common chat templates, never left bare in a text.
CONTROLS = (OPEN, CLOSE, "<|im_sep|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = "|".join(re.escape(c) for c in CONTROLS)
_IN_TEXT = re.compile(rf"(?<!\\)(\\*+)({_CONTROL}|\Z)")
_IN_ROLE = re.compile(rf"(?<!\\)(\\*+)({_CONTROL}|\n|\Z)")
LOSS_ROLE = "assistant"


def escape(text: str, where: re.Pattern = _IN_TEXT) -> str:
    return where.sub(lambda m: m[1] * 2 + (ESCAPE + m[2] if m[2] else ""), text)


class Parser:
    """Reads rendered turns; ``feed`` gives the (role, text) pairs that a chunk
    completes. The rest waits for the next chunk."""

    def __init__(self):
        self.buffer = ""
        self.role: str | None = None
        self.state = "out"

    def _field(self, stops: re.Pattern, ends: str, at: int) -> tuple[str, int] | None:
        """Unescaped content from ``at`` to the bare string ``ends``, and its end."""
        out = []
        for m in stops.finditer(self.buffer, at):
            if not m[2]:
                continue
            half, odd = divmod(len(m[1]), 2)
            out.append(self.buffer[at:m.start()] + ESCAPE * half)
            at = m.end()
            if odd:
                out.append(m[2])
            elif m[2] == ends:
                return "".join(out), at
            else:
                raise ValueError(f"bare {m[2]!r}")
        return None

    def feed(self, chunk: str) -> Iterator[tuple[str, str]]:
        self.buffer += chunk
        while True:
            if self.state == "out":
                if len(self.buffer) < len(OPEN):
                    return
                if not self.buffer.startswith(OPEN):
                    raise ValueError("a turn must open")
                self.buffer, self.state = self.buffer[len(OPEN):], "role"
            if self.state == "role":
                got = self._field(_IN_ROLE, "\n", 0)
                if got is None:
                    return
                self.role, self.buffer, self.state = got[0], self.buffer[got[1]:], "text"
            got = self._field(_IN_TEXT, CLOSE, 0)
            if got is None or len(self.buffer) == got[1]:
                return
            if self.buffer[got[1]] != "\n":
                raise ValueError("a turn must end with a line break")
            yield self.role, got[0]
            self.buffer, self.state = self.buffer[got[1] + 1:], "out"

    def finish(self) -> None:
        if self.buffer or self.state != "out":
            raise ValueError("unfinished turn")


def reparse(rendered: str) -> list[tuple[str, str]] | None:
    """The turns, or None if the text is not one of the grammar."""
    p = Parser()
    try:
        turns = list(p.feed(rendered))
        p.finish()
    except ValueError:
        return None
    return turns


def render_turn(role: str, text: str) -> str:
    """One turn, escaped only where it would not be read back."""
    for r, t in ((role, text), (role, escape(text)), (escape(role, _IN_ROLE), escape(text))):
        out = f"{OPEN}{r}\n{t}{CLOSE}\n"
        if reparse(out) == [(role, text)]:
            return out
    raise ValueError("turn cannot be rendered")


def render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, rendered): one rendered turn a row; a
    conversation is its turns in order, joined."""
    def run(batches):
        for b in batches:
            for i in range(0, len(b), 1024):
                part = b.slice(i, 1024)
                made = [render_turn(r, t) for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.string())], names=["conv_id", "turn", "role", "text", "rendered"])

    empty = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(""))
    src = turns.select(quoted(conv).cast("long").alias("conv_id"), quoted(turn).cast("long").alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    return src.mapInArrow(run, "conv_id long, turn long, role string, text string, rendered string")


class Reader:
    """What is read back from one conversation."""

    def __init__(self):
        self.parser = Parser()
        self.n = self.chars = self.loss = 0
        self.turns, self.mask = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text in self.parser.feed(rendered):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == LOSS_ROLE:
                self.loss += len(text)
                self.mask.update(text.encode())

    def row(self, conv) -> tuple:
        self.parser.finish()
        return conv, self.n, self.turns.hexdigest(), self.loss, self.mask.hexdigest(), self.chars


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation, from the rendered text alone: turns, their digest, the
    texts under the loss mask (assistant) and the length."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        conv, reader = None, None
        for b in batches:
            done = []
            for c, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if reader is None or c != conv:
                    if reader is not None:
                        done.append(reader.row(conv))
                    conv, reader = c, Reader()
                reader.add(text)
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=names)
        if reader is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(reader.row(conv), types)], names=names)

    return (rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "rendered")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
