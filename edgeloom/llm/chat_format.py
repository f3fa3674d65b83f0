"""Chat formatting: conversations as one text with a loss mask, and back.

Template, per turn: ``<|turn|>role<|text|>content<|end|>``. Every control string begins
with ``<|``. In roles and contents a ``<``, any backslashes and a ``|`` get one backslash
more, so ``<|`` never occurs in them; the reader takes one away again. Other text stays
as it is.

Turns are formatted a column at a time: lengths of all segments, their cumulative
offsets and scatter indices are computed in numpy, and headers and contents are copied
into one preallocated Arrow buffer. A conversation is a run of rows, one per turn, so
its length is bounded by nothing but the disk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm.tables import written

TURN, TEXT, END = b"<|turn|>", b"<|text|>", b"<|end|>"
#: The role whose texts are learned from.
LEARNED = "assistant"

#: Bytes of short segments that are copied by their indices at a time, and of what is no longer short.
SCATTERED, LONG = 1 << 20, 1 << 16
#: Bytes of a text that are unescaped at a time.
READ = 1 << 20

_ESCAPED = r"<(\\*)\|"
_ONE_MORE = r"<\\\1|"
_UNESCAPE = re.compile(rb"<\\(\\*)\|")
_TURN = re.compile(rb"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)


def escape(column: pa.Array) -> pa.Array:
    """Roles or contents without control strings; null is empty."""
    return pc.replace_substring_regex(column.fill_null(""), _ESCAPED, _ONE_MORE)


def unescape(content: bytes) -> bytes:
    return _UNESCAPE.sub(rb"<\1|", content)


def unescaped(content: memoryview) -> Iterator[bytes]:
    """``content`` as it was before it was escaped, piece by piece.

    No piece ends with ``<`` or a backslash, so no escaped string is cut.
    """
    start, size = 0, len(content)
    while start < size:
        stop = min(start + READ, size)
        while stop < size and content[stop - 1] in b"<\\":
            stop += 1
        yield unescape(bytes(content[start:stop]))
        start = stop


def _characters(piece: bytes) -> int:
    """Code points of UTF-8, some of which may begin or end elsewhere: bytes that begin one."""
    return int(np.count_nonzero((np.frombuffer(piece, np.uint8) & 0xC0) != 0x80))


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Copies ``sizes[i]`` bytes of ``data`` from ``starts[i]`` on to ``out`` from ``at[i]`` on.

    Short ones by their indices, ``SCATTERED`` bytes at a time; long ones each as a whole.
    """
    long = sizes > LONG
    for i in np.flatnonzero(long).tolist():
        out[at[i]:at[i] + sizes[i]] = data[starts[i]:starts[i] + sizes[i]]
    at, starts, sizes = at[~long], starts[~long], sizes[~long]
    part = (np.cumsum(sizes) - sizes) // SCATTERED
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(sizes)) if len(sizes) else []
    for a, b in zip(cuts, cuts[1:]):
        n = sizes[a:b]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(at[a:b], n) + inside] = data[np.repeat(starts[a:b], n) + inside]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data, starts and sizes of a string column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return content, places[:-1], np.diff(places)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted turns, and where the text of each begins and ends in its turn, in bytes."""
    columns = [_bytes_of(escape(roles)), _bytes_of(escape(texts))]
    (role, role_at, role_size), (text, text_at, text_size) = columns
    n = len(roles)
    head = len(TURN) + role_size + len(TEXT)
    sizes = head + text_size + len(END)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    start = offsets[:-1]
    out = np.empty(int(offsets[-1]), np.uint8)
    for control, at in ((TURN, start), (TEXT, start + head - len(TEXT)), (END, start + head + text_size)):
        out[(at[:, None] + np.arange(len(control))).ravel()] = np.tile(np.frombuffer(control, np.uint8), n)
    _scatter(out, start + len(TURN), role, role_at, role_size)
    _scatter(out, start + head, text, text_at, text_size)
    formatted = pa.Array.from_buffers(
        pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)]
    )
    return formatted, head, head + text_size


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, formatted, loss_start, loss_end``, one row per turn.

    ``turns`` has ``conv_id, turn, role, text``; null roles and texts are empty, rows of
    a null ``conv_id`` are one conversation, null turns come first. ``loss_start`` and
    ``loss_end`` are byte places in ``formatted`` and null unless the role is ``assistant``.
    Other columns are not read. An empty table gives no rows.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column(2)
            formatted, start, end = assemble(roles, batch.column(3))
            silent = ~np.array(pc.equal(roles, LEARNED).fill_null(False).to_pylist(), bool)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), formatted.cast(pa.string()),
                pa.array(start, pa.int64(), mask=silent), pa.array(end, pa.int64(), mask=silent),
            ], names=["conv_id", "turn", "formatted", "loss_start", "loss_end"])

    source = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    return source.mapInArrow(
        build, "conv_id long, turn long, formatted string, loss_start long, loss_end long"
    )


class _Reading:
    """What is known of one conversation while its turns go by."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: bytes, start: int | None, end: int | None) -> None:
        whole = memoryview(formatted)
        for i in range(0, len(whole), READ):
            self.chars += _characters(whole[i:i + READ])
        for turn in _TURN.finditer(formatted):
            for group in (1, 2):
                for piece in unescaped(whole[turn.start(group):turn.end(group)]):
                    self.turns.update(piece)
                self.turns.update(b"\n")
            self.n_turns += 1
        if start is not None:
            for piece in unescaped(whole[start:end]):
                self.loss.update(piece)
                self.loss_chars += _characters(piece)

    def row(self, conv_id: int | None) -> tuple:
        return (conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars)


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, read from formatted turns.

    Turns of a conversation are put in order and read one after the other, with the state
    of one conversation in memory; equal turn numbers are ordered by the formatted text.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, rows = None, None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if n.endswith("256") else pa.int64())
                 for n, v in zip(names, zip(*rows))], names=names
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3)]
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for conv_id, start, end, text in zip(*columns, texts):
                if state is None or conv_id != current:
                    if state is not None:
                        rows.append(state.row(current))
                    current, state = conv_id, _Reading()
                state.add(text, start, end)
            if len(rows) > 4096:
                yield done()
                rows = []
        if state is not None:
            rows.append(state.row(current))
        if rows:
            yield done()

    ordered = formatted.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "formatted"
    )
    return ordered.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(read, schema)


def with_probe(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``turns`` and a conversation that is made of control strings."""
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    own = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    return own.union(probe)


def chat_report(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Formats all conversations and the probe, writes them, and digests what was written."""
    return read_conversations(
        written(format_conversations(with_probe(spark, turns)), "chat-formatted")
    )
