"""Token ids in binary files: fixed-width bit packing with block offsets.

A file holds whole documents in ascending order of their ids. Every token id takes the
minimum bits of the vocabulary; ids are packed in blocks that start on a byte, and the
file's table of block offsets lets a reader unpack any range with numpy.

Layout, all numbers little-endian::

    8 bytes   magic
    4 x u64   bits per id, ids per block, number of ids, number of documents
    i64[docs] document ids          u8[docs]  1 where the document id is null
    u64[docs] end of each document, counted in ids
    u64[blocks + 1] byte offset of each block behind this table, and of the end
    blocks

Tasks write a file under a name of their own and rename it when it is whole; a repeated
task writes the same bytes again.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edgeloom.llm.shingles import column_bytes
from edgeloom.llm.tables import written
from edgeloom.session import scratch_path

MAGIC = b"EDGEIDS1"
END_ID = 0
BLOCK = 4096
#: Ids after which a file ends with the current document.
FILE_IDS = 1 << 22
#: Pieces of text from which a generation is full (a worker remembers two), and their most letters.
REMEMBERED, LONG_PIECE = 1 << 18, 64
#: Letters of the texts that are encoded at a time, the last one aside.
AT_A_TIME = 1 << 23


# --------------------------------------------------------------------- packing

def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(int(vocabulary - 1).bit_length(), 1)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other, lowest bit first, filled up to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    places = np.arange(bits, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> places) & 1 != 0, bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """``n`` ids of 32 bits."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    loose = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little")
    whole = np.zeros((n, 32), np.uint8)
    whole[:, :bits] = loose.reshape(n, bits)
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").reshape(n)


def write_file(out: BinaryIO, doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, bits: int) -> None:
    blocks = [pack(ids[i:i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    offsets = np.cumsum([0, *map(len, blocks)])
    out.write(MAGIC)
    out.write(np.array([bits, BLOCK, len(ids), len(doc_ids)], "<u8").tobytes())
    out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    out.write(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    out.write(ends.astype("<u8").tobytes())
    out.write(offsets.astype("<u8").tobytes())
    for block in blocks:
        out.write(block)


class TokenFile:
    """A file of packed ids; reads the table at once and blocks on demand."""

    def __init__(self, source: BinaryIO):
        self._source = source
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a file of packed token ids")
        self.bits, self.block, self.n_ids, n_docs = map(int, self._numbers("<u8", 4))
        ids, missing = self._numbers("<i8", n_docs), self._numbers(np.uint8, n_docs)
        self.doc_ids = [None if gone else int(i) for i, gone in zip(ids, missing)]
        self.ends = self._numbers("<u8", n_docs).astype(np.int64)
        self._offsets = self._numbers("<u8", -(-self.n_ids // self.block) + 1).astype(np.int64)
        self._base = source.tell()

    def _numbers(self, kind, n: int) -> np.ndarray:
        return np.frombuffer(self._source.read(np.dtype(kind).itemsize * n), kind, n)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to before ``end``; reads the blocks they lie in."""
        if start >= end:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        self._source.seek(self._base + int(self._offsets[first]))
        data = self._source.read(int(self._offsets[last + 1] - self._offsets[first]))
        blocks = []
        for i in range(first, last + 1):
            at = int(self._offsets[i] - self._offsets[first])
            n = min(self.block, self.n_ids - i * self.block)
            blocks.append(unpack(data[at:at + -(-n * self.bits // 8)], self.bits, n))
        return np.concatenate(blocks)[start - first * self.block:end - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


# -------------------------------------------------------------------- encoding

class PieceEncoder:
    """Ids of whole texts, asking the tokenizer once per piece of text.

    A piece runs up to a blank or line feed that follows no other white space, or up to a
    common mark behind a letter or digit. The vocabulary's own rule for cutting texts always
    cuts there and looks no further back, so pieces give the ids of the whole text; natural
    text repeats most of its pieces. Texts are cut and their pieces numbered in Arrow, each
    different piece is looked up once per call, and the ids are gathered by the pieces' numbers.
    Short pieces met lately are remembered in two generations: when a call leaves the younger
    one full, the older one goes, and pieces met again move to the younger.
    """

    _BEHIND_SPACE = re.compile(r"\s[ \n]|\x01")
    _CUT = re.compile(r"(?<=\S)(?=[ \n])")
    #: Where a piece ends before marks; what follows is told by a character of its own.
    _MARKS, _MARKED = r"([\pL\pN])([.,;:!?]+)", "\\1 \x01\\2"

    def __init__(self, path: str):
        # Spark has a task on every core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.vocabulary = self._tokenizer.get_vocab_size()
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _looked_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; ``pieces`` should differ."""
        found = list(map(self._young.get, pieces))
        known, ask, tokenize = self._old.get, [], self._model.tokenize
        young, packs = self._young, len(_PACK)
        for i in [i for i, ids in enumerate(found) if ids is None]:
            piece = pieces[i]
            if (ids := known(piece)) is None:
                letters = piece[1:]
                if piece[:1] != " " or not letters.isalpha():
                    ask.append(i)
                    continue
                # Letters behind a blank are one word of the vocabulary's rule.
                if letters.isascii():
                    word = _BLANK + letters
                else:
                    word = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
                own = [t.id for t in tokenize(word)]
                ids = _PACK[len(own)](*own) if len(own) < packs else _four_bytes(own)
            found[i] = young[piece] = ids
        if ask:
            told = self._tokenizer.encode_batch_fast([pieces[i] for i in ask], add_special_tokens=False)
            for i, e in zip(ask, told):
                found[i] = young[pieces[i]] = _four_bytes(e.ids)
        self._forget(pieces)
        return found

    def _forget(self, pieces: list[str]) -> None:
        """Long pieces at once; the older generation when the younger one is full."""
        for piece in [p for p in pieces if len(p) > LONG_PIECE]:
            self._young.pop(piece, None)
        if len(self._young) >= REMEMBERED:
            self._old, self._young = self._young, {}

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        odd = [i for i, t in enumerate(texts) if t[:1] in (" ", "\n") or self._BEHIND_SPACE.search(t)]
        # Where no white space meets another, cuts are at blanks, one being put before line feeds.
        plain = [t.replace("\n", " \n") for t in texts]
        for i in odd:
            plain[i] = ""
        marked = pc.replace_substring_regex(pa.array(plain, pa.large_string()), self._MARKS, self._MARKED)
        lists = pc.split_pattern(marked, " ")
        cut, first = lists.values.dictionary_encode(), lists.offsets.to_numpy()[:-1]
        code = cut.indices.to_numpy().astype(np.int64)
        later = np.ones(len(code), bool)
        later[first] = False
        seen = np.flatnonzero(np.bincount(code[later], minlength=len(cut.dictionary)))
        values = [v.decode() for v in column_bytes(cut.dictionary.take(pa.array(seen)))]
        known = self._looked_up([_piece(v) for v in values])
        heads = self._looked_up(cut.dictionary.take(pa.array(code[first])).to_pylist())
        for i in odd:
            pieces = self._CUT.split(texts[i])
            own = dict.fromkeys(pieces)
            own = dict(zip(own, self._looked_up(list(own))))
            heads[i] = b"".join(map(own.__getitem__, pieces))
        # Numbers of pieces: first the different ones behind a blank, then each text's first.
        number = np.zeros(len(cut.dictionary), np.int64)
        number[seen] = np.arange(len(seen))
        number = number[code]
        number[first] = len(seen) + np.arange(len(first))
        sizes = np.array([len(x) // 4 for x in (*known, *heads)], np.int64)
        ids = np.frombuffer(b"".join((*known, *heads)), "<u4")
        base, n = np.cumsum(sizes) - sizes, sizes[number]
        at = np.repeat(base[number] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return ids[at], np.add.reduceat(n, first) if len(first) else n

    def encode(self, text: str) -> bytes:
        """Ids of one text as little-endian 32-bit numbers."""
        return self.encode_many([text])[0].tobytes()


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable characters of Latin-1 stand for themselves, the other bytes, in ascending
    order, for the characters from 256 on.
    """
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()
_BLANK = _BYTE_LETTERS[ord(" ")]
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _four_bytes(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


def _piece(cut: str) -> str:
    """A piece as the text has it: behind a blank, a line feed or, told apart by its sign, a letter."""
    if cut[:1] == "\x01":
        return cut[1:]
    return cut if cut[:1] == "\n" else " " + cut


@cache
def _encoder(path: str) -> PieceEncoder:
    """One per Python worker, which serves many tasks."""
    return PieceEncoder(path)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``AT_A_TIME`` bytes of text."""
    size = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // AT_A_TIME
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Encodes ``text`` of every document into files below ``path``.

    Returns the files: ``part``, ``file``, ``path``, ``n_docs``, ``n_ids``; in the order
    of ``part``, ``file`` documents ascend by ``doc_id`` (null first; repeated ids by a hash
    of the text). A null text is empty; every document ends with ``end_id``, so it has at
    least one id. A document is never split over files. No documents give no files.
    """
    fs_path = path
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, encoder = TaskContext.get(), _encoder(tokenizer)
        bits = bits_for(max(encoder.vocabulary, end_id + 1))
        system, root = _filesystem(fs_path)
        doc_ids, parts, sizes, total, number = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            name = f"{root}/part-{context.partitionId():06d}-{number:04d}.ids"
            mine = f"{name}.{context.taskAttemptId()}"
            ids = np.concatenate(parts)
            with system.open_output_stream(mine) as out:
                write_file(out, doc_ids, np.cumsum(np.concatenate(sizes)), ids, bits)
            system.move(mine, name)
            return pa.RecordBatch.from_pydict({
                "part": [context.partitionId()], "file": [number], "path": [name],
                "n_docs": [len(doc_ids)], "n_ids": [len(ids)],
            })

        system.create_dir(root, recursive=True)
        for batch in batches:
            for some in _slices(batch):
                ids, n = encoder.encode_many(some.column(1).to_pylist())
                n = n + 1
                ended = np.full(len(ids) + len(n), end_id, "<u4")
                inside = np.ones(len(ended), bool)
                inside[np.cumsum(n) - 1] = False
                ended[inside] = ids
                doc_ids += some.column(0).to_pylist()
                parts.append(ended)
                sizes.append(n)
                total += len(ended)
                if total >= FILE_IDS:
                    yield flush()
                    doc_ids, parts, sizes, total, number = [], [], [], 0, number + 1
        if doc_ids:
            yield flush()

    schema = "part long, file long, path string, n_docs long, n_ids long"
    return written(dealt.mapInArrow(write, schema), "token-files")


def read_tokens(files: DataFrame, path: str) -> DataFrame:
    """Each document from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it, over all files.
    """
    order = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    placed = files.select(
        "path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("first")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(path)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(name) as source:
                    file = TokenFile(source)
                    ids, starts = file.ids(0, file.n_ids), np.concatenate([[0], file.ends[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(file.doc_ids, pa.int64()), pa.array(first + starts),
                    pa.array(file.ends - starts),
                    pa.array([
                        zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, file.ends)
                    ], pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # A stated number of tasks, since Spark would merge so few and so short rows into one.
    spread = placed.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the token files of all documents to the shared folder and reads them back."""
    path = scratch_path(docs.sparkSession, "token-ids")
    return read_tokens(write_tokens(docs, tokenizer, path), path)
