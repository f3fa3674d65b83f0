"""Hashes of words and of runs of words, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multipliers; any would do.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that lets every input bit reach every output bit."""
    values = (values ^ (values >> _HALF)) * _MIX
    values = (values ^ (values >> _HALF)) * _MIX
    return values ^ (values >> _HALF)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` words, in order; none for fewer words than that."""
    n = len(hashes) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for i in range(1, width):
        total = mixed(total) * _STEP + hashes[i:i + n]
    return mixed(total)


def text_slices(texts: pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """First and end row of slices of a column of texts, of about ``size`` bytes each."""
    n = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(n) - n) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(n)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def column_bytes(column: pa.LargeStringArray) -> list[bytes]:
    """The bytes of a column without nulls, sooner than by way of its own scalars."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(ends, ends[1:])]


def hashed_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of all texts one after the other, and the number of words of each."""
    known, code, n = numbered_words(texts, lower)
    return known[code], n


def numbered_words(texts: pa.Array, lower: bool = False, names=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words, the number of every word among them, and how many each text has.

    ``names`` makes the hashes of a column of words, by default those of ``word_hashes``.

    Words are cut and numbered in Arrow, and each different one is hashed once. No text is
    taken apart in Python, so a very long one costs little more than its words.
    """
    # Taken row by row: Arrow lower-cases a slice of a column wrongly.
    texts = pc.fill_null(texts.cast(pa.large_string()), "").take(pa.array(np.arange(len(texts))))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    cut = lists.flatten().dictionary_encode()
    known = names(cut.dictionary) if names else word_hashes(column_bytes(cut.dictionary))
    # White space at either end of a text leaves an empty piece there.
    code = cut.indices.to_numpy()
    kept = pc.binary_length(cut.dictionary).to_numpy(zero_copy_only=False)[code] > 0
    ends = np.append(0, np.cumsum(kept))[np.cumsum(pc.list_value_length(lists).to_numpy())]
    return known, code[kept], np.diff(np.append(0, ends))
