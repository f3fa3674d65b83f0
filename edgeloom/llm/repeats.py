"""Suffix-array dedup of bytes: substrings that start a second time are removed.

Bucket-pointer refinement. Suffixes enter buckets by their first q bytes; buckets are
refined by the bucket identifiers of later offsets, identifiers that were refined before
being used again at twice the depth, until suffixes agree on ``LENGTH`` bytes.

At corpus scale the first buckets are shared out by Spark. Of the q-byte strings inside
any ``LENGTH`` bytes the one of least hash (the leftmost of several) is its anchor, so
equal strings have equal anchors at equal offsets, and one position in thirty-seven is
one. An anchor's *context* is the stretch of all strings that it anchors in one place.
Round by round only what is not settled yet is refined:

1. anchors in buckets by their q bytes; an anchor alone in its bucket is settled;
2. equal contexts of a bucket: all but the first are removed as a whole;
3. first contexts of a bucket that holds several different ones: their bytes are brought
   together by bucket and refined suffix by suffix, exactly, in numpy.

Buckets with more than ``CROWD`` different contexts take part in round 3 string by
string, spread by a 128-bit hash. Equal contexts and strings are combined inside
each task's batches before they are shuffled, so a passage in a third of all documents
costs one row per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import text_bytes, written

LENGTH = 100
Q = 32
#: q-byte strings inside a string of ``LENGTH``.
INSIDE = LENGTH - Q + 1
#: Different contexts of a bucket up to which one task compares them: 2.7 MB at most.
CROWD = 16_384
#: Bytes of one text that are hashed at a time.
SEGMENT = 1 << 22
#: Bytes of contexts that are refined at a time, whole buckets aside.
CHUNK = 1 << 22
#: Neighbours whose strings are compared at a time.
COMPARED = 1 << 16

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_HALF, _THIRD = np.uint64(32), np.uint64(29)


# -------------------------------------------------------------- anchors (rounds 1, 2)

def q_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit identifier of the ``Q`` bytes from each position on, by doubling."""
    found = text.astype(np.uint64) * _A
    found ^= found >> _THIRD
    size = 1
    while size < Q:
        pair = found[:-size] * _A + (found[size:] ^ _B) * _B
        pair ^= pair >> _THIRD
        pair *= _A
        found, size = pair ^ (pair >> _HALF), 2 * size
    return found


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, start and size of each context of a text.

    A context is the run of strings that share an anchor. A text is taken in segments, and
    a context that crosses their border counts as two.
    """
    buckets, starts, sizes = [], [], []
    data = np.frombuffer(text, np.uint8)
    for base in range(0, len(data) - LENGTH + 1, SEGMENT):
        hashes = q_hashes(data[base:base + SEGMENT + LENGTH - 1])
        n = len(hashes) - INSIDE + 1
        least, width = hashes, 1
        while 2 * width <= INSIDE:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[:n], least[INSIDE - width:INSIDE - width + n])
        # The next string has another anchor if a smaller hash enters or the anchor leaves.
        moved = (least[1:] != least[:-1]) | (hashes[:n - 1] == least[:-1])
        new = np.append(0, np.flatnonzero(moved) + 1)
        buckets.append(least[new])
        starts.append(base + new)
        sizes.append(np.diff(np.append(new, n)) + LENGTH - 1)
    if not buckets:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(buckets), np.concatenate(starts), np.concatenate(sizes)


def _ranks(ids: list, ties: list) -> np.ndarray:
    """Place of each row in the order of documents; null ids come first."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, ties[i]))
    ranks = np.empty(len(ids), np.int64)
    ranks[order] = np.arange(len(ids))
    return ranks


_ROUND = "bucket long, context long, doc_id long, tie int, start int, end int"


def _round(rows: pa.RecordBatch, which: np.ndarray, bucket, context, start, end) -> pa.RecordBatch:
    """Rows of ``_ROUND``; ``rows`` has ``doc_id`` and ``tie``. Without a context a row is a mark."""
    n, places = len(which), pa.array(which)
    numbers = [
        pa.nulls(n, pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in (bucket, context)
    ]
    return pa.RecordBatch.from_arrays([
        *numbers, rows.column("doc_id").take(places), rows.column("tie").take(places),
        pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)),
    ], names=[c.split()[0] for c in _ROUND.split(", ")])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of all texts as ``_ROUND``; what a batch has already is a mark."""
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        rows, buckets, contexts, starts, ends = [], [], [], [], []
        for i, text in enumerate(texts):
            bucket, start, size = anchors(text)
            rows.append(np.full(len(bucket), i))
            buckets.append(bucket)
            starts.append(start)
            ends.append(start + size)
            contexts.append(np.fromiter(
                (xxhash.xxh3_64_intdigest(text[a:b])
                 for a, b in zip(start.tolist(), ends[-1].tolist())), np.uint64, len(start),
            ))
        if not rows:
            continue
        row, bucket, context, start, end = map(
            np.concatenate, (rows, buckets, contexts, starts, ends)
        )
        ranks = _ranks(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist())
        order = np.lexsort((start, ranks[row], context, bucket))
        same = (np.diff(bucket[order]) == 0) & (np.diff(context[order]) == 0)
        again = np.zeros(len(row), bool)
        again[order[1:][same]] = True
        yield _round(batch, row[~again], bucket[~again], context[~again], start[~again], end[~again])
        row, start, end = row[again], start[again], end[again]
        if not len(row):
            continue
        # Marks that touch are one; their places spread them over the partitions.
        new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > end[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        spread = (row[first].astype(np.uint64) * _A) ^ (start[first].astype(np.uint64) * _B)
        yield _round(batch, row[first], spread, None, start[first], end[last])


def _settle_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rounds 1 and 2 over contexts in the order of bucket, context and place.

    Passes marks on, turns repeated contexts into marks and keeps the first of each context
    where its bucket holds several. Only the row before is remembered. A bucket at either
    end of a batch may go on beyond it and counts as holding several.
    """
    before = None
    for batch in batches:
        known = pc.is_null(batch.column("context"))
        if pc.any(known).as_py():
            yield batch.filter(known)
            batch = batch.filter(pc.invert(known))
        if not batch.num_rows:
            continue
        bucket, context, start, end = (
            batch.column(c).to_numpy() for c in ("bucket", "context", "start", "end")
        )
        opens = np.append(before is None or bucket[0] != before[0], bucket[1:] != bucket[:-1])
        new = opens | np.append(before is None or context[0] != before[1], context[1:] != context[:-1])
        before = bucket[-1], context[-1]
        group = np.cumsum(np.append(True, bucket[1:] != bucket[:-1])) - 1
        several = np.bincount(group, new) > 1
        several[[0, -1]] = True
        kept, again = np.flatnonzero(new & several[group]), np.flatnonzero(~new)
        yield _round(batch, kept, bucket[kept], context[kept], start[kept], end[kept])
        yield _round(batch, again, None, None, start[again], end[again])


# ------------------------------------------------------------------ refinement (round 3)

class Buckets:
    """Suffixes of ``data`` in buckets, refined until those of one agree on ``depth`` bytes.

    ``order`` holds the suffixes, bucket after bucket; ``pointer`` names the bucket of each by
    its last place there, so pointers compare as the suffixes do. A bucket whose suffixes agree
    on ``n`` bytes is sorted by the pointers ``n`` bytes further on and split where these differ;
    the new pointers are written back at once, and the buckets that come after it in the same
    pass sort by them already. A suffix alone in its bucket is settled and left out from then on.
    """

    #: Suffixes that are sorted before their pointers are written back, whole buckets aside.
    AT_A_TIME = 1 << 16

    def __init__(self, data: np.ndarray, depth: int) -> None:
        n, q = len(data), 8
        first = np.zeros(n, ">u8")
        octets = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(q - 1, np.uint8)), q)
        first[:] = np.ascontiguousarray(octets).view(">u8").ravel()
        first = first.astype(np.uint64)
        self.order = np.argsort(first, kind="stable").astype(np.int32)
        ends = np.append(np.flatnonzero(np.diff(first[self.order])), n - 1)
        del first
        # Behind the last byte nothing follows, which comes before all else.
        self.pointer = np.full(n + depth, -1, np.int32)
        self.pointer[self.order] = np.repeat(ends, np.diff(np.append(-1, ends)))
        while q < depth:
            self._pass(q)
            q *= 2

    def _pass(self, q: int) -> None:
        own = self.pointer[self.order]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        sizes = np.diff(np.append(starts, len(own)))
        open_ = np.flatnonzero(sizes > 1)
        starts, sizes = starts[open_], sizes[open_]
        part = (np.cumsum(sizes) - sizes) // self.AT_A_TIME
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(starts))
        for a, b in zip(cuts, cuts[1:]):
            self._split(starts[a:b], sizes[a:b], q)

    def _split(self, starts: np.ndarray, sizes: np.ndarray, q: int) -> None:
        places = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        bucket = np.repeat(np.arange(len(starts)), sizes)
        suffixes = self.order[places]
        further = self.pointer[suffixes + q]
        by = np.lexsort((further, bucket))
        suffixes, further = suffixes[by], further[by]
        self.order[places] = suffixes
        last = np.append((bucket[1:] != bucket[:-1]) | (further[1:] != further[:-1]), True)
        ends = np.flatnonzero(last)
        self.pointer[suffixes] = places[np.repeat(ends, np.diff(np.append(-1, ends)))]


def refine(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each place whether its ``LENGTH`` bytes are those of an earlier place of the list.

    ``places`` ascend. Buckets may be finer than ``LENGTH`` bytes; strings that agree on these
    are neighbours in their order all the same, and are told by their bytes.
    """
    number = np.full(len(data), -1, np.int32)
    number[places] = np.arange(len(places))
    order = Buckets(data, LENGTH).order
    own = number[order]
    order = order[own >= 0]
    strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    new = np.ones(len(order), bool)
    for i in range(1, len(order), COMPARED):
        here = order[i:i + COMPARED]
        new[i:i + COMPARED] = (strings[here] != strings[order[i - 1:i - 1 + len(here)]]).any(axis=1)
    first = np.minimum.reduceat(order, np.flatnonzero(new)) if len(order) else order
    again = np.ones(len(places), bool)
    again[number[first]] = False
    return again


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    gap = np.flatnonzero(np.diff(places) != 1)
    return places[np.append(0, gap + 1)], places[np.append(gap, len(places) - 1)]


_MARKS = "doc_id long, tie int, start int, end int"
_PIECES = ("key long, second long, doc_id long, tie int, start int, end int, content binary")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts that are not settled, with their bytes: ``_PIECES``.

    A context of a crowded bucket is given string by string instead: ``key`` and
    ``second`` hash the string and ``content`` is null. Strings that a batch has
    already are settled, ``second`` and ``content`` are null and ``end`` is set.
    """
    names = [c.split()[0] for c in _PIECES.split(", ")]
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        ids, ties, wanted = (batch.column(c).to_pylist() for c in ("doc_id", "tie", "wanted"))
        found: list[tuple] = []
        strings: set[bytes] = set()
        ranks = _ranks(ids, ties)
        for i in np.argsort(ranks).tolist():
            text = texts[i]
            for context in sorted(wanted[i] or (), key=lambda c: c["start"]):
                start, end = context["start"], context["end"]
                if not context["crowded"]:
                    found.append((context["bucket"], 0, ids[i], ties[i], start, end, text[start:end]))
                    continue
                for at in range(start, end - LENGTH + 1):
                    digest = xxhash.xxh3_128_digest(text[at:at + LENGTH])
                    if digest in strings:
                        key = hash((i, at))
                        found.append((key, None, ids[i], ties[i], at, at + LENGTH, None))
                    else:
                        strings.add(digest)
                        key, second = np.frombuffer(digest, "<i8").tolist()
                        found.append((key, second, ids[i], ties[i], at, at + LENGTH, None))
        if found:
            columns = list(zip(*found))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks ``_MARKS`` of repeated strings, from pieces in the order of key and place."""
    held: list[pa.Table] = []
    size, last_string = 0, None

    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = table["key"].to_numpy()
        sizes = pc.binary_length(table["content"]).to_numpy()
        data = np.frombuffer(b"".join(table["content"].to_pylist()), np.uint8)
        base = np.cumsum(sizes) - sizes
        strings = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(keys)), strings)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
        again = np.flatnonzero(refine(data, base[owner] + inside))
        if len(again):
            # Numbered so that runs end with their context.
            first, last = _runs(again + owner[again])
            own = owner[np.searchsorted(np.arange(len(owner)) + owner, first)]
            begin = table["start"].to_numpy()[own] + (first - own - (np.cumsum(strings) - strings)[own])
            yield marks(table.take(pa.array(own)), begin, begin + (last - first) + LENGTH)

    def marks(rows, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        one = rows.select(["doc_id", "tie"]).combine_chunks()
        return pa.RecordBatch.from_arrays([
            _flat(one["doc_id"]), _flat(one["tie"]),
            pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)),
        ], names=["doc_id", "tie", "start", "end"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        whole = table.filter(pc.is_valid(table["content"]))
        loose = table.filter(pc.is_null(table["content"]))
        if loose.num_rows:
            pairs = list(zip(loose["key"].to_pylist(), loose["second"].to_pylist()))
            before = [last_string, *pairs[:-1]]
            again = np.array([p[1] is None or p == b for p, b in zip(pairs, before)])
            last_string = pairs[-1]
            rows = loose.filter(pa.array(again))
            if rows.num_rows:
                yield marks(rows, rows["start"].to_numpy(), rows["end"].to_numpy())
        if whole.num_rows:
            held.append(whole)
            size += int(pc.sum(pc.binary_length(whole["content"])).as_py())
        if size >= CHUNK:
            # The last bucket may go on in the next batch.
            table = pa.concat_tables(held)
            keys = table["key"].to_numpy()
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
            if cut:
                yield from done(table.slice(0, cut))
            held, size = [table.slice(cut)], 0
    if held:
        table = pa.concat_tables(held)
        if table.num_rows:
            yield from done(table)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


# ------------------------------------------------------------------------------- output

_REPORT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def kept_stretches(size: int, marks: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """What is left of ``size`` bytes without the marked ones, and how many runs are removed."""
    kept, at, runs, reach = [], 0, 0, -1
    for start, end in sorted(marks):
        if start > reach:
            runs += 1
        if start > at:
            kept.append((at, start))
        at = reach = max(at, end)
    if at < size:
        kept.append((at, size))
    return kept, runs


def repeated_stretches(docs: DataFrame, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``doc_id, tie, text`` and their marks ``doc_id, tie, marks``, one row each per document.

    ``tie`` tells repeated ids apart: 0 unless an id occurs twice, else from the text's
    checksum. It comes after the id in the order of documents. Null ids come first.
    """
    repeated = docs.groupBy("doc_id").count().where("count > 1")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    crc = F.shiftright(F.crc32(F.coalesce("text", F.lit("")).cast("binary")), 1).cast("int")
    if repeated.isEmpty():
        keyed = unique = rows.select("doc_id", F.lit(0).alias("tie"), "text")
    else:
        keyed = rows.select("doc_id", crc.alias("tie"), "text")
        unique = keyed.dropDuplicates(["doc_id", "tie"])

    # Ranges of bucket and context, so that a bucket of very many contexts is split.
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("start")]
    rounds = written(
        unique.mapInArrow(_contexts, _ROUND).repartitionByRange("bucket", "context")
        .sortWithinPartitions("bucket", "context", *order).mapInArrow(_settle_contexts, _ROUND),
        "repeat-rounds",
    )
    unsettled = rounds.where("context IS NOT NULL")
    crowds = written(
        unsettled.groupBy("bucket").count().where(F.col("count") > crowd).select(
            "bucket", F.lit(True).alias("crowded")
        ), "repeat-crowds",
    )
    crowded = F.lit(False)
    if not crowds.isEmpty():
        unsettled, crowded = unsettled.join(crowds, "bucket", "left"), F.coalesce("crowded", F.lit(False))
    wanted = unsettled.groupBy("doc_id", "tie").agg(F.collect_list(F.struct(
        "bucket", "start", "end", crowded.alias("crowded")
    )).alias("wanted"))
    pieces = _with(unique, wanted).select("doc_id", "tie", "text", "wanted").mapInArrow(
        _pieces, _PIECES
    )
    whole = rounds.where("context IS NULL").select("doc_id", "tie", "start", "end")
    compared = (
        pieces.repartition("key").sortWithinPartitions("key", "second", *order)
        .mapInArrow(_settle, _MARKS)
    )
    marks = whole.union(compared).groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("start", "end")).alias("marks")
    )
    return keyed, marks


def _with(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Documents with what is known of them; the same exchange of texts serves both uses."""
    there = lists.withColumnsRenamed({"doc_id": "of_doc", "tie": "of_tie"}).hint("shuffle_hash")
    return docs.join(
        there, docs["doc_id"].eqNullSafe(F.col("of_doc")) & (docs["tie"] == F.col("of_tie")), "left"
    )


def repeat_report(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row.

    A byte is removed if it lies in ``LENGTH`` bytes that also start earlier: in a document
    of smaller id, or further ahead in the same one. Null texts are empty. Rows that repeat
    an id and its text are one document and have the same result; rows that repeat only
    the id are ordered by checksum. An empty table gives no rows; other columns are not read.
    """
    keyed, marks = repeated_stretches(docs, crowd)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, own in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                kept, runs = kept_stretches(len(text), [(m["start"], m["end"]) for m in own or ()])
                digest = hashlib.sha256()
                for a, b in kept:
                    digest.update(memoryview(text)[a:b])
                left = sum(b - a for a, b in kept)
                rows.append((len(text), len(text) - left, runs, digest.hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]],
                pa.array(columns[3], pa.string()),
            ], names=[c.split()[0] for c in _REPORT.split(", ")])

    return _with(keyed, marks).select("doc_id", "text", "marks").mapInArrow(report, _REPORT)
