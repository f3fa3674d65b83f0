"""Substring dedup over words: documents are parsed against reference blocks, long factors go.

Relative Lempel-Ziv parsing. A document is cut greedily into factors, each the longest run of
words from there on that occurs in a reference block. A run of ``WINDOW`` words that occurs
there either lies in one factor, or crosses a single boundary between two long factors: a
window that held a whole factor and the word behind it would make that factor longer. So
factors of ``WINDOW`` words or more are duplicate spans, and windows across a boundary are
looked up only where both factors together leave room for one.

All documents together are the reference, so which blocks can hold a match must be known
beforehand. Of the ``Q``-word runs inside any window the one of least hash (the leftmost of
several) is its *anchor*, and equal windows have equal anchors. The stretch of windows that
share an anchor in one place is a *piece*. Blocks are dealt out by anchor: a block holds all
pieces of its anchors, from all documents, and each piece is parsed against the one block in
which it can match. What is taken out beforehand needs no parsing:

* a piece whose anchor no other piece has matches nothing;
* a piece that an earlier document has word for word is a single factor.

A block is indexed by the order of its suffixes, and a match must start in a document of
smaller id. Anchors with more than ``CROWD`` different pieces (a line in very many documents,
with different surroundings) would fill a task; their windows become pieces of their own,
dealt out by all their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.shingles import hashed_words, mixed, run_hashes, text_slices
from edgeloom.llm.tables import text_bytes, word_lists, written

WINDOW = 13
#: Words of an anchor, and how many such runs a window holds.
Q = 5
INSIDE = WINDOW - Q + 1
#: Different pieces of an anchor up to which they are parsed in one block.
CROWD = 4096
#: Words of a block, the last anchor's pieces aside.
BLOCK = 1 << 18
#: Words of the longest match looked for; more is another factor.
LONGEST = 16
#: Any odd number of 64 bits, one less than a multiple of four.
BASE = 0xD1B54A32D192ED03


# ------------------------------------------------------------------------ pieces

def pieces_of(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first word and number of words of each piece of some texts.

    ``hashes`` are the texts' words one after the other, ``lengths`` how many each has.
    """
    grams = run_hashes(hashes, Q)
    n = len(grams) - INSIDE + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = grams[:n].copy()
    for i in range(1, INSIDE):
        np.minimum(least, grams[i:i + n], out=least)
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = text[:n] == text[WINDOW - 1:]
    # The next window has another anchor if a smaller hash enters or the anchor leaves.
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (grams[:n - 1] == least[:-1]) | (text[1:n] != text[:n - 1])
    first = np.flatnonzero(new & inside)
    ends = np.append(np.flatnonzero(new | ~inside), n)
    return least[first], first, ends[np.searchsorted(ends, first, "right")] - first + WINDOW - 1


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.append(np.uint64(1), np.full(n, base, np.uint64)))[:n]


def stretch_hashes(hashes: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each stretch of words, from differences of one running sum."""
    n = len(hashes)
    sums = np.append(np.uint64(0), np.cumsum(hashes * _powers(BASE, n)))
    inverse = _powers(pow(BASE, -1, 1 << 64), n)
    return mixed((sums[first + size] - sums[first]) * inverse[first] + size.astype(np.uint64))


def _places(ids: list) -> np.ndarray:
    """Rank of each row's id; equal ids have equal ranks, null ids come first."""
    order = {d: i for i, d in enumerate(sorted({d for d in ids if d is not None}), 1)}
    return np.array([order.get(d, 0) for d in ids], np.int64)


_FOUND = "anchor long, content long, doc_id long, tie int, n int, starts array<int>"


def _found(rows: pa.RecordBatch, row, anchor, content, size, starts, offsets) -> pa.RecordBatch:
    """Rows of ``_FOUND``; ``starts`` are cut by ``offsets``. Without a content a row is a mark."""
    n, take = len(row), pa.array(row)
    numbers = [
        pa.nulls(n, pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in (anchor, content)
    ]
    return pa.RecordBatch.from_arrays([
        *numbers, rows.column("doc_id").take(take), rows.column("tie").take(take),
        pa.array(size.astype(np.int32)),
        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(starts.astype(np.int32))),
    ], names=[c.split()[0] for c in _FOUND.split(", ")])


def _spans(rows: pa.RecordBatch, row, start, size) -> pa.RecordBatch:
    """Marks of stretches of words, those that touch made one; dealt out by their places."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], (start + size)[order]
    new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > end[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    spread = mixed(row[first].astype(np.uint64) ^ mixed(start[first].astype(np.uint64)))
    return _found(rows, row[first], spread, None, end[last] - start[first], start[first],
                  np.arange(len(first) + 1))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of all texts as ``_FOUND``, equal ones of a document in one row.

    What an earlier document of the batch has is a mark.
    """
    for batch in batches:
        found = []
        for begin, end in text_slices(batch.column("text")):
            hashes, lengths = hashed_words(batch.column("text").slice(begin, end - begin))
            anchor, start, size = pieces_of(hashes, lengths)
            ends = np.cumsum(lengths)
            row = np.searchsorted(ends, start, "right")
            content = stretch_hashes(hashes, start, size)
            found.append((begin + row, anchor, content, start - (ends - lengths)[row], size))
        if not found:
            continue
        row, anchor, content, start, size = map(np.concatenate, zip(*found))
        if not len(row):
            continue
        place = _places(batch.column("doc_id").to_pylist())[row]
        # Together by what they are; in a stable order, so by id and place within that.
        order = np.argsort(mixed(anchor) ^ content, kind="stable")
        if (np.diff(place) < 0).any():
            by_place = np.argsort(place, kind="stable")
            order = by_place[np.argsort((mixed(anchor) ^ content)[by_place], kind="stable")]
        row, anchor, content, start, size, place = (
            x[order] for x in (row, anchor, content, start, size, place)
        )
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
        again = place != place[np.flatnonzero(new)][np.cumsum(new) - 1]
        if again.any():
            yield _spans(batch, row[again], start[again], size[again])
            row, anchor, content, start, size, new = (
                x[~again] for x in (row, anchor, content, start, size, new)
            )
        first = np.flatnonzero(new | np.append(True, row[1:] != row[:-1]))
        yield _found(batch, row[first], anchor[first], content[first], size[first], start,
                     np.append(first, len(start)))


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces in the order of anchor, content and id: marks, and pieces to be parsed.

    Pieces of an earlier document's words become marks; first ones stay where their anchor
    holds several. Only the last row's piece is remembered; an anchor at either end of a
    batch may go on beyond it and counts as holding several.
    """
    before, first_doc = None, None
    for batch in batches:
        known = pc.is_null(batch.column("content"))
        if pc.any(known).as_py():
            yield batch.filter(known)
            batch = batch.filter(pc.invert(known))
        if not batch.num_rows:
            continue
        anchor, content = (batch.column(c).to_numpy() for c in ("anchor", "content"))
        opens = np.append(before is None or anchor[0] != before[0], anchor[1:] != anchor[:-1])
        new = opens | np.append(before is None or content[0] != before[1], content[1:] != content[:-1])
        ids = batch.column("doc_id").to_pylist()
        at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        firsts = [first_doc if i < 0 else ids[i] for i in at.tolist()]
        own = np.array([d == f for d, f in zip(ids, firsts)])
        before, first_doc = (anchor[-1], content[-1]), firsts[-1]
        group = np.cumsum(np.append(True, anchor[1:] != anchor[:-1])) - 1
        several = np.bincount(group, new) > 1
        several[[0, -1]] = True
        yield batch.filter(pa.array(own & several[group]))
        marks = batch.filter(pa.array(~own))
        yield marks.set_column(1, "content", pa.nulls(marks.num_rows, pa.int64()))


# ----------------------------------------------------------------------- parsing

class Block:
    """A reference block: runs of words one after the other, indexed by the order of suffixes.

    ``words`` are any numbers that tell words apart, ``sizes`` the runs' lengths, ``places``
    the rank of each run's document. Matches are looked for in documents of smaller rank.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        self.start = np.cumsum(sizes + 1) - sizes - 1
        self.stop = self.start + sizes
        text = np.zeros(int(sizes.sum()) + len(sizes) + LONGEST, np.int64)
        # One free place behind each run, which no word equals.
        text[np.arange(len(owner)) + owner] = np.unique(words, return_inverse=True)[1] + 1
        self.ranks, n = {1: text}, 1
        while n < LONGEST:
            shorter = self.ranks[n]
            pair = (shorter << 32) | np.append(shorter[n:], np.zeros(n, np.int64))
            n *= 2
            self.ranks[n] = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        self.suffixes = np.argsort(self.ranks[LONGEST], kind="stable")
        place = np.full(len(text), np.iinfo(np.int64).max)
        place[np.arange(len(owner)) + owner] = places[owner]
        # Least ranks of 1, 2, 4, .. neighbours in the order of suffixes.
        self.least = [place[self.suffixes]]
        while 2 << (len(self.least) - 1) <= len(text):
            width = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-width], self.least[-1][width:]))
        self.place = place
        self.columns: dict[int, np.ndarray] = {}

    def _first(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least rank among suffixes ``low`` to ``high`` (one beyond), not empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for n in np.unique(level).tolist():
            which = level == n
            least = self.least[n]
            found[which] = np.minimum(least[low[which]], least[high[which] - (1 << n)])
        return found

    def _narrowed(self, low, high, skip, step, wanted) -> tuple[np.ndarray, np.ndarray]:
        """Of suffixes ``low`` to ``high``, equal in ``skip`` words, those that go on as ``wanted``."""
        rank, bounds, end = self.ranks[step], [], len(self.suffixes) - 1
        if not skip.any():
            if step not in self.columns:
                self.columns[step] = rank[self.suffixes]
            return tuple(np.searchsorted(self.columns[step], wanted, side) for side in ("left", "right"))
        for upper in (False, True):
            a, b = low.copy(), high.copy()
            while (a < b).any():
                middle = (a + b) >> 1
                # Where the search is over, a comparison that changes nothing.
                place = self.suffixes[np.minimum(middle, end)] + skip
                there = rank[np.minimum(place, end)]
                right = (there < wanted) | (upper & (there == wanted))
                going = a < b
                a = np.where(going & right, middle + 1, a)
                b = np.where(going & ~right, middle, b)
            bounds.append(a)
        return bounds[0], bounds[1]

    def longest(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Words from each place on, ``limit`` and ``LONGEST`` at most, that occur earlier."""
        found = np.zeros(len(at), np.int64)
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.suffixes))
        step = LONGEST
        while step:
            which = np.flatnonzero(found + step <= np.minimum(limit, LONGEST))
            if len(which):
                here, skip = at[which], found[which]
                wanted = self.ranks[step][here + skip]
                a, b = self._narrowed(low[which], high[which], skip, step, wanted)
                # The place itself is always among them.
                good = self._first(a, b) < self.place[here]
                which = which[good]
                found[which] += step
                low[which], high[which] = a[good], b[good]
            step //= 2
        return found

    def factors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Run, start and length of the factors of all runs, all runs side by side.

        A word that does not occur earlier is a factor of no length.
        """
        runs, starts, lengths = [], [], []
        run, at = np.arange(len(self.start)), self.start.copy()
        while len(run):
            length = self.longest(at, self.stop[run] - at)
            runs.append(run)
            starts.append(at)
            lengths.append(length)
            at = at + np.maximum(length, 1)
            left = at < self.stop[run]
            run, at = run[left], at[left]
        run, start, length = map(np.concatenate, (runs, starts, lengths))
        order = np.lexsort((start, run))
        return run[order], start[order], length[order]

    def repeated_windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Run and first word, counted in the run, of each window that occurs earlier."""
        run, start, length = self.factors()
        inside = np.maximum(length - WINDOW + 1, 0)
        windows = [np.repeat(start, inside) + _counted(inside)]
        owners = [np.repeat(run, inside)]
        # Across boundaries: between the starts of two factors, and within both.
        end, follows = start + length, np.append(run[1:] == run[:-1], False)
        touching = np.flatnonzero(follows & (length > 0) & (np.append(length[1:], 0) > 0))
        if len(touching):
            low = np.maximum(start[touching] + 1, end[touching] - WINDOW + 1)
            high = np.minimum(end[touching] - 1, end[touching + 1] - WINDOW)
            n = np.maximum(high - low + 1, 0)
            at, owner = np.repeat(low, n) + _counted(n), np.repeat(run[touching], n)
            good = self.longest(at, np.full(len(at), WINDOW)) == WINDOW
            windows.append(at[good])
            owners.append(owner[good])
        owner, window = np.concatenate(owners), np.concatenate(windows)
        return owner, window - self.start[owner]


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of ``sizes``."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _each_text(texts: pa.Array) -> Iterator[np.ndarray]:
    """The words' hashes of each text."""
    for begin, end in text_slices(texts):
        hashes, lengths = hashed_words(texts.slice(begin, end - begin))
        yield from np.split(hashes, np.cumsum(lengths)[:-1])


_DEALT = "key long, doc_id long, tie int, starts array<int>, words binary"
_MARKS = "doc_id long, tie int, start int, end int"


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces to be parsed with their words' hashes: ``_DEALT``.

    A piece of a crowded anchor is given window by window. Windows that an earlier document
    of the batch has are marks: ``words`` is null.
    """
    names = [c.split()[0] for c in _DEALT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary()]
    for batch in batches:
        places = _places(batch.column("doc_id").to_pylist())
        order = np.argsort(places, kind="stable")
        needed = pc.is_valid(batch.column("wanted")).to_numpy(zero_copy_only=False)[order]
        order = order[needed]
        batch, places = batch.take(pa.array(order)), places[order]
        ids, ties, wanted = (batch.column(c).to_pylist() for c in ("doc_id", "tie", "wanted"))
        first: dict[bytes, int] = {}
        rows: list[tuple] = []
        for i, hashes in enumerate(_each_text(batch.column("text"))):
            windows, singles = None, {}
            for piece in wanted[i]:
                start = piece["starts"][0]
                if not piece["crowded"]:
                    words = hashes[start:start + piece["n"]].tobytes()
                    rows.append((piece["anchor"], ids[i], ties[i], piece["starts"], words))
                    continue
                if windows is None:
                    windows = run_hashes(hashes, WINDOW).view(np.int64)
                for at in range(piece["n"] - WINDOW + 1):
                    words = hashes[start + at:start + at + WINDOW].tobytes()
                    single = int(windows[start + at]), words
                    singles.setdefault(single, []).extend(s + at for s in piece["starts"])
            for (key, words), starts in singles.items():
                if first.setdefault(words, places[i]) < places[i]:
                    rows.append((key ^ hash((i, starts[0])), ids[i], ties[i], starts, None))
                else:
                    rows.append((key, ids[i], ties[i], starts, words))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
            )


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of repeated windows, from dealt pieces in the order of key, id and words."""
    held: list[pa.Table] = []
    size, last = 0, (None, None, None)

    def marks(rows: pa.Table, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        """Spans of words in pieces as marks of their documents, for every place of the piece."""
        starts = rows["starts"].combine_chunks()
        n = pc.list_value_length(starts).to_numpy()
        flat, base = starts.flatten().to_numpy(), np.cumsum(n) - n
        many = n[row]
        place = flat[np.repeat(base[row], many) + _counted(many)]
        take = pa.array(np.repeat(row, many))
        return pa.RecordBatch.from_arrays([
            rows["doc_id"].combine_chunks().take(take), rows["tie"].combine_chunks().take(take),
            pa.array((place + np.repeat(start, many)).astype(np.int32)),
            pa.array((place + np.repeat(stop, many)).astype(np.int32)),
        ], names=["doc_id", "tie", "start", "end"])

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = pc.binary_length(rows["words"]).to_numpy() // 8
        words = np.frombuffer(b"".join(rows["words"].to_pylist()), np.uint64)
        block = Block(words, sizes.astype(np.int64), _places(rows["doc_id"].to_pylist()))
        row, window = block.repeated_windows()
        if not len(row):
            return
        order = np.lexsort((window, row))
        row, window = row[order], window[order]
        new = np.append(True, (row[1:] != row[:-1]) | (window[1:] > window[:-1] + WINDOW))
        first = np.flatnonzero(new)
        final = np.append(first[1:], len(row)) - 1
        yield marks(rows, row[first], window[first], window[final] + WINDOW)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        known = table.filter(pc.is_null(table["words"]))
        whole = table.filter(pc.is_valid(table["words"]))
        # A piece that an earlier document has word for word is a single factor.
        keys, ids, words = (whole[c].to_pylist() for c in ("key", "doc_id", "words"))
        again = np.zeros(len(keys), bool)
        for i, (key, doc, own) in enumerate(zip(keys, ids, words)):
            if (key, own) == last[:2]:
                again[i] = doc != last[2]
            else:
                last = key, own, doc
        for rows in (known, whole.filter(pa.array(again))):
            if rows.num_rows:
                n = pc.fill_null(pc.binary_length(rows["words"]), 8 * WINDOW).to_numpy() // 8
                yield marks(rows, np.arange(rows.num_rows), np.zeros(rows.num_rows, np.int64), n)
        whole = whole.filter(pa.array(~again))
        if whole.num_rows:
            held.append(whole)
            size += pc.sum(pc.binary_length(whole["words"])).as_py() // 8
        if size >= BLOCK:
            # The last anchor may go on in the next batch.
            table = pa.concat_tables(held)
            keys = table["key"].to_numpy()
            other = np.flatnonzero(keys != keys[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from done(table.slice(0, cut))
            held, size = [table.slice(cut)], 0
    if held and sum(t.num_rows for t in held):
        yield from done(pa.concat_tables(held))


# ------------------------------------------------------------------------ output

def repeated_words(docs: DataFrame, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``doc_id, tie, text`` and the marks ``doc_id, tie, marks`` of their words to be removed.

    ``tie`` tells rows of equal ids apart by their texts' checksum; it is 0 where ids are distinct.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    repeated = docs.groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        keyed = unique = rows.select("doc_id", F.lit(0).alias("tie"), "text")
    else:
        crc = F.shiftright(F.crc32(F.coalesce("text", F.lit("")).cast("binary")), 1).cast("int")
        keyed = rows.select("doc_id", crc.alias("tie"), "text")
        unique = keyed.dropDuplicates(["doc_id", "tie"])

    # Ranges of anchor and content, so that an anchor of very many pieces is split.
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    found = written(
        unique.mapInArrow(_pieces, _FOUND).repartitionByRange("anchor", "content")
        .sortWithinPartitions("anchor", "content", *order).mapInArrow(_settle, _FOUND),
        "parse-pieces",
    )
    pieces = found.where("content IS NOT NULL")
    crowds = written(
        pieces.groupBy("anchor").count().where(F.col("count") > crowd)
        .select("anchor", F.lit(True).alias("crowded")), "parse-crowds",
    )
    if crowds.isEmpty():
        pieces = pieces.withColumn("crowded", F.lit(False))
    else:
        pieces = pieces.join(crowds, "anchor", "left").withColumn(
            "crowded", F.coalesce("crowded", F.lit(False))
        )
    wanted = pieces.groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("anchor", "n", "starts", "crowded")).alias("wanted")
    )
    parsed = (
        _with(unique, wanted).select("doc_id", "tie", "text", "wanted").mapInArrow(_dealt, _DEALT)
        .repartition("key").sortWithinPartitions("key", "words", *order).mapInArrow(_parse, _MARKS)
    )
    known = found.where("content IS NULL").select(
        "doc_id", "tie", F.explode("starts").alias("start"), "n"
    ).select("doc_id", "tie", "start", (F.col("start") + F.col("n")).alias("end"))
    marks = known.union(parsed).groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("start", "end")).alias("marks")
    )
    return keyed, marks


def _with(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Documents with what is known of them; the same exchange of texts serves both uses."""
    there = lists.withColumnsRenamed({"doc_id": "of_doc", "tie": "of_tie"}).hint("shuffle_hash")
    return docs.join(
        there, docs["doc_id"].eqNullSafe(F.col("of_doc")) & (docs["tie"] == F.col("of_tie")), "left"
    )


_REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, own in zip(text_bytes(batch.column("text")), batch.column("marks").to_pylist()):
            edges = np.array([(m["start"], m["end"]) for m in own or ()], np.int64).reshape(-1, 2)
            starts, ends = np.sort(edges[:, 0]), np.sort(edges[:, 1])
            digest, n, left = hashlib.sha256(), 0, 0
            for words in word_lists(text):
                if own:
                    # A word is marked if more marks begin up to it than end.
                    at = np.arange(n, n + len(words))
                    clear = np.searchsorted(starts, at, "right") == np.searchsorted(ends, at, "right")
                    n += len(words)
                    words = [words[i] for i in np.flatnonzero(clear).tolist()]
                else:
                    n += len(words)
                if words:
                    digest.update((b" " if left else b"") + b" ".join(words))
                    left += len(words)
            rows.append((n, n - left, digest.hexdigest()))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.string()),
        ], names=[c.split()[0] for c in _REPORT.split(", ")])


def substring_report(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row.

    A word is removed if a window of 13 words around it also starts in a document of smaller
    id. Null texts have no words. Null ids come before all others, and rows of equal ids do not
    remove each other's words. An empty table gives no rows; other columns are not read.
    """
    keyed, marks = repeated_words(docs, crowd)
    return _with(keyed, marks).select("doc_id", "text", "marks").mapInArrow(_kept, _REPORT)
