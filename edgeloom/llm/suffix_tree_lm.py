"""LM scoring with a probabilistic suffix tree over words.

A context is a run of up to ``DEPTH`` words that repeats in the training documents.
It is retained if its distribution of next words diverges from that of the next shorter
context by more than its entries cost to state. A word is predicted from the longest retained
suffix of what precedes it: the state's own share for the word, discounted, plus what the
discounts leave times the prediction of the next shorter one, down to the root, the add-one
unigram estimate over all training words. Every frequent context is tested, whether its
suffixes were retained or not. What is retained is decided by this test: the least counts
only leave out what occurs once. The tree grows with the corpus.

The tree is two tables in Spark, contexts and entries, grown level by level by a shuffle each:
a pass over the texts counts the words behind frequent contexts, the counts meet the level
before, and the test is a grouping by context, combined before its shuffle.

A score is a sum over the runs that end at each word. The root gives each word its estimate.
A retained context adds what it leaves, an entry what its share is beyond that and beyond what the
next shorter context predicts; every other run adds nothing. So runs are looked up in any order, each for itself. Tasks
that score hold a bounded part of these values, those of the most frequent runs, and a filter of
fixed size of all. What else may have a value is sent to the tables: each run once for many
documents, and their numbers. What a task holds decides how much is shuffled, never what a word scores.

Runs go to fixed ranges of their names, in order, as packed columns of bytes. Documents are scored
in rounds. Each table is written on its own; what Spark shuffled for it is removed then, and tables that
only the next one needs go with it. So the disk holds one step's data, or one round's, beside the tree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.shingles import mixed, numbered_words, text_slices
from edgeloom.llm.tables import dropped, passing, settled

#: A document is held out if crc32 of its id as text leaves this remainder.
FOLDS, HELD_OUT = 7, 2
#: Words of the longest contexts.
DEPTH = 2
#: Least counts of a context and of an entry (a word behind a context): both have to repeat.
LEAST_CONTEXT, LEAST_ENTRY = 2, 2
#: Nats that an entry of a retained context must gain on average over all its occurrences.
PENALTY = 8.0
#: Taken off each entry's count in favour of the shorter context.
DISCOUNT = 0.75
#: Values of the tree that a task holds at most (16 MB), and a quarter as many words.
HELD = 1 << 20
#: Bits of the filters, as a power of two: 4 MB.
FILTER_BITS = 25
#: Bytes of texts that a task works on at a time.
SLICE = 1 << 20
#: Rows that a task brings together before it sends them.
GATHERED = 1 << 20
#: Values that one task looks up in (16 MB).
LOOKED_UP = 1 << 20
#: Rounds in which documents are scored, at most, and words of a round, at least.
ROUNDS, ROUND_WORDS = 4, 1 << 22
#: Share of a filter's bits from which it rules out too little: what it is for takes twice as many rounds then.
FULL = 0.5
#: Bytes of the longest words that are named in numpy.
SHORT = 32
#: The end of a document, also what precedes its first word. No word holds a blank.
END = np.uint64(xxhash.xxh64_intdigest(b" end"))
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ runs of words

def word_names(words: pa.LargeStringArray) -> np.ndarray:
    """Names of words without nulls, mixed from their lengths and their bytes, eight at a time."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    text = np.append(np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), np.zeros(8, np.uint8))
    # The eight bytes from each place on.
    eight = np.ndarray(len(text) - 7, np.uint64, text, strides=(1,))
    start, n = ends[:-1], np.diff(ends)
    names = mixed(n.astype(np.uint64) + _STEP)
    for k in range(0, SHORT, 8):
        of = np.flatnonzero((n > k) & (n <= SHORT))
        beyond = (np.uint64(64) - np.uint64(8) * np.minimum(n[of] - k, 8).astype(np.uint64))
        names[of] = mixed(names[of] * _STEP + (eight[start[of] + k] << beyond))
    for i in np.flatnonzero(n > SHORT):
        names[i] = xxhash.xxh64_intdigest(text[start[i]:ends[i + 1]])
    return names


def joined(before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Name of a run of words from the names of all but its last and of all but its first word."""
    return mixed(before) * _STEP + behind


def before_last(names: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The inverse of ``joined``: names of the runs but for their first word."""
    return names - mixed(before) * _STEP


def runs(hashes: np.ndarray, depth: int) -> list[np.ndarray]:
    """Names of the runs of 1 to ``depth + 1`` words that end at each place (0 before there are so many)."""
    found = [hashes]
    for _ in range(depth):
        longer = np.zeros_like(hashes)
        longer[1:] = joined(found[-1][:-1], found[-1][1:])
        found.append(longer)
    return found


def _sequences(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch: first row, end row, hashes of all words, and the rows' lengths.

    Each document is the end symbol, its words, the end symbol.
    """
    for start, end, known, code, lengths in _numbered(batch, column):
        yield start, end, known[code], lengths


def _numbered(batch: pa.RecordBatch, column: int):
    """As ``_sequences``, with the hashes of the different words and the number of each word."""
    texts = batch.column(column)
    for start, end in text_slices(texts, SLICE):
        known, words, n = numbered_words(texts.slice(start, end - start), lower=True, names=word_names)
        lengths = n + 2
        ends = np.cumsum(lengths)
        inside = np.ones(ends[-1], bool)
        inside[ends - 1] = inside[ends - lengths] = False
        code = np.full(ends[-1], len(known))
        code[inside] = words
        yield start, end, np.append(known, END), code, lengths


def _offsets(lengths: np.ndarray) -> np.ndarray:
    """Each word's place in its document."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - FILTER_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def filter_of(keys: DataFrame) -> np.ndarray:
    """A bit for the leading bits of every ``key``; the driver sees no key, only bits."""
    bit = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    rows = (
        keys.select(bit.alias("bit")).selectExpr("bit div 32768 AS bucket", "bit % 32768 AS place")
        .groupBy("bucket").agg(F.expr("bitmap_construct_agg(place)").alias("bits"))
    )
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in rows.toLocalIterator():
        bits[row["bucket"] * 4096:(row["bucket"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _rounds(bits: np.ndarray) -> int:
    return 2 if np.bitwise_count(bits).sum() > FULL * (1 << FILTER_BITS) else 1


# ----------------------------------------------------------------------- packing

def packed(values: np.ndarray) -> bytes:
    """Bytes of the values, those of equal rank together: the leading ones of sorted names shrink when compressed."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Places of the first of equal neighbours."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)])


def _cuts(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``parts`` equal ranges ascending names lie in, and the first and end place of each."""
    part = ((names >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    first = _firsts(part)
    return part[first], first, np.append(first[1:], len(part))[:len(first)]


def _order(names: np.ndarray) -> np.ndarray:
    """As ``argsort``: the leading bits of the names are sorted with their places, which next to always decides."""
    bits = np.uint64(len(names).bit_length())
    order = np.sort((names >> bits << bits) | np.arange(len(names), dtype=np.uint64))
    order = (order & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    found = names[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(names)


def _together(columns: list[np.ndarray]) -> list[np.ndarray]:
    """One row per name, ascending: columns that the name decides stay, the last is summed up."""
    order = _order(columns[0])
    name = columns[0][order]
    start = _firsts(name)
    total = np.add.reduceat(columns[-1][order], start) if len(start) else columns[-1]
    return [name[start], *(c[order[start]] for c in columns[1:-1]), total]


def _gathered(slices: Iterable[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """The rows of many slices, as ``_together``."""
    waiting: list[list[np.ndarray]] = []
    rows = 0
    for columns in slices:
        waiting.append(columns)
        rows += len(columns[0])
        if rows >= GATHERED:
            yield _together([np.concatenate(c) for c in zip(*waiting)])
            waiting, rows = [], 0
    if waiting:
        yield _together([np.concatenate(c) for c in zip(*waiting)])


def _binary(column: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.Array:
    return pa.array([packed(column[a:b]) for a, b in zip(first.tolist(), end.tolist())], pa.binary())


# ----------------------------------------------------------------------- growing

def _counted(texts: DataFrame, found, names: list[str], least: int = 0) -> DataFrame:
    """``key``, more of ``names``, and ``n``: the slices' rows that ``found`` makes of a task's batches, summed up by ``key``.

    With ``context`` comes ``shorter``, the key's run but for its first word.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [*names, "n"]
    kinds, made = [*(np.uint64 for _ in names), np.int64], [*columns, *(["shorter"] if "context" in names else [])]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(found(batches)):
            part, *at = _cuts(rows[0], parts)
            yield pa.RecordBatch.from_arrays([pa.array(part), *(_binary(c, *at) for c in rows)], names=["part", *columns])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = [[c.as_py() for c in row] for batch in batches for row in zip(*(batch.column(c) for c in columns))]
        if waiting:
            rows = _together([np.concatenate([unpacked(d, kind) for d in c]) for c, kind in zip(zip(*waiting), kinds)])
            kept = rows[-1] >= least
            rows = [c[kept].view(np.int64) for c in rows]
            more = [before_last(*(c.view(np.uint64) for c in rows[:2])).view(np.int64)] if "context" in names else []
            table = pa.RecordBatch.from_arrays([pa.array(c) for c in [*rows, *more]], names=made)
            yield from (table.slice(a, GATHERED >> 2) for a in range(0, len(table), GATHERED >> 2))

    dealt = texts.mapInArrow(count, ", ".join(["part int", *(f"{c} binary" for c in columns)]))
    return dealt.repartitionById(parts, "part").mapInArrow(total, ", ".join(f"{c} long" for c in made))


def word_counts(texts: DataFrame) -> DataFrame:
    """``key, n``: every token of the texts, one end per document among them."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            for _, _, known, code, lengths in _numbered(batch, 0):
                n = np.bincount(code[_offsets(lengths) > 0], minlength=len(known))
                # White space may leave an empty piece among the words.
                yield [known[n > 0], n[n > 0]]

    return _counted(texts, found, ["key"])


def _behind(
    texts: DataFrame, length: int, contexts: np.ndarray, ends: np.ndarray, least: int, turn: int, turns: int
) -> DataFrame:
    """``key, context, n, shorter``: runs of ``length`` words and what follows them ``least`` times or more.

    ``key`` names the run with the next word, ``shorter`` that without its first word. Runs and
    ``shorter`` that the filters rule out are left out, and keys of another ``turn``.
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            for _, _, hashes, lengths in _sequences(batch, 0):
                at = np.flatnonzero(_offsets(lengths) >= length)
                names = runs(hashes, length)[length - 1]
                context, shorter = names[at - 1], names[at]
                kept = in_filter(contexts, context) & in_filter(ends, shorter)
                key, context = joined(context[kept], shorter[kept]), context[kept]
                if turns > 1:
                    now = key % np.uint64(turns) == turn
                    key, context = key[now], context[now]
                yield [key, context, np.ones(len(key), np.int64)]

    return _counted(texts, found, ["key", "context"], least)


@dataclass(frozen=True)
class Bounds:
    """What makes a tree: depth, least counts, the cost of an entry; what a task holds of it."""

    depth: int = DEPTH
    context: int = LEAST_CONTEXT
    entry: int = LEAST_ENTRY
    penalty: float = PENALTY
    held: int = HELD


@dataclass
class Tree:
    """``contexts``: ``key, left, n`` of the retained ones. ``entries``: ``key, n, value`` of theirs.

    ``value``: log10 of an entry's probability over what it were without the entry.
    ``passed``: tables of shorter entries, which only these two need.
    """

    contexts: DataFrame
    entries: DataFrame
    passed: list[DataFrame]

    def values(self) -> DataFrame:
        """``key, n, value``: what each run adds to a score. A run that is a context and an entry has two rows."""
        return self.contexts.select("key", "n", F.log10("left").alias("value")).union(self.entries)


def grow(texts: DataFrame, counts: DataFrame, room: float, bounds: Bounds) -> Tree:
    """The tree of the training documents; ``counts`` has ``key, n`` of all their words."""
    totals, ends = counts, filter_of(counts.where(F.col("n") >= bounds.entry))
    below = counts.select("key", ((F.col("n") + 1) / F.lit(room)).alias("p"))
    levels: list[tuple[DataFrame, DataFrame]] = []
    passed: list[DataFrame] = []
    for length in range(1, bounds.depth + 1):
        frequent = totals.where(F.col("n") >= bounds.context).select("key", F.col("n").alias("total"))
        # All that is in the table of a level has the least count of an entry.
        same = bounds.context == bounds.entry or length > 1 and bounds.context < bounds.entry
        within = ends if same else filter_of(frequent)
        turns = _rounds(within)
        shorter = below.select(F.col("key").alias("shorter"), F.col("p").alias("below"))
        n = F.col("n")
        with ExitStack() as later:
            with ExitStack() as joining:
                found = reduce(DataFrame.union, [
                    joining.enter_context(passing(_behind(texts, length, within, ends, bounds.entry, k, turns), "lm-found"))
                    for k in range(turns)
                ])
                entries = later.enter_context(passing(
                    found.join(shorter, "shorter").select("key", "context", "n", "below"), "lm-entries"
                ))
            tested = entries.groupBy(F.col("context").alias("key")).agg(
                F.sum(n * (F.log("n") - F.log("below"))).alias("gain"), F.sum("n").alias("inside"),
                F.count("*").alias("entries"), F.sum(n - DISCOUNT).alias("taken"),
            ).join(frequent, "key")
            gain = F.col("gain") - F.col("inside") * F.log("total")
            left = 1 - F.col("taken") / F.col("total")
            contexts = settled(
                tested.select(
                    "key", F.when(gain > bounds.penalty * F.col("entries"), left).alias("left"), F.col("total").alias("n")
                ), "lm-contexts",
            )
            states = contexts.select(F.col("key").alias("context"), F.col("n").alias("total"), "left")
            own = (n - DISCOUNT) / F.col("total") + F.col("left") * F.col("below")
            likely = entries.join(states, "context").select(
                "key", "n", (F.log10(own) - F.log10("below") - F.log10("left")).alias("value"),
                F.coalesce(own, "below").alias("p"),
            )
            if length == bounds.depth:
                likely = likely.where("value IS NOT NULL").drop("p")
            likely = settled(likely, "lm-likely")
        levels.append((
            contexts.where("left IS NOT NULL"), likely.where("value IS NOT NULL").select("key", "n", "value")
        ))
        if length < bounds.depth:
            passed.append(likely)
            totals, below = likely.select("key", "n"), likely.select("key", "p")
            ends = filter_of(totals)
    contexts, entries = levels[0]
    for more, further in levels[1:]:
        contexts, entries = contexts.union(more), entries.union(further)
    return Tree(contexts, entries, passed)


# ----------------------------------------------------------------------- scoring

@dataclass
class Held:
    """What tasks hold: sorted names with values, a filter of all that have one, and in how many parts they are looked up."""

    words: np.ndarray
    root: np.ndarray
    keys: np.ndarray
    values: np.ndarray
    some: np.ndarray
    depth: int
    word_parts: int
    parts: int


def _sorted(rows: DataFrame) -> list[np.ndarray]:
    """Names in ascending order and the sums of their values; only for bounded tables."""
    table = rows.toArrow()
    return _together([table[0].to_numpy().view(np.uint64), table[1].to_numpy()])


def _sizes(rows: DataFrame) -> dict[int, int]:
    """The rows by the power of two that their ``n`` reaches."""
    return {r["level"]: r["size"] for r in rows.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count("*").alias("size")).collect()}


def _least(sizes: dict[int, int], most: int) -> int:
    """The least power of two ``n`` so that the rows of that ``n`` or more make at most ``most``."""
    least, total = 1 << 62, 0
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > most:
            break
        least = 1 << int(level)
    return least


def _roots(counts: DataFrame) -> DataFrame:
    """``key, n, value``: what a word's count adds to the root's estimate. A word without one is one in ``room``."""
    return counts.select("key", "n", F.log10(F.col("n") + 1).alias("value"))


def hold(values: DataFrame, roots: DataFrame, bounds: Bounds) -> Held:
    """What tasks hold: the most frequent of both, and a filter of all values."""
    least_parts = 2 * values.sparkSession.sparkContext.defaultParallelism
    parts, found = [], []
    for rows, most in ((roots, bounds.held // 4), (values, bounds.held)):
        sizes = _sizes(rows)
        found += _sorted(rows.where(F.col("n") >= _least(sizes, most)).select("key", "value"))
        parts.append(max(least_parts, -(-sum(sizes.values()) // LOOKED_UP)))
    return Held(*found, filter_of(values), bounds.depth, *parts)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, -1 if absent. In ascending order, neighbours share the memory that they are looked up in."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _values(held: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Held values; 0 where there is none."""
    if not len(held):
        return np.zeros(len(place))
    return np.where(place >= 0, held[place], 0.0)


def is_held_out(doc_id: Column) -> Column:
    """A null id reads as no text."""
    number = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(number, F.lit(FOLDS)) == HELD_OUT


_SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, own double, "
           "rooted boolean, part int, first long, keys binary, times binary, docs binary")
_TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}


def _rows(schema: str, n: int, /, **columns) -> pa.RecordBatch:
    """``n`` rows of a schema, null where no column is given."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, _TYPES[kind]) if c not in columns
        else columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], _TYPES[kind])
        for c, kind in zip(names, kinds)
    ], names=list(names))


def _asked(keys: np.ndarray, docs: np.ndarray, parts: int, first: int, rooted: bool) -> pa.RecordBatch:
    """Rows of ``_SCORED`` that ask the tables: ascending ``keys`` once, how often, and the documents that have them."""
    start = _firsts(keys)
    times = np.diff(np.append(start, len(keys))).astype(np.uint32)
    key = keys[start]
    part, a, b = _cuts(key, parts)
    ends = np.append(start, len(keys))
    return _rows(
        _SCORED, len(part), rooted=np.full(len(part), rooted), part=part, first=np.full(len(part), first),
        keys=_binary(key, a, b), times=_binary(times, a, b), docs=_binary(docs, ends[a], ends[b]),
    )


def _scores(shared):
    """Rows of ``_SCORED``: one per document with what the task knows, and what it asks the tables.

    ``base`` and ``own`` are sums of values without the tables' ones. What is asked is for the
    roots (``rooted``) or for the runs; ``docs`` are numbers of rows from ``first`` on.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        slices, waiting, rows = [], [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            """What has been gathered: the runs in order, each looked up once."""
            row, doc_id, held_out, n_tokens, n_known, base, own = (list(c) for c in zip(*slices))
            row, base, own = np.concatenate(row), np.concatenate(base), np.concatenate(own)
            keys, docs = (np.concatenate(c) for c in list(zip(*waiting))[:2])
            order = _order(keys)
            keys, docs = keys[order], docs[order]
            start = _firsts(keys)
            place = np.repeat(_find(tree.keys, keys[start]), np.diff(np.append(start, len(keys))))
            own += np.bincount(docs, _values(tree.values, place), len(own))
            yield _rows(
                _SCORED, len(row), row=row, doc_id=pa.concat_arrays(doc_id), held_out=pa.concat_arrays(held_out),
                n_tokens=np.concatenate(n_tokens), n_known=np.concatenate(n_known), base=base, own=own,
            )
            yield _asked(keys[place < 0], docs[place < 0], tree.parts, int(row[0]), False)
            keys, docs = (np.concatenate(c) for c in list(zip(*waiting))[2:])
            order = _order(keys)
            yield _asked(keys[order], docs[order], tree.word_parts, int(row[0]), True)

        for batch in batches:
            for start, end, words, code, lengths in _numbered(batch, 3):
                some, hashes = batch.slice(start, end - start), words[code]
                offsets, n = _offsets(lengths), len(lengths)
                document, at = np.repeat(np.arange(n, dtype=np.uint32), lengths), np.flatnonzero(offsets > 0)
                inside, word = document[at], code[at]
                before = sum(len(x[0]) for x in slices)
                # What a word adds as a context is counted with it: the end that precedes a document with the one behind it.
                order = _order(words)
                place, alone = np.empty((2, len(words)), np.int64)
                place[order], alone[order] = _find(tree.words, words[order]), _find(tree.keys, words[order])
                root, single, known = _values(tree.root, place), _values(tree.values, alone), place >= 0
                base = np.bincount(inside, root[word], n)
                slices.append([
                    some.column(0).to_numpy(), some.column(1), some.column(2), lengths - 1,
                    np.bincount(inside, known[word], n).astype(np.int64), base, base + np.bincount(inside, single[word], n),
                ])
                asked = at[((alone < 0) & in_filter(tree.some, words))[word]]
                named, places = runs(hashes, tree.depth), [asked]
                keys = [hashes[asked]]
                for length in range(1, tree.depth + 1):
                    at_runs = np.flatnonzero(offsets >= length)
                    name = named[length][at_runs]
                    kept = in_filter(tree.some, name)
                    keys.append(name[kept])
                    places.append(at_runs[kept])
                keys, places, rare = np.concatenate(keys), np.concatenate(places), at[~known[word]]
                waiting.append([
                    keys, document[places] + np.uint32(before), hashes[rare], document[rare] + np.uint32(before)
                ])
                rows += len(keys) + len(rare)
                if rows >= GATHERED:
                    yield from sent()
                    slices, waiting, rows = [], [], 0
        if slices:
            yield from sent()
    return score


_QUESTION = "part int, first long, keys binary, times binary, docs binary"
_ANSWER = "part int, first long, docs binary, n binary, value binary"


def _dealt(values: DataFrame, parts: int) -> DataFrame:
    """Rows of ``_QUESTION`` with the names and the values of the table, the latter as ``docs``."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = ([b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()] for b in batches)
        for key, value in _gathered(slices):
            part, *at = _cuts(key, parts)
            yield _rows(_QUESTION, len(part), part=part, keys=_binary(key, *at), docs=_binary(value, *at))

    return values.select("key", "value").mapInArrow(deal, _QUESTION)


def _looked_up(asked: DataFrame, values: DataFrame, parts: int) -> DataFrame:
    """``row, n, value``: how many of the names that each row asked for have a value, and the sum of them.

    Values, as ``_dealt``, and questions meet by ranges of names; answers, summed up for the documents of a
    question, by the question's origin.
    """
    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, asks = [], []
        for batch in batches:
            for first, *data in zip(*(batch.column(c).to_pylist() for c in ("first", "keys", "times", "docs"))):
                if first is None:
                    known.append([unpacked(data[0], np.uint64), unpacked(data[2], np.float64)])
                else:
                    asks.append((first, data))
        if not known:
            return
        names, value = _together([np.concatenate(c) for c in zip(*known)])
        found, answers = [], []
        for first, (keys, times, docs) in asks:
            place = np.repeat(_find(names, unpacked(keys, np.uint64)), unpacked(times, np.uint32))
            doc = unpacked(docs, np.uint32)[place >= 0]
            n = np.bincount(doc)
            of = np.flatnonzero(n)
            total = np.bincount(doc, value[place[place >= 0]])
            found.append(first)
            answers.append([packed(of.astype(np.uint32)), packed(n[of].astype(np.uint32)), packed(total[of])])
        if found:
            docs, n, total = zip(*answers)
            origin = np.array(found)
            part = mixed(origin.view(np.uint64)) % np.uint64(parts)
            yield _rows(_ANSWER, len(found), part=part.astype(np.int32), first=origin, docs=list(docs), n=list(n), value=list(total))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origins: dict[int, list] = {}
        for batch in batches:
            for first, *data in zip(*(batch.column(c).to_pylist() for c in ("first", "docs", "n", "value"))):
                origins.setdefault(first, []).append(data)
        for first, data in origins.items():
            docs, n, value = (
                np.concatenate([unpacked(d, kind) for d in c]) for c, kind in zip(zip(*data), (np.uint32, np.uint32, np.float64))
            )
            times = np.bincount(docs, n).astype(np.int64)
            of = np.flatnonzero(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of + first), pa.array(times[of]), pa.array(np.bincount(docs, value)[of])], names=["row", "n", "value"]
            )

    met = values.union(asked.select("part", "first", "keys", "times", "docs")).repartitionById(parts, "part")
    replies = met.mapInArrow(reply, _ANSWER)
    return replies.repartitionById(parts, "part").mapInArrow(add, "row long, n long, value double")


def score_report(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Null and empty texts are one end symbol. Repeated rows count as often as they occur.
    Without training documents every token is unknown to a model of no tokens: both scores
    are those of probability 1. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out"))
    training = rows.where(~F.col("held_out")).select("text")
    counts = settled(word_counts(training), "lm-words")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens = size["n"]
    room = float(tokens + 1 * (size["v"] + 1))
    tree = grow(training, counts, room, bounds)
    values, roots = tree.values(), _roots(counts)
    held = hold(values, roots, bounds)
    shared = docs.sparkSession.sparkContext.broadcast(held)
    rounds = max(1, min(ROUNDS, tokens // ROUND_WORDS)) * _rounds(held.some)
    # Each row is in one round, whatever order it is read in.
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    with passing(_dealt(roots, held.word_parts), "lm-roots") as roots, passing(_dealt(values, held.parts), "lm-values") as values:
        for table in tree.passed:
            dropped(table)
        found = [_scored(rows.where(turn == k) if rounds > 1 else rows, shared, roots, values) for k in range(rounds)]
    none, unknown = F.lit(0.0), F.col("n_tokens") * F.log10(F.lit(room))
    base = F.col("base") + F.coalesce("rare", none) - unknown
    return reduce(DataFrame.union, found).select(
        F.col("doc_id"), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("own") + F.coalesce("rare", none) + F.coalesce("opened", none) - unknown).alias("score"),
    )


def _scored(rows: DataFrame, shared, roots: DataFrame, values: DataFrame) -> DataFrame:
    """One round: what tasks know of the rows (``n_known, base, own``), and what the tables add (``n_rare, rare, opened``)."""
    numbered = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "held_out", "text"
    )
    held = shared.value
    with passing(numbered.mapInArrow(_scores(shared), _SCORED), "lm-sent") as sent:
        scored = settled(sent.where("n_tokens IS NOT NULL").select(
            "row", "doc_id", "held_out", "n_tokens", "n_known", "base", "own"
        ), "lm-scored")
        rare = settled(_looked_up(sent.where("rooted"), roots, held.word_parts), "lm-rare")
        opened = settled(_looked_up(sent.where("NOT rooted"), values, held.parts), "lm-opened")
    return scored.join(
        rare.select("row", F.col("n").alias("n_rare"), F.col("value").alias("rare")), "row", "left"
    ).join(opened.select("row", F.col("value").alias("opened")), "row", "left")
