"""Benchmark decontamination: short items inside long documents.

Size-partitioned MinHash containment search. Items are partitioned by their number
of shingles into classes with an upper bound ``U`` each (powers of two). For a class,
every document is cut into blocks of ``U`` shingles, and two neighbouring blocks form
a window: whatever stretch of ``U`` shingles an item may fill lies inside one window,
so containment ``t`` of the item means a Jaccard similarity of at least
``t*q / (q + 2*U - t*q)`` with it, whatever the document's length. Block minima of a
class come from those of the class below, so all classes cost one pass per hash.

A minimum shared by item and window makes a candidate; candidates are verified by
exact containment of the item's shingles in the whole document.

An item of one to four words is one run of its own length. It is looked up, exactly, among the
documents' runs of that length; texts are passed over for the lengths that items have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.llm.shingles import mixed, run_hashes, word_hashes
from edgeloom.llm.tables import free_name, lower_words, text_bytes, written

WORDS = 5
CONTAINMENT = 0.8
#: Hash functions, one band of one row each. At the lowest similarity that an item of
#: a class can have (0.19) a candidate is missed with probability 0.81 ** 40 = 0.0002;
#: an item contained whole (0.25 at least) with 0.00001.
HASHES = 40
#: Bits of the fixed-size filters that tasks hold: 512 KB for minima, 2 MB for shingles,
#: whatever the number of items. A false hit costs a row that the joins drop.
MINIMA_BITS = 22
SHINGLE_BITS = 24
#: Shingles that are hashed at a time, long documents aside.
GROUP = 1 << 18
NOTHING = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Family of the rows that hold shingles; minima have ``size class * HASHES + function``.
IN_DOCUMENT = -1
#: Family of the runs of so many words, for items that are no longer; below ``IN_DOCUMENT``.
SHORT = {n: IN_DOCUMENT - n for n in range(1, WORDS)}


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    return seeds[:HASHES], seeds[HASHES:] | np.uint64(1)


def _slots(values: np.ndarray, family: int, bits: int) -> np.ndarray:
    """Places of hash values in a filter."""
    salt = mixed(np.array([family + 2 + WORDS], np.uint64))[0]
    return (mixed(values ^ salt) >> np.uint64(64 - bits)).astype(np.int64)


def _shingles(text: bytes) -> np.ndarray:
    return run_hashes(word_hashes(lower_words(text)), WORDS)


def item_index(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, n, family, value)``: each item's distinct shingles and its minima.

    ``n`` counts its distinct shingles. An item of fewer than five words is a single one, of
    all its words; an item without words is not searched for. ``item`` is a struct of the id and a hash of the text: rows
    that repeat an id are one item if their texts are equal, else items of their own.
    """
    identity = F.struct(
        F.col(item).alias("item_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash")
    )
    source = items.select(identity.alias("item"), text).distinct()
    schema = T.StructType([
        source.schema["item"], T.StructField("n", T.IntegerType()),
        T.StructField("family", T.IntegerType()), T.StructField("value", T.LongType()),
    ])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, factor = _functions()
        for batch in batches:
            rows, sizes, families, values = [], [], [], []
            for i, content in enumerate(text_bytes(batch.column(1))):
                words = word_hashes(lower_words(content))
                if 0 < len(words) < WORDS:
                    rows.append([i])
                    sizes.append([1])
                    families.append([SHORT[len(words)]])
                    values.append(run_hashes(words, len(words)))
                    continue
                own = np.unique(run_hashes(words, WORDS))
                if not len(own):
                    continue
                minima = ((own[None, :] ^ add[:, None]) * factor[:, None]).min(axis=1)
                level = int(len(own) - 1).bit_length()
                rows.append(np.full(len(own) + HASHES, i))
                sizes.append(np.full(len(own) + HASHES, len(own)))
                families.append(np.full(len(own), IN_DOCUMENT))
                families.append(np.arange(HASHES) + level * HASHES)
                values += [own, minima]
            if rows:
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.concatenate(rows))),
                    pa.array(np.concatenate(sizes).astype(np.int32)),
                    pa.array(np.concatenate(families).astype(np.int32)),
                    pa.array(np.concatenate(values).view(np.int64)),
                ], names=["item", "n", "family", "value"])

    return source.mapInArrow(index, schema)


def _filters(index: DataFrame) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """Filters over minima (and short items) and over shingles; size classes and short lengths in use.

    What reaches the driver is bounded by the filters' size: distinct places.
    """
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            families = batch.column(0).to_numpy()
            values = batch.column(1).to_numpy().view(np.uint64)
            for family in np.unique(families):
                bits = SHINGLE_BITS if family == IN_DOCUMENT else MINIMA_BITS
                found = np.unique(_slots(values[families == family], int(family), bits))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(found), family == IN_DOCUMENT)), pa.array(found),
                ], names=["shingle", "place"])

    found = (
        index.select("family", "value").mapInArrow(places, "shingle boolean, place long")
        .distinct().toArrow()
    )
    shingle, place = found["shingle"].to_numpy(), found["place"].to_numpy()
    filters = []
    for bits, chosen in ((MINIMA_BITS, ~shingle.astype(bool)), (SHINGLE_BITS, shingle.astype(bool))):
        holds = np.zeros(1 << bits, bool)
        holds[place[chosen]] = True
        filters.append(np.packbits(holds))
    levels = [
        r["level"] for r in index.where(F.col("family") >= 0)
        .select((F.col("family") / HASHES).cast("int").alias("level")).distinct().collect()
    ]
    short = {
        r["family"] for r in index.where(F.col("family") < IN_DOCUMENT).select("family").distinct().collect()
    }
    return filters[0], filters[1], sorted(levels), [n for n in SHORT if SHORT[n] in short]


def _window_hits(shingles: np.ndarray, levels: list[int], holds: np.ndarray):
    """``(family, level, window, value)`` of the minima that an item may have."""
    add, factor = _functions()
    base = 1 << levels[0]
    starts = np.arange(0, len(shingles), base)
    empty = shingles == NOTHING
    for k in range(HASHES):
        hashed = (shingles ^ add[k]) * factor[k]
        hashed[empty] = NOTHING
        minima = np.minimum.reduceat(hashed, starts)
        at = levels[0]
        for level in levels:
            while at < level:
                minima = np.minimum.reduceat(minima, np.arange(0, len(minima), 2))
                at += 1
            window = minima.copy()
            window[:-1] = np.minimum(minima[:-1], minima[1:])
            family = level * HASHES + k
            hit = np.flatnonzero(holds[_slots(window, family, MINIMA_BITS)])
            if len(hit):
                yield family, level, hit, window[hit]


def _groups(texts: list[bytes], unit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingles of several texts, each padded to whole blocks, and the text of each ``unit``."""
    parts, owners, total = [], [], 0
    for i, text in enumerate(texts):
        own = _shingles(text)
        if not len(own):
            continue
        room = -(-len(own) // unit) * unit
        parts += [own, np.full(room - len(own), NOTHING)]
        owners.append(np.full(room // unit, i))
        total += room
        if total >= GROUP:
            yield np.concatenate(parts), np.concatenate(owners)
            parts, owners, total = [], [], 0
    if parts:
        yield np.concatenate(parts), np.concatenate(owners)


def _document_hits(keyed: DataFrame, index: DataFrame) -> DataFrame:
    """``(key, family, value)``: what a document may share with items. One pass over the texts."""
    minima_filter, shingle_filter, levels, short = _filters(index)
    schema = T.StructType([
        keyed.schema["key"], T.StructField("family", T.IntegerType()),
        T.StructField("value", T.LongType()),
    ])
    if not levels and not short:
        return keyed.sparkSession.createDataFrame([], schema)
    shared = keyed.sparkSession.sparkContext.broadcast((minima_filter, shingle_filter))
    unit = 1 << levels[-1] if levels else 1

    def looked_up(batch: pa.RecordBatch, holds: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The runs of a text that short items may be."""
        for i, text in enumerate(text_bytes(batch.column(1)) if short else ()):
            words = word_hashes(lower_words(text))
            for n in short:
                runs = np.unique(run_hashes(words, n))
                runs = runs[holds[_slots(runs, SHORT[n], MINIMA_BITS)]]
                if len(runs):
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(np.full(len(runs), i))),
                        pa.array(np.full(len(runs), SHORT[n], np.int32)), pa.array(runs.view(np.int64)),
                    ], names=["key", "family", "value"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima, shingles = (np.unpackbits(f).view(bool) for f in shared.value)
        for batch in batches:
            yield from looked_up(batch, minima)
            for hashes, owner in _groups(text_bytes(batch.column(1)) if levels else [], unit):
                found = np.flatnonzero(shingles[_slots(hashes, IN_DOCUMENT, SHINGLE_BITS)])
                found = found[hashes[found] != NOTHING]
                families, values = [np.full(len(found), IN_DOCUMENT)], [hashes[found]]
                rows = [owner[found // unit]]
                for family, level, window, value in _window_hits(hashes, levels, minima):
                    families.append(np.full(len(window), family))
                    values.append(value)
                    rows.append(owner[(window << level) // unit])
                table = np.rec.fromarrays(
                    [np.concatenate(rows), np.concatenate(families), np.concatenate(values)]
                )
                once = np.unique(table)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(once["f0"])),
                    pa.array(once["f1"].astype(np.int32)),
                    pa.array(once["f2"].view(np.int64)),
                ], names=["key", "family", "value"])

    return keyed.select("key", "text").mapInArrow(search, schema)


def contained_items(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``(key, item, n_shingles, n_found, containment)`` per document and item contained in it.

    ``key`` is a struct of the document's ``doc_id`` (which may be null) and a hash of
    its text, so that repeated ids do not pool their texts. Null and empty texts match
    nothing, texts of fewer than five words only items that are no longer. Such a short item is
    one shingle: contained whole or not at all.
    """
    index = written(item_index(items), "leak-index")
    hits = written(_document_hits(_keyed(docs), index), "leak-hits")
    minima = index.where(F.col("family") >= 0).select("item", "n", "family", "value")
    candidates = hits.where(F.col("family") >= 0).join(minima, ["family", "value"])
    pairs = candidates.select("key", "item", "n").distinct()
    wanted = index.where(F.col("family") == IN_DOCUMENT).select("item", "n", "value")
    present = hits.where(F.col("family") == IN_DOCUMENT).select("key", "value").distinct()
    found = (
        pairs.join(wanted.drop("n"), "item").join(present, ["key", "value"])
        .groupBy("key", "item", "n").agg(F.count("*").alias("n_found"))
    )
    short = hits.where(F.col("family") < IN_DOCUMENT).join(
        index.where(F.col("family") < IN_DOCUMENT), ["family", "value"]
    ).select("key", "item", "n", F.lit(1).cast("long").alias("n_found")).distinct()
    return found.where(F.col("n_found") >= containment * F.col("n")).union(short).select(
        "key", "item", F.col("n").cast("long").alias("n_shingles"), "n_found",
        (F.col("n_found") / F.col("n")).alias("containment"),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_key().alias("key"), "text")


def _key():
    return F.struct(
        F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    )


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment``, one row per contained item.

    Rows that repeat an id and its text are one document. Empty tables give no rows.
    """
    return contained_items(docs, items).select(
        "key.doc_id", "item.item_id", "n_shingles", "n_found", "containment"
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item; columns and rows otherwise as they are."""
    key = free_name("key", docs.columns)
    leaks = contained_items(docs, items).select(F.col("key").alias(key)).distinct()
    return docs.withColumn(key, _key()).join(leaks, key, "left_anti").select(docs.columns)
