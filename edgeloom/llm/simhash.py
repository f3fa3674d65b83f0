"""SimHash near-dedup by multi-index hashing.

A fingerprint has two 32-bit segments. Of two fingerprints at most 2 bits apart,
one segment differs in at most one bit. So every fingerprint enters one table per
segment, and asks each table for the small Hamming ball around its own segment;
what the tables hand out is verified on all 64 bits. Of two segments one bit apart
one holds a 0 where the other holds a 1, so asking only upwards finds each pair once.

A bucket with more than ``BUCKET`` distinct fingerprints (a large group of near
copies) would be compared pair by pair. Fingerprints that meet such a bucket are
linked through their full balls of radius 1 instead: two of them share a centre
exactly if they are at most 2 bits apart, and a centre has at most 65 of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.llm.components import connected_components
from edgeloom.llm.tables import free_name, lower_words, text_bytes, written

SEED = 42
SHINGLE = 3
RADIUS = 2
SEGMENT_BITS = 32
SEGMENT_MASK = (1 << SEGMENT_BITS) - 1
#: Distinct fingerprints in a bucket up to which its pairs are compared one by one.
BUCKET = 64
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 16


def fingerprint(words: list[bytes]) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes; no words: 0."""
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        octets = hashes[i:i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and the fingerprint of each row's text as a signed long ``fp``. Null text: 0."""
    source = docs.select(*keys, text)
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("fp", T.LongType(), False)])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(lower_words(t)) for t in text_bytes(batch.column(len(keys)))]
            column = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keys)], column], names=[*batch.schema.names[:-1], "fp"]
            )

    return source.mapInArrow(sketch, schema)


def near_links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct fingerprints ``fp`` as all pairs within 2 bits do.

    Every such pair outside large buckets is a link itself; inside them it is
    joined through a shared centre. Nothing is left out.
    """
    both = F.array(*[
        F.struct(F.lit(i).alias("segment"), v.alias("value"))
        for i, v in enumerate(_segments(F.col("fp")))
    ])
    entries = fps.select("fp", F.explode(both).alias("e")).select("fp", "e.segment", "e.value")
    ball = F.explode(F.array_compact(F.array(F.col("value"), *[
        F.when(F.col("value").bitwiseAND(1 << i) == 0, F.col("value") + (1 << i))
        for i in range(SEGMENT_BITS)
    ])))
    probes = entries.select(
        "segment", F.col("fp").alias("a"), F.col("value").alias("own"), ball.alias("value")
    )
    large = written(
        entries.groupBy("segment", "value").count().where(F.col("count") > bucket).drop("count"),
        "simhash-large",
    )
    crowded = not large.isEmpty()
    if crowded:
        entries = entries.join(large, ["segment", "value"], "left_anti")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    found = (
        probes.join(entries.withColumnRenamed("fp", "b"), ["segment", "value"])
        .where((apart <= RADIUS) & ((F.col("own") != F.col("value")) | (F.col("a") < F.col("b"))))
        .select("a", "b")
    )
    if not crowded:
        return found
    met = probes.join(large, ["segment", "value"], "left_semi").select("a").distinct()
    return found.union(_shared_centres(met))


def _segments(fp: Column) -> list[Column]:
    return [fp.bitwiseAND(SEGMENT_MASK), F.shiftrightunsigned(fp, SEGMENT_BITS)]


def _shared_centres(members: DataFrame) -> DataFrame:
    """Links between fingerprints ``a`` that have a neighbour at distance 1 or less in common."""
    flips = [F.lit((1 << i) - (1 << 64 if i == 63 else 0)) for i in range(64)]
    centres = F.explode(F.array(F.col("a"), *[F.col("a").bitwiseXOR(f) for f in flips]))
    return (
        members.select("a", centres.alias("centre"))
        .groupBy("centre").agg(F.collect_set("a").alias("around"))
        .where(F.size("around") > 1)
        .select(F.array_min("around").alias("a"), F.explode("around").alias("b"))
        .where("a <> b").distinct()
    )


def components(sketch: DataFrame, first: Column) -> DataFrame:
    """``(fp, first)`` for each distinct ``fp``: the least ``first`` in its component, nulls aside."""
    fps = written(sketch.groupBy("fp").agg(F.min(first).alias("first")), "simhash-fps")
    members = connected_components(near_links(fps.select("fp")))
    linked = members.withColumnRenamed("node", "fp").join(fps, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    joined = linked.select("fp", "root").join(least, "root").select("fp", "least")
    return fps.join(joined, "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("first")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, one row per input row.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most 2
    differing bits. Null and wordless texts have fingerprint 0, linked like any
    other. Rows with a null or repeated id keep their rows; a component of null ids
    only has a null id. An empty table gives no rows. Other columns are not read.
    """
    sketch = written(fingerprints(docs, ["doc_id"]), "simhash-sketch")
    labels = components(sketch, F.col("doc_id")).withColumnRenamed("first", "component_id")
    return sketch.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the one of smallest id, then of smallest text hash.

    Ids come before null ids. Of rows that repeat an id and its text one stays. The text
    moves once, to meet the ids that go; only rows that are repeated move again.
    """
    mark = free_name("hash", docs.columns)
    identity = F.struct(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    keyed = docs.withColumn(mark, identity)
    sketch = written(fingerprints(keyed, [mark]).withColumnRenamed(mark, "mark"), "simhash-sketch")
    place = F.struct(F.col("mark.doc_id").isNull().alias("none"), F.col("mark").alias("mark"))
    stays = components(sketch, place).select("fp", F.col("first.mark").alias("stays"))
    gone = written(
        sketch.join(stays, "fp").where("mark <> stays").select(F.col("mark").alias(mark)).distinct(),
        "simhash-gone",
    )
    kept = keyed.join(gone, mark, "left_anti")
    repeated = written(
        sketch.groupBy("mark").agg(F.count("*").alias("rows")).where("rows > 1")
        .select(F.col("mark").alias(mark)), "simhash-repeated",
    )
    if not repeated.isEmpty():
        once = kept.join(repeated, mark, "left_semi").dropDuplicates([mark])
        kept = kept.join(repeated, mark, "left_anti").unionByName(once)
    return kept.select(docs.columns)
