"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.session import scratch_path

#: White space between words: blank and the control characters 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
_SPACE = re.compile(SPACE_CLASS.encode())
#: Bytes of a text whose words are listed at a time.
SEGMENT = 1 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, read back.

    Cuts the lineage: a lost executor costs a read, not the work before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark removes a write's shuffle files when it ends, not when the driver's next collection finds them unused.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, label: str) -> DataFrame:
    """As ``written``; the shuffle files of the write are gone when it ends."""
    conf = df.sparkSession.conf
    before = conf.get(_FREED, None)
    conf.set(_FREED, "true")
    try:
        # The plan keeps the setting that it was made under.
        return written(df.select("*"), label)
    finally:
        conf.unset(_FREED) if before is None else conf.set(_FREED, before)


@contextmanager
def passing(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as ``settled``, and deleted after the block: what is made of it there has to be written there."""
    found = settled(df, label)
    try:
        yield found
    finally:
        dropped(found)


def dropped(table: DataFrame) -> None:
    """Deletes a table of ``settled``."""
    context = table.sparkSession.sparkContext
    for file in table.inputFiles()[:1]:
        folder = context._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(stem: str, taken: Iterable[str]) -> str:
    """A column name based on ``stem`` that no column of ``taken`` has, in any case."""
    used, name = {c.lower() for c in taken}, stem
    while name.lower() in used:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` but for ``names``, quoted for ``select``."""
    gone = {n.lower() for n in names}
    return [f"`{c.replace('`', '``')}`" for c in df.columns if c.lower() not in gone]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, none for null. Reads the batch's buffers, decodes nothing."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def lower_words(text: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case: bytes' own notions are the ASCII ones."""
    return text.lower().split()


def word_lists(text: bytes, size: int = SEGMENT) -> Iterator[list[bytes]]:
    """The words of a text, a stretch of about ``size`` bytes at a time."""
    start = 0
    while start < len(text):
        gap = _SPACE.search(text, start + size) if start + size < len(text) else None
        stop = gap.start() if gap else len(text)
        yield text[start:stop].split()
        start = stop + 1


def utf8_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
