"""File streams over Parquet tables, and running a stream over what is there."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.functions.measures import MICROS_PER_SECOND, micros
from edgeloom.session import scratch_path


# Characters with a meaning in path patterns.
PATTERN_CHARACTERS = re.compile(r"[\\*?\[\]{}^]")
# Bytes of a row group of a landed slice.
ROW_GROUP = 4 << 20


def parquet_stream(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Stream of a Parquet table's files; without ``schema``, with the one the table has now.

    ``path`` may name a folder, which is watched for new files, or one file. Characters
    of path patterns in it are refused: a file stream reads such a path as a pattern,
    and, where they are escaped, lists its files twice.
    """
    if found := PATTERN_CHARACTERS.search(path):
        raise ValueError(f"{found[0]} in the path of a file stream: {path}")
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # As a pattern that only this name fits, one letter being a class of itself, the path
    # is accepted for a single file too.
    folder, slash, name = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{folder}{slash}[{name[0]}]{name[1:]}")


def land_in_order(frame: DataFrame, path: str, time: str, first: object, width: float, slices: int) -> None:
    """Lands ``frame`` in the folder ``path`` as a file per slice of ``time``, written in one pass.

    Slices are ``width`` seconds wide and counted from ``first``; what lies before or behind
    them goes to the first or last one, rows without a time to the last. One shuffle deals the
    slices out to as many tasks, which write beside ``path``; whole files are then moved there.
    A file stream takes files in the order of their modification times, so these are set to
    follow each other as the slices do; the store has to support that, as HDFS and local folders do.
    Row groups are small, so that a large slice is read by several tasks.
    """
    spark = frame.sparkSession
    since = (micros(F.col(time)) - micros(F.lit(first))) / F.lit(width * MICROS_PER_SECOND)
    number = F.least(F.greatest(F.floor(since), F.lit(0)), F.lit(slices - 1))
    column = free_column("slice", frame.columns)
    # A stated number of tasks, which adaptive execution leaves as it is.
    number = F.when(F.col(time).isNull(), slices - 1).otherwise(number)
    frame.withColumn(column, number.cast("int")).repartition(
        slices, column
    ).write.partitionBy(column).option("parquet.block.size", ROW_GROUP).parquet(f"{path}-slices")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(path))
    begun = system.getFileStatus(hadoop.Path(path)).getModificationTime() - 1000 * (slices + 1)
    for status in system.globStatus(hadoop.Path(f"{path}-slices/{column}=*/*.parquet")):
        number = int(status.getPath().getParent().getName().partition("=")[2])
        landed = hadoop.Path(f"{path}/{number:06d}-{status.getPath().getName()}")
        system.setTimes(status.getPath(), begun + 1000 * number, -1)
        system.rename(status.getPath(), landed)


def free_column(stem: str, taken: Sequence[str]) -> str:
    """``stem``, with as many underscores as set it apart from all columns."""
    used = {c.lower() for c in taken}
    while stem.lower() in used:
        stem += "_"
    return stem


@dataclass(frozen=True)
class Drained:
    """The written output of a stream that ran over all its input, and how the run went."""

    output: DataFrame
    progress: list[dict]

    def watermarks(self) -> list[datetime]:
        """The watermark of each batch that had one, in UTC."""
        found = [p["eventTime"]["watermark"] for p in self.progress if p.get("eventTime")]
        return [datetime.fromisoformat(w.replace("Z", "+00:00")).replace(tzinfo=None) for w in found]

    def largest_state(self) -> int:
        """The most rows that any stateful operator held after a batch."""
        return max((o["numRowsTotal"] for p in self.progress for o in p["stateOperators"]), default=0)


def drain(stream: DataFrame, label: str, partitions: int | None = None) -> Drained:
    """Runs an append-mode stream over all available input.

    Checkpoint and output lie in the shared scratch folder, so a restarted
    query resumes there and every executor can read the result. ``partitions`` is the most
    state stores of the stream, each of which is committed with every batch, even if empty;
    by default it has as many as the session's shuffles.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(partitions or int(before), int(before))))
    try:
        # A stream works in a copy of the session from its start on.
        query = (
            stream.writeStream.format("parquet")
            .option("path", f"{base}/output")
            .option("checkpointLocation", f"{base}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    query.awaitTermination()
    progress = [json.loads(p.json) for p in query.recentProgress]
    return Drained(spark.read.schema(stream.schema).parquet(f"{base}/output"), progress)


def drain_to_parquet(stream: DataFrame, label: str) -> DataFrame:
    """The output of ``drain`` as a table."""
    return drain(stream, label).output


def drain_complete(stream: DataFrame, label: str) -> DataFrame:
    """Runs a complete-mode stream over all available input; its last result as a table.

    Every batch replaces the result written before it. Nothing of it passes through
    the driver, however many groups it has.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, label)

    def replace(result: DataFrame, _: int) -> None:
        result.write.mode("overwrite").parquet(f"{base}/output")

    query = (
        stream.writeStream.foreachBatch(replace)
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/output")
