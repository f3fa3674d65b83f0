"""The ledger total as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_total(counts: DataFrame, value: str = "value") -> DataFrame:
    """Total of all counts so far; one row of state, summed within tasks before the shuffle.

    For ``outputMode("complete")``.
    """
    return counts.agg(F.sum(value).cast("bigint").alias("value"))


SNAPSHOT = "batch bigint, total bigint"


def append_snapshots(counts: DataFrame, path: str, checkpoint: str, value: str = "value") -> DataFrame:
    """Runs the stream ``counts`` over all its input; one snapshot of the total per micro-batch.

    Returns ``batch, total`` of all snapshots at ``path``, those of earlier runs with the same
    ``checkpoint`` among them. A snapshot is its batch's counts added to the snapshot before
    it, so no state is kept and no file is read twice. It is written to a folder of the batch's
    number, replacing what is there: a batch that was written but not committed, and is run
    again after a failure, writes the same row and is counted once. NULL counts add nothing; the
    total is NULL until there is a count.
    """
    spark = counts.sparkSession

    def snapshot(batch: DataFrame, number: int) -> None:
        added = batch.agg(F.sum(value).cast("bigint").alias("total"))
        if number:
            before = spark.read.schema("total bigint").parquet(f"{path}/batch={number - 1}")
            added = before.union(added).agg(F.sum("total").alias("total"))
        added.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        counts.writeStream.foreachBatch(snapshot).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(SNAPSHOT).parquet(path).select("batch", "total")
