"""The ledger tables: created if absent, only ever appended to.

``counts`` holds the counts, ``sums`` one snapshot of their total per run, ``marks`` a single
row that says which files of ``counts`` the last snapshot covers, so that the next one reads
only what has landed since. One writer at a time, as for any plain Parquet table. Totals are
64-bit, since a 32-bit column overflows long before a large ledger ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from edgeloom.operators.ledger import ledger_total


def create_counts(spark: SparkSession, table: str, location: str | None = None) -> None:
    _create(spark, table, "INT", location)


def create_sums(spark: SparkSession, table: str, location: str | None = None) -> None:
    _create(spark, table, "BIGINT", location)


def create_marks(spark: SparkSession, table: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (value BIGINT, until TIMESTAMP, files ARRAY<STRING>) "
        f"USING parquet{where}"
    )


def _create(spark: SparkSession, table: str, value_type: str, location: str | None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (value {value_type}) USING parquet{where}")


def append_count(spark: SparkSession, table: str, value: int = 1) -> None:
    """One more count."""
    spark.sql(f"INSERT INTO {table} (value) VALUES ({int(value)})")


def append_counts(counts: DataFrame, table: str, value: str = "value") -> None:
    """Many counts in one write, rather than one small file per count."""
    counts.select(F.col(value).cast("int").alias("value")).write.insertInto(table)


def compact(
    spark: SparkSession, table: str, location: str, files: int = 1, marks: str | None = None
) -> None:
    """Moves a ledger's rows into ``files`` files at a new ``location``; no count is lost.

    A count a minute is half a million files a year, and a full total reads them all. Run
    it while no one appends. The old files stay where they were. The new ones are all new to
    ``marks``, which is emptied first: the next total reads them once, and goes on from there.
    """
    if marks:
        _overwrite(spark, marks, [])
    spark.table(table).coalesce(files).write.parquet(location)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")


def append_total(spark: SparkSession, counts: str, sums: str, marks: str | None = None) -> None:
    """Snapshot of the current total; NULL while there are no counts.

    With ``marks`` the last snapshot is carried on by the files that have landed since. Should a
    run end between its two writes, the next one starts from the older mark, or from none, and
    reads more; its total is the same.
    """
    if marks is None:
        ledger_total(spark.table(counts)).write.insertInto(sums)
        return
    last = spark.table(marks).first()
    landed = files_since(spark.table(counts), last)
    at, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_name")
    by_time = landed.groupBy(at.alias("until")).agg(
        F.sum("value").alias("value"), F.collect_set(name).alias("files")
    )
    new = by_time.agg(F.sum("value").alias("value"), F.max(F.struct("until", "files")).alias("newest")).first()
    known = [v for v in (last and last["value"], new["value"]) if v is not None]
    total, newest = sum(known) if known else None, new["newest"]
    spark.sql(f"INSERT INTO {sums} VALUES (CAST({'NULL' if total is None else total} AS BIGINT))")
    if newest is None:
        return
    # Files of the very instant that the last mark ended at are as covered as before.
    same = last is not None and last["until"] == newest["until"]
    covered = sorted({*newest["files"], *(last["files"] if same else ())})
    _overwrite(spark, marks, [(total, newest["until"], covered)])


def _overwrite(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, spark.table(table).schema).coalesce(1).write.insertInto(table, overwrite=True)


def files_since(counts: DataFrame, mark: Row | None) -> DataFrame:
    """Rows of the files that ``mark`` (``until, files``) does not cover; all without one.

    The condition is on the files' own times and names, so other files are never opened.
    """
    if mark is None:
        return counts
    at, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_name")
    return counts.where((at > F.lit(mark["until"])) | ((at == F.lit(mark["until"])) & ~name.isin(mark["files"])))
