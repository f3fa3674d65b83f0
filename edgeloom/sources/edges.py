"""Edge lists and event logs: schemas, delimited-text reader, Parquet reader and writer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Result = TypeVar("Result")

# --- Fixed values: table names, column names and text format of the inputs. ---
SEPARATOR = " "
NETWORK_COLUMNS = {
    "social_network": ("follower", "followed"),
    "retweet_network": ("tweeter", "tweeted", "occur"),
    "reply_network": ("replier", "replied", "occur"),
    "mention_network": ("mentioner", "mentioned", "occur"),
}
ACTIVITY = "activity_time"
ACTIVITY_COLUMNS = ("userA", "userB", "timestamp", "interaction")
VIEW_NAMES = {
    "social_network": "social",
    "retweet_network": "retweet",
    "reply_network": "reply",
    "mention_network": "mention",
    "activity_time": "activity",
}
# ------------------------------------------------------------------------------

# Holds the raw text of a malformed line while a table is read.
CORRUPT = "_malformed_line"

TABLES = (*NETWORK_COLUMNS, ACTIVITY)


def edge_schemas(number: T.DataType | None = None) -> dict[str, T.StructType]:
    """Schema per table. Ids, weights and epoch seconds are 64-bit.

    Pass ``IntegerType()`` only for data known to fit 32 bits: a number that does
    not fit is NULL in the permissive text reader, and its line is malformed.
    """
    number = number or T.LongType()
    schemas = {
        name: T.StructType([T.StructField(c, number) for c in columns])
        for name, columns in NETWORK_COLUMNS.items()
    }
    user_a, user_b, timestamp, interaction = ACTIVITY_COLUMNS
    schemas[ACTIVITY] = T.StructType([
        T.StructField(user_a, number),
        T.StructField(user_b, number),
        T.StructField(timestamp, number),
        T.StructField(interaction, T.StringType()),
    ])
    return schemas


class EdgeTableSet:
    """The five input tables, under their view names."""

    social: DataFrame
    retweet: DataFrame
    reply: DataFrame
    mention: DataFrame
    activity: DataFrame

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        for table, view in VIEW_NAMES.items():
            yield table, getattr(self, view)

    def register_views(self) -> None:
        """Make the tables available to SQL text as ``social``, ``retweet``, ..."""
        for table, frame in self.items():
            frame.createOrReplaceTempView(VIEW_NAMES[table])


@dataclass(frozen=True)
class EdgeTables(EdgeTableSet):
    """Five given DataFrames."""

    social: DataFrame
    retweet: DataFrame
    reply: DataFrame
    mention: DataFrame
    activity: DataFrame


def read_edges(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = SEPARATOR,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Delimited text without header, compression taken from the file extension.

    In the default mode a value that does not parse becomes NULL, missing
    trailing columns are NULL and surplus ones are ignored. ``FAILFAST`` raises
    instead; ``corrupt_column`` adds the raw line of every malformed row.
    """
    options = {"sep": sep, "mode": mode}
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.schema(schema).options(**options).csv(path)


def read_tables(spark: SparkSession, parquet_dir: str) -> EdgeTables:
    return EdgeTables(**{
        view: spark.read.parquet(f"{parquet_dir.rstrip('/')}/{table}")
        for table, view in VIEW_NAMES.items()
    })


def together(
    spark: SparkSession, write: Callable[[str], Result], names: Sequence[str]
) -> list[Result]:
    """Submit one independent write per name at the same time, and wait for all.

    The threads take on the caller's job group, description and scheduler pool.
    """
    submit = inheritable_thread_target(spark)(write)
    with ThreadPoolExecutor(max_workers=max(len(names), 1)) as pool:
        return list(pool.map(submit, names))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class Ingested:
    """Where a table went, its rows, and how many of their lines were malformed."""

    path: str
    rows: int
    malformed: int


def ingest(
    spark: SparkSession,
    sources: Mapping[str, str | list[str]],
    target_dir: str,
    schemas: Mapping[str, T.StructType] | None = None,
    sep: str = SEPARATOR,
    mode: str = "PERMISSIVE",
    write_partitions: int | None = None,
    corrupt_dir: str | None = None,
) -> dict[str, Ingested]:
    """Convert text tables to Parquet; returns what was written per table.

    A malformed line (a value that does not parse or fit, too few or too many of
    them) becomes a row with NULLs. Such lines are counted by the pass that writes
    the table; with ``corrupt_dir`` they are also kept there as text, one folder
    per table, at the cost of reading a table that has any once more.

    The tables are independent, so their writes are submitted together: one
    large gzip file is a single task, and it must not hold up the others. A
    gzip file cannot be split; ``write_partitions`` spreads its rows over that
    many tasks and files before encoding. Leave it unset for inputs of many
    files or plain text, where the scan already is parallel.
    """
    schemas = schemas or edge_schemas()

    def convert(table: str) -> Ingested:
        # FAILFAST stops at the first malformed line and allows no column for it.
        column = CORRUPT if mode == "PERMISSIVE" else None
        rows = read_edges(spark, sources[table], schemas[table], sep, mode, column)
        seen = Observation()
        figures = [F.count(F.lit(1)).alias("rows")]
        if column:
            figures.append(F.count(CORRUPT).alias("malformed"))
        kept = rows.observe(seen, *figures).drop(CORRUPT)
        if write_partitions:
            kept = kept.repartition(write_partitions)
        target = f"{target_dir.rstrip('/')}/{table}"
        write_parquet(kept, target)
        malformed = seen.get.get("malformed", 0)
        if corrupt_dir and malformed:
            # Naming all columns makes the reader parse them all, which is what tells.
            line = F.coalesce(CORRUPT, F.concat_ws(sep, *schemas[table].names))
            rows.where(F.col(CORRUPT).isNotNull()).select(line.alias("value")).write.mode(
                "overwrite").text(f"{corrupt_dir.rstrip('/')}/{table}")
        return Ingested(target, seen.get["rows"], malformed)

    return dict(zip(sources, together(spark, convert, list(sources))))
