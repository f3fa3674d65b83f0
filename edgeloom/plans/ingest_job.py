"""The ingest job: five text files to Parquet.

    python -m edgeloom.plans.ingest_job SOURCE_DIR PARQUET_DIR [--prefix NAME-] [--master MASTER]

Edge lists are read from ``<prefix><table>.edgelist.gz`` and the event log from
``<prefix><table>.txt.gz``. The job names the missing files and stops if any of
the five has not landed. It reports the rows and the malformed lines of each table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import types as T

from edgeloom.session import get_session
from edgeloom.sources.edges import ACTIVITY, TABLES, edge_schemas, ingest
from edgeloom.sources.files import missing_files


def source_names(prefix: str = "") -> dict[str, str]:
    """File name per table."""
    return {
        table: f"{prefix}{table}." + ("txt.gz" if table == ACTIVITY else "edgelist.gz")
        for table in TABLES
    }


def source_paths(source_dir: str, prefix: str = "") -> dict[str, str]:
    return {
        table: f"{source_dir.rstrip('/')}/{name}" for table, name in source_names(prefix).items()
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Convert edge lists to Parquet.")
    parser.add_argument("source_dir")
    parser.add_argument("parquet_dir")
    parser.add_argument("--prefix", default="", help="start of every file name")
    parser.add_argument("--mode", default="PERMISSIVE", choices=["PERMISSIVE", "FAILFAST"],
                        help="what to do with malformed lines: fill with NULL, or stop")
    parser.add_argument("--narrow", action="store_true",
                        help="32-bit ids, weights and times, for data known to fit")
    parser.add_argument("--corrupt-dir", help="folder that keeps malformed lines as text")
    parser.add_argument("--write-partitions", type=int,
                        help="tasks and files per table, for gzip input that cannot be split")
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    spark = get_session("edge ingest", master=args.master)
    missing = missing_files(spark, source_names(args.prefix).values(), args.source_dir)
    # At most the five expected names.
    absent = sorted(row["name"] for row in missing.collect())
    if absent:
        raise SystemExit(f"not in {args.source_dir}: {', '.join(absent)}")
    written = ingest(
        spark, source_paths(args.source_dir, args.prefix), args.parquet_dir,
        schemas=edge_schemas(T.IntegerType() if args.narrow else None),
        mode=args.mode, write_partitions=args.write_partitions, corrupt_dir=args.corrupt_dir,
    )
    for table, done in written.items():
        print(f"{table} -> {done.path}: {done.rows} rows, {done.malformed} malformed lines")


if __name__ == "__main__":
    main()
