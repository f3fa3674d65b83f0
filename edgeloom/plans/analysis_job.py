"""The analysis job: user profiles, four result datasets and their previews.

    python -m edgeloom.plans.analysis_job PARQUET_DIR RESULTS_DIR [--master MASTER]

Follower counts are part of every result, and mention figures of three of the
four. The job therefore makes one pass over the networks, writes the user
profiles, and derives all results from that table of one row per user.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from edgeloom.operators import ranking, report
from edgeloom.plans import sql_queries
from edgeloom.session import get_session
from edgeloom.sources.edges import EdgeTableSet, read_tables, together, write_parquet

# --- Fixed values: names of the result datasets and the order of their rows. ---
RESULT_ORDER = {
    "top_followed": (("followers",), "followed"),
    "top_mentioned": (("mentions",), "mentioned"),
    "top_followed_mentions": (("followers",), "followed"),
    "top_100_users": (("followers_count", "mentions_count"), "user_id"),
}
# -------------------------------------------------------------------------------


# The dataset of all measures per user, beside the results.
PROFILES = "user_profiles"


def results(profile: DataFrame) -> dict[str, DataFrame]:
    return {
        "top_followed": report.followed_in(profile),
        "top_mentioned": report.mentioned_in(profile),
        "top_followed_mentions": report.leaders_in(profile),
        "top_100_users": report.top_users(report.user_report(profile)),
    }


def save_results(
    spark: SparkSession, tables: EdgeTableSet, results_dir: str
) -> dict[str, DataFrame]:
    """Write all results; returns them as read back from what was written.

    The profiles they come from are a dataset of their own, ``PROFILES``.
    """
    profile_path = f"{results_dir.rstrip('/')}/{PROFILES}"
    write_parquet(report.user_profile(tables), profile_path)
    frames = results(spark.read.parquet(profile_path))
    paths = {name: f"{results_dir.rstrip('/')}/{name}" for name in frames}
    together(spark, lambda name: write_parquet(frames[name], paths[name]), list(frames))
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def preview(saved: dict[str, DataFrame], rows: int = 10) -> dict[str, DataFrame]:
    """First rows of each written result, so that showing them computes nothing again."""
    return {
        name: ranking.top(frame, *RESULT_ORDER[name][0], by=RESULT_ORDER[name][1], k=rows)
        for name, frame in saved.items()
    }


def sql_previews(spark: SparkSession, tables: EdgeTableSet, rows: int = 10) -> dict[str, DataFrame]:
    """First rows of the two analyses that also exist as SQL text, run over views of ``tables``."""
    tables.register_views()
    return {
        "top_followed in SQL": sql_queries.sql_top_followed(spark).limit(rows),
        "top_followed_mentions in SQL": sql_queries.sql_top5_followed_mentions(spark),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Rank users and write the user report.")
    parser.add_argument("parquet_dir")
    parser.add_argument("results_dir")
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    spark = get_session("edge analysis", master=args.master)
    tables = read_tables(spark, args.parquet_dir)
    saved = save_results(spark, tables, args.results_dir)
    for name, frame in {**preview(saved), **sql_previews(spark, tables)}.items():
        print(name)
        frame.show()


if __name__ == "__main__":
    main()
