"""Which files have landed in a folder, as a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from edgeloom.operators.reconcile import missing_items


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the files in ``folder``: column ``name``; no row for an absent folder.

    Only ``path`` is selected, so Spark lists the files (in parallel, where
    there are many) and opens none.
    """
    try:
        files = spark.read.format("binaryFile").load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string")
    return files.selectExpr("element_at(split(path, '/'), -1) AS name")


def missing_files(
    spark: SparkSession, expected: Iterable[str], folder: str, force: bool = False
) -> DataFrame:
    """Expected file names that ``folder`` lacks; all of them when a refresh is forced."""
    names = spark.createDataFrame([(name,) for name in expected], "name string")
    return missing_items(names, landed_files(spark, folder), ["name"], force=force)
