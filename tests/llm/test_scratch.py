import os
import random
from pathlib import Path

from helpers import frame, prose

from edgeloom.llm import suffix_tree_lm as lm
from edgeloom.llm.tables import passing, settled


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for f in Path(d).rglob("shuffle_*")}


def tables(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "edgeloom")
    return set(os.listdir(folder)) if folder.exists() else set()


def test_a_settled_table_leaves_no_shuffle_files_and_a_passing_one_goes(spark):
    counted = spark.range(1000).selectExpr("id % 100 AS k").groupBy("k").count()
    files, folders, setting = shuffle_files(spark), tables(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    assert settled(counted, "kept").count() == 100
    with passing(counted, "gone") as found:
        own = settled(found.where("k < 10"), "made")
    assert own.count() == 10 and spark.conf.get(setting, None) == before
    assert {t.rpartition("-")[0] for t in tables(spark) - folders} == {"kept", "made"}
    # Those of the two counts are of one row a task.
    assert sum(f.stat().st_size for f in shuffle_files(spark) - files if f.suffix == ".data") < 1000


def test_growing_a_tree_keeps_its_tables_only(spark):
    rng = random.Random(3)
    docs, folders = frame(spark, [(i, prose(rng, 100)) for i in range(50)]), tables(spark)
    assert lm.score_report(docs).count() == 50
    assert {t.rpartition("-")[0] for t in tables(spark) - folders} == {
        "lm-words", "lm-contexts", "lm-likely", "lm-scored", "lm-rare", "lm-opened"
    }
