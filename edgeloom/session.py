"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE merges small shuffle partitions, splits skewed join partitions, and joins by
# hash instead of sorting where every partition of one side has been measured to
# be small. Scans of narrow columns get larger splits than the default where there
# is more data than cores: fewer map tasks mean fewer, larger shuffle blocks, and
# an ingest writes fewer, larger files.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

# For streams whose state does not fit the executors' heap: state in RocksDB, its
# memory bounded per executor, and only changes written at each checkpoint.
# Slower while state is small.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the defaults above; ``conf`` wins over them.

    ``shuffle_partitions`` is the number AQE starts from and merges down. Choose
    it so that the largest shuffle divided by it stays near 200 MB: a few
    thousand for terabytes, tens of thousands for 100 TB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder named by ``spark.checkpoint.dir``.

    Written intermediates and streaming checkpoints go there, so that every
    executor can read them again after another one is lost. Only a local-mode
    session without that setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="edgeloom-")
    return f"{root.rstrip('/')}/edgeloom/{label}-{uuid.uuid4().hex}"
