"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a punctuality job wants on a cluster. AQE does the run-time work:
# it turns a join into a broadcast only after it has measured the small side,
# splits skewed join partitions and merges small ones.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "Europe/Paris",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "railcadence", **extra: str) -> SparkSession:
    """A session with the job settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in JOB_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="railcadence-")
    return _local_roots[context.applicationId]


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name below the shared root."""
    return f"{shared_root(spark)}/railcadence/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def one_group_at_a_time(spark: SparkSession) -> Iterator[None]:
    """Collected lists of what is written inside are built group after group from sorted rows.

    By default a task holds those of up to 128 groups at once, too much if a list is many megabytes.
    """
    key = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


Keep = Callable[[DataFrame, str], DataFrame]


@contextmanager
def work_tables(spark: SparkSession, purpose: str) -> Iterator[Keep]:
    """A function that writes a DataFrame below the shared root and reads it back, by a name.

    Cuts plans that use a result several times; what executors lose is read again. The tables
    are deleted at the end, so nothing that reads them may leave the block.
    """
    root = work_dir(spark, purpose)

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
