"""Spark session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package expects.  Cluster deployments pass
# their own sizing (shuffle partitions, executor memory) on submit; these
# are only the semantic ones plus sane local defaults.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast only when the measured build side is small;
    # otherwise the planner keeps the sort-merge join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Window partitions (one Pareto group-month, one range slice) are kept
    # in memory up to this many rows before spilling; the default 4096
    # spills every month of the overall group.
    "spark.sql.windowExec.buffer.in.memory.threshold": "262144",
    "spark.sql.windowExec.buffer.spill.threshold": "1048576",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "salesabc",
              shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only a local master may run without it and gets a private
    folder; on a cluster executors could not see one, so that is an error.
    """
    cdir = spark.conf.get("spark.checkpoint.dir", None)
    if not cdir:
        cdir = spark.sparkContext.getCheckpointDir()
    if not cdir:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        cdir = tempfile.mkdtemp(prefix="salesabc-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cdir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(cdir)
    return cdir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each write inside removes the shuffle files of its own query as it ends.

    Otherwise they stay until the driver happens to collect the plan, so a job
    of several writes holds the shuffles of all of them.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, name: str, scratch: ExitStack | None = None) -> DataFrame:
    """``df`` stored in a scratch folder and read back; with ``scratch`` the folder goes as that stack closes."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    if scratch is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        scratch.callback(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete, at, True)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
