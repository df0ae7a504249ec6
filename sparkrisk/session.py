"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: Rows for which a task of its own pays in each pass of a learner.
TASK_ROWS = 20_000


def build_session(app: str = "sparkrisk", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def is_local(master: str) -> bool:
    """Whether driver and executors are one process, and so share the local disk."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the setting is absent and Spark runs in one local process is a fresh temporary
    folder used, and it is registered as the checkpoint folder. On a cluster a missing setting
    is an error: executors would write to disks that the others cannot read.
    """
    setting = "spark.checkpoint.dir"
    configured = spark.conf.get(setting, None) or spark.sparkContext.getConf().get(setting, None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparkrisk-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder, never used before."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str, by: tuple[str, ...] = ()):
    """Write a table to the scratch folder and read it back.

    Cuts the lineage at a point that outlives lost executors, for tables that
    several later jobs read. With ``by`` each value of those columns has a folder of its own, so that
    a filter on them reads nothing else.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


@contextmanager
def learning_rows(df: DataFrame, at_once: int = 1) -> Iterator[tuple[DataFrame, int]]:
    """A table for the many passes of a learner, kept while these run, and its number of rows.

    A small file, or one row group, is read by one task, which each pass would then run as its only one: rows in too few
    parts for the cores are dealt out once. ``at_once`` learners share the cores.
    """
    kept = [df.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        n = df.count()
        cores = df.sparkSession.sparkContext.defaultParallelism
        wanted = min(-(-cores // at_once), -(-n // TASK_ROWS))
        if df.rdd.getNumPartitions() < wanted:
            kept.append(df.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK))
            kept[1].count()
            kept[0].unpersist()
        yield kept[-1], n
    finally:
        for table in kept:
            table.unpersist()
