"""Session settings the operators rely on, and the place lineage is cut."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording a Python stack for every column expression costs more than planning them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "prepline") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only on one machine, where no setting is needed, is a scratch folder used in its place.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="prepline-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that is read several times; a lost block is computed again from its lineage."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Frames run inside reach Python in batches of at most so many rows; for rows that are wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
