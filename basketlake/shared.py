"""Where intermediate tables live: the shared folder the cluster names."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import Counter
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Tables are read more often than written, and several snapshots lie side by side.
CODEC = "zstd"
_FREE, _OPEN, _LOCK = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", Counter(), threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    ``spark.checkpoint.dir`` is read from the session. Only a master of one
    process may run without it; there a fresh temporary folder takes its place. A cluster
    without the setting is an error: executors could not see each other's files.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="basketlake-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Queries planned and run inside remove their shuffle files when they end.

    Otherwise these stay until the driver collects garbage, which need not happen before the disk is full. The
    session's own setting comes back when the last of several threads leaves.
    """
    session = spark._jsparkSession.hashCode()
    with _LOCK:
        if not _OPEN[session]:
            _OPEN[session, "was"] = spark.conf.get(_FREE, "false")
            spark.conf.set(_FREE, "true")
        _OPEN[session] += 1
    try:
        yield
    finally:
        with _LOCK:
            _OPEN[session] -= 1
            if not _OPEN[session]:
                spark.conf.set(_FREE, _OPEN.pop((session, "was")))
                del _OPEN[session]


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; survives lost executors.

    A written table rather than a checkpoint: it is columnar, so later readers
    fetch the columns they use, and its row count is in the file footers.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/basketlake/{spark.sparkContext.applicationId}/cut-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
