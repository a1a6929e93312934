"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlake.shared import shared_dir, shuffles_freed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space; every other character belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column, gap: str = SPACE) -> Column:
    """The words between the gaps; null text has none."""
    return F.coalesce(F.array_remove(F.split(text, gap), ""), F.array().cast("array<string>"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of the cluster."""
    return f"{shared_dir(spark)}/basketlake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Folders of the tables that :func:`written` made and that nobody has dropped.
_FOLDERS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors, has a known size."""
    path = scratch(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def small(df: DataFrame, rows: int, *texts: str, megabytes: int = 64) -> bool:
    """Whether a written table may be broadcast: at most ``rows`` rows, and its texts no longer than ``megabytes`` in all."""
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0)).cast("bigint")
    found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("b")).first()
    return found.n <= rows and found.b <= megabytes << 20


def discard(*frames: DataFrame) -> None:
    """Deletes tables of :func:`written` from which everything that is still needed has been written elsewhere."""
    for df in frames:
        path = _FOLDERS.pop(df, None)
        if path:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shielded(docs: DataFrame, *used: str):
    """``docs`` with all columns but the used ones renamed out of an operator's way, and what gives the names back."""
    names = {c: c if c in used else f"__other{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return inner, lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])
