"""Tables that grow by batches.

Every batch writes a folder of its own, ``batches=<first>_<last>``, which counts once Spark's marker of a finished
write is in it. Closed batches are merged into wider folders; a finished wider folder stands for all those
inside its range, so a merge takes effect at one moment, loses nothing when it breaks off and moves no file. A
replayed batch replaces its own folder.
"""

from __future__ import annotations

import re
from typing import Callable, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketlake.shared import CODEC, shuffles_freed

_NAME = re.compile(r"batches=(-?\d+)_(-?\d+)$")
#: So many neighbours of one level become one of the next: at most (FAN_OUT - 1) folders a level stay.
FAN_OUT = 8


class Part(NamedTuple):
    first: int
    last: int
    folder: str


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, target = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def observed(seen: Observation) -> dict | None:
    """What a write measured in passing; None where Spark knew that there was no row, and ran no aggregate."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return None


def finished(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(target)


def _all(spark: SparkSession, path: str) -> list[Part]:
    found = [(n, m) for n in names_in(spark, path) if (m := _NAME.match(n))]
    return [Part(int(m[1]), int(m[2]), f"{path}/{n}") for n, m in found if finished(spark, f"{path}/{n}")]


def _inside(parts: list[Part]) -> tuple[list[Part], list[Part]]:
    """The parts that count, in order, and those a wider one stands for."""
    live: list[Part] = []
    merged: list[Part] = []
    for p in sorted(parts, key=lambda p: (p.first, -p.last)):
        (merged if live and p.last <= live[-1].last else live).append(p)
    return live, merged


def live(spark: SparkSession, path: str, before: int | None = None) -> list[Part]:
    """Finished parts that count; with ``before`` only those of earlier batches."""
    return [p for p in _inside(_all(spark, path))[0] if before is None or p.last < before]


def _load(spark: SparkSession, path: str, schema: str, folders: list[str]) -> DataFrame:
    """Rows of some parts; the folders' name is a partition column to Spark, which is left out."""
    return spark.read.schema(f"{schema}, batches string").option("basePath", path).parquet(*folders).drop("batches")


def _folder(path: str, first: int, last: int) -> str:
    return f"{path}/batches={first}_{last}"


def read(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """All rows, or those of batches before ``before``; no rows where there is no part."""
    folders = [p.folder for p in live(spark, path, before)]
    return _load(spark, path, schema, folders) if folders else spark.createDataFrame([], schema)


def read_batch(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    return _load(spark, path, schema, [_folder(path, batch_id, batch_id)])


def write(df: DataFrame, path: str, batch_id: int, partition_by: list[str] = (), measures: dict[str, Column] | None = None, first: int | None = None) -> dict:
    """Writes one batch, or everything from ``first`` to it; returns the measures, taken while writing.

    A batch that was merged cannot be written again: the stream then has lost its checkpoint, and its batch
    numbers mean other rows than the stored ones.
    """
    spark = df.sparkSession
    own = Part(batch_id if first is None else first, batch_id, "")
    wider = [p for p in live(spark, path) if p.first <= own.first and own.last <= p.last and (p.first, p.last) != own[:2]]
    if wider:
        raise ValueError(f"batch {batch_id} of {path} is merged into {wider[0].folder}: the checkpoint is not the one that wrote this table")
    seen = Observation()
    if measures:
        df = df.observe(seen, *[c.alias(n) for n, c in measures.items()])
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    with shuffles_freed(spark):
        df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(_folder(path, own.first, own.last))
    if not measures:
        return {}
    nothing = lambda: spark.createDataFrame([], df.schema).agg(*[c.alias(n) for n, c in measures.items()]).first().asDict()
    return observed(seen) or nothing()


def _level(p: Part, fan_out: int) -> int:
    level, width = 0, p.last - p.first + 1
    while width >= fan_out:
        level, width = level + 1, width // fan_out
    return level


def _due(parts: list[Part], fan_out: int) -> list[Part]:
    for i in range(len(parts) - fan_out + 1):
        run = parts[i : i + fan_out]
        if len({_level(p, fan_out) for p in run}) == 1:
            return run
    return []


def compact(
    spark: SparkSession,
    path: str,
    schema: str,
    before: int,
    partition_by: list[str] = (),
    fold: Callable[[DataFrame], DataFrame] | None = None,
    fan_out: int = FAN_OUT,
) -> int:
    """Merges closed batches, those before ``before``, and returns the number of merges.

    ``fold`` sums up rows of one key where a table's rows may be merged. A row is written again once a level, so
    about the logarithm of the number of batches times.
    """
    live_parts, merged = _inside(_all(spark, path))
    for p in merged:  # left by a run that broke off after its merge
        delete(spark, p.folder)
    closed, merges = [p for p in live_parts if p.last < before], 0
    while run := _due(closed, fan_out):
        df = _load(spark, path, schema, [p.folder for p in run])
        df = fold(df) if fold else df
        # One file a partition value, or several where it is large; without a partition column as many as are due by size.
        df = df.hint("rebalance", *partition_by)
        wide = Part(run[0].first, run[-1].last, _folder(path, run[0].first, run[-1].last))
        with shuffles_freed(spark):
            df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(wide.folder)
        for p in run:
            delete(spark, p.folder)
        at = closed.index(run[0])
        closed[at : at + len(run)] = [wide]
        merges += 1
    return merges
