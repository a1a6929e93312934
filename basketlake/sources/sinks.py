"""Writers: full refresh, append, keyed upsert.

A stored table is a folder of snapshots, ``snapshot-<number>``. The newest finished one is the table: replacing a table
writes the next one beside it and moves nothing, so that readers always find a whole table. A table written in buckets
keeps a folder per bucket and generation instead, and a mark per finished generation.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basketlake.shared import CODEC, cut_lineage, shuffles_freed
from basketlake.sources.parts import delete, file_system, finished, names_in, observed

_SNAPSHOT = re.compile(r"snapshot-(\d+)$")
_BUCKETS = re.compile(r"buckets-(\d+)$")


def _snapshots(spark, path: str) -> list[tuple[int, str]]:
    return sorted((int(m[1]), f"{path}/{n}") for n in names_in(spark, path) if (m := _SNAPSHOT.match(n)))


def current(spark, path: str) -> str | None:
    """The folder that holds the table: its newest finished snapshot, or ``path`` itself if that is a plain Parquet table."""
    for _, folder in reversed(_snapshots(spark, path)):
        if finished(spark, folder):
            return folder
    return path if finished(spark, path) else None


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    cluster: bool = False,
    only_touched: bool = False,
) -> int:
    """Write Parquet and return the row count, taken while writing (no second pass).

    With ``cluster`` the rows are first rebalanced on the partition column: AQE
    gives a small month one file and cuts a huge month into several, so the file
    count follows the data and not tasks times months. ``only_touched`` replaces
    just the partitions present in ``df``, in place, as ``append`` adds files in place. A
    whole table becomes a new snapshot: a failed job leaves the old table, ``df`` may read it, and
    the snapshot that was replaced stays until the next write, for those who still read it.
    """
    if partition_by and cluster:
        df = df.hint("rebalance", partition_by)
    spark = df.sparkSession
    old = _snapshots(spark, path)
    target = current(spark, path) if only_touched or mode == "append" else None
    fresh = f"{path}/snapshot-{(old[-1][0] if old else 0) + 1:08d}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode if target else "overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(partition_by)
        writer = writer.option("partitionOverwriteMode", "dynamic" if target and only_touched else "static")
    with shuffles_freed(spark):
        writer.parquet(target or fresh)
    if not target:
        done = [folder for _, folder in old if finished(spark, folder)]
        for _, folder in old:
            if folder not in done[-1:]:
                delete(spark, folder)
    return (observed(seen) or {"rows": 0})["rows"]


def load_raw_overwrite(raw: DataFrame, path: str) -> int:
    return write_table(raw, path, "overwrite")


def load_raw_append(batch: DataFrame, path: str) -> int:
    return write_table(batch, path, "append")


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """The newest row per key. An aggregate, not a window: it combines map-side,
    so a key with very many versions never gathers in one task."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def merge_keyed(existing: DataFrame, updates: DataFrame, keys: list[str], newest: list[str] | None = None) -> DataFrame:
    """Existing rows without an update, plus the updates.

    ``newest`` picks the last of several updates of one key. Only the keys of
    the updates meet the existing rows; when they are few Spark broadcasts them
    (by measured size) and the existing table is not shuffled at all.
    """
    if newest:
        updates = latest_per_key(updates, keys, newest)
    kept = existing.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates)


def insert_absent_rows(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows plus those new rows whose key is not there yet."""
    new = rows.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(new)


def upsert_keyed(
    spark, path: str, updates: DataFrame, keys: list[str], newest: list[str] | None = None, partition_by: str | None = None, buckets: int | None = None
) -> int:
    """INSERT .. ON CONFLICT DO UPDATE on a Parquet table; returns the rows written.

    One writer at a time. A missing table is created. With ``partition_by`` (a
    column that depends on the key) only the partitions the updates fall into
    are read and replaced, however large the table is. With ``buckets`` the same
    holds for any key: rows lie in that many hash buckets of the key, and only the touched
    buckets are written anew. The number is the one the table was made with.
    """
    if buckets or _bucket_count(spark, path):
        return _upsert_buckets(spark, path, updates, keys, newest, buckets)
    if not table_exists(spark, path):
        return write_table(latest_per_key(updates, keys, newest) if newest else updates, path, partition_by=partition_by)
    existing = spark.read.parquet(current(spark, path))
    if partition_by:
        existing = existing.join(updates.select(partition_by).distinct(), partition_by, "left_semi").select(*existing.columns)
    merged = merge_keyed(existing, updates, keys, newest)
    if partition_by:
        # Partitions are replaced in place, so what is read from them is stored first.
        return write_table(cut_lineage(merged), path, partition_by=partition_by, only_touched=True)
    return write_table(merged, path)


def insert_if_absent(spark, path: str, rows: DataFrame, keys: list[str]) -> int:
    """INSERT .. ON CONFLICT DO NOTHING on a Parquet table; returns its row count."""
    if not table_exists(spark, path):
        return write_table(rows.dropDuplicates(keys), path)
    return write_table(insert_absent_rows(spark.read.parquet(current(spark, path)), rows, keys), path)


# --- buckets ----------------------------------------------------------------------


def _bucket_count(spark, path: str) -> int | None:
    found = [int(m[1]) for n in names_in(spark, path) if (m := _BUCKETS.match(n))]
    return found[0] if found else None


def _bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _generations(spark, root: str) -> set[int]:
    """The finished generations of a bucketed table."""
    return {int(n) for n in names_in(spark, f"{root}/_finished")}


def _bucket_folders(spark, root: str, only: list[int] | None = None) -> dict[int, list[tuple[int, str]]]:
    """For each bucket its finished generations and their folders, newest first."""
    done = _generations(spark, root)
    buckets = only if only is not None else [int(n.split("=")[1]) for n in names_in(spark, root) if n.startswith("bucket=")]
    out = {}
    for b in buckets:
        gens = [(int(n.split("=")[1]), f"{root}/bucket={b}/{n}") for n in names_in(spark, f"{root}/bucket={b}") if n.startswith("generation=")]
        out[b] = sorted((g for g in gens if g[0] in done), reverse=True)
    return {b: gens for b, gens in out.items() if gens}


def _read_folders(spark, root: str, folders: list[str], schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


def _upsert_buckets(spark, path: str, updates: DataFrame, keys: list[str], newest: list[str] | None, buckets: int | None) -> int:
    made = _bucket_count(spark, path)
    if made and buckets and made != buckets:
        raise ValueError(f"{path} has {made} buckets, not {buckets}")
    n = made or buckets
    root = f"{path}/buckets-{n}"
    updates = cut_lineage(latest_per_key(updates, keys, newest) if newest else updates).withColumn("bucket", _bucket_of(keys, n))
    touched = [r[0] for r in updates.select("bucket").distinct().collect()]  # as many numbers as there are buckets at most
    folders = _bucket_folders(spark, root, touched)
    plain = updates.drop("bucket")
    existing = _read_folders(spark, root, [gens[0][1] for gens in folders.values()], plain.schema)
    merged = merge_keyed(existing, plain, keys).withColumn("bucket", _bucket_of(keys, n))
    # A number no folder has yet: what a broken run left is never taken for a later one's.
    # All buckets count: the new mark would finish its folders in buckets that this run does not touch, too.
    every = [b for b in names_in(spark, root) if b.startswith("bucket=")]
    used = [int(g.split("=")[1]) for b in every for g in names_in(spark, f"{root}/{b}") if g.startswith("generation=")]
    generation = max([0, *used, *_generations(spark, root)]) + 1
    seen = Observation()
    out = merged.withColumn("generation", F.lit(generation)).observe(seen, F.count(F.lit(1)).alias("rows"))
    with shuffles_freed(spark):
        out.hint("rebalance", "bucket").write.mode("append").option("compression", CODEC).partitionBy("bucket", "generation").parquet(root)
    fs, mark = file_system(spark, f"{root}/_finished/{generation}")
    fs.create(mark, True).close()
    for gens in folders.values():  # the one just replaced stays for those who read it
        for _, folder in gens[1:]:
            delete(spark, folder)
    return (observed(seen) or {"rows": 0})["rows"]


def read_bucketed(spark, path: str, schema=None) -> DataFrame:
    """The newest finished generation of every bucket."""
    root = f"{path}/buckets-{_bucket_count(spark, path)}"
    folders = [gens[0][1] for gens in _bucket_folders(spark, root).values()]
    return _read_folders(spark, root, folders, schema)


# --- lookups ----------------------------------------------------------------------


def read_table(spark, path: str, schema: str | None = None) -> DataFrame:
    """A stored table, or the Parquet files of a folder that no writer of this module made."""
    if _bucket_count(spark, path):
        return read_bucketed(spark, path, schema)
    folder = current(spark, path) or path
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(folder)


def path_exists(spark, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def table_exists(spark, path: str) -> bool:
    """A finished table."""
    n = _bucket_count(spark, path)
    return bool(_generations(spark, f"{path}/buckets-{n}")) if n else current(spark, path) is not None
