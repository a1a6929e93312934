"""Global positions, NTILE and RANK that do not collapse into one task.

A window without PARTITION BY moves every row to a single task. Here all wanted
orderings are stacked into one narrow frame of (ordering, sort value, id), range
partitioned on all three. The id makes the order total, so even a value shared
by most rows is cut at partition borders. The position of a row is its index in
the partition plus the number of rows in earlier partitions; only those counts
(one per partition and ordering) are ever brought together. Every size takes this path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlake.shared import cut_lineage

# monotonically_increasing_id() is (partition index << 33) + row index.
_PARTITION_BITS = 33


def positions(df: DataFrame, key: str, orderings: dict[str, tuple[str, bool]]) -> DataFrame:
    """(ordering, value, key, position, total) for every row and ordering.

    ``orderings`` maps a name to (numeric column, descending). Ties are broken
    by ``key`` ascending, which must be unique and not NULL. NULL values come last.
    """
    names = list(orderings)
    # A row for each ordering with its value in a column of the value's own type; the others are NULL there.
    values = [f"_value{i}" for i in range(len(names))]
    entries = [
        F.struct(
            F.lit(i).alias("_ordering"), F.col(column).isNull().alias("_null"),
            *[((-F.col(column) if desc else F.col(column)) if k == i else F.lit(None).cast(df.schema[orderings[names[k]][0]].dataType)).alias(v) for k, v in enumerate(values)],
        )
        for i, (column, desc) in enumerate(orderings.values())
    ]
    stacked = df.select(F.col(key).alias("_id"), F.explode(F.array(*entries)).alias("_e")).select("_id", "_e.*")
    order = ["_ordering", "_null", *values, "_id"]
    # The bounds of a range shuffle are sampled: the result is stored once, so
    # counts and positions cannot come from two different cuts.
    stored = cut_lineage(
        stacked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_row", _PARTITION_BITS))
    parts = stored.groupBy("_ordering", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # One row per partition and ordering: as small as the partition count.
    w = Window.partitionBy("_ordering")
    offsets = parts.select(
        "_ordering",
        "_part",
        "_first",
        (F.sum("_n").over(w.orderBy("_part")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(w).alias("total"),
    )
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_ordering") + 1)
    return stored.join(F.broadcast(offsets), ["_ordering", "_part"]).select(
        label.alias("ordering"),
        F.struct("_null", *values).alias("value"),
        F.col("_id").alias(key),
        (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("position"),
        "total",
    )


def ntile_of(position, total, tiles: int):
    """NTILE bucket of a position: the first ``total % tiles`` buckets hold one row more."""
    size, extra = F.floor(total / tiles), total % tiles
    wide = extra * (size + 1)
    return (
        F.when(position <= wide, F.floor((position - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor((position - 1 - wide) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def with_ntiles(df: DataFrame, key: str, tiles: int, orderings: dict[str, tuple[str, bool]]) -> DataFrame:
    """``df`` plus one NTILE column per ordering (ties broken by key).

    ``df`` is stored first: it is read to rank and to join.
    """
    df = cut_lineage(df)
    pos = positions(df, key, orderings)
    tile = ntile_of(F.col("position"), F.col("total"), tiles)
    wide = pos.groupBy(key).agg(*[F.max(F.when(F.col("ordering") == n, tile)).alias(n) for n in orderings])
    return df.join(wide, key)


def with_ranks(df: DataFrame, key: str, orderings: dict[str, tuple[str, bool]]) -> DataFrame:
    """``df`` plus one RANK column per ordering: the first position of each tie group.

    Tie groups aggregate map-side; in the join back AQE splits a hot value, whose
    other side is a single row.
    """
    df = cut_lineage(df)
    pos = positions(df, key, orderings)
    firsts = pos.groupBy("ordering", "value").agg(F.min("position").alias("rank"))
    firsts = firsts.select(F.col("ordering").alias("_o"), F.col("value").alias("_v"), "rank")
    ranked = pos.join(firsts, F.expr("ordering = _o and value <=> _v"))
    wide = ranked.groupBy(key).agg(*[F.max(F.when(F.col("ordering") == n, F.col("rank"))).alias(n) for n in orderings])
    return df.join(wide, key)
