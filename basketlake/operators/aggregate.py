"""Generic dashboard building blocks: metric by dimension, filters, pivots, periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_filters(
    df: DataFrame,
    between: dict[str, tuple] | None = None,
    within: dict[str, list] | None = None,
) -> DataFrame:
    """Native dashboard filters: closed ranges and value sets, None meaning no filter."""
    for column, (low, high) in (between or {}).items():
        if low is not None:
            df = df.where(F.col(column) >= low)
        if high is not None:
            df = df.where(F.col(column) <= high)
    for column, values in (within or {}).items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    return df


def aggregate_query(
    df: DataFrame,
    metrics: dict[str, str] | None = None,
    dims: list[str] | None = None,
    filters: list[str] | None = None,
    time_column: str | None = None,
    grain: str = "day",
    raw_columns: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Chart query: ``metrics`` (name -> SQL aggregate) by ``dims`` and a time grain.

    ``raw_columns`` switches to a plain projection. ``limit`` is a cap that
    the caller asks for; rows are ordered by the dimensions, so it is repeatable.
    """
    for condition in filters or []:
        df = df.where(condition)
    if raw_columns:
        order, out = raw_columns, df.select(*raw_columns)
    else:
        by = [F.col(d) for d in dims or []]
        if time_column:
            by.append(F.date_trunc(grain, time_column).cast("date").alias(time_column))
        order = [*(dims or []), *([time_column] if time_column else [])]
        out = df.groupBy(*by).agg(*[F.expr(sql).alias(name) for name, sql in (metrics or {}).items()])
    out = out.orderBy(*order) if order else out
    return out.limit(limit) if limit else out


def top_k(df: DataFrame, by: str, k: int, tie: list[str]) -> DataFrame:
    """The ``k`` largest rows; the tie columns make the cut repeatable. Each task
    keeps k rows, so only k rows per task are merged."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie).limit(k)


def period_sums(df: DataFrame, day: str, periods: dict[str, tuple[Column, Column]], measures: dict[str, str]) -> DataFrame:
    """One row with each measure for each closed period: a single conditional aggregate."""
    out = []
    for p, (start, end) in periods.items():
        inside = F.col(day).between(start, end)
        for m, column in measures.items():
            out.append(F.sum(F.when(inside, F.col(column))).alias(f"{p}_{m}"))
    return df.agg(*out)


def metric_pivot_sum(df: DataFrame, metric: str, value: str, names: list[str], by: list[str] | None = None) -> DataFrame:
    """SUM(value) per metric name as columns; names are given, so no extra pass looks for them."""
    aggs = [F.sum(F.when(F.col(metric) == n, F.col(value)).otherwise(0)).alias(n) for n in names]
    return df.groupBy(*(by or [])).agg(*aggs)
