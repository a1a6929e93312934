"""Daily series: every operator takes any number of series told apart by key columns.

A series has one row per day, so one group is at most as long as the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.functions import errors
from basketlake.schemas import KPI_METRICS

METRIC = ["metric_name"]
# Names a model may be asked for by.
MODELS = {"naive", "weekday_mean", "smoothing", "ets", "trend_seasonal"}


def unpivot_metrics(kpis: DataFrame, metrics: list[str] = KPI_METRICS, day: str = "full_date") -> DataFrame:
    """Wide KPI rows to (metric_name, ds, value): one scan, no shuffle."""
    unknown = [m for m in metrics if m not in KPI_METRICS]
    if unknown:
        raise ValueError(f"unknown metric {unknown}: choose from {KPI_METRICS}")
    wide = kpis.select(F.col(day).alias("ds"), *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot("ds", metrics, "metric_name", "value").select("metric_name", "ds", "value")


def fill_daily_gaps(series: DataFrame, keys: list[str] = METRIC, fill: float | None = 0.0) -> DataFrame:
    """One row per day between the first and last day of each series.

    Each row emits itself and the empty days up to the next row: a single
    shuffle on the keys, with no date spine to build and join.
    """
    w = Window.partitionBy(*keys).orderBy("ds")
    nxt = F.coalesce(F.date_sub(F.lead("ds").over(w), 1), F.col("ds"))
    days = series.where(F.col("value").isNotNull()).withColumn("_until", nxt)
    spread = days.select(
        *keys, F.col("ds").alias("_from"), "value", F.explode(F.sequence("ds", "_until", F.expr("interval 1 day"))).alias("ds")
    )
    gap = F.lit(fill).cast("double")
    return spread.select(*keys, "ds", F.when(F.col("ds") == F.col("_from"), F.col("value")).otherwise(gap).alias("value"))


def lookback_filter(series: DataFrame, days: int, keys: list[str] = METRIC) -> DataFrame:
    """Rows of the last ``days`` days before the newest day of all series (inclusive)."""
    newest = series.agg(F.max("ds")).scalar()
    return series.where(F.col("ds") >= F.date_sub(newest, days))


def train_test_split_tail(series: DataFrame, test_days: int = 14, min_train: int = 30, keys: list[str] = METRIC) -> DataFrame:
    """Marks the last ``test_days`` rows of each series; too short series are left out."""
    w = Window.partitionBy(*keys)
    return (
        series.withColumn("_n", F.count(F.lit(1)).over(w))
        .withColumn("_back", F.row_number().over(w.orderBy(F.col("ds").desc())))
        .where(F.col("_n") >= test_days + min_train)
        .withColumn("is_test", F.col("_back") <= test_days)
        .drop("_n", "_back")
    )


def naive_weekly_forecast(
    series: DataFrame, horizon: int, keys: list[str] = METRIC, z: float = 1.96
) -> DataFrame:
    """Last week repeated; the mean for series of less than seven rows.

    Bounds are ``z`` standard deviations of the week-over-week differences,
    clipped at zero. Columns: keys, ds, step, predicted, lower_bound, upper_bound.
    """
    w = Window.partitionBy(*keys)
    newest_first = w.orderBy(F.col("ds").desc())
    marked = series.select(
        *keys,
        "ds",
        "value",
        F.row_number().over(newest_first).alias("_back"),
        (F.col("value") - F.lead("value", 7).over(newest_first)).alias("_diff"),
    )
    week = F.when(F.col("_back") <= 7, F.struct("ds", "value"))
    stats = marked.groupBy(*keys).agg(
        F.max("ds").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.avg("value").alias("_mean"),
        F.coalesce(F.stddev_samp("_diff"), F.lit(0.0)).alias("_sd"),
        F.array_sort(F.collect_list(week)).alias("_week"),
    )
    steps = stats.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    repeated = F.col("_week")[(F.col("step") - 1) % 7]["value"]
    predicted = F.when(F.col("_n") < 7, F.col("_mean")).otherwise(repeated)
    clip = lambda c: F.round(F.greatest(c, F.lit(0.0)), 2)
    return steps.select(
        *keys,
        F.date_add("_last", F.col("step")).alias("ds"),
        "step",
        clip(predicted).alias("predicted"),
        clip(predicted - z * F.col("_sd")).alias("lower_bound"),
        clip(predicted + z * F.col("_sd")).alias("upper_bound"),
    )


def _cents(c: Column) -> Column:
    """Clipped at zero and rounded to two digits; six digits first, so that the last bit of a double decides nothing."""
    return F.round(F.greatest(c, F.lit(0.0)).cast("decimal(24,6)"), 2).cast("double")


def _by_weekday(weekdays: DataFrame, horizon: int, keys: list[str], z: float) -> DataFrame:
    """Forecast rows from (keys, _weekday, _last, _level, _sd, _n): a level per series and day of the week.

    A weekday that a short series lacks takes the mean of the others, weighed by their days.
    """
    w = Window.partitionBy(*keys)
    last = F.max("_last").over(w)
    mean = F.sum(F.col("_level") * F.col("_n")).over(w) / F.sum("_n").over(w)
    per = weekdays.withColumn("_end", last).withColumn("_mean", mean).groupBy(*keys).agg(
        F.first("_end").alias("_end"), F.first("_mean").alias("_mean"),
        F.map_from_entries(F.collect_list(F.struct("_weekday", F.struct("_level", "_sd")))).alias("_of"),  # seven entries at most
    )
    steps = per.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")).withColumn("ds", F.date_add("_end", F.col("step")))
    found = F.col("_of")[F.weekday("ds")]
    level, sd = F.coalesce(found["_level"], F.col("_mean")), F.coalesce(found["_sd"], F.lit(0.0))
    return steps.select(
        *keys, "ds", "step", _cents(level).alias("predicted"), _cents(level - z * sd).alias("lower_bound"), _cents(level + z * sd).alias("upper_bound")
    )


def weekday_mean_forecast(series: DataFrame, horizon: int, keys: list[str] = METRIC, weeks: int = 8, z: float = 1.96) -> DataFrame:
    """The mean of the last ``weeks`` days of the same day of the week; bounds are ``z`` of their deviations."""
    w = Window.partitionBy(*keys, F.weekday("ds")).orderBy(F.col("ds").desc())
    recent = series.withColumn("_weekday", F.weekday("ds")).withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= weeks)
    levels = recent.groupBy(*keys, "_weekday").agg(
        F.max("ds").alias("_last"), F.avg("value").alias("_level"), F.stddev_pop("value").alias("_sd"), F.count(F.lit(1)).alias("_n")
    )
    return _by_weekday(levels, horizon, keys, z)


def smoothing_forecast(series: DataFrame, horizon: int, keys: list[str] = METRIC, alpha: float = 0.3, z: float = 1.96) -> DataFrame:
    """Exponential smoothing of each day of the week: level = alpha * value + (1 - alpha) * level, from the first day on.

    A fold over the days in order. The array of one series and weekday is a seventh of the calendar at most. Bounds are
    ``z`` root mean squares of the one-step errors.
    """
    days = series.groupBy(*keys, F.weekday("ds").alias("_weekday")).agg(F.array_sort(F.collect_list(F.struct("ds", "value"))).alias("_days"))
    first = F.struct(F.col("_days")[0]["value"].alias("level"), F.lit(0.0).alias("squares"))

    def step(state: Column, day: Column) -> Column:
        error = day["value"] - state["level"]
        return F.struct((alpha * day["value"] + (1 - alpha) * state["level"]).alias("level"), (state["squares"] + error * error).alias("squares"))

    folded = days.withColumn("_s", F.aggregate(F.slice("_days", F.lit(2), F.greatest(F.size("_days") - 1, F.lit(0))), first, step))
    levels = folded.select(
        *keys, "_weekday", F.element_at("_days", -1)["ds"].alias("_last"), F.col("_s.level").alias("_level"),
        F.sqrt(F.col("_s.squares") / F.greatest(F.size("_days") - 1, F.lit(1))).alias("_sd"), F.size("_days").cast("bigint").alias("_n"),
    )
    return _by_weekday(levels, horizon, keys, z)


def forecast_errors(pairs: DataFrame, by: list[str]) -> DataFrame:
    """MAPE, sMAPE, RMSE and MAE of (actual, predicted) rows per group: one aggregate."""
    a, p = F.col("actual"), F.col("predicted")
    return pairs.groupBy(*by).agg(
        errors.mape(a, p).alias("mape"),
        errors.smape(a, p).alias("smape"),
        errors.rmse(a, p).alias("rmse"),
        errors.mae(a, p).alias("mae"),
        F.count(F.lit(1)).alias("test_samples"),
    )


def select_best_model(scores: DataFrame, keys: list[str] = METRIC) -> DataFrame:
    """Model with the lowest MAPE per series; ties go to the first name."""
    order = F.struct("mape", "model_type")
    return scores.where(F.col("mape").isNotNull()).groupBy(*keys).agg(
        F.min_by("model_type", order).alias("model_type"), F.min("mape").alias("mape")
    )


def pick_model(scores: DataFrame, model: str | None = None, keys: list[str] = METRIC) -> DataFrame:
    """The model to use per series: the best one for None or 'auto', else the named one."""
    name = (model or "auto").strip().lower()
    if name == "auto":
        return select_best_model(scores, keys)
    if name not in MODELS:
        raise ValueError(f"unknown model {model!r}: choose from {sorted(MODELS)} or 'auto'")
    return scores.where(F.col("model_type") == name).select(*keys, "model_type", "mape")
