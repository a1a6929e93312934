"""Forecast models, back-test and model choice.

The models of ``NATIVE`` are DataFrame expressions over any number of series. Those of ``FITS`` are optional
numeric fits in Python, one task per (series, model), each a single daily series. Errors, baseline and choice are
plain DataFrame aggregates.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlake.functions.errors import improvement_pct
from basketlake.operators.series import (
    METRIC,
    fill_daily_gaps,
    forecast_errors,
    naive_weekly_forecast,
    select_best_model,
    smoothing_forecast,
    weekday_mean_forecast,
)

# Display names of the models.
MODEL_NAMES = {
    "ets": "ETS", "trend_seasonal": "Trend + seasonality", "naive": "Naive weekly", "weekday_mean": "Weekday mean", "smoothing": "Exponential smoothing",
}
LEVEL = 0.95
Z_LEVEL = 1.96
SEASON = 7


def fit_ets(y: np.ndarray, horizon: int) -> tuple[np.ndarray, float] | None:
    """Holt-Winters with additive trend and weekly season.

    The three smoothing factors are searched on a coarse grid and then on a
    finer one around the best point; each pass runs all candidates at once.
    """
    n = len(y)
    if n < 2 * SEASON:
        return None
    first, second = y[:SEASON].mean(), y[SEASON : 2 * SEASON].mean()

    def run(a, b, g):
        level = np.full(a.shape, first)
        trend = np.full(a.shape, (second - first) / SEASON)
        season = np.repeat((y[:SEASON] - first)[:, None], len(a), axis=1)
        resid = np.empty((n, len(a)))
        for t in range(n):
            s = season[t % SEASON]
            resid[t] = y[t] - (level + trend + s)
            before = level
            level = a * (y[t] - s) + (1 - a) * (level + trend)
            trend = b * (level - before) + (1 - b) * trend
            season[t % SEASON] = g * (y[t] - level) + (1 - g) * s
        return level, trend, season, resid

    def search(axes):
        a, b, g = (m.ravel() for m in np.meshgrid(*axes, indexing="ij"))
        state = run(a, b, g)
        best = int(np.argmin((state[3] ** 2).sum(axis=0)))
        return (a[best], b[best], g[best]), [m[..., best] for m in state]

    coarse = [np.array([0.02, 0.1, 0.2, 0.4, 0.7]), np.array([0.0, 0.01, 0.05, 0.2]), np.array([0.0, 0.05, 0.15, 0.4])]
    centre, _ = search(coarse)
    fine = [np.clip(c * np.array([0.6, 0.85, 1.0, 1.2, 1.6]), 0.0, 0.99) for c in centre]
    _, (level, trend, season, resid) = search(fine)
    steps = np.arange(1, horizon + 1)
    return level + trend * steps + season[(n + steps - 1) % SEASON], float(resid.std())


def _design(t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Trend with slope changes at the knots, weekly and yearly Fourier terms."""
    cols = [np.ones_like(t), t / 365.25]
    cols += [np.maximum(t - k, 0.0) / 365.25 for k in knots]
    for period, order in ((7.0, 3), (365.25, 10)):
        for k in range(1, order + 1):
            cols += [np.sin(2 * np.pi * k * t / period), np.cos(2 * np.pi * k * t / period)]
    return np.column_stack(cols)


def fit_trend_seasonal(y: np.ndarray, horizon: int, knots: int = 25, yearly_penalty: float = 5.0) -> tuple[np.ndarray, float] | None:
    """Ridge least squares on a bending trend plus weekly and yearly seasons; the same model at every length."""
    n = len(y)
    if n < 2 * SEASON:
        return None
    scale = float(np.abs(y).max()) or 1.0
    t = np.arange(n + horizon, dtype=float)
    bends = np.linspace(0, 0.8 * (n - 1), knots + 1)[1:]
    x = _design(t, bends)
    # Slope changes are held back most, seasons little, level and slope not at all.
    penalty = np.r_[0.0, 1e-6, np.full(knots, 20.0), np.full(6, 0.01), np.full(20, yearly_penalty)]
    coef = np.linalg.solve(x[:n].T @ x[:n] + np.diag(penalty), x[:n].T @ (y / scale))
    fitted = x @ coef * scale
    return fitted[n:], float((y - fitted[:n]).std())


FITS = {"ets": fit_ets, "trend_seasonal": fit_trend_seasonal}
NATIVE = {"naive": naive_weekly_forecast, "weekday_mean": weekday_mean_forecast, "smoothing": smoothing_forecast}


def forecast(series: DataFrame, models: list[str], horizon: int, keys: list[str] = METRIC) -> DataFrame:
    """Forecast of each (gap-filled) series with each model.

    A series frame with a column ``model_type`` names its model itself, one of ``models``. Columns: keys,
    model_type, ds, step, predicted, lower_bound, upper_bound; values clipped at 0 and rounded to 2 digits.
    A model that cannot be fitted to a series gives no rows for it.
    """
    named = "model_type" in series.columns
    columns = [*keys, "model_type", "ds", "step", "predicted", "lower_bound", "upper_bound"]
    frames = []
    for m in [m for m in models if m in NATIVE]:
        own = series.where(F.col("model_type") == m) if named else series
        rows = NATIVE[m](own.select(*keys, "ds", "value"), horizon, keys)
        frames.append(rows.withColumn("model_type", F.lit(m)).select(*columns))
    if fits := [m for m in models if m in FITS]:
        chosen = F.array(*[F.lit(m) for m in fits])
        frames.append(_fitted(series.where(F.col("model_type").isin(fits)) if named else series.withColumn("model_type", F.explode(chosen)), horizon, keys))
    return reduce(lambda a, b: a.unionByName(b), frames)


def _fitted(series: DataFrame, horizon: int, keys: list[str]) -> DataFrame:
    """The fits named in ``model_type``, one task per series and model."""
    key_fields = [series.schema[k] for k in keys]
    schema = T.StructType(
        key_fields
        + [T.StructField("model_type", T.StringType()), T.StructField("ds", T.DateType()), T.StructField("step", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in ("predicted", "lower_bound", "upper_bound")]
    )

    def one_fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        fitted = FITS[key[-1]](pdf["value"].to_numpy(float), horizon)
        if fitted is None:
            return pd.DataFrame(columns=schema.names)
        mean, sd = fitted
        clip = lambda v: np.round(np.maximum(v, 0.0), 2)
        out = pd.DataFrame({k: key[i] for i, k in enumerate(keys + ["model_type"])}, index=range(horizon))
        out["ds"] = pd.date_range(pd.Timestamp(pdf["ds"].iloc[-1]) + pd.Timedelta(days=1), periods=horizon).date
        out["step"] = np.arange(1, horizon + 1, dtype="int32")
        out["predicted"], out["lower_bound"], out["upper_bound"] = clip(mean), clip(mean - Z_LEVEL * sd), clip(mean + Z_LEVEL * sd)
        return out

    return series.select(*keys, "model_type", "ds", "value").groupBy(*keys, "model_type").applyInPandas(one_fit, schema)


def forecast_ets(series: DataFrame, horizon: int = 14, keys: list[str] = METRIC) -> DataFrame:
    return forecast(fill_daily_gaps(series, keys), ["ets"], horizon, keys)


def forecast_trend_seasonal(series: DataFrame, horizon: int = 14, keys: list[str] = METRIC) -> DataFrame:
    return forecast(fill_daily_gaps(series, keys), ["trend_seasonal"], horizon, keys)


def backtest_days(series: DataFrame, models: list[str], test_days: int = 14, keys: list[str] = METRIC, origins: int = 3, min_train: int = 30) -> DataFrame:
    """Prediction next to the actual for every hold-out day, model and series, from rolling origins.

    Origin 0 forecasts the last ``test_days`` days from all days before, origin 1 the ``test_days`` before
    those, and so on; an origin with less than ``min_train`` days before it is left out. Columns: keys, origin,
    model_type, ds, predicted, lower_bound, upper_bound, actual, baseline.
    """
    filled = fill_daily_gaps(series, keys)
    w = Window.partitionBy(*keys)
    placed = filled.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_back", F.row_number().over(w.orderBy(F.col("ds").desc())))
    rolled = placed.withColumn("origin", F.explode(F.sequence(F.lit(0), F.lit(origins - 1))))
    rolled = rolled.where((F.col("_n") >= (F.col("origin") + 1) * test_days + min_train) & (F.col("_back") > F.col("origin") * test_days))
    test = F.col("_back") <= (F.col("origin") + 1) * test_days
    by = [*keys, "origin"]
    train = rolled.where(~test).select(*by, "ds", "value")
    actual = rolled.where(test).select(*by, "ds", F.col("value").alias("actual"))
    predicted = forecast(train, models, test_days, by).drop("step")
    base = naive_weekly_forecast(train, test_days, by).select(*by, "ds", F.col("predicted").alias("baseline"))
    return predicted.join(actual, by + ["ds"]).join(base, by + ["ds"])


def backtest(series: DataFrame, models: list[str], test_days: int = 14, keys: list[str] = METRIC, origins: int = 3) -> DataFrame:
    """Errors of each model on the hold-out days against the naive week."""
    return score_backtest(backtest_days(series, models, test_days, keys, origins), keys)


def score_backtest(days: DataFrame, keys: list[str] = METRIC) -> DataFrame:
    by = keys + ["model_type"]
    model = forecast_errors(days, by)
    base = forecast_errors(days.withColumn("predicted", F.col("baseline")), by).select(
        *by, F.col("mape").alias("baseline_mape"), F.col("rmse").alias("baseline_rmse")
    )
    span = days.groupBy(*by).agg(F.min("ds").alias("test_start"), F.max("ds").alias("test_end"))
    two = lambda c: F.round(c, 2).alias(c)
    return (
        model.join(base, by)
        .join(span, by)
        .select(
            *by,
            *[two(c) for c in ("mape", "smape", "rmse", "mae", "baseline_mape", "baseline_rmse")],
            F.round(F.coalesce(improvement_pct(F.col("baseline_mape"), F.col("mape")), F.lit(0.0)), 2).alias("improvement_pct"),
            "test_samples",
            "test_start",
            "test_end",
        )
    )


def backtest_rows(days: DataFrame, run_id: str) -> DataFrame:
    """Hold-out days in the shape of the back-test table."""
    a, p = F.col("actual"), F.col("predicted")
    money = lambda c, n: c.cast("decimal(20,2)").alias(n)
    return days.select(
        F.concat_ws("-", F.lit(run_id), "model_type", "metric_name").alias("run_id"),
        "metric_name",
        "model_type",
        "origin",
        F.col("ds").alias("prediction_date"),
        money(a, "actual_value"),
        money(p, "predicted_value"),
        money(F.col("lower_bound"), "lower_bound"),
        money(F.col("upper_bound"), "upper_bound"),
        money(F.abs(a - p), "absolute_error"),
        F.when(a != 0, F.abs(a - p) / F.abs(a) * 100).cast("decimal(12,4)").alias("percentage_error"),
        a.between(F.col("lower_bound"), F.col("upper_bound")).alias("within_confidence_interval"),
    )


def forecast_all(series: DataFrame, best: DataFrame, horizon: int = 365, keys: list[str] = METRIC, models: list[str] | None = None) -> DataFrame:
    """One long forecast per series with its chosen model; shorter horizons are a filter on ``step``.

    ``models`` are those that ``best`` may name.
    """
    filled = fill_daily_gaps(series, keys)
    return forecast(filled.join(best.select(*keys, "model_type"), keys), models or [*NATIVE, *FITS], horizon, keys)


def forecast_rows(predicted: DataFrame, run_id: str | None = None, version: str = "1") -> DataFrame:
    """Forecasts in the shape of the forecast table."""
    names = F.create_map(*[F.lit(x) for pair in MODEL_NAMES.items() for x in pair])
    money = lambda c: F.col(c).cast("decimal(20,2)").alias(c)
    return predicted.select(
        F.col("ds").alias("forecast_date"),
        "metric_name",
        F.col("predicted").cast("decimal(20,2)").alias("predicted_value"),
        money("lower_bound"),
        money("upper_bound"),
        F.lit(LEVEL).cast("decimal(5,2)").alias("confidence_level"),
        F.when(F.lit(run_id).isNotNull(), F.concat_ws("-", F.lit(run_id), "model_type", "metric_name")).alias("model_run_id"),
        names[F.col("model_type")].alias("model_name"),
        F.lit(version).alias("model_version"),
    )


def record_model_runs(scores: DataFrame, spans: DataFrame, best: DataFrame, run_id: str, at, version: str = "1", keys: list[str] = METRIC) -> DataFrame:
    """Back-test scores as rows of the model run table: the model trained per series is ``completed``, the others ``rejected``.

    ``spans`` holds train_start_date, train_end_date and train_samples per series, ``best`` the chosen model_type.
    """
    four = lambda c, t: F.round(c, 4).cast(t).alias(c)
    chosen = best.select(*keys, "model_type", F.lit("completed").alias("status"))
    joined = scores.join(spans, keys).join(chosen, [*keys, "model_type"], "left")
    return joined.select(
        F.concat_ws("-", F.lit(run_id), "model_type", "metric_name").alias("run_id"),
        F.lit(str(at)).cast("timestamp_ntz").alias("run_timestamp"),
        F.concat(F.lit("forecast_"), "model_type").alias("model_type"),
        F.col("metric_name").alias("target_metric"),
        "train_start_date",
        "train_end_date",
        F.col("train_samples").cast("int").alias("train_samples"),
        F.to_json(F.struct(F.lit(SEASON).alias("seasonal_periods"), F.lit(LEVEL).alias("level"))).alias("parameters"),
        four("mape", "decimal(12,4)"),
        four("smape", "decimal(12,4)"),
        four("rmse", "decimal(20,4)"),
        four("mae", "decimal(20,4)"),
        four("baseline_mape", "decimal(12,4)"),
        four("baseline_rmse", "decimal(20,4)"),
        F.round(improvement_pct(F.col("baseline_mape"), F.col("mape")), 4).cast("decimal(12,4)").alias("improvement_vs_baseline_pct"),
        F.lit(version).alias("model_version"),
        F.lit(version).alias("code_version"),
        F.coalesce("status", F.lit("rejected")).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit("basketlake").alias("created_by"),
        F.lit(None).cast("string").alias("notes"),
    )


def detection_runs(found: DataFrame, spans: DataFrame, run_id: str, at, parameters: dict, version: str = "1") -> DataFrame:
    """A row of the model run table for each series in which a detection found days; it has no forecast errors."""
    days = found.groupBy("metric_name").agg(F.count(F.lit(1)).alias("_days"))
    none = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in names]
    text = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in parameters.items()]))
    return spans.join(days, "metric_name").select(
        F.concat_ws("-", F.lit(run_id), F.lit("anomaly"), "metric_name").alias("run_id"),
        F.lit(str(at)).cast("timestamp_ntz").alias("run_timestamp"),
        F.lit("anomaly_robust").alias("model_type"),
        F.col("metric_name").alias("target_metric"),
        "train_start_date", "train_end_date", F.col("train_samples").cast("int").alias("train_samples"), text.alias("parameters"),
        *none(*[(c, "decimal(12,4)") for c in ("mape", "smape")], *[(c, "decimal(20,4)") for c in ("rmse", "mae")],
              ("baseline_mape", "decimal(12,4)"), ("baseline_rmse", "decimal(20,4)"), ("improvement_vs_baseline_pct", "decimal(12,4)")),
        F.lit(version).alias("model_version"), F.lit(version).alias("code_version"), F.lit("completed").alias("status"),
        F.lit(None).cast("string").alias("error_message"), F.lit("basketlake").alias("created_by"),
        F.concat(F.col("_days").cast("string"), F.lit(" days found")).alias("notes"),
    )


def train_spans(series: DataFrame, keys: list[str] = METRIC) -> DataFrame:
    return series.where(F.col("value").isNotNull()).groupBy(*keys).agg(
        F.min("ds").alias("train_start_date"),
        F.max("ds").alias("train_end_date"),
        (F.datediff(F.max("ds"), F.min("ds")) + 1).alias("train_samples"),
    )


