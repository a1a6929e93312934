"""Forecast error measures as aggregate columns over (actual, predicted) rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over non-zero actuals; 0 when there are none."""
    err = F.when(actual != 0, F.abs((actual - predicted) / actual))
    return F.coalesce(F.avg(err) * 100, F.lit(0.0))


def smape(actual: Column, predicted: Column) -> Column:
    scale = (F.abs(actual) + F.abs(predicted)) / 2
    return F.coalesce(F.avg(F.when(scale != 0, F.abs(actual - predicted) / scale)) * 100, F.lit(0.0))


def rmse(actual: Column, predicted: Column) -> Column:
    diff = actual - predicted
    return F.sqrt(F.avg(diff * diff))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def improvement_pct(baseline: Column, model: Column) -> Column:
    """How much lower the model's error is than the baseline's; NULL without a baseline error."""
    return F.when(baseline > 0, (baseline - model) / baseline * 100)
