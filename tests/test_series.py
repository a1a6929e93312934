import datetime as dt
import math
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlake.operators import anomalies, forecast, series
from checks import catalog
from tests.conftest import rows

START = dt.date(2024, 1, 1)
SCHEMA = "metric_name string, ds date, value double"


def days(values, name="m", skip=()):
    return [(name, START + dt.timedelta(days=i), float(v)) for i, v in enumerate(values) if i not in skip]


def weekly(n, noise=0.0, seed=1):
    rnd = random.Random(seed)
    return [200 + 0.5 * i + [0, 5, 10, 5, 20, 60, 50][i % 7] + rnd.gauss(0, noise) for i in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    return lambda data: spark.createDataFrame(data, SCHEMA)


def test_gaps_are_filled_per_series(frame):
    gaps = {3, 4, 5, 10, 11, 20, 33, 40, 41}
    data = days(weekly(60), "a", gaps) + days([1, 2, 3], "b") + [("b", START + dt.timedelta(days=5), None)]
    got = {(r.metric_name, r.ds): r.value for r in series.fill_daily_gaps(frame(data)).collect()}
    full = weekly(60)
    assert got == {
        **{("a", START + dt.timedelta(days=i)): 0.0 if i in gaps else float(full[i]) for i in range(60)},
        **{("b", START + dt.timedelta(days=i)): float(i + 1) for i in range(3)},
    }
    holes = series.fill_daily_gaps(frame(data), fill=None).where("value is null").count()
    assert holes == len(gaps)


def test_naive_week_and_short_series(frame):
    data = days(range(10), "long") + days([2, 4], "short")
    got = {(r.metric_name, r.step): r.predicted for r in series.naive_weekly_forecast(frame(data), 9).collect()}
    assert [got[("long", s)] for s in range(1, 10)] == [3, 4, 5, 6, 7, 8, 9, 3, 4]
    assert {got[("short", s)] for s in range(1, 10)} == {3.0}


def test_split_needs_enough_days(frame):
    split = series.train_test_split_tail(frame(days(weekly(43), "short") + days(weekly(44), "long")))
    assert dict(rows(split.groupBy("metric_name").agg(F.count_if("is_test")))) == {"long": 14}
    assert forecast.backtest(frame(days(weekly(43))), ["ets"]).count() == 0


def test_error_measures(frame, spark):
    a, p = [0.0, 10.0, 20.0, -5.0], [1.0, 12.0, 15.0, -5.0]
    df = spark.createDataFrame([("m", x, y) for x, y in zip(a, p)] + [("zero", 0.0, 0.0)], "metric_name string, actual double, predicted double")
    got = {r.metric_name: r for r in series.forecast_errors(df, ["metric_name"]).collect()}
    m = got["m"]
    assert m.mape == pytest.approx((0.2 + 0.25 + 0) / 3 * 100)
    assert m.smape == pytest.approx((1 / 0.5 + 2 / 11 + 5 / 17.5 + 0) / 4 * 100)
    assert m.rmse == pytest.approx(math.sqrt((1 + 4 + 25) / 4)) and m.mae == pytest.approx(2.0)
    assert got["zero"].mape == 0 and got["zero"].smape == 0


def test_models_recover_trend_and_week(frame):
    data = days(weekly(150), "clean") + days(weekly(150, 6), "noisy")
    truth = weekly(164)[150:]
    for model in ("ets", "trend_seasonal"):
        out = forecast.forecast(frame(data), [model], 14).orderBy("metric_name", "step").collect()
        assert len(out) == 28
        clean = [r.predicted for r in out if r.metric_name == "clean"]
        assert np.allclose(clean, truth, rtol=0.05), model
        assert all(0 <= r.lower_bound <= r.predicted <= r.upper_bound for r in out)
        assert out[0].ds == START + dt.timedelta(days=150)


def test_backtest_beats_naive_and_picks_a_model(frame):
    data = frame(days(weekly(200, 8), "a") + days(weekly(120, 8, 2), "b"))
    scores = forecast.backtest(data, ["ets", "trend_seasonal"])
    got = scores.collect()
    assert len(got) == 4 and all(r.test_samples == 42 for r in got)
    best = {r.metric_name: (r.model_type, r.mape) for r in series.select_best_model(scores).collect()}
    for name in ("a", "b"):
        mine = [r for r in got if r.metric_name == name]
        assert best[name][1] == min(r.mape for r in mine)
        assert best[name][1] < mine[0].baseline_mape
    year = forecast.forecast_all(data, series.select_best_model(scores), 365, models=["ets", "trend_seasonal"])
    assert year.count() == 730 and year.where("step <= 14").count() == 28


def test_best_model_ties_and_missing_scores(spark):
    s = spark.createDataFrame([("m", "b", 1.0), ("m", "a", 1.0), ("m", "c", None)], "metric_name string, model_type string, mape double")
    assert rows(series.select_best_model(s)) == [("m", "a", 1.0)]


def test_models_and_metrics_are_checked(frame, spark):
    s = spark.createDataFrame([("m", "ets", 2.0), ("m", "naive", 1.0)], "metric_name string, model_type string, mape double")
    assert rows(series.pick_model(s)) == [("m", "naive", 1.0)] and rows(series.pick_model(s, " ETS ")) == [("m", "ets", 2.0)]
    with pytest.raises(ValueError, match="unknown model"):
        series.pick_model(s, "oracle")
    with pytest.raises(ValueError, match="unknown metric"):
        series.unpivot_metrics(spark.range(1), ["profit"])


def test_ets_refuses_short_series(frame):
    assert forecast.forecast_ets(frame(days(range(13)))).count() == 0


def test_zscores_against_numpy(frame):
    values = weekly(60, 9)
    got = {r.ds: r for r in anomalies.anomaly_zscore(frame(days(values))).collect()}
    for weekend in (False, True):
        idx = [i for i in range(60) if ((START + dt.timedelta(days=i)).weekday() >= 5) == weekend]
        for n, i in enumerate(idx):
            part = [values[j] for j in idx[max(0, n - 3) : n + 1]]
            mean = np.mean(part) if len(part) > 1 else np.mean([values[j] for j in idx])
            std = np.std(part, ddof=1) if len(part) > 1 else np.std(values, ddof=1)
            r = got[START + dt.timedelta(days=i)]
            assert r.expected == pytest.approx(mean) and r.z_score == pytest.approx((values[i] - mean) / std)


def test_planted_anomalies_are_found(frame):
    values = weekly(80, 3)
    values[40] *= 3
    values[60] *= 0.2
    found = {r.ds: r for r in anomalies.detect_anomalies(frame(days(values, "total_revenue")), forest=True, robust=False).collect()}
    spike, drop = found[START + dt.timedelta(days=40)], found[START + dt.timedelta(days=60)]
    assert spike.anomaly_type == "spike" and drop.anomaly_type == "drop" and spike.severity == "critical"
    assert "total revenue" in spike.business_interpretation or "weekend" in spike.business_interpretation
    assert drop.recommended_action.startswith("URGENT")
    assert len(found) <= 12


def test_thirteen_days_give_nothing(frame):
    assert anomalies.detect_anomalies(frame(days(range(13)))).count() == 0


def test_forest_does_not_depend_on_partitioning(frame):
    df = anomalies.anomaly_zscore(frame(days(weekly(60, 5))))
    one = anomalies.anomaly_isolation_forest(df.coalesce(1)).orderBy("ds").select("if_score", "if_anomaly").collect()
    many = anomalies.anomaly_isolation_forest(df.repartition(4)).orderBy("ds").select("if_score", "if_anomaly").collect()
    assert one == many and 3 <= sum(r.if_anomaly for r in one) <= 6


def test_acknowledge_touches_one_row(frame):
    values = weekly(80, 3)
    values[40] *= 3
    found = anomalies.anomaly_rows(anomalies.detect_anomalies(frame(days(values, "total_revenue"))))
    day = START + dt.timedelta(days=40)
    done = anomalies.acknowledge_anomaly(found, day, "total_revenue", "ana", "2024-05-01 10:00:00")
    assert [(r.anomaly_date, r.acknowledged_by) for r in done.where("acknowledged").collect()] == [(day, "ana")]


def test_acknowledge_query_without_a_revenue_anomaly(frame):
    """No day of the metric stands out: nothing is marked, and the other metric's rows pass through."""
    values = weekly(80, 3)
    values[40] *= 3
    found = anomalies.anomaly_rows(anomalies.detect_anomalies(frame(days(values, "total_orders") + days(weekly(80), "total_revenue"))))
    stored = SimpleNamespace(table={"ml_anomalies_daily": found.where("metric_name = 'total_orders'")}.get)
    assert rows(catalog.acknowledge_anomaly(stored)) == [(START + dt.timedelta(days=40), "total_orders", False, None)]


def test_lookback_is_inclusive(frame):
    assert series.lookback_filter(frame(days(range(60))), 30).count() == 31


def brute_levels(values, model):
    """Level and deviation per weekday of a series that starts on a Monday."""
    out = {}
    for wd in range(7):
        own = [v for i, v in enumerate(values) if i % 7 == wd]
        if model == "weekday_mean":
            own = own[-8:]
            out[wd] = np.mean(own), np.std(own)
        else:
            level, squares = own[0], 0.0
            for v in own[1:]:
                squares += (v - level) ** 2
                level = 0.3 * v + 0.7 * level
            out[wd] = level, math.sqrt(squares / max(len(own) - 1, 1))
    return out


@pytest.mark.parametrize("model", ["weekday_mean", "smoothing"])
def test_native_models_against_a_loop(frame, model):
    a, b = weekly(100, 9), weekly(60, 30, 3)
    rows_ = forecast.NATIVE[model](frame(days(a, "a") + days(b, "b")), 20).collect()
    assert len(rows_) == 40
    for name, values in (("a", a), ("b", b)):
        levels = brute_levels(values, model)
        for r in [r for r in rows_ if r.metric_name == name]:
            assert r.ds == START + dt.timedelta(days=len(values) + r.step - 1)
            level, sd = levels[r.ds.weekday()]
            assert r.predicted == pytest.approx(max(level, 0), abs=0.006)
            assert r.lower_bound == pytest.approx(max(level - 1.96 * sd, 0), abs=0.006) and r.upper_bound == pytest.approx(level + 1.96 * sd, abs=0.006)


@pytest.mark.parametrize("model", ["weekday_mean", "smoothing"])
def test_native_models_on_short_series(frame, model):
    got = forecast.NATIVE[model](frame(days([10, 20, 30], "m")), 7).collect()
    at = {r.ds.weekday(): r.predicted for r in got}
    assert [at[i] for i in range(7)] == [10, 20, 30, 20, 20, 20, 20]
    assert forecast.NATIVE[model](frame(days([], "m")), 7).count() == 0


def test_native_models_use_no_python(frame):
    data = series.fill_daily_gaps(frame(days(weekly(100, 9), "a")))
    plan = forecast.forecast(data, list(forecast.NATIVE), 14)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_rolling_origins(frame):
    values = weekly(90, 8)
    got = forecast.backtest_days(frame(days(values, "a") + days(weekly(50), "b")), ["naive", "smoothing"]).collect()
    of = lambda name: sorted({(r.origin, r.ds) for r in got if r.metric_name == name})
    assert of("a") == [(o, START + dt.timedelta(days=90 - 14 * (o + 1) + i)) for o in range(3) for i in range(14)]
    assert [o for o, _ in of("b")] == [0] * 14
    for r in got:
        if r.metric_name == "a" and r.model_type == "naive":
            before = values[: 90 - 14 * (r.origin + 1)]
            step = (r.ds - START).days - len(before)
            assert r.predicted == pytest.approx(before[-7 + step % 7], abs=0.006) and r.predicted == r.baseline
    scores = {(r.metric_name, r.model_type): r for r in forecast.backtest(frame(days(values, "a")), ["naive", "smoothing"]).collect()}
    assert scores[("a", "naive")].improvement_pct == 0 and scores[("a", "smoothing")].test_samples == 42


def test_median_rule_against_numpy(frame):
    values = weekly(80, 3)
    values[40] *= 3
    values[60] *= 0.2
    scored = anomalies.anomaly_median(anomalies.anomaly_zscore(frame(days(values, "total_revenue")))).collect()
    for r in scored:
        own = [v for i, v in enumerate(values) if ((START + dt.timedelta(days=i)).weekday() >= 5) == r.is_weekend]
        centre = np.median(own)
        spread = np.median(np.abs(np.array(own) - centre)) * 1.4826
        assert r.median == pytest.approx(centre) and r.robust_z == pytest.approx((r.value - centre) / spread)
    found = {r.ds: r for r in anomalies.detect_anomalies(frame(days(values, "total_revenue"))).collect()}
    spike, drop = found[START + dt.timedelta(days=40)], found[START + dt.timedelta(days=60)]
    assert spike.anomaly_type == "spike" and drop.anomaly_type == "drop" and spike.severity == "critical"
    assert len(found) <= 4


def test_median_rule_on_constant_days_and_lookback(frame):
    values = [100.0] * 60
    values[50] = 200.0
    found = anomalies.detect_anomalies(frame(days(values, "m"))).collect()
    assert [(r.ds, r.expected) for r in found] == [(START + dt.timedelta(days=50), 100.0)]
    assert [r.ds for r in anomalies.detect_anomalies(frame(days(values, "m")), lookback_days=20).collect()] == [START + dt.timedelta(days=50)]
    assert anomalies.detect_anomalies(frame(days(values, "m")), lookback_days=5).count() == 0


def test_extreme_days_keep_their_figures(frame):
    values = [1e-6] * 40
    values[20] = 1e15
    row = anomalies.anomaly_rows(anomalies.detect_anomalies(frame(days(values, "m")))).collect()
    assert [r.anomaly_date for r in row] == [START + dt.timedelta(days=20)]
    assert row[0].deviation_pct > 1e20 and abs(row[0].z_score) > 1e9


def test_fits_do_not_change_with_length():
    # One observation more or less does not change the model.
    for n in (99, 100, 729, 730):
        y = np.array(weekly(n))
        mean, _ = forecast.fit_trend_seasonal(y, 14)
        assert np.allclose(mean, weekly(n + 14)[n:], rtol=0.1)
