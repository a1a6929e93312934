"""Anomalies in daily series: a rolling z-score and a median rule per day type, and optionally an isolation forest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlake.operators.series import METRIC, lookback_filter

MIN_DAYS = 14
ROLLING_ROWS = 4
Z_THRESHOLD = 2.5
#: Robust z-score beyond which a day stands out, and what makes a median deviation comparable to a standard deviation.
ROBUST_THRESHOLD, MAD_SCALE = 3.5, 1.4826
#: Metrics a detection over recent days takes, and how far it looks back.
DETECTED_METRICS = ["total_revenue", "total_orders", "unique_customers", "avg_order_value"]
LOOKBACK_DAYS = 30


def _day_types(series: DataFrame, keys: list[str]) -> DataFrame:
    """Days with a value, one shuffle on the keys for all windows that follow."""
    return (
        series.where(F.col("value").isNotNull())
        .repartition(*keys)
        .withColumn("day_of_week", F.weekday("ds"))
        .withColumn("is_weekend", F.weekday("ds") >= 5)
    )


def daytype_baseline(series: DataFrame, keys: list[str] = METRIC) -> DataFrame:
    """Mean of all weekend days or of all weekdays, next to each day."""
    w = Window.partitionBy(*keys, "is_weekend")
    return _day_types(series, keys).withColumn("baseline", F.avg("value").over(w))


def daytype_rolling_stats(series: DataFrame, keys: list[str] = METRIC) -> DataFrame:
    """Mean and sample deviation of the last four days of the same type, this day included."""
    w = Window.partitionBy(*keys, "is_weekend").orderBy("ds").rowsBetween(1 - ROLLING_ROWS, 0)
    enough = F.count(F.lit(1)).over(w) >= 2
    return (
        _day_types(series, keys)
        .withColumn("rolling_mean", F.when(enough, F.avg("value").over(w)))
        .withColumn("rolling_std", F.when(enough, F.stddev_samp("value").over(w)))
    )


def anomaly_zscore(series: DataFrame, keys: list[str] = METRIC) -> DataFrame:
    """Expected value, z-score and deviation of each day; series under 14 days drop out."""
    whole = Window.partitionBy(*keys)
    daytype = Window.partitionBy(*keys, "is_weekend")
    v = F.col("value")
    nonzero = lambda c: F.when(c == 0, 1.0).otherwise(c)
    return (
        daytype_rolling_stats(series, keys)
        .withColumn("_days", F.count(F.lit(1)).over(whole))
        .withColumn("_std", F.stddev_samp("value").over(whole))
        .withColumn("_baseline", F.avg("value").over(daytype))
        .where(F.col("_days") >= MIN_DAYS)
        .withColumn("expected", F.coalesce("rolling_mean", "_baseline"))
        .withColumn("std", F.coalesce("rolling_std", "_std"))
        .withColumn("z_score", (v - F.col("expected")) / nonzero(F.col("std")))
        .withColumn("deviation_pct", F.round((v - F.col("expected")) / nonzero(F.col("expected")) * 100, 2))
        .select(*keys, "ds", "value", "day_of_week", "is_weekend", "expected", "std", "z_score", "deviation_pct")
    )


def anomaly_median(scored: DataFrame, keys: list[str] = METRIC) -> DataFrame:
    """Adds ``median``, ``spread`` and ``robust_z``: how far a day is from the median of its day type, in median deviations.

    One day that stands out moves neither, while it moves the mean and the deviation of its own window. Two small
    aggregates, of a row per series and day type, are joined back. A day type whose days are mostly equal has spread 0;
    then the rest differ at all, and ``robust_z`` is taken against one hundredth of the median, or against 1.
    """
    by = [*keys, "is_weekend"]
    centre = scored.groupBy(*by).agg(F.median("value").alias("median"))
    apart = scored.join(centre, by).withColumn("_off", F.abs(F.col("value") - F.col("median")))
    spread = apart.groupBy(*by).agg((F.median("_off") * MAD_SCALE).alias("spread"))
    off = F.col("value") - F.col("median")
    hundredth = F.abs("median") / 100
    unit = F.when(F.col("spread") > 0, F.col("spread")).when(hundredth > 0, hundredth).otherwise(F.lit(1.0))
    return apart.drop("_off").join(spread, by).withColumn("robust_z", off / unit)


# --- isolation forest ---------------------------------------------------------

TREES = 100
SAMPLE = 256
SEED = 42


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _tree_depths(sample: np.ndarray, points: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """Depth of every point in one random tree grown on ``sample``.

    On one feature a node is an interval of sorted values: each split keeps two
    index ranges of the sample and of the points, so no tree object is built.
    """
    s, order = np.sort(sample), np.argsort(points, kind="stable")
    p = points[order]
    depth = np.empty(len(p))
    todo = [(0, len(s), 0, len(p), 0)]
    while todo:
        s0, s1, p0, p1, level = todo.pop()
        if p0 == p1:
            continue
        if level >= limit or s1 - s0 <= 1 or s[s0] == s[s1 - 1]:
            depth[p0:p1] = level + _mean_path(np.array([s1 - s0]))[0]
            continue
        cut = rng.uniform(s[s0], s[s1 - 1])
        sm = s0 + int(np.searchsorted(s[s0:s1], cut, side="right"))
        pm = p0 + int(np.searchsorted(p[p0:p1], cut, side="right"))
        todo.append((s0, sm, p0, pm, level + 1))
        todo.append((sm, s1, pm, p1, level + 1))
    out = np.empty(len(p))
    out[order] = depth
    return out


def forest_scores(values: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Isolation score in (0, 1]; higher is more isolated."""
    rng = np.random.default_rng(seed)
    size = min(SAMPLE, len(values))
    limit = int(np.ceil(np.log2(max(size, 2))))
    total = np.zeros(len(values))
    for _ in range(TREES):
        total += _tree_depths(rng.choice(values, size, replace=False), values, limit, rng)
    return 2.0 ** (-(total / TREES) / max(_mean_path(np.array([size]))[0], 1e-12))


def anomaly_isolation_forest(scored: DataFrame, keys: list[str] = METRIC, contamination: float = 0.1) -> DataFrame:
    """Adds ``if_score`` and ``if_anomaly`` computed on the residuals of each series.

    One group is one daily series. Series run in parallel; rows are put in date
    order first, so the seeded result does not depend on the partitioning.
    """
    schema = T.StructType(scored.schema.fields + [T.StructField("if_score", T.DoubleType()), T.StructField("if_anomaly", T.BooleanType())])

    def one_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        score = forest_scores((pdf["value"] - pdf["expected"]).to_numpy(float))
        cut = np.percentile(-score, 100 * contamination)
        return pdf.assign(if_score=score, if_anomaly=-score < cut)

    return scored.groupBy(*keys).applyInPandas(one_series, schema)


# --- labels -------------------------------------------------------------------


def severity():
    z, dev = F.abs("z_score"), F.abs("deviation_pct")
    # Severity limits on |z| and |deviation %|.
    return (
        F.when((z > 4) | (dev > 50), "critical")
        .when((z > 3) | (dev > 30), "high")
        .when((z > 2) | (dev > 15), "medium")
        .otherwise("low")
    )


def interpretation(metric: str):
    # Day names and message texts.
    names = F.array(*[F.lit(d) for d in ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")])
    day = F.element_at(names, F.col("day_of_week") + 1)
    spike = F.col("anomaly_type") == "spike"
    weekend = F.col("is_weekend")
    words = F.replace(F.col(metric), F.lit("_"), F.lit(" "))
    return (
        F.when(spike & weekend, F.format_string("Unusual weekend spike on %s. Possible promotion effect or special event.", day))
        .when(spike, F.format_string("Unexpected high %s on %s. Review for campaign impact.", words, day))
        .when(weekend, F.format_string("Weekend drop on %s below normal patterns. Check for site issues.", day))
        .otherwise(F.format_string("Weekday underperformance on %s. Investigate operational issues.", day))
    )


def recommended_action():
    # Message texts.
    serious = F.col("severity").isin("critical", "high")
    return (
        F.when(
            serious & (F.col("anomaly_type") == "drop"),
            "URGENT: Check website uptime, payment systems, and inventory availability.",
        )
        .when(serious, "Review: Identify cause of spike for replication or concern.")
        .otherwise("Monitor: Track if pattern continues over next few days.")
    )


def label_anomalies(
    scored: DataFrame, z_threshold: float = Z_THRESHOLD, metric: str = "metric_name", robust_threshold: float = ROBUST_THRESHOLD
) -> DataFrame:
    """Keeps the anomalous days and explains them; ``robust_z`` and ``if_anomaly`` count when present.

    A day that only the median rule finds is measured against the median: expected value, deviation and score are its.
    """
    flag = F.abs("z_score") > z_threshold
    if "robust_z" in scored.columns:
        robust = ~flag & (F.abs("robust_z") > robust_threshold)
        v = F.col("value")
        base = F.when(F.col("median") == 0, 1.0).otherwise(F.col("median"))
        scored = (
            scored.withColumn("_robust", robust)
            .withColumn("expected", F.when(F.col("_robust"), F.col("median")).otherwise(F.col("expected")))
            .withColumn("deviation_pct", F.when(F.col("_robust"), F.round((v - F.col("median")) / base * 100, 2)).otherwise(F.col("deviation_pct")))
            .withColumn("z_score", F.when(F.col("_robust"), F.col("robust_z")).otherwise(F.col("z_score")))
        )
        # Either score above its own limit; the median rule's is kept apart, as ``z_score`` holds the one that counts.
        flag = F.col("_robust") | flag
    if "if_anomaly" in scored.columns:
        flag = flag | F.col("if_anomaly")
    kind = F.when(F.col("value") > F.col("expected"), "spike").when(F.col("value") < F.col("expected"), "drop")
    return (
        scored.where(flag)
        .drop("_robust")
        .withColumn("anomaly_type", kind)
        .withColumn("severity", severity())
        .withColumn("business_interpretation", interpretation(metric))
        .withColumn("recommended_action", recommended_action())
    )


def detect_anomalies(
    series: DataFrame,
    keys: list[str] = METRIC,
    contamination: float = 0.1,
    z_threshold: float = Z_THRESHOLD,
    forest: bool = False,
    robust: bool = True,
    robust_threshold: float = ROBUST_THRESHOLD,
    lookback_days: int | None = None,
) -> DataFrame:
    """Z-score or median rule, or the isolation forest, with type, severity, text and advice per anomalous day.

    ``lookback_days`` keeps the days up to so many before the newest of all, and the rules then know only these.
    """
    if lookback_days is not None:
        series = lookback_filter(series, lookback_days, keys)
    scored = anomaly_zscore(series, keys)
    if robust:
        scored = anomaly_median(scored, keys)
    if forest:
        scored = anomaly_isolation_forest(scored, keys, contamination)
    return label_anomalies(scored, z_threshold, keys[0], robust_threshold)


def anomaly_rows(found: DataFrame, run_id=None) -> DataFrame:
    """Detected days in the shape of the anomaly table. Scores and deviations are doubles: a day of any size keeps its figure."""
    none = lambda t: F.lit(None).cast(t)
    # Means of cents end in halves of a cent: six digits first, so that the last bit of a
    # double does not decide how they round.
    money = lambda c: F.round(F.col(c).cast("decimal(22,6)"), 2).cast("decimal(20,2)")
    return found.select(
        F.col("ds").alias("anomaly_date"),
        "metric_name",
        money("value").alias("actual_value"),
        money("expected").alias("expected_value"),
        none("decimal(20,2)").alias("lower_bound"),
        none("decimal(20,2)").alias("upper_bound"),
        "deviation_pct",
        F.round("z_score", 4).alias("z_score"),
        "anomaly_type",
        "severity",
        "is_weekend",
        "day_of_week",
        F.lit(False).alias("is_holiday"),
        F.lit(True).alias("seasonality_adjusted"),
        none("string").alias("probable_cause"),
        "business_interpretation",
        "recommended_action",
        F.lit(False).alias("is_alert_sent"),
        none("timestamp_ntz").alias("alert_sent_at"),
        F.lit(False).alias("acknowledged"),
        none("string").alias("acknowledged_by"),
        none("timestamp_ntz").alias("acknowledged_at"),
        F.lit(run_id).cast("string").alias("model_run_id"),
    )


def keep_acknowledgement(found: DataFrame, stored: DataFrame) -> DataFrame:
    """``found`` with the acknowledgement that the stored row of the same day and metric has."""
    keys, marks = ["anomaly_date", "metric_name"], ["acknowledged", "acknowledged_by", "acknowledged_at"]
    done = stored.where("acknowledged").select(*keys, *[F.col(c).alias(f"_{c}") for c in marks])
    return found.join(done, keys, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in marks else F.col(c) for c in found.columns])


def acknowledge_anomaly(anomalies: DataFrame, day, metric: str, by: str = "analyst", at=None) -> DataFrame:
    """Marks one (day, metric) as acknowledged; every other row passes through, as do all where ``day`` is None."""
    hit = (F.col("anomaly_date") == F.lit(None if day is None else str(day)).cast("date")) & (F.col("metric_name") == metric)
    now = F.localtimestamp() if at is None else F.lit(str(at)).cast("timestamp_ntz")
    keep = lambda new, old: F.when(hit, new).otherwise(F.col(old))
    return (
        anomalies.withColumn("acknowledged_at", keep(now, "acknowledged_at"))
        .withColumn("acknowledged_by", keep(F.lit(by), "acknowledged_by"))
        .withColumn("acknowledged", keep(F.lit(True), "acknowledged"))
    )
