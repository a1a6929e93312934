"""Headline timings: prints one JSON line.

The full refresh (raw tables to checked marts) and the queries over its marts, at
$BENCH_SF_DIR on local[$BENCH_CPUS]. One refresh of the smallest tables at hand
warms the JVM up; its time is reported apart and not counted.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from basketlake.operators import forecast
from basketlake.operators.series import fill_daily_gaps
from basketlake.plans import dashboards as d
from basketlake.plans.warehouse import Warehouse
from basketlake.shared import shared_dir
from basketlake.sources import tpch

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

DASHBOARDS = [
    d.executive_summary, d.kpi_scorecard_28d, d.monthly_summary, d.revenue_by_country_top10, d.rfm_segment_details, d.top_customers,
    d.high_value_at_risk, d.product_tiers, d.product_delta_30d, d.country_delta_30d, d.daily_product_trend, d.moving_avg_7d, d.wow_growth,
    d.forecast_vs_actual_combined, d.yearly_outlook, d.active_alerts_14d, d.model_comparison,
]


def new_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}", lambda: tpch.raw_transactions(spark, folder))


def consume(df: DataFrame) -> None:
    """Computes every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, run):
        t0 = time.perf_counter()
        out = run()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    small = Path(FOLDER).parent / "sf0.001"
    warm = new_warehouse(spark, str(small if small.exists() else FOLDER))
    t0 = time.perf_counter()
    warm.run_etl("warm-up", fail_on_critical=False)
    for q in DASHBOARDS:
        consume(q(warm))
    warm_up = time.perf_counter() - t0

    w = new_warehouse(spark, FOLDER)
    timed("ingest_raw", lambda: w.refresh("raw_transactions"))
    report = timed("full_etl", lambda: w.run_etl(FOLDER, fail_on_critical=False, ingest=False))
    timed("backtest_and_train", lambda: w.refresh("ml_forecast_daily"))
    timed("forecast_14d", lambda: consume(forecast.forecast(fill_daily_gaps(w.metric_series()), list(forecast.NATIVE), 14)))
    timed("detect_anomalies", lambda: w.refresh("ml_anomalies_daily"))
    w.table("ml_model_runs"), w.table("table_refresh_log")
    for q in DASHBOARDS:
        timed(q.__name__, lambda q=q: consume(q(w)))
    rows = dict((name, n) for name, n, _, _ in report)["stg_transactions_clean"]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "etl_rows": rows,
                "etl_rows_per_sec": round(rows / times["full_etl"]),
                "warm_up_sec": round(warm_up, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
