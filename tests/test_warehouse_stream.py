import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from basketlake.operators import quality
from basketlake.plans import dashboards as d
from basketlake.plans.warehouse import Warehouse
from basketlake.schemas import CSV_COLUMNS, ETL_RUN_LOG, RAW
from basketlake.sources import parts
from basketlake.streaming import transactions as st
from tests.conftest import rows
from tests.test_star_marts import skewed_raw


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw, data = skewed_raw(spark, 3000)
    w = Warehouse(spark, str(tmp_path_factory.mktemp("wh")), lambda: raw)
    report = w.run_etl("fixture", run_id="r1", fail_on_critical=False)
    return w, data, report


def test_run_reports_and_logs(built, spark):
    w, data, report = built
    n = {name: rows for name, rows, _, _ in report}
    assert n["raw_transactions"] == n["stg_transactions_clean"] == n["fact_sales"] == len(data)
    run = w.log("etl_run_log").first()
    assert run.run_id == "r1" and run.rows_read == len(data) and run.rows_rejected == 0 and run.completed_at >= run.started_at
    meta = json.loads(run.metadata)
    assert int(meta["staging_rows"]) == len(data) and int(meta["dq_checks_passed"]) + int(meta["dq_checks_failed"]) == 8
    log = {r.table_name: r.row_count for r in w.table("table_refresh_log").collect()}
    assert log["mart_daily_kpis"] == w.table("mart_daily_kpis").count()
    assert w.log("dq_check_results").count() == 8


def test_totals_agree_across_marts(built):
    w, _, _ = built
    total = lambda t: w.table(t).agg({"total_revenue": "sum"}).first()[0]
    assert total("mart_daily_kpis") == total("mart_country_performance") == total("mart_product_performance") == total("mart_monthly_trends")


def test_second_run_reads_the_source_again(spark, tmp_path):
    raw, data = skewed_raw(spark, 3000)
    loads = [raw.where("invoice_date < timestamp '2011-06-10'"), raw]
    w = Warehouse(spark, str(tmp_path), lambda: loads[0], models=("naive", "smoothing"), z_threshold=1.45)
    w.run_etl("first", fail_on_critical=False, train=True)
    first = {n: w.table(n).count() for n in ("ml_forecast_daily", "ml_model_runs", "mart_daily_kpis")}
    early = w.as_of()
    found = w.table("ml_anomalies_daily").first()
    w.acknowledge(found.anomaly_date, found.metric_name, "me", "2024-01-01 00:00:00")
    loads.pop(0)
    w.run_etl("second", fail_on_critical=False)
    assert w.table("raw_transactions").count() == len(data) and w.as_of() > early
    assert w.table("ml_forecast_daily").count() > first["ml_forecast_daily"]
    runs = w.table("ml_model_runs")
    assert runs.count() == 2 * first["ml_model_runs"] and runs.where("model_type = 'anomaly_robust'").count() >= 2
    assert runs.groupBy("run_timestamp", "target_metric").agg(F.count_if(F.expr("status = 'completed' and model_type like 'forecast%'")).alias("n")).where("n <> 1").count() == 0
    # A second training on the same data is a training of its own.
    w.run_etl("third", fail_on_critical=False, ingest=False)
    assert w.table("ml_model_runs").where(F.col("run_id").contains(f"{w.as_of()}-2-")).count() == first["ml_model_runs"]
    assert w.table("backtest_days").agg({"ds": "max"}).first()[0] == w.as_of()
    assert w.table("ml_anomalies_daily").where("acknowledged").select("acknowledged_by").collect() == [("me",)]
    assert {"ml_forecast_daily", "ml_anomalies_daily"} <= {r.table_name for r in w.table("table_refresh_log").collect()}


def test_failed_run_is_logged_and_raised(spark, tmp_path):
    raw, _ = skewed_raw(spark, 50)
    w = Warehouse(spark, str(tmp_path), lambda: raw.where("false"))
    with pytest.raises(quality.DataQualityFailure):
        w.run_etl("empty", run_id="bad")
    run = w.log("etl_run_log").first()
    assert run.status == "failed" and "raw_row_count" in run.error_message


def test_dashboard_windows_prune_months(built):
    w, _, _ = built
    plan = d.product_delta_30d(w)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert "PushedFilters" in plan and "full_date" in plan


def test_freshness_limits(spark):
    from pyspark.sql import functions as F

    now = dt.datetime(2024, 1, 2, 12)
    ages = [(h, now - dt.timedelta(hours=h)) for h in (1, 6, 23, 24, 30)]
    log = spark.createDataFrame([(str(h), at, 1) for h, at in ages], "table_name string, last_refresh_at timestamp_ntz, row_count bigint")
    got = {r.table_name: r.freshness_status for r in quality.freshness(log, F.lit(now).cast("timestamp_ntz")).collect()}
    assert got == {"1": "fresh", "6": "stale", "23": "stale", "24": "outdated", "30": "outdated"}


def write_csv(folder, name, data):
    lines = [",".join(CSV_COLUMNS)]
    for inv, code, desc, qty, at, price, cust, country in data:
        lines.append(f"{inv},{code},{desc},{qty},{at.month}/{at.day}/{at.year} {at.hour}:{at.minute:02d},{price},{cust},{country}")
    (folder / name).write_text("\n".join(lines) + "\n", encoding="latin-1")


def kpi_rows(df):
    return sorted(rows(df.select(*sorted(df.columns))))


def lines_in(spark, folder):
    return st.typed(st.rename_by_name(st.csv_options(spark.read).csv(str(folder))))


def test_stream_equals_batch_and_replay_changes_nothing(built, spark, tmp_path):
    batch, data, _ = built
    folder = tmp_path / "in"
    folder.mkdir()
    w = Warehouse(spark, str(tmp_path / "wh"))
    refresh = st.StreamRefresh(w, buckets=4, fan_out=2)
    for i in range(5):
        write_csv(folder, f"{i}.csv", data[i * 600 : (i + 1) * 600])
        refresh.run(str(folder), str(tmp_path / "cp"), files_per_batch=2)
    want = kpi_rows(batch.table("mart_daily_kpis"))
    assert kpi_rows(w.table("mart_daily_kpis")) == want
    # Closed batches are merged two by two.
    assert [(p.first, p.last) for p in parts.live(spark, w.path("stream_staging"))] == [(0, 3), (4, 4)]
    # The last batch once more, as after a crash between writing and committing.
    refresh.batch(lines_in(spark, folder / "4.csv"), 4)
    assert kpi_rows(w.table("mart_daily_kpis")) == want
    assert w.table("raw_transactions").count() == w.table("fact_sales").count() == len(data)
    # Checks and a line of the run log for each batch.
    assert w.log("dq_check_results").groupBy("run_id").count().where("count = 6").count() == 5
    log = w.log("etl_run_log").orderBy("run_id").collect()
    assert [(r.run_id, r.rows_read, r.run_type) for r in log] == [(f"batch-{i}", 600, "etl_incremental") for i in range(5)]
    assert all(int(json.loads(r.metadata)["addBatch_ms"]) > 0 and r.status in ("success", "warning") for r in log)


def test_source_and_stream_together(spark, tmp_path):
    raw, data = skewed_raw(spark, 3000)
    source, later = data[:1300], data[1300:]
    w = Warehouse(spark, str(tmp_path / "wh"), lambda: spark.createDataFrame(source, raw.schema))
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder, "0.csv", later[:900])
    write_csv(folder, "1.csv", later[900:])
    st.StreamRefresh(w, full_every=2, buckets=4).run(str(folder), str(tmp_path / "cp"), files_per_batch=1)
    whole = Warehouse(spark, str(tmp_path / "whole"), lambda: raw)
    want = kpi_rows(whole.table("mart_daily_kpis"))
    for again in (True, False):  # after the stream with its full refresh, and after the source was read again
        assert w.table("raw_transactions").count() == w.table("stg_transactions_clean").count() == len(data)
        assert kpi_rows(w.table("mart_daily_kpis")) == want
        assert sorted(rows(w.table("dim_customer"))) == sorted(rows(whole.table("dim_customer")))
        if again:
            w.run_etl("again", fail_on_critical=False)
    # A batch after that starts from what both brought.
    extra = [("900001", "85123A", "WHITE HEART", 1, data[0][4], data[0][5], "1", "France")]
    write_csv(folder, "2.csv", extra)
    st.StreamRefresh(w, buckets=4).run(str(folder), str(tmp_path / "cp"))
    full = Warehouse(spark, str(tmp_path / "full"), lambda: spark.createDataFrame([*data, *extra], raw.schema))
    assert kpi_rows(w.table("mart_daily_kpis")) == kpi_rows(full.table("mart_daily_kpis"))
    assert w.table("raw_transactions").count() == len(data) + 1


def test_product_days_follow_the_stream(spark, tmp_path):
    raw, data = skewed_raw(spark, 1000)
    w = Warehouse(spark, str(tmp_path / "wh"), lambda: spark.createDataFrame(data[:600], raw.schema))
    w.run_etl("source", fail_on_critical=False)
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder, "0.csv", data[600:])
    st.StreamRefresh(w, buckets=4).run(str(folder), str(tmp_path / "cp"))
    whole = Warehouse(spark, str(tmp_path / "whole"), lambda: raw)
    assert sorted(rows(d.daily_product_trend(w))) == sorted(rows(d.daily_product_trend(whole)))
    plan = d.daily_product_trend(w)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Exchange" not in plan


def test_critical_checks_mark_a_batch_failed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder, "0.csv", [])
    w = Warehouse(spark, str(tmp_path / "wh"))
    st.StreamRefresh(w).run(str(folder), str(tmp_path / "cp"))
    run = w.log("etl_run_log").first()
    assert (run.status, run.rows_read) == ("failed", 0)
    bad = {r.check_name: r.message for r in w.log("dq_check_results").where("NOT passed").collect()}
    assert bad["raw_row_count"] == "CRITICAL: Raw table is empty!"
    strict = st.StreamRefresh(Warehouse(spark, str(tmp_path / "strict")), fail_on_critical=True)
    query = strict.start(str(folder), str(tmp_path / "cp2"))
    with pytest.raises(Exception, match="critical checks failed"):
        query.awaitTermination()
    strict.log.wait()
    last = strict.w.log("etl_run_log").first()
    assert last.status == "failed" and "critical checks failed" in last.error_message


def test_processing_time_trigger_and_run_log(built, spark, tmp_path):
    _, data, _ = built
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        write_csv(folder, f"{i}.csv", data[i * 100 : (i + 1) * 100])
    raw, log = str(tmp_path / "raw"), str(tmp_path / "log")
    query = st.stream_transactions(spark, str(folder), raw, str(tmp_path / "cp"), every="1 second", files_per_batch=1, log_path=log)
    for _ in range(120):
        if parts.live(spark, log) and parts.read(spark, log, ETL_RUN_LOG).count() >= 3:
            break
        time.sleep(0.5)
    query.stop()
    lines = parts.read(spark, log, ETL_RUN_LOG).orderBy("run_id").collect()
    assert [(r.run_id, r.rows_read, r.status) for r in lines] == [(f"batch-{i}", 100, "success") for i in range(3)]
    assert parts.read(spark, raw, RAW).count() == 300


def test_append_stream_and_event_time_days(built, spark, tmp_path):
    batch, data, _ = built
    folder = tmp_path / "in"
    folder.mkdir()
    ordered = sorted(data, key=lambda r: r[4])
    late, ordered = ordered[:150], ordered[150:]  # the oldest lines come last
    for i in range(3):
        write_csv(folder, f"{i}.csv", ordered[i * 1000 : (i + 1) * 1000])
        time.sleep(0.02)
    write_csv(folder, "z.csv", late)
    raw = str(tmp_path / "raw")
    st.stream_transactions(spark, str(folder), raw, str(tmp_path / "cp1"), files_per_batch=1).awaitTermination()
    assert len(parts.live(spark, raw)) == 4 and parts.read(spark, raw, RAW).count() == len(data)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = str(tmp_path / "days")
        stream = st.read_stream(spark, str(folder), 1)
        st.stream_daily_kpis(spark, stream, out, str(tmp_path / "cp2")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    kpis = st.DailyKpis(spark, out, fan_out=2)
    columns = ["full_date", "total_revenue", "total_items_sold"]
    want = sorted(rows(batch.table("mart_daily_kpis").select(*columns)))
    assert sorted(rows(kpis.table().select(*columns))) == want
    # Late lines are kept and counted, and their days hold them.
    assert kpis.table().agg(F.sum("late_lines")).first()[0] == kpis.late_lines().count() == 150
    # A replayed batch, and the merging of closed ones, change nothing.
    kpis.batch(lines_in(spark, folder / "z.csv"), 3)
    kpis.batch(lines_in(spark, folder / "z.csv").where("false"), 4)
    assert len(parts.live(spark, kpis.days)) == 2
    assert sorted(rows(kpis.table().select(*columns))) == want and kpis.late_lines().count() == 150
    orders = batch.table("mart_daily_kpis").select("full_date", "total_orders")
    off = kpis.table().join(orders, "full_date").agg(F.max(F.abs(F.col("approx_orders") - F.col("total_orders")) / F.greatest("total_orders", F.lit(1)))).first()[0]
    assert off < 0.05


def test_full_refresh_every_batch(built, spark, tmp_path):
    _, data, _ = built
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder, "0.csv", data[:400])
    w = Warehouse(spark, str(tmp_path / "wh"))
    st.StreamRefresh(w, full_every=1).run(str(folder), str(tmp_path / "cp"))
    assert w.table("mart_product_performance").count() > 0
    assert {r.source_file for r in w.log("etl_run_log").collect()} == {"batch 0", str(folder)}


def test_detection_over_recent_days_keeps_what_was_acknowledged(spark, tmp_path):
    raw, _ = skewed_raw(spark, 3000)
    w = Warehouse(spark, str(tmp_path / "wh"), lambda: raw, z_threshold=1.45, horizon=14)
    found = w.detect(lookback_days=60)
    assert {r.metric_name for r in found.select("metric_name").distinct().collect()} <= {"total_revenue", "total_orders", "unique_customers", "avg_order_value"}
    one = found.first()
    w.acknowledge(one.anomaly_date, one.metric_name, "me", "2024-01-01 00:00:00")
    w.detect(lookback_days=60)
    assert w.table("ml_anomalies_daily").where("acknowledged").select("acknowledged_by").collect() == [("me",)]
    runs = w.table("ml_model_runs").select("run_id", "model_type", "notes").collect()
    assert {r.model_type for r in runs} == {"anomaly_robust"} and len({r.run_id.split("-anomaly")[0] for r in runs}) == 2


def test_profile_adds_only_new_months(spark, tmp_path):
    raw, _ = skewed_raw(spark, 2000)
    w = Warehouse(spark, str(tmp_path / "wh"), lambda: raw)
    months = sorted(r[0] for r in w.table("stg_transactions_clean").select("year_month").distinct().collect())
    assert len(months) > 1
    w.profile(months[:1], ["quantity", "country"])
    at = tmp_path / "wh" / "agg_column_sketches"
    before = {p: p.stat().st_mtime_ns for p in at.rglob("*.parquet")}
    whole = {r.column_name: r for r in w.profile(columns=["quantity", "country"]).collect()}
    after = {p: p.stat().st_mtime_ns for p in at.rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) == len(months)
    exact = {r.column_name: r for r in quality.profile_columns(w.table("stg_transactions_clean"), "t", ["quantity", "country"], exact=True).collect()}
    for c in exact:
        assert (whole[c].total_rows, whole[c].min_value, whole[c].max_value) == (exact[c].total_rows, exact[c].min_value, exact[c].max_value)


def test_event_days_parse_a_line_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(value):
        calls.add(1)
        return value

    raw, data = skewed_raw(spark, 200)
    df = raw.withColumn("invoice_date", text(F.col("invoice_date").cast("string")).cast("timestamp_ntz"))
    kpis = st.DailyKpis(spark, str(tmp_path))
    kpis.batch(df, 0)
    assert calls.value == len(data) == kpis.table().agg(F.sum("lines")).first()[0]


def test_stream_files_grow_with_the_lines(spark, monkeypatch):
    """More files, each a task's work, and still three batches of days of their own."""
    from checks import catalog

    folders = []
    monkeypatch.setattr(catalog, "LINES_A_FILE", 250)
    monkeypatch.setattr(catalog, "_STREAMED", {})
    monkeypatch.setattr(catalog, "_scratch", lambda *a, make=catalog._scratch: folders.append(make(*a)) or folders[-1])
    log = catalog.QUERIES["stream_run_log"](spark, "/root/testdata/sf0.001").first()
    assert (log.batches, log.lines) == (3, 3) and log.rows_read == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    counts = [len([n for n in parts.names_in(spark, f) if n.endswith(".csv")]) for f in folders]
    assert max(counts) > 6
