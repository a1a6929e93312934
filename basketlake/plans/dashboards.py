"""Named analytic queries over the marts.

Every "today" is an ``as_of`` day: by default the newest day with sales, and for
forecast windows the day after it. Divisions of counts are fractional.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.functions.amounts import MONEY, avg_exact, change_pct, money_sum, share
from basketlake.functions.rules import revenue_tier, severity_order
from basketlake.operators import quality
from basketlake.operators.aggregate import metric_pivot_sum, period_sums, top_k
from basketlake.plans.warehouse import Warehouse

DAY = dt.timedelta(days=1)


def _today(w: Warehouse, as_of) -> dt.date:
    return as_of or w.as_of()


def _tomorrow(w: Warehouse, as_of) -> dt.date:
    return as_of or w.as_of() + DAY


def _r(name: str, scale: int, alias: str | None = None) -> Column:
    return F.round(name, scale).cast(f"decimal(30,{scale})").alias(alias or name)


# --- executive overview ---------------------------------------------------------------


def revenue_orders_trend(w: Warehouse) -> DataFrame:
    return w.table("mart_daily_kpis").select(F.col("full_date").alias("date"), F.col("total_revenue").alias("revenue"), F.col("total_orders").alias("orders")).orderBy("date")


def revenue_by_country_top10(w: Warehouse, k: int = 10) -> DataFrame:
    out = w.table("mart_country_performance").select(F.col("country_name").alias("country"), F.col("total_revenue").alias("revenue"), "revenue_share_pct")
    return top_k(out, "revenue", k, ["country"])


def monthly_summary(w: Warehouse) -> DataFrame:
    """Customers are the sum of daily uniques, as dashboards show them; ``customers_distinct``
    counts each customer once per month, from the fact."""
    months = w.table("mart_daily_kpis").groupBy(F.date_format("full_date", "yyyy-MM").alias("month")).agg(
        money_sum(F.col("total_revenue")).alias("revenue"),
        F.sum("total_orders").alias("orders"),
        F.sum("unique_customers").alias("customers"),
        avg_exact(F.col("avg_order_value")).alias("avg_order_value"),
    )
    return months.orderBy("month")


def monthly_distinct_customers(w: Warehouse) -> DataFrame:
    sales = w.table("agg_invoices").where("customer_id IS NOT NULL")
    sales = sales.select(F.date_format("full_date", "yyyy-MM").alias("month"), "customer_id").distinct()
    return sales.groupBy("month").agg(F.count(F.lit(1)).alias("customers_distinct"))


def kpi_total_revenue(w: Warehouse) -> DataFrame:
    return w.table("mart_daily_kpis").agg(money_sum(F.col("total_revenue")).alias("total_revenue"))


def kpi_total_orders(w: Warehouse) -> DataFrame:
    return w.table("mart_daily_kpis").agg(F.sum("total_orders").alias("total_orders"))


def kpi_total_customers(w: Warehouse) -> DataFrame:
    # customer_id is the key of the dimension, so counting rows counts customers.
    return w.table("dim_customer").where("customer_id IS NOT NULL").agg(F.count(F.lit(1)).alias("total_customers"))


def kpi_avg_order_value(w: Warehouse) -> DataFrame:
    return w.table("mart_daily_kpis").where("avg_order_value > 0").agg(avg_exact(F.col("avg_order_value")).alias("average_order_value"))


def period_kpis(w: Warehouse, days: int = 28, as_of=None) -> DataFrame:
    """One row of sums for the last ``days`` days and the ``days`` before, over one scan."""
    end = _today(w, as_of)
    start = end - (days - 1) * DAY
    both = w.table("mart_daily_kpis").where(F.col("full_date").between(start - days * DAY, end))
    now = F.col("full_date") >= start
    aggs = []
    for p, inside in (("current", now), ("previous", ~now)):
        pick = lambda c: F.when(inside, F.col(c))  # noqa: E731, B023
        aggs += [
            money_sum(pick("total_revenue")).alias(f"{p}_revenue"),
            F.sum(pick("total_orders")).alias(f"{p}_orders"),
            avg_exact(F.nullif(pick("avg_order_value"), F.lit(0))).alias(f"{p}_aov"),
            F.sum(pick("unique_customers")).alias(f"{p}_customers"),
            F.avg(pick("cancellation_rate").cast("double")).alias(f"{p}_cancel_rate"),
            F.avg(pick("return_rate").cast("double")).alias(f"{p}_return_rate"),
        ]
    return both.agg(*aggs)


def kpi_scorecard_28d(w: Warehouse, as_of=None) -> DataFrame:
    """Four metric rows from one aggregate: a stack, not a union of four scans."""
    one = period_kpis(w, 28, as_of)
    rows = [("Revenue", "revenue", 0), ("Orders", "orders", 0), ("Avg Order Value", "aov", 2), ("Unique Customers", "customers", 0)]
    parts = ", ".join(
        f"'{label}', cast(round(cast(current_{c} as {MONEY}), {s}) as {MONEY}), cast(round(cast(previous_{c} as {MONEY}), {s}) as {MONEY}), "
        f"cast(current_{c} as {MONEY}), cast(previous_{c} as {MONEY})"
        for label, c, s in rows
    )
    return one.selectExpr(f"stack(4, {parts}) as (metric, current, previous, _c, _p)").select(
        "metric", "current", "previous", change_pct(F.col("_c"), F.col("_p")).alias("change_pct")
    )


def cancel_return_rates(w: Warehouse) -> DataFrame:
    pct = lambda c: F.round(F.col(c) * 100, 2).cast("decimal(7,2)")
    return w.table("mart_daily_kpis").select(
        F.col("full_date").alias("date"), pct("cancellation_rate").alias("cancellation_rate_pct"), pct("return_rate").alias("return_rate_pct")
    ).orderBy("date")


def new_vs_repeat(w: Warehouse) -> DataFrame:
    return w.table("mart_daily_kpis").select(
        F.col("full_date").alias("date"), "new_customers", "repeat_customers", F.col("unique_customers").alias("total_customers")
    ).orderBy("date")


def executive_summary(w: Warehouse) -> DataFrame:
    return w.table("mart_daily_kpis").agg(
        F.min("full_date").alias("start_date"),
        F.max("full_date").alias("end_date"),
        F.round(F.sum("total_revenue"), 0).cast("decimal(20,0)").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("unique_customers").alias("unique_customers"),
        avg_exact(F.nullif("avg_order_value", F.lit(0))).alias("avg_order_value"),
        _mean_pct("cancellation_rate").alias("cancellation_rate_pct"),
        _mean_pct("return_rate").alias("return_rate_pct"),
    )


def _mean_pct(c: str) -> Column:
    total = F.sum(c).cast("decimal(18,4)") * 100
    return (total.cast("decimal(22,4)") / F.nullif(F.count(c), F.lit(0)).cast("decimal(12,0)")).cast("decimal(9,2)")


def country_top10(w: Warehouse, k: int = 10) -> DataFrame:
    top = top_k(w.table("mart_country_performance"), "total_revenue", k, ["country_name"])
    return top.select("country_name", _r("total_revenue", 0), "total_orders", "total_customers", _r("avg_order_value", 2))


# --- customers ------------------------------------------------------------------------


def rfm_segment_distribution(w: Warehouse) -> DataFrame:
    return w.table("mart_rfm").groupBy(F.col("rfm_segment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customer_count"), money_sum(F.col("monetary")).alias("total_revenue")
    ).orderBy(F.desc("customer_count"), "segment")


def rfm_segment_details(w: Warehouse) -> DataFrame:
    return w.table("mart_rfm").groupBy(F.col("rfm_segment").alias("segment"), F.col("segment_description").alias("description")).agg(
        F.count(F.lit(1)).alias("customers"),
        avg_exact(F.col("recency_days"), 0).alias("avg_recency_days"),
        avg_exact(F.col("frequency"), 1).alias("avg_frequency"),
        avg_exact(F.col("monetary"), 2).alias("avg_monetary"),
    ).orderBy(F.desc("customers"), "segment")


def rfm_heatmap(w: Warehouse) -> DataFrame:
    return w.table("mart_rfm").groupBy("r_score", "f_score").agg(F.count(F.lit(1)).alias("customer_count")).orderBy("r_score", "f_score")


def rfm_segment_count(w: Warehouse, segment: str = "Champions") -> DataFrame:
    return w.table("mart_rfm").where(F.col("rfm_segment") == segment).agg(F.count(F.lit(1)).alias("customers"))


def top_customers(w: Warehouse, k: int = 20) -> DataFrame:
    out = w.table("mart_rfm").select(
        "customer_id",
        F.col("rfm_segment").alias("segment"),
        F.col("recency_days").alias("days_since_last_purchase"),
        F.col("frequency").alias("purchase_frequency"),
        F.col("monetary").alias("total_spend"),
    )
    return top_k(out, "total_spend", k, ["customer_id"])


def high_value_at_risk(w: Warehouse, k: int = 20) -> DataFrame:
    rfm = w.table("mart_rfm")
    twice, n = rfm.agg(F.sum("monetary") * 2).scalar(), rfm.agg(F.count("monetary")).scalar()
    # monetary > 2 * average, without rounding the average
    rich = F.col("monetary").cast("decimal(20,2)") * n.cast("decimal(12,0)") > twice
    picked = rfm.where(F.col("rfm_segment").isin("At Risk", "Cant Lose Them")).where(rich)
    out = picked.select(
        "customer_id",
        F.col("monetary").alias("lifetime_value"),
        F.col("recency_days").alias("days_since_purchase"),
        F.col("rfm_segment").alias("current_segment"),
        F.lit("Send re-engagement offer").alias("recommended_action"),
    )
    return top_k(out, "lifetime_value", k, ["customer_id"])


# --- products and countries --------------------------------------------------------------


def top_products_revenue(w: Warehouse, k: int = 20) -> DataFrame:
    return _products(w, "revenue", k)


def top_products_quantity(w: Warehouse, k: int = 20) -> DataFrame:
    return _products(w, "quantity_sold", k)


def _products(w: Warehouse, by: str, k: int) -> DataFrame:
    out = w.table("mart_product_performance").select(
        F.col("stock_code").alias("sku"),
        F.left("description", F.lit(50)).alias("product"),
        F.col("total_revenue").alias("revenue"),
        F.col("total_quantity").alias("quantity_sold"),
    )
    return top_k(out, by, k, ["sku"])


def product_tiers(w: Warehouse) -> DataFrame:
    return w.table("mart_product_performance").groupBy(revenue_tier(F.col("revenue_rank")).alias("tier")).agg(
        F.count(F.lit(1)).alias("product_count"), money_sum(F.col("total_revenue")).alias("total_revenue")
    )


def revenue_concentration(w: Warehouse, top: int = 10) -> DataFrame:
    best = F.sum(F.when(F.col("revenue_rank") <= top, F.col("total_revenue")).otherwise(0))
    return w.table("mart_product_performance").agg(share(best, F.sum("total_revenue"), 4).alias("top_share_pct"))


def _window_delta(w: Warehouse, table: str, key: str, days: int, as_of) -> tuple[DataFrame, list[Column]]:
    """Revenue per key in the last ``days`` days and the ``days`` before, from a table of day sums.

    Only the two windows are read: literal dates prune months, where the table has them, and row groups.
    """
    end = _today(w, as_of)
    start = end - (days - 1) * DAY
    first = start - days * DAY
    now = F.col("full_date") >= start
    sales = w.table(table).where(F.col("full_date").between(first, end))
    if "year_month" in sales.columns:
        sales = sales.where(F.col("year_month").between(f"{first:%Y-%m}", f"{end:%Y-%m}"))
    sums = sales.groupBy(key).agg(
        money_sum(F.when(now, F.col("revenue")).otherwise(0)).alias("_cur"),
        money_sum(F.when(~now, F.col("revenue")).otherwise(0)).alias("_prev"),
    )
    cur = F.coalesce("_cur", F.lit(0).cast(MONEY))
    prev = F.coalesce("_prev", F.lit(0).cast(MONEY))
    return sums, [
        F.round(cur, 0).cast("decimal(20,0)").alias("current_30d_revenue"),
        F.round(prev, 0).cast("decimal(20,0)").alias("previous_30d_revenue"),
        F.round(cur - prev, 0).cast("decimal(20,0)").alias("delta"),
        change_pct(cur, prev).alias("delta_pct"),
    ]


def product_delta_30d(w: Warehouse, as_of=None, k: int = 20) -> DataFrame:
    """Articles by revenue change. Articles that ever sold but not in the windows have delta 0."""
    sums, columns = _window_delta(w, "agg_product_days", "stock_code", 30, as_of)
    sold = w.table("dim_product").where("total_quantity_sold > 0").select("stock_code", "description")
    out = sold.join(sums, "stock_code", "left").select(F.col("stock_code").alias("sku"), F.left("description", F.lit(50)).alias("product"), *columns)
    return top_k(out, "delta", k, ["sku"])


def country_delta_30d(w: Warehouse, as_of=None, k: int = 10) -> DataFrame:
    sums, columns = _window_delta(w, "agg_invoices", "country_name", 30, as_of)
    sold = w.table("dim_country").where("total_revenue > 0").select("country_name")
    out = sold.join(sums, "country_name", "left").select(F.col("country_name").alias("country"), *columns)
    return top_k(out, "delta", k, ["country"])


def daily_product_trend(w: Warehouse, start=None, end=None) -> DataFrame:
    """Valid quantity and revenue per day and article: a scan of the day sums, no shuffle.

    The result has as many rows as there are days times articles sold, so it is ordered (day, revenue
    falling, article) within its partitions only; months are not mixed in one.
    """
    sales = w.table("agg_product_days").where("valid_lines > 0")
    if start is not None:
        sales = sales.where((F.col("full_date") >= start) & (F.col("year_month") >= str(start)[:7]))
    if end is not None:
        sales = sales.where((F.col("full_date") <= end) & (F.col("year_month") <= str(end)[:7]))
    out = sales.select(F.col("full_date").alias("date"), F.col("stock_code").alias("sku"), "quantity", "revenue")
    return out.sortWithinPartitions("date", F.desc("revenue"), "sku")


def growing_countries(w: Warehouse, k: int = 10) -> DataFrame:
    top = top_k(w.table("mart_country_performance").where("total_customers > 10"), "total_revenue", k, ["country_name"])
    return top.select(
        F.col("country_name").alias("country"),
        _r("total_revenue", 0, "revenue"),
        F.col("total_orders").alias("orders"),
        F.col("total_customers").alias("customers"),
        _r("avg_order_value", 2, "aov"),
        F.lit("Consider market expansion").alias("opportunity"),
    )


def products_needing_attention(w: Warehouse, k: int = 15) -> DataFrame:
    mid = w.table("mart_product_performance").where("revenue_rank BETWEEN 50 AND 200 AND total_orders > 10")
    return top_k(mid, "total_revenue", k, ["stock_code"]).select(
        F.col("stock_code").alias("sku"),
        F.left("description", F.lit(40)).alias("product"),
        F.col("total_orders").alias("orders"),
        _r("total_revenue", 0, "revenue"),
        _r("avg_unit_price", 2, "avg_price"),
        F.lit("Review pricing/promotion").alias("action"),
    )


# --- trends -----------------------------------------------------------------------------


def moving_avg_7d(w: Warehouse) -> DataFrame:
    """Mean of seven rows (days with sales). Unpartitioned window over one row per day."""
    seven = Window.orderBy("full_date").rowsBetween(-6, 0)
    mean = (F.sum("total_revenue").over(seven) / F.count("total_revenue").over(seven)).cast("decimal(20,4)")
    return w.table("mart_daily_kpis").select(F.col("full_date").alias("date"), F.col("total_revenue").alias("daily_revenue"), mean.alias("avg_7d"))


def wow_growth(w: Warehouse) -> DataFrame:
    weeks = w.table("mart_daily_kpis").groupBy(F.trunc("full_date", "week").alias("week")).agg(
        money_sum(F.col("total_revenue")).alias("revenue"), F.sum("total_orders").alias("orders")
    )
    prev = F.lag("revenue").over(Window.orderBy("week"))
    return weeks.select("week", "revenue", "orders", prev.alias("previous_week_revenue"), change_pct(F.col("revenue"), prev).alias("wow_growth_pct"))


# --- forecasts --------------------------------------------------------------------------


def _forecast(w: Warehouse, metric: str) -> DataFrame:
    return w.table("ml_forecast_daily").where(F.col("metric_name") == metric)


def forecast_vs_actual(w: Warehouse, metric: str, faithful: bool = False) -> DataFrame:
    """Actual and forecast by day, either may be missing.

    With the metric only in the join condition, forecasts of other metrics come
    through unmatched; ``faithful=True`` keeps those rows.
    """
    kpis = w.table("mart_daily_kpis").select("full_date", F.col(metric).alias("actual"))
    fc = w.table("ml_forecast_daily")
    on = F.col("full_date") == F.col("forecast_date")
    if faithful:
        on = on & (F.col("metric_name") == metric)
    else:
        fc = fc.where(F.col("metric_name") == metric)
    return kpis.join(fc, on, "full").select(
        F.coalesce("full_date", "forecast_date").alias("date"),
        "actual",
        F.col("predicted_value").alias("predicted"),
        "lower_bound",
        "upper_bound",
    )


def forecast_vs_actual_revenue(w: Warehouse, faithful: bool = False) -> DataFrame:
    return forecast_vs_actual(w, "total_revenue", faithful)


def forecast_vs_actual_orders(w: Warehouse, faithful: bool = False) -> DataFrame:
    return forecast_vs_actual(w, "total_orders", faithful)


def v_forecast_vs_actual(w: Warehouse) -> DataFrame:
    """KPI days with both forecasts, their errors and the mart's refresh time.

    The forecasts are pivoted by metric first: one join instead of two.
    """
    fc = w.table("ml_forecast_daily").where(F.col("metric_name").isin("total_revenue", "total_orders"))
    picks = []
    for metric, short in (("total_revenue", "revenue"), ("total_orders", "orders")):
        for column, name in (("predicted_value", f"forecast_{short}"), ("lower_bound", f"{short}_lower"), ("upper_bound", f"{short}_upper")):
            picks.append(F.max(F.when(F.col("metric_name") == metric, F.col(column))).alias(name))
    wide = fc.groupBy(F.col("forecast_date").alias("full_date")).agg(*picks)
    log = w.table("table_refresh_log").where(F.col("table_name") == "mart_daily_kpis").agg(F.max("last_refresh_at"))

    def err(actual: str, predicted: str) -> Column:
        a = F.col(actual).cast("decimal(20,2)")
        return F.when(a > 0, share(F.abs(a - F.col(predicted)), a))

    kpis = w.table("mart_daily_kpis").select("full_date", F.col("total_revenue").alias("actual_revenue"), F.col("total_orders").alias("actual_orders"))
    return kpis.join(wide, "full_date", "left").select(
        "full_date", "actual_revenue", "actual_orders",
        "forecast_revenue", "revenue_lower", "revenue_upper", "forecast_orders", "orders_lower", "orders_upper",
        err("actual_revenue", "forecast_revenue").alias("revenue_error_pct"),
        err("actual_orders", "forecast_orders").alias("orders_error_pct"),
        log.scalar().alias("data_freshness"),
    )


def forecast_vs_actual_combined(w: Warehouse) -> DataFrame:
    return v_forecast_vs_actual(w).withColumnRenamed("full_date", "date").drop("data_freshness").orderBy("date")


def future_forecasts(w: Warehouse, as_of=None, days: int = 14) -> DataFrame:
    """The next ``days`` days of every metric."""
    first = _tomorrow(w, as_of)
    return (
        w.table("ml_forecast_daily")
        .where((F.col("forecast_date") >= first) & (F.col("forecast_date") < F.date_add(F.lit(first), days)))
        .select(F.col("forecast_date").alias("date"), F.col("metric_name").alias("metric"), F.col("predicted_value").alias("predicted"), "lower_bound", "upper_bound")
        .orderBy("metric", "date")
    )


def latest_forecasts(w: Warehouse, as_of=None) -> DataFrame:
    return (
        w.table("ml_forecast_daily")
        .where(F.col("forecast_date") >= _tomorrow(w, as_of))
        .select("forecast_date", "metric_name", "predicted_value", "lower_bound", "upper_bound", "model_name")
        .orderBy("metric_name", "forecast_date")
    )


def _forecast_14d(w: Warehouse, metric: str, name: str, as_of) -> DataFrame:
    start = _tomorrow(w, as_of)
    r = lambda c, n: F.round(F.sum(c), 0).cast("decimal(20,0)").alias(n)
    return _forecast(w, metric).where(F.col("forecast_date").between(start, start + 13 * DAY)).agg(
        r("predicted_value", name), r("lower_bound", "conservative_estimate"), r("upper_bound", "optimistic_estimate")
    )


def forecast_14d_revenue(w: Warehouse, as_of=None) -> DataFrame:
    return _forecast_14d(w, "total_revenue", "forecasted_revenue", as_of)


def forecast_14d_orders(w: Warehouse, as_of=None) -> DataFrame:
    return _forecast_14d(w, "total_orders", "forecasted_orders", as_of)


def yearly_outlook(w: Warehouse, as_of=None, exact_365: bool = False) -> DataFrame:
    """Next 365 forecast days against the last year of sales.

    The usual lower limit ``newest - 365`` is inclusive and keeps 366 days;
    ``exact_365=True`` drops the extra one.
    """
    start = _tomorrow(w, as_of)
    ahead = metric_pivot_sum(
        w.table("ml_forecast_daily").where(F.col("forecast_date").between(start, start + 364 * DAY)),
        "metric_name", "predicted_value", ["total_revenue", "total_orders"],
    ).toDF("_fr", "_fo")
    since = w.as_of() - (364 if exact_365 else 365) * DAY
    past = w.table("mart_daily_kpis").where(F.col("full_date") >= since)
    revenue, orders = past.agg(money_sum(F.col("total_revenue"))).scalar(), past.agg(F.sum("total_orders")).scalar()
    both = ahead.select("*", revenue.alias("_ar"), orders.alias("_ao"))
    whole = lambda c, n: F.round(c, 0).cast("decimal(20,0)").alias(n)
    fr, fo, ar, ao = (F.col(c).cast(MONEY) for c in ("_fr", "_fo", "_ar", "_ao"))
    return both.select(
        whole(fr, "forecast_revenue_365d"), whole(ar, "last_365d_revenue"), whole(fr - ar, "delta_revenue"), change_pct(fr, ar).alias("delta_revenue_pct"),
        whole(fo, "forecast_orders_365d"), whole(ao, "last_365d_orders"), whole(fo - ao, "delta_orders"), change_pct(fo, ao).alias("delta_orders_pct"),
    )


def actual_vs_forecast_30d(w: Warehouse, as_of=None) -> DataFrame:
    today, ahead = _today(w, as_of), _tomorrow(w, as_of)
    past = w.table("mart_daily_kpis").where(F.col("full_date") >= today - 30 * DAY).select(
        F.col("full_date").alias("date"), F.col("total_revenue").alias("value"), F.lit("Actual").alias("type")
    )
    future = _forecast(w, "total_revenue").where(F.col("forecast_date") >= ahead).select(
        F.col("forecast_date").alias("date"), F.col("predicted_value").alias("value"), F.lit("Forecast").alias("type")
    )
    return past.unionByName(future).orderBy("date")


# --- anomalies --------------------------------------------------------------------------


def _by_severity(df: DataFrame, *then: Column | str) -> DataFrame:
    return df.orderBy(severity_order(F.col("severity")), *then)


def _unacknowledged() -> Column:
    return ~F.coalesce("acknowledged", F.lit(False))


def anomaly_table(w: Warehouse) -> DataFrame:
    return w.table("ml_anomalies_daily").orderBy(F.desc("anomaly_date"), severity_order(F.col("severity")), "metric_name").select(
        F.col("anomaly_date").alias("date"), F.col("metric_name").alias("metric"), F.col("actual_value").alias("actual"),
        F.col("expected_value").alias("expected"), _r("deviation_pct", 1), F.col("anomaly_type").alias("type"), "severity",
    )


def anomaly_by_severity(w: Warehouse) -> DataFrame:
    return _by_severity(w.table("ml_anomalies_daily").groupBy("severity").agg(F.count(F.lit(1)).alias("count")))


def latest_anomalies(w: Warehouse, k: int = 15) -> DataFrame:
    top = w.table("ml_anomalies_daily").orderBy(F.desc("anomaly_date"), severity_order(F.col("severity")), "metric_name").limit(k)
    return top.select(
        "anomaly_date", "metric_name", "actual_value", "expected_value", _r("deviation_pct", 2), "anomaly_type", "severity", "business_interpretation"
    )


def latest_anomalies_50(w: Warehouse, k: int = 50) -> DataFrame:
    top = w.table("ml_anomalies_daily").orderBy(F.desc("anomaly_date"), severity_order(F.col("severity")), "metric_name").limit(k)
    return top.select(
        "anomaly_date", "metric_name", "actual_value", "expected_value", "deviation_pct", "anomaly_type", "severity",
        "business_interpretation", "recommended_action", "is_weekend", "acknowledged",
    )


def _since(w: Warehouse, days: int, as_of) -> Column:
    return F.col("anomaly_date") >= _today(w, as_of) - days * DAY


def recent_anomalies_7d(w: Warehouse, as_of=None, k: int = 10) -> DataFrame:
    return w.table("ml_anomalies_daily").where(_since(w, 7, as_of)).orderBy(F.desc("anomaly_date"), "metric_name").limit(k).select(
        "anomaly_date", "metric_name", "severity", "anomaly_type", _r("deviation_pct", 2)
    )


def serious_anomalies_7d(w: Warehouse, as_of=None) -> DataFrame:
    return w.table("ml_anomalies_daily").where(_since(w, 7, as_of) & F.col("severity").isin("critical", "high")).orderBy(F.desc("anomaly_date"), "metric_name")


def active_alerts_7d(w: Warehouse, as_of=None) -> DataFrame:
    live = w.table("ml_anomalies_daily").where(_unacknowledged() & _since(w, 7, as_of))
    return _by_severity(live, F.desc("anomaly_date"), "metric_name").select(
        "anomaly_date", "metric_name", "actual_value", "expected_value", "deviation_pct", "severity", "anomaly_type", "probable_cause",
        "business_interpretation", "recommended_action", severity_order(F.col("severity")).alias("priority_order"),
    )


def active_alerts_14d(w: Warehouse, as_of=None) -> DataFrame:
    live = w.table("ml_anomalies_daily").where(_unacknowledged() & _since(w, 14, as_of))
    return _by_severity(live, F.desc("anomaly_date"), "metric_name").select(
        F.col("anomaly_date").alias("date"),
        F.col("metric_name").alias("metric"),
        _r("actual_value", 0, "actual"),
        _r("expected_value", 0, "expected"),
        F.concat(F.round(F.col("deviation_pct").cast("decimal(28,4)"), 1).cast("decimal(24,1)").cast("string"), F.lit("%")).alias("deviation"),
        F.upper("anomaly_type").alias("type"),
        F.upper("severity").alias("severity"),
        F.coalesce("business_interpretation", F.lit("Requires investigation")).alias("what_happened"),
        F.coalesce("recommended_action", F.lit("Review and acknowledge")).alias("recommended_action"),
    )


def critical_alert_count(w: Warehouse) -> DataFrame:
    return w.table("ml_anomalies_daily").where((F.col("severity") == "critical") & _unacknowledged()).agg(F.count(F.lit(1)).alias("critical_alerts"))


def alert_summary(w: Warehouse, as_of=None) -> DataFrame:
    """Data of the alert report: counts and details per severity, at most a week of alerts."""
    detail = F.concat_ws(" | ", F.col("anomaly_date").cast("string"), "metric_name", "anomaly_type")
    return serious_anomalies_7d(w, as_of).groupBy("severity").agg(
        F.count(F.lit(1)).alias("alerts"), F.array_join(F.array_sort(F.collect_list(detail)), "; ").alias("details")
    )


# --- models and freshness ---------------------------------------------------------------


def _forecast_runs(w: Warehouse) -> DataFrame:
    # In this pattern '_' matches any single character.
    return w.table("ml_model_runs").where(F.col("status") == "completed").where(F.col("model_type").like("forecast_%"))


def model_performance_latest(w: Warehouse, k: int = 4) -> DataFrame:
    pct = lambda c: F.concat(F.round(c, 1).cast("decimal(12,1)").cast("string"), F.lit("%"))
    return _forecast_runs(w).orderBy(F.desc("run_timestamp"), "target_metric", "model_type").limit(k).select(
        F.col("target_metric").alias("metric"),
        F.col("model_type").alias("model"),
        pct("mape").alias("model_mape"),
        pct("baseline_mape").alias("baseline_mape"),
        pct("improvement_vs_baseline_pct").alias("improvement"),
        F.concat(F.col("train_samples").cast("string"), F.lit(" days")).alias("training_data"),
        F.date_format("run_timestamp", "yyyy-MM-dd HH:mm").alias("last_trained"),
    )


def model_comparison(w: Warehouse) -> DataFrame:
    avg = lambda c: F.round(F.avg(F.col(c).cast("double")), 2)
    return _forecast_runs(w).groupBy(F.col("target_metric").alias("metric"), F.col("model_type").alias("model")).agg(
        avg("mape").alias("avg_mape"), avg("baseline_mape").alias("avg_baseline_mape"), avg("improvement_vs_baseline_pct").alias("avg_improvement_pct")
    ).orderBy("metric", "avg_mape")


def v_model_performance(w: Warehouse) -> DataFrame:
    return w.table("ml_model_runs").where(F.col("status") == "completed").groupBy("model_type", "target_metric").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.round(F.avg(F.col("mape").cast("double")), 4).alias("avg_mape"),
        F.min("mape").alias("best_mape"),
        F.round(F.avg(F.col("improvement_vs_baseline_pct").cast("double")), 4).alias("avg_improvement_pct"),
        F.max("run_timestamp").alias("last_run"),
    )


def model_runs_latest(w: Warehouse, k: int = 20) -> DataFrame:
    return w.table("ml_model_runs").orderBy(F.desc("run_timestamp"), "run_id").limit(k).select(
        "model_type", "target_metric", "train_start_date", "train_end_date", "train_samples", "mape", "smape",
        "baseline_mape", "improvement_vs_baseline_pct", "model_version", "code_version", "run_timestamp", "status",
    )


def _now(w: Warehouse, now) -> Column:
    """``now`` or noon of the newest day with sales."""
    return F.lit(str(now or dt.datetime.combine(w.as_of(), dt.time(12)))).cast("timestamp_ntz")


def data_freshness(w: Warehouse, now=None, tables=("mart_daily_kpis", "mart_rfm", "ml_forecast_daily")) -> DataFrame:
    return quality.freshness(w.table("table_refresh_log"), _now(w, now)).where(F.col("table_name").isin(list(tables))).select(
        F.col("table_name").alias("data_source"),
        F.date_format("last_refresh_at", "yyyy-MM-dd HH:mm").alias("last_updated"),
        F.col("row_count").alias("records"),
        F.initcap("freshness_status").alias("status"),
    ).orderBy(F.desc("last_updated"), "data_source")


def v_dashboard_freshness(w: Warehouse, now=None) -> DataFrame:
    return quality.freshness(w.table("table_refresh_log"), _now(w, now))


def last_data_date(w: Warehouse) -> DataFrame:
    return w.table("mart_daily_kpis").agg(F.max("full_date").alias("last_data_date"), F.count(F.lit(1)).alias("total_records"))


def period_cross(w: Warehouse, days: int = 30, as_of=None) -> DataFrame:
    """Revenue and orders of the last two closed periods, side by side."""
    end = _today(w, as_of)
    start = end - (days - 1) * DAY
    lit = lambda d: F.lit(d)
    periods = {"current": (lit(start), lit(end)), "previous": (lit(start - days * DAY), lit(start - DAY))}
    return period_sums(w.table("mart_daily_kpis"), "full_date", periods, {"revenue": "total_revenue", "orders": "total_orders"})
