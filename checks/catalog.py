"""Registered queries: every operator run over the given tables.

The tables reach the library through the transaction view of
``basketlake.sources.tpch``. Operators run lazily over stored upstream tables;
dashboards run over stored marts, as they would in service. Decimals are shown
as doubles so that any client compares them alike.
"""

from __future__ import annotations

import uuid
from functools import wraps
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlake.functions import parsers, rules
from basketlake.functions.amounts import change_pct, money_sum
from basketlake.operators import aggregate, anomalies, clean, forecast, marts, quality, series, star
from basketlake.plans import dashboards as d
from basketlake.plans.warehouse import Warehouse
from basketlake.schemas import CSV_COLUMNS, RAW, RAW_COLUMNS
from basketlake.shared import shared_dir
from basketlake.sources import parts, sinks, tpch
from basketlake.sources.readers import rename_by_name, rename_by_position, typed
from basketlake.streaming import transactions as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_WAREHOUSES: dict[tuple, Warehouse] = {}


def warehouse(spark: SparkSession, folder: str, **options) -> Warehouse:
    """The warehouse of a table folder, with the default models and detectors; its tables are built when first read."""
    key = (spark.sparkContext.applicationId, folder, repr(sorted(options.items())))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse.for_source(spark, folder, lambda: tpch.raw_transactions(spark, folder), **options)
    return _WAREHOUSES[key]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(
        *[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    )


def query(fn: Callable[[Warehouse], DataFrame], name: str | None = None):
    """Registers a function of a warehouse."""

    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(fn(warehouse(spark, folder)))

    QUERIES[name or fn.__name__] = run
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def on_tables(fn: Query):
    """Registers a function of (spark, folder)."""
    QUERIES[fn.__name__] = wraps(fn)(lambda spark, folder: plain(fn(spark, folder)))
    return fn


# --- text parsing over line items ---------------------------------------------------


def _number_texts(spark, folder) -> DataFrame:
    q = F.col("l_quantity").cast("int").cast("string")
    k = F.col("l_linenumber") % 7
    text = (
        F.when(k == 0, "").when(k == 1, F.concat(q, F.lit(".0"))).when(k == 2, F.concat(F.lit(" "), q, F.lit(" ")))
        .when(k == 3, F.concat(F.lit("x"), q)).when(k == 4, F.concat(F.lit("-"), q, F.lit(".9"))).when(k == 5, F.concat(q, F.lit("e2"))).otherwise(q)
    )
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))


@on_tables
def parse_int_lenient(spark, folder):
    return _number_texts(spark, folder).withColumn("parsed", parsers.parse_int(F.col("text")))


@on_tables
def parse_float_lenient(spark, folder):
    return _number_texts(spark, folder).withColumn("parsed", parsers.parse_float(F.col("text")))


@on_tables
def parse_invoice_date(spark, folder):
    ship = F.col("l_shipdate")
    n = F.col("l_linenumber")
    day = F.concat_ws("/", F.month(ship), F.dayofmonth(ship), F.year(ship))
    clock = F.concat(F.pmod(n * 5, F.lit(24)).cast("string"), F.lit(":0"), n.cast("string"))
    text = (
        F.when(n % 5 == 0, F.concat_ws(" ", day, F.concat(clock, F.lit(":30"))))
        .when(n % 5 == 1, F.concat_ws("-", F.year(ship), F.month(ship)))
        .when(n % 5 == 2, "")
        .otherwise(F.concat_ws(" ", day, clock))
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))
    return lines.withColumn("parsed", parsers.parse_invoice_date(F.col("text")))


@on_tables
def strip_excel_eq(spark, folder):
    key, n = F.col("l_partkey").cast("string"), F.col("l_linenumber") % 5
    text = F.when(n == 0, F.concat(F.lit("="), key)).when(n == 1, F.concat(F.lit(" = "), key)).when(n == 2, "NaN").when(n == 3, " = ").otherwise(key)
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))
    return lines.withColumn("stripped", parsers.strip_excel_eq(F.col("text")))


def _file_text(raw: DataFrame) -> DataFrame:
    """Raw rows as the text columns of a transactions file."""
    at = F.col("invoice_date")
    date = F.concat(F.month(at), F.lit("/"), F.dayofmonth(at), F.lit("/"), F.year(at), F.lit(" "), F.hour(at), F.lit(":"), F.date_format(at, "mm"))
    cols = {**{c: F.col(c).cast("string") for c in RAW_COLUMNS}, "invoice_date": date}
    return raw.select(*[cols[n].alias(c) for c, n in zip(CSV_COLUMNS, RAW_COLUMNS)])


@query
def rename_by_name_(w):
    return typed(rename_by_name(_file_text(w.table("raw_transactions"))))


@query
def rename_by_position_(w):
    return typed(rename_by_position(_file_text(w.table("raw_transactions"))))


for _n in ("rename_by_name", "rename_by_position"):
    QUERIES[_n] = QUERIES.pop(_n + "_")


@query
def read_transactions_json(w):
    from basketlake.sources.readers import read_transactions_json as read

    text = _file_text(w.table("raw_transactions"))
    # One JSON document per row: arrays are never gathered across rows.
    docs = text.select(F.to_json(F.array(F.struct(*CSV_COLUMNS))).alias("payload"))
    return read(docs)


def _scratch(spark, label: str) -> str:
    return f"{shared_dir(spark)}/basketlake/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


#: A file is one task's work to a stream, as its texts may hold line feeds: their number grows with the lines.
LINES_A_FILE = 500_000


def _files(lines: int, pieces: int) -> int:
    """Files that each of so many equal pieces of the lines is cut into."""
    return max(1, -(-lines // (pieces * LINES_A_FILE)))


def _csv_folder(w: Warehouse, label: str, files: int | None = None, by_date: bool = False) -> str:
    """The raw table written out as Latin-1 transaction files; ``by_date`` gives each file days of its own."""
    folder = _scratch(w.spark, label)
    raw = w.table("raw_transactions")
    if files:
        raw = raw.repartitionByRange(files, "invoice_date") if by_date else raw.repartition(files)
    text = _file_text(raw)
    text.write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(folder)
    return folder


@query
def read_transactions_csv(w):
    from basketlake.sources.readers import read_transactions_csv as read

    return read(w.spark, _csv_folder(w, "csv"))


@query
def read_transactions_csv_headers(w):
    """Files of two headers, one in another order with further columns, and texts of two lines in quotes."""
    from basketlake.sources.readers import read_transactions_csv as read

    folder = _scratch(w.spark, "headers")
    text = _file_text(w.table("raw_transactions")).withColumn("Description", F.concat("Description", F.lit("\n, second line")))
    odd = F.col("StockCode").cast("int") % 2 == 1
    options = {"header": True, "encoding": "ISO-8859-1", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    text.where(odd).write.options(**options).csv(f"{folder}/a")
    text.where(~odd).select(F.lit("x").alias("More"), *CSV_COLUMNS[::-1], F.lit("y").alias("Even more")).write.options(**options).csv(f"{folder}/b")
    return read(w.spark, folder)


# --- cleaning -------------------------------------------------------------------------


@query
def load_raw(w):
    return w.table("raw_transactions")


@query
def clean_transactions(w):
    return clean.clean_transactions(w.table("raw_transactions")).drop("full_date", "year_month")


@query
def quarantine_rejects(w):
    return clean.quarantine_rejects(w.table("raw_transactions"))


@query
def cleaning_rules_catalog(w):
    return clean.cleaning_rules_catalog(w.table("raw_transactions")).select("rule_name", "target_column", "rule_type", "affected", "records_affected_pct")


for _rule in rules.CLEANING_RULES:
    # The raw rows each rule acts on.
    query(
        (lambda r: lambda w: w.table("raw_transactions").where(r.touches()).select("invoice_no", "stock_code", "quantity", "unit_price"))(_rule),
        f"rule_{_rule.name}",
    )


@query
def dim_date(w):
    return w.build("dim_date")


@query
def dim_country(w):
    return w.build("dim_country").drop("country_key", "region")


@query
def dim_product(w):
    return w.build("dim_product").drop("product_key", "product_category")


@query
def dim_customer(w):
    return w.build("dim_customer").drop("customer_key", "customer_segment")


def _fact_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "date_key", "customer_id", "stock_code", "country_name", "invoice_no", "quantity", "unit_price", "line_total", "is_cancelled", "is_return"
    )


@query
def fact_sales(w):
    return _fact_columns(w.build("fact_sales"))


@query
def fact_sales_lookup(w):
    t = w.table
    fact = star.fact_sales_lookup(t("stg_transactions_clean"), t("dim_customer"), t("dim_product"), t("dim_country"), t("dim_date"))
    return _fact_columns(fact)


@query
def predicate_forms(w):
    return w.table("stg_transactions_clean").where(
        F.col("invoice_no").like("1_0%")
        & ~F.coalesce("is_return", F.lit(False))
        & F.col("country").isin("FRANCE", "GERMANY", "JAPAN", "Unknown")
        & F.col("quantity").between(5, 40)
    ).select("invoice_no", "stock_code", "country", "quantity")


@query
def dashboard_filter(w):
    end = w.as_of()
    days = aggregate.apply_filters(w.table("mart_daily_kpis"), between={"full_date": (end - 90 * d.DAY, end)})
    return days.select("full_date", "total_revenue", "total_orders")


@query
def dashboard_filter_sets(w):
    rfm = aggregate.apply_filters(
        w.table("mart_rfm"), within={"rfm_segment": ["Champions", "At Risk"], "r_score": None}, between={"frequency": (3, None)}
    )
    return rfm.select("customer_id", "rfm_segment", "frequency")


@query
def severity_order(w):
    return w.table("ml_anomalies_daily").select("anomaly_date", "metric_name", "severity", rules.severity_order(F.col("severity")).alias("priority"))


# --- keyed writes ----------------------------------------------------------------------


def _price_list(spark, folder) -> DataFrame:
    return table(spark, folder, "part").where("p_partkey % 3 <> 0").select(
        F.col("p_partkey").alias("part"), F.round("p_retailprice", 2).alias("price"), F.lit(0).cast("bigint").alias("version")
    )


def _price_updates(spark, folder) -> DataFrame:
    """Many updates per part; the highest (order, line, price) is the newest."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("part"), F.round("l_extendedprice", 2).alias("price"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("version")
    )


@on_tables
def upsert_keyed(spark, folder):
    """Balances of all customers, updated by the newest event of those who have one."""
    path = _scratch(spark, "balances")
    balance = F.round("c_acctbal", 2).alias("amount")
    sinks.write_table(table(spark, folder, "customer").select(F.col("c_custkey").alias("customer"), balance, F.lit(-1).cast("bigint").alias("version")), path)
    events = table(spark, folder, "events").select(F.col("user_id").alias("customer"), F.col("value").alias("amount"), F.col("event_id").alias("version"))
    sinks.upsert_keyed(spark, path, events, ["customer"], ["version", "amount"])
    return sinks.read_table(spark, path)


@on_tables
def upsert_buckets(spark, folder):
    """The same balances in hash buckets: of the second batch of events only the touched buckets are written."""
    path = _scratch(spark, "bucket-balances")
    balance = F.round("c_acctbal", 2).alias("amount")
    start = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer"), balance, F.lit(-1).cast("bigint").alias("version"))
    sinks.upsert_keyed(spark, path, start, ["customer"], buckets=16)
    events = table(spark, folder, "events").select(F.col("user_id").alias("customer"), F.col("value").alias("amount"), F.col("event_id").alias("version"))
    sinks.upsert_keyed(spark, path, events.where("version % 2 = 0"), ["customer"], ["version", "amount"])
    late = sinks.merge_keyed(sinks.read_table(spark, path), events, ["customer"], ["version", "amount"])
    sinks.upsert_keyed(spark, path, late.where("version % 2 = 1"), ["customer"])
    return sinks.read_table(spark, path)


@on_tables
def load_raw_append(spark, folder):
    """Orders appended to a table year by year."""
    path = _scratch(spark, "orders")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    years = [r[0] for r in orders.select("year").distinct().orderBy("year").collect()]
    for year in years:
        sinks.load_raw_append(orders.where(F.col("year") == year), path)
    return sinks.read_table(spark, path)


@on_tables
def read_table(spark, folder):
    """A table that was replaced and replaced again, under a declared schema."""
    from basketlake.sources.readers import read_table as read

    path = _scratch(spark, "suppliers")
    for batch in (table(spark, folder, "supplier").where("s_suppkey % 2 = 0"), table(spark, folder, "supplier")):
        sinks.write_table(batch.select("s_suppkey", "s_nationkey"), path)
    return read(spark, path, "s_suppkey bigint, s_nationkey bigint")


@on_tables
def insert_if_absent(spark, folder):
    path = _scratch(spark, "parts")
    sinks.write_table(_price_list(spark, folder), path)
    rows = table(spark, folder, "part").select(
        F.col("p_partkey").alias("part"), F.lit(-1.0).alias("price"), F.lit(1).cast("bigint").alias("version")
    )
    sinks.insert_if_absent(spark, path, rows, ["part"])
    return sinks.read_table(spark, path)


@on_tables
def latest_per_key(spark, folder):
    return sinks.latest_per_key(_price_updates(spark, folder), ["part"], ["version", "price"])


@query
def acknowledge_anomaly(w):
    newest = w.table("ml_anomalies_daily").where("metric_name = 'total_revenue'").agg(F.max("anomaly_date")).first()[0]
    done = anomalies.acknowledge_anomaly(w.table("ml_anomalies_daily"), newest, "total_revenue", "analyst", "2024-01-01 00:00:00")
    return done.select("anomaly_date", "metric_name", "acknowledged", "acknowledged_by")


@query
def new_dim_members(w):
    stg = w.table("stg_transactions_clean")
    earlier = w.table("dim_customer").where(F.col("first_purchase_date") < "1996-01-01")
    return star.new_dim_members(stg, earlier, "customer_id", "customer_id")


@query
def scd1_aggregate_update(w):
    return w.build("dim_customer_rfm").drop("customer_key", "customer_segment")


@query
def merge_dimension(w):
    """Dimension of the first years, refreshed from the lines of the last ones."""
    stg = w.table("stg_transactions_clean")
    old = star.dim_product(star.product_days(stg.where("year_month < '1997-01'")))
    new = star.dim_product(star.product_days(stg.where("year_month >= '1997-01'")))
    return star.merge_dimension(old, new, "stock_code").select("stock_code", "total_quantity_sold", "total_revenue", "first_sold_date", "last_sold_date")


@query
def kpi_new_customers_join(w):
    first = marts.first_purchases(w.table("dim_customer"))
    kpis = w.table("mart_daily_kpis").select("full_date", "unique_customers")
    return kpis.join(first, "full_date", "left").select("full_date", "unique_customers", F.coalesce("new_customers", F.lit(0)).alias("new_customers"))


@query
def fact_date_orphans(w):
    """Facts outside a calendar that covers only the years 1996 to 1998."""
    dates = star.dim_date(w.spark, "1996-01-01", "1998-12-31")
    return quality.orphans(w.table("fact_sales"), dates, "date_key").agg(F.count(F.lit(1)).alias("orphans"))


@query
def semi_join(w):
    """Products bought by customers of the best segment."""
    best = w.table("mart_rfm").where("rfm_segment = 'Champions'").select("customer_id")
    return w.table("fact_sales").join(best, "customer_id", "left_semi").groupBy("stock_code").agg(F.count(F.lit(1)).alias("lines"))


@query
def star_drill(w):
    """Year by country by weekday over valid sales."""
    by_day = star.star_drill(
        w.table("fact_sales"), ["date_key", "country_name"], {"q": F.sum("quantity"), "r": money_sum(F.col("line_total"))}
    )
    dates = w.table("dim_date").select("date_key", "year", "day_name")
    return by_day.join(dates, "date_key").groupBy("year", "country_name", "day_name").agg(
        F.sum("q").alias("quantity"), money_sum(F.col("r")).alias("revenue")
    )


@query
def scalar_cross(w):
    days = w.table("mart_daily_kpis").agg(F.count(F.lit(1)).alias("kpi_days"))
    return days.select("kpi_days", w.table("mart_rfm").agg(F.count(F.lit(1))).scalar().alias("rfm_customers"))


# --- marts ---------------------------------------------------------------------------


@query
def mart_daily_kpis(w):
    return w.build("mart_daily_kpis")


@query
def rfm_metrics(w):
    return marts.rfm_metrics(w.table("agg_invoices"), w.table("mart_daily_kpis"))


@query
def rfm_scores(w):
    return marts.rfm_scores(marts.rfm_metrics(w.table("agg_invoices"), w.table("mart_daily_kpis"))).select("customer_id", "r_score", "f_score", "m_score")


@query
def mart_rfm(w):
    return w.build("mart_rfm")


@query
def rfm_segment_corrected(w):
    rfm = w.table("mart_rfm").select("customer_id", "r_score", "f_score", "m_score")
    return rfm.select("customer_id", rules.rfm_segment(True).alias("rfm_segment"), rules.segment_description(True).alias("segment_description"))


@query
def mart_country_performance(w):
    return w.build("mart_country_performance").drop("country_key")


@query
def mart_product_performance(w):
    return w.build("mart_product_performance").drop("product_key", "product_category")


@query
def product_ranks(w):
    sales = marts.product_sales(w.table("agg_product_days"), w.table("fact_sales"))
    return marts.product_ranks(sales).select("stock_code", "revenue_rank", "quantity_rank")


@query
def product_days(w):
    days = star.product_days(w.table("stg_transactions_clean"))
    return days.select("full_date", "stock_code", "description", "prices", "priced_lines", "valid_lines", "quantity", "revenue")


@query
def country_totals(w):
    return star.country_totals(w.table("agg_invoices"))


@query
def mart_monthly_trends(w):
    return w.build("mart_monthly_trends")


@query
def mom_growth(w):
    return w.table("mart_monthly_trends").select("year_month", "revenue_mom_growth", "orders_mom_growth")


@query
def yoy_growth(w):
    return marts.yoy_growth(w.table("mart_monthly_trends"))


@query
def duplicate_invoice_lines(w):
    return quality.duplicate_groups(w.table("stg_transactions_clean"), ["invoice_no", "stock_code", "quantity"])


@query
def null_rate(w):
    return quality.null_rate(w.table("stg_transactions_clean"), "customer_id")


@query
def retention_rate(w):
    return quality.retention_rate(w.table("raw_transactions"), w.table("stg_transactions_clean"))


@query
def date_range(w):
    return quality.date_range(w.table("mart_daily_kpis"), "full_date")


@query
def metric_pivot_sum(w):
    fc = w.table("ml_forecast_daily").withColumn("year", F.year("forecast_date"))
    return aggregate.metric_pivot_sum(fc, "metric_name", "predicted_value", ["total_revenue", "total_orders"], ["year"])


PROFILED = ["invoice_no", "stock_code", "description", "quantity", "unit_price", "customer_id", "country", "line_total"]


@query
def profile_columns(w):
    return quality.profile_columns(w.table("stg_transactions_clean"), "stg_transactions_clean", PROFILED, exact=True)


@query
def profile_columns_approx(w):
    return quality.profile_columns(w.table("stg_transactions_clean"), "stg_transactions_clean", PROFILED)


@query
def profile_by_month(w):
    """The stored profile without its estimates: months after the first year are sketched in a second step."""
    stg = w.table("stg_transactions_clean")
    first = [r[0] for r in stg.select("year_month").distinct().collect() if r[0] < "1996-01"]
    w.profile(first, PROFILED)
    profile = w.profile(columns=PROFILED)
    return profile.select("column_name", "total_rows", "null_count", "null_pct", "min_value", "max_value", F.round("mean_value", 2).alias("mean_value"))


@query
def distinct_values(w):
    pairs = w.table("stg_transactions_clean").select("country", "customer_id").distinct()
    return pairs.groupBy("country").agg(F.count("customer_id").alias("customers"), F.count(F.lit(1)).alias("pairs"))


@query
def table_counts(w):
    names = ["raw_transactions", "stg_transactions_clean", "dim_customer", "dim_product", "dim_country", "fact_sales", "mart_daily_kpis", "mart_rfm"]
    return quality.table_counts({n: w.table(n) for n in names})


# --- sorting and top-k ---------------------------------------------------------------


@query
def top_k(w):
    lines = w.table("fact_sales").groupBy("invoice_no").agg(money_sum(F.col("line_total")).alias("amount"))
    return aggregate.top_k(lines, "amount", 28, ["invoice_no"])


@query
def order_by_case(w):
    a = w.table("ml_anomalies_daily").orderBy(rules.severity_order(F.col("severity")), F.desc("anomaly_date"), "metric_name").limit(50)
    return a.select("anomaly_date", "metric_name", "severity")


# --- named dashboard queries ----------------------------------------------------------

for _fn in (
    d.revenue_orders_trend, d.revenue_by_country_top10, d.monthly_summary, d.monthly_distinct_customers, d.kpi_total_revenue,
    d.kpi_total_orders, d.kpi_total_customers, d.kpi_avg_order_value, d.kpi_scorecard_28d, d.cancel_return_rates, d.new_vs_repeat,
    d.executive_summary, d.country_top10, d.rfm_segment_distribution, d.rfm_segment_details, d.rfm_heatmap, d.top_customers,
    d.high_value_at_risk, d.top_products_revenue, d.top_products_quantity, d.product_tiers, d.revenue_concentration,
    d.product_delta_30d, d.country_delta_30d, d.daily_product_trend, d.growing_countries, d.products_needing_attention,
    d.moving_avg_7d, d.wow_growth, d.forecast_vs_actual_combined,
    d.future_forecasts, d.latest_forecasts, d.forecast_14d_revenue, d.forecast_14d_orders, d.yearly_outlook,
    d.actual_vs_forecast_30d, d.anomaly_table, d.anomaly_by_severity, d.latest_anomalies, d.latest_anomalies_50,
    d.critical_alert_count, d.last_data_date,
    d.period_cross,
):
    query(_fn)

for _name, _segment in (("champions", "Champions"), ("loyal", "Loyal Customers"), ("at_risk", "At Risk"), ("lost", "Hibernating")):
    query((lambda s: lambda w: d.rfm_segment_count(w, s))(_segment), f"rfm_segment_count_{_name}")


def _alert_day(w):
    """The newest day with a serious alert, as the day of alert queries."""
    return w.table("ml_anomalies_daily").where("severity in ('critical', 'high')").agg(F.max("anomaly_date")).first()[0]


for _fn in (d.recent_anomalies_7d, d.active_alerts_7d, d.active_alerts_14d, d.alert_summary):
    query((lambda fn: lambda w: fn(w, _alert_day(w)))(_fn), _fn.__name__)

query(lambda w: d.serious_anomalies_7d(w, _alert_day(w)).select("anomaly_date", "metric_name", "severity", "anomaly_type", "deviation_pct"), "serious_anomalies_7d")
query(lambda w: d.yearly_outlook(w, exact_365=True), "yearly_outlook_exact_365")


# --- chart aggregates -------------------------------------------------------------------


def chart(name: str, source: str, **spec) -> None:
    query(lambda w: aggregate.aggregate_query(w.table(source), **spec), f"chart_{name}")


chart("total_revenue", "mart_daily_kpis", metrics={"sum_total_revenue": "sum(total_revenue)"})
chart("total_orders", "mart_daily_kpis", metrics={"sum_total_orders": "sum(total_orders)"})
chart("avg_order_value", "mart_daily_kpis", metrics={"avg_order_value": "round(avg(cast(avg_order_value as double)), 4)"})
chart("revenue_trend", "mart_daily_kpis", metrics={"sum_total_revenue": "sum(total_revenue)"}, time_column="full_date")
chart("revenue_trend_monthly", "mart_daily_kpis", metrics={"sum_total_revenue": "sum(total_revenue)"}, time_column="full_date", grain="month")
chart("revenue_by_country", "mart_country_performance", metrics={"sum_total_revenue": "sum(total_revenue)"}, dims=["country_name"])
chart("monthly_performance", "mart_monthly_trends", raw_columns=["year_month", "total_revenue", "total_orders", "avg_order_value"])
chart("total_customers", "mart_rfm", metrics={"customers": "count(distinct customer_id)"})
chart("segment_distribution", "mart_rfm", metrics={"customers": "count(customer_id)"}, dims=["rfm_segment"])
chart(
    "segment_performance", "mart_rfm", dims=["rfm_segment"],
    metrics={
        "customers": "count(customer_id)",
        "avg_recency": "round(avg(cast(recency_days as double)), 4)",
        "avg_frequency": "round(avg(cast(frequency as double)), 4)",
        "avg_monetary": "round(avg(cast(monetary as double)), 4)",
    },
)
chart(
    "revenue_forecast", "ml_forecast_daily", time_column="forecast_date", filters=["metric_name = 'total_revenue'"],
    metrics={n: f"round(avg(cast({c} as double)), 4)" for n, c in (("predicted", "predicted_value"), ("lower", "lower_bound"), ("upper", "upper_bound"))},
)


@query
def chart_active_alerts(w):
    return aggregate.aggregate_query(d.active_alerts_7d(w, _alert_day(w)), {"alerts": "count(*)"}, ["anomaly_date", "metric_name", "severity", "anomaly_type"])


# --- data quality ----------------------------------------------------------------------


@query
def run_dq_checks(w):
    return quality.run_dq_checks(w.checks(), "run").drop("run_id")


for _check in (
    "raw_row_count", "staging_retention_rate", "customer_id_null_rate", "duplicate_invoice_lines", "mart_daily_kpis_populated",
    "mart_rfm_populated", "date_range_check", "fact_date_integrity",
):
    query(
        (lambda name: lambda w: next(c for c in w.checks() if c.name == name).result("run").select("check_name", "actual_value", "passed", "severity"))(_check),
        "dq_" + _check.removesuffix("_check"),
    )


@on_tables
def run_etl(spark, folder):
    """A whole refresh with checks; its steps and row counts."""
    w = Warehouse(spark, _scratch(spark, "etl"), lambda: tpch.raw_transactions(spark, folder))
    report = w.run_etl(folder, fail_on_critical=False)
    return spark.createDataFrame([(s, n) for s, n, _, _ in report if s != "data_quality_checks"], "step_name string, rows_affected bigint")


FIRST_LOAD = "2000-06-01"
_GROWN: dict[tuple, Warehouse] = {}


def _grown(spark, folder) -> Warehouse:
    """A warehouse loaded and trained twice: with the lines before a day, then with all."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _GROWN:
        raw = tpch.raw_transactions(spark, folder)
        loads = iter([raw.where(F.col("invoice_date") < FIRST_LOAD), raw])
        w = Warehouse(spark, _scratch(spark, "grown"), lambda: next(loads))
        w.run_etl("first", fail_on_critical=False, train=True, run_id="first")
        w.run_etl("second", fail_on_critical=False, run_id="second")
        _GROWN[key] = w
    return _GROWN[key]


def grown(fn: Callable[[Warehouse], DataFrame], name: str | None = None):
    """Registers a function of the warehouse that was loaded and trained twice."""
    QUERIES[name or fn.__name__] = wraps(fn)(lambda spark, folder: plain(fn(_grown(spark, folder))))
    return fn


@on_tables
def run_etl_twice(spark, folder):
    """Daily KPIs after the second load."""
    return _grown(spark, folder).table("mart_daily_kpis")


@on_tables
def run_etl_twice_log(spark, folder):
    """Rows of the refreshed tables; those of a training hold both."""
    names = ["mart_daily_kpis", "mart_rfm", "mart_product_performance", "ml_forecast_daily", "ml_model_runs"]
    return _grown(spark, folder).table("table_refresh_log").where(F.col("table_name").isin(names)).select("table_name", "row_count")


for _fn in (d.forecast_vs_actual_revenue, d.forecast_vs_actual_orders, d.model_comparison):
    grown(_fn)

grown(lambda w: d.forecast_vs_actual_revenue(w, faithful=True), "forecast_vs_actual_full")
# Forecasts of the first training against what the second load brought.
grown(d.forecast_vs_actual_combined, "forecast_kept_vs_actual")
# Times of the log are those of the run; that there is one, shows in the view.
grown(lambda w: d.v_forecast_vs_actual(w).withColumn("data_freshness", F.col("data_freshness").isNotNull()), "v_forecast_vs_actual")
grown(lambda w: d.v_model_performance(w).select("model_type", "target_metric", "total_runs", "avg_mape", "best_mape", "avg_improvement_pct", "last_run"), "v_model_performance")
grown(d.model_performance_latest)
grown(d.model_runs_latest)


@grown
def chart_model_performance(w):
    return aggregate.aggregate_query(
        d.v_model_performance(w), {"avg_mape": "round(avg(avg_mape), 4)", "best_mape": "min(best_mape)"}, ["target_metric", "model_type"]
    )


@grown
def record_model_runs(w):
    return w.table("ml_model_runs").select(
        "run_id", "model_type", "target_metric", "train_start_date", "train_end_date", "train_samples", "mape", "smape", "rmse", "mae",
        "baseline_mape", "improvement_vs_baseline_pct", "status", "notes",
    )


def _later(w, hours: int):
    """Some hours after the newest refresh the log knows."""
    return w.table("table_refresh_log").agg(F.max("last_refresh_at") + F.expr(f"interval {hours} hours")).first()[0]


@grown
def data_freshness(w):
    return d.data_freshness(w, _later(w, 12)).select("data_source", "records", "status")


@grown
def v_dashboard_freshness(w):
    return d.v_dashboard_freshness(w, _later(w, 30)).select("table_name", "row_count", "freshness_status")


@grown
def log_table_refresh(w):
    return w.table("table_refresh_log").select("table_name", "refresh_run_id", "row_count", "refresh_type")


@grown
def v_dq_summary(w):
    return quality.dq_summary(w.log("etl_run_log"), w.log("dq_check_results")).drop("started_at", "completed_at")


@grown
def run_status_exists(w):
    return quality.run_status(w.log("dq_check_results"))


@grown
def etl_run_log(w):
    return w.log("etl_run_log").select("run_id", "run_type", "status", "source_file", "rows_read", "rows_written", "rows_rejected")


# --- time series -----------------------------------------------------------------------


@query
def unpivot_metrics(w):
    return series.unpivot_metrics(w.table("mart_daily_kpis"))


@query
def fill_daily_gaps(w):
    """Daily revenue of every country, each series with its own gaps."""
    sales = w.table("fact_sales").where(star.valid_sale()).groupBy("country_name", F.col("full_date").alias("ds"))
    return series.fill_daily_gaps(sales.agg(money_sum(F.col("line_total")).cast("double").alias("value")), ["country_name"])


def _product_series(w) -> DataFrame:
    sales = w.table("fact_sales").where(star.valid_sale()).groupBy("stock_code", F.col("full_date").alias("ds"))
    return sales.agg(money_sum(F.col("line_total")).cast("double").alias("value"))


@query
def naive_weekly_forecast(w):
    return series.naive_weekly_forecast(series.fill_daily_gaps(series.unpivot_metrics(w.table("mart_daily_kpis"))), 28)


@query
def naive_weekly_forecast_many(w):
    """One forecast per article, the mean where an article has under seven days."""
    out = series.naive_weekly_forecast(_product_series(w), 14, ["stock_code"])
    return out.select("stock_code", "step", "predicted")


@query
def train_test_split_tail(w):
    filled = series.fill_daily_gaps(series.unpivot_metrics(w.table("mart_daily_kpis")))
    return series.train_test_split_tail(filled).where("is_test").select("metric_name", "ds", "value")


def _naive_pairs(w) -> DataFrame:
    filled = series.fill_daily_gaps(series.unpivot_metrics(w.table("mart_daily_kpis")))
    split = series.train_test_split_tail(filled)
    base = series.naive_weekly_forecast(split.where("NOT is_test"), 14)
    return split.where("is_test").join(base, ["metric_name", "ds"]).select("metric_name", "ds", F.col("value").alias("actual"), "predicted")


def _rounded_errors(df: DataFrame) -> DataFrame:
    return df.select("metric_name", *[F.round(c, 4).alias(c) for c in ("mape", "smape", "rmse", "mae")], "test_samples")


@query
def forecast_errors(w):
    return _rounded_errors(series.forecast_errors(_naive_pairs(w), ["metric_name"]))


def _error(name: str) -> None:
    query(lambda w: _rounded_errors(series.forecast_errors(_naive_pairs(w), ["metric_name"])).select("metric_name", name), f"eval_{name}")


for _e in ("mape", "smape", "rmse", "mae"):
    _error(_e)


@query
def backtest_native(w):
    """Errors of the native models over three rolling origins, against the naive week of the same days."""
    return forecast.score_backtest(w.table("backtest_days")).select(
        "metric_name", "model_type", "mape", "smape", "rmse", "mae", "baseline_mape", "baseline_rmse", "improvement_pct", "test_samples"
    )


@query
def improvement_pct(w):
    from basketlake.functions.errors import improvement_pct as better

    s = w.scores()
    return s.select("metric_name", "model_type", F.round(better(F.col("baseline_mape"), F.col("mape")), 4).alias("improvement_pct"))


@query
def select_best_model(w):
    """The best of the native models for the daily revenue of each country."""
    sales = w.table("fact_sales").where(star.valid_sale()).groupBy("country_name", F.col("full_date").alias("ds"))
    days = sales.agg(money_sum(F.col("line_total")).cast("double").alias("value"))
    scores = forecast.backtest(days, list(forecast.NATIVE), keys=["country_name"])
    return series.select_best_model(scores, ["country_name"])


def _native(w, name: str) -> DataFrame:
    days = series.fill_daily_gaps(series.unpivot_metrics(w.table("mart_daily_kpis")))
    return forecast.NATIVE[name](days, 28)


query(lambda w: _native(w, "weekday_mean"), "weekday_mean_forecast")
query(lambda w: _native(w, "smoothing"), "smoothing_forecast")


@query
def daytype_rolling_stats(w):
    s = anomalies.daytype_rolling_stats(series.unpivot_metrics(w.table("mart_daily_kpis")))
    return s.select("metric_name", "ds", F.round("rolling_mean", 4).alias("rolling_mean"), F.round("rolling_std", 4).alias("rolling_std"))


@query
def daytype_baseline(w):
    s = anomalies.daytype_baseline(series.unpivot_metrics(w.table("mart_daily_kpis")))
    return s.select("metric_name", "ds", "is_weekend", F.round("baseline", 4).alias("baseline"))


@query
def anomaly_zscore(w):
    z = anomalies.anomaly_zscore(w.metric_series())
    four = lambda c: F.round(c, 4).alias(c)
    return z.select("metric_name", "ds", "day_of_week", "is_weekend", four("expected"), four("std"), four("z_score"), "deviation_pct")


@query
def detect_anomalies(w):
    return _shown(anomalies.anomaly_rows(anomalies.detect_anomalies(w.metric_series())))


def _shown(found: DataFrame) -> DataFrame:
    return found.select(
        "anomaly_date", "metric_name", "actual_value", "expected_value", "deviation_pct", "anomaly_type", "severity", "is_weekend",
        "day_of_week", "business_interpretation", "recommended_action",
    )


@query
def detect_anomalies_zscore(w):
    """The z-score rule alone; a window of four rows that contains the day limits |z| to 1.5, hence the lower threshold."""
    return _shown(anomalies.anomaly_rows(anomalies.detect_anomalies(w.metric_series(), z_threshold=1.45, robust=False)))


@query
def detect_anomalies_lookback(w):
    """Four metrics over the newest 90 days."""
    found = anomalies.detect_anomalies(w.metric_series(anomalies.DETECTED_METRICS), lookback_days=90)
    return _shown(anomalies.anomaly_rows(found))


@query
def lookback_filter(w):
    return series.lookback_filter(series.unpivot_metrics(w.table("mart_daily_kpis")), 30)


@query
def ml_backtest_results(w):
    return w.build("ml_backtest_results").select(
        "metric_name", "model_type", "origin", "prediction_date", "actual_value", "predicted_value", "absolute_error", "percentage_error"
    )


@query
def ml_forecast_daily(w):
    return w.build("ml_forecast_daily").select("forecast_date", "metric_name", "predicted_value", "model_name")


# Model fits: compared by invariants in the tests, not by SQL.


@query
def forecast_ets(w):
    return forecast.forecast_ets(w.metric_series(), 14)


@query
def forecast_trend_seasonal(w):
    return forecast.forecast_trend_seasonal(w.metric_series(), 14)


@query
def backtest(w):
    return forecast.backtest(w.metric_series(), ["ets", "trend_seasonal"])


@query
def forecast_all(w):
    s = w.metric_series()
    best = series.select_best_model(forecast.backtest(s, ["ets", "trend_seasonal"]))
    return forecast.forecast_all(s, best, 365, models=["ets", "trend_seasonal"])


@query
def anomaly_isolation_forest(w):
    return anomalies.anomaly_isolation_forest(anomalies.anomaly_zscore(w.metric_series()))


@query
def detect_anomalies_forest(w):
    return anomalies.anomaly_rows(anomalies.detect_anomalies(w.metric_series(), forest=True))


# --- streaming --------------------------------------------------------------------------


@query
def stream_transactions(w):
    """Files of the raw table read as a stream into a raw table."""
    out = _scratch(w.spark, "stream-raw")
    st.stream_transactions(w.spark, _csv_folder(w, "in", 8), out, _scratch(w.spark, "cp"), files_per_batch=3).awaitTermination()
    return parts.read(w.spark, out, RAW).select(*RAW_COLUMNS)


_STREAMED: dict[tuple, Warehouse] = {}


def _refreshed(spark, folder) -> Warehouse:
    """A warehouse without a source, filled by three micro-batches of files that hold days of their own."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STREAMED:
        src = warehouse(spark, folder)
        w = Warehouse(spark, _scratch(spark, "stream-wh"))
        n = _files(src.table("raw_transactions").count(), 6)
        st.StreamRefresh(w).run(_csv_folder(src, "in", 6 * n, by_date=True), _scratch(spark, "cp"), files_per_batch=2 * n)
        _STREAMED[key] = w
    return _STREAMED[key]


@on_tables
def stream_refresh(spark, folder):
    """Daily KPIs kept up to date batch by batch; equal to a batch refresh at the end."""
    return _refreshed(spark, folder).table("mart_daily_kpis")


@on_tables
def stream_dq_checks(spark, folder):
    """Checks of the batches: each has the same number of batches, and their raw rows sum up to all."""
    results = _refreshed(spark, folder).log("dq_check_results")
    rows = F.sum(F.when(F.col("check_type") == "row_count", F.when(F.col("table_name") == "raw_transactions", F.col("actual_value").try_cast("bigint"))))
    return results.groupBy("check_name").agg(F.count_distinct("run_id").alias("batches"), rows.alias("raw_rows"))


@on_tables
def stream_run_log(spark, folder):
    """The run log a listener wrote: a line per batch, with the rows it read."""
    log = _refreshed(spark, folder).log("etl_run_log")
    return log.groupBy("run_type").agg(F.count_distinct("run_id").alias("batches"), F.count(F.lit(1)).alias("lines"), F.sum("rows_read").alias("rows_read"))


def _stream_after_source(spark, folder) -> Warehouse:
    """Lines before a day come from the source, later ones by stream; then the source is read again, in a full refresh."""
    raw = tpch.raw_transactions(spark, folder)
    early = F.coalesce(F.col("invoice_date") < FIRST_LOAD, F.lit(False))
    w = Warehouse(spark, _scratch(spark, "mixed-wh"), lambda: raw.where(early))
    path = _scratch(spark, "late-lines")
    options = {"header": True, "encoding": "ISO-8859-1", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    n = _files(table(spark, folder, "lineitem").count(), 6)  # a sixth of the lines or so come after that day, in two batches
    _file_text(raw.where(~early)).repartition(2 * n).write.options(**options).csv(path)
    st.StreamRefresh(w, full_every=2).run(path, _scratch(spark, "cp"), files_per_batch=n)
    w.run_etl("again", fail_on_critical=False)
    return w


_MIXED: dict[tuple, Warehouse] = {}


@on_tables
def stream_refresh_after_source(spark, folder):
    """Daily KPIs of a source and a stream together, after a refresh that read the source again."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MIXED:
        _MIXED[key] = _stream_after_source(spark, folder)
    return _MIXED[key].table("mart_daily_kpis")


@on_tables
def stream_keeps_raw(spark, folder):
    """Raw and staging rows of the same warehouse: no line is lost, none comes twice."""
    stream_refresh_after_source(spark, folder)
    w = _MIXED[(spark.sparkContext.applicationId, folder)]
    return quality.table_counts({n: w.table(n) for n in ("raw_transactions", "stg_transactions_clean", "fact_sales")})


@query
def stream_daily_kpis(w):
    """Event-time days with the default delay: files come in date order, and lines of every tenth invoice at the end, late."""
    out, path = _scratch(w.spark, "stream-kpis"), _scratch(w.spark, "days")
    options = {"header": True, "encoding": "ISO-8859-1", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw = w.table("raw_transactions")
    late = F.regexp_replace("invoice_no", "^C", "").cast("bigint") % 320 < 32
    year = F.coalesce(F.year("invoice_date"), F.lit(0))
    n = _files(raw.count(), 2)  # of a piece; the largest holds less than half of the lines
    for piece in (raw.where(~late & (year < 1995)), raw.where(~late & year.between(1995, 1997)), raw.where(~late & (year > 1997)), raw.where(late)):
        _file_text(piece).repartition(n).write.options(**options).mode("append").csv(path)
    st.stream_daily_kpis(w.spark, st.read_stream(w.spark, path, n), out, _scratch(w.spark, "cp")).awaitTermination()
    return st.DailyKpis(w.spark, out).table().select("full_date", "total_revenue", "total_items_sold", "lines")


@on_tables
def stream_event_days(spark, folder):
    """Daily purchases of the event table, read as a stream of files."""
    events = table(spark, folder, "events")
    src, out = _scratch(spark, "events"), _scratch(spark, "event-days")
    events.write.parquet(src)
    days = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(src)
        .where("event_type = 'purchase'")
        .groupBy(F.col("ts").cast("date").alias("ds"))
        .agg(F.count(F.lit(1)).alias("purchases"), F.sum(F.col("value").cast("decimal(18,2)")).alias("amount"))
    )
    q = (
        days.writeStream.outputMode("update")
        .option("checkpointLocation", _scratch(spark, "cp"))
        .foreachBatch(lambda df, i: sinks.upsert_keyed(spark, out, df, ["ds"]))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return sinks.read_table(spark, out)
