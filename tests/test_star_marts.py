import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlake.functions import rules
from basketlake.operators import clean, marts, quality, ranking, star
from tests.conftest import rows


@pytest.fixture(scope="module")
def stg(raw):
    return clean.clean_transactions(raw).cache()


@pytest.fixture(scope="module")
def fact(stg):
    return star.fact_sales(stg)


@pytest.fixture(scope="module")
def invoices(fact):
    return star.invoice_totals(fact).cache()


def test_calendar_covers_the_data(stg):
    assert [r.full_date.day for r in star.dim_date_for(stg).orderBy("full_date").collect()] == [1, 2, 3]


def test_clean_and_quarantine_partition_raw(raw, stg):
    bad = clean.quarantine_rejects(raw)
    assert stg.count() == 7 and stg.count() + bad.count() == raw.count()
    assert dict(rows(bad.groupBy("reject_reason").count())) == {
        "missing_invoice_no": 1, "missing_stock_code": 1, "filter_null_invoice_date": 1, "filter_invalid_price": 3,
        "filter_zero_quantity": 2, "bad_customer_id": 1,
    }


def test_imputed_values_and_flags(stg):
    got = {(r.invoice_no, r.stock_code): r for r in stg.collect()}
    assert got[("536365", "71053")].description == "Unknown" and got[("536365", "71053")].customer_id == 17850
    assert got[("536366", "85123A")].customer_id is None
    assert got[("536380", "71053")].country == "Unknown" and got[("536380", "71053")].is_return
    cancelled = got[("C536379", "85123A")]
    assert cancelled.is_cancelled and cancelled.line_total == Decimal("-5.10")


def test_rule_catalogue(raw):
    got = {r.rule_name: r.affected for r in clean.cleaning_rules_catalog(raw).collect()}
    assert len(got) == 9
    assert got["filter_invalid_price"] == 3 and got["null_customer_impute"] == 1 and got["derive_line_total"] == 7


def test_calendar(spark):
    days = star.dim_date(spark, "2010-12-31", "2012-01-01").collect()
    assert len(days) == 367
    first = days[0]
    assert (first.date_key, first.month_name, first.week_of_year, first.day_of_week, first.day_name, first.is_weekend) == (
        20101231, "December", 52, 5, "Friday", False,
    )
    assert days[1].week_of_year == 52 and days[1].is_weekend  # ISO week of 1 January 2011


def test_dimensions(stg, invoices):
    countries = {r.country_name: r for r in star.dim_country(star.country_totals(invoices)).collect()}
    assert countries["United Kingdom"].total_orders == 2 and countries["United Kingdom"].total_revenue == Decimal("22.08")
    assert countries["Unknown"].total_revenue == 0 and countries["Unknown"].total_customers == 1
    products = {r.stock_code: r for r in star.dim_product(star.product_days(stg)).collect()}
    p = products["85123A"]
    assert p.description == "HEART, WHITE" and p.total_quantity_sold == 15 and p.avg_unit_price == Decimal("2.59")
    customers = {r.customer_id: r for r in star.dim_customer(invoices).collect()}
    assert set(customers) == {17850, 13047}
    assert customers[17850].total_orders == 2  # the cancelled one counts here
    assert customers[13047].first_purchase_date == dt.date(2010, 12, 2)  # dated by a return


def test_fact_by_keys_equals_fact_by_lookup(spark, stg, fact, invoices):
    dims = star.dim_customer(invoices), star.dim_product(star.product_days(stg)), star.dim_country(star.country_totals(invoices)), star.dim_date_for(stg)
    looked_up = star.fact_sales_lookup(stg, *dims)
    assert sorted(map(str, rows(looked_up.select(*fact.columns)))) == sorted(map(str, rows(fact)))
    short = star.fact_sales_lookup(stg, *dims[:3], star.dim_date(spark, "2010-12-01", "2010-12-01"))
    assert short.count() == 3


def test_lookup_of_mostly_null_customers(spark, stg, fact, invoices):
    dims = star.dim_customer(invoices), star.dim_product(star.product_days(stg)), star.dim_country(star.country_totals(invoices)), star.dim_date_for(stg)
    nulls = stg.withColumn("customer_id", F.when(F.col("invoice_no") == "536365", F.col("customer_id")))
    got = star.fact_sales_lookup(nulls, *dims)
    assert got.count() == fact.count()
    assert got.where("customer_id IS NULL AND customer_key IS NOT NULL").count() == 0
    assert got.where("customer_key IS NOT NULL").count() == nulls.where("customer_id IS NOT NULL").count() > 0


def test_daily_kpis(invoices):
    kpis = marts.mart_daily_kpis(invoices, marts.first_purchases(star.dim_customer(invoices)))
    got = {r.full_date.day: r for r in kpis.collect()}
    a, b, c = got[1], got[2], got[3]
    assert (a.total_revenue, a.total_orders, a.total_items_sold, a.unique_customers) == (Decimal("24.63"), 2, 9, 1)
    assert a.avg_order_value == Decimal("12.32") and a.new_customers == 1 and a.repeat_customers == 0
    assert (b.total_orders, b.cancelled_orders, b.return_orders) == (1, 1, 2)
    assert b.cancelled_revenue == Decimal("5.10") and b.return_revenue == Decimal("8.49")
    assert b.cancellation_rate == Decimal("0.5000") and b.return_rate == Decimal("1.0000")
    assert b.total_revenue == 0 and b.avg_order_value == 0
    assert c.total_orders == 1 and c.repeat_customers == 1


def test_insert_only_dimension(spark):
    old = spark.createDataFrame([("a", "old a", 1), ("b", "old b", 2)], "stock_code string, description string, n int")
    new = spark.createDataFrame([("b", "new b", 20), ("c", "new c", 30)], "stock_code string, description string, n int")
    got = star.merge_dimension(old, new, "stock_code").select("stock_code", "description", "n")
    assert sorted(rows(got)) == [("a", "old a", 1), ("b", "old b", 20), ("c", "new c", 30)]


def brute_ntile(values, tiles):
    n, out, at = len(values), {}, 0
    for t in range(tiles):
        size = n // tiles + (1 if t < n % tiles else 0)
        for key in values[at : at + size]:
            out[key] = t + 1
        at += size
    return out


@pytest.mark.parametrize("n", [1, 3, 7, 501])
def test_ntile(spark, n):
    rnd = random.Random(n)
    # Over a third of all rows share one value.
    data = [(i, 5 if rnd.random() < 0.4 else rnd.randint(0, 50), Decimal(rnd.randint(1, 10**6)) / 100) for i in range(n)]
    df = spark.createDataFrame(data, "id bigint, few int, many decimal(20,2)")
    got = {r.id: (r.a, r.b) for r in ranking.with_ntiles(df, "id", 5, {"a": ("few", True), "b": ("many", False)}).collect()}
    a = brute_ntile([i for i, *_ in sorted(data, key=lambda r: (-r[1], r[0]))], 5)
    b = brute_ntile([i for i, *_ in sorted(data, key=lambda r: (r[2], r[0]))], 5)
    assert got == {i: (a[i], b[i]) for i, *_ in data}


def test_rank(spark):
    rnd = random.Random(2)
    data = [(str(i), 0 if rnd.random() < 0.4 else rnd.randint(-30, 30), rnd.randint(0, 9)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, x int, y int")
    got = {r.k: (r.rx, r.ry) for r in ranking.with_ranks(df, "k", {"rx": ("x", True), "ry": ("y", False)}).collect()}
    assert got == {k: (1 + sum(o[1] > x for o in data), 1 + sum(o[2] < y for o in data)) for k, x, y in data}


def test_ranks_keep_nulls_and_decimals(spark):
    df = spark.createDataFrame([(1, 1.001, 4), (2, 1.004, None), (3, None, None), (4, 5.0, -2), (5, None, 4)], "k int, v double, w int")
    got = {r.k: (r.a, r.b) for r in ranking.with_ranks(df, "k", {"a": ("v", True), "b": ("w", False)}).collect()}
    assert got == {1: (3, 2), 2: (2, 4), 3: (4, 4), 4: (1, 1), 5: (4, 2)}
    tiles = {r.k: (r.a, r.b) for r in ranking.with_ntiles(df, "k", 3, {"a": ("v", False), "b": ("v", True)}).collect()}
    assert tiles == {1: (1, 2), 2: (1, 1), 4: (2, 1), 3: (2, 2), 5: (3, 3)}


def test_segments_over_all_scores(spark):
    scores = spark.range(125).selectExpr("cast(id div 25 + 1 as int) r_score", "cast(id div 5 % 5 + 1 as int) f_score", "cast(id % 5 + 1 as int) m_score")
    usual = dict(rows(scores.groupBy(rules.rfm_segment()).count()))
    assert "Cant Lose Them" not in usual and usual["Others"] == 9 and sum(usual.values()) == 125
    corrected = dict(rows(scores.groupBy(rules.rfm_segment(True)).count()))
    assert corrected["Cant Lose Them"] == 8 and corrected["At Risk"] == usual["At Risk"] - 8


def skewed_raw(spark, n=6000):
    """One customer, one country, one product and one day each hold about a third of the lines."""
    rnd = random.Random(5)
    hot = lambda v, other: v if rnd.random() < 0.35 else other()
    data = []
    for _ in range(n):
        inv = hot("9999", lambda: str(rnd.randint(1, 900)))
        inv = ("C" + inv) if int(inv) % 20 == 0 else inv
        at = hot(dt.datetime(2011, 5, 5, 9), lambda: dt.datetime(2011, 1, 1) + dt.timedelta(days=rnd.randint(0, 200)))
        data.append((
            inv, hot("P0", lambda: f"P{rnd.randint(1, 50)}"), "d", rnd.choice([-1, 1, 2, 5]), at, Decimal(rnd.randint(1, 999)) / 100,
            hot("1", lambda: rnd.choice(["", str(rnd.randint(2, 60))])), hot("UK", lambda: f"C{rnd.randint(1, 9)}"),
        ))
    from basketlake.schemas import RAW

    return spark.createDataFrame(data, RAW), data


def test_marts_on_skewed_lines_against_brute_force(spark):
    raw, data = skewed_raw(spark)
    stg = clean.clean_transactions(raw).cache()
    fact = star.fact_sales(stg)
    inv = star.invoice_totals(fact).cache()
    by_country, by_day = defaultdict(list), defaultdict(list)
    for r in data:
        by_country[r[7]].append(r)
        by_day[r[4].date()].append(r)
    amount = lambda rs: sum(r[3] * r[5] for r in rs if r[3] > 0 and not r[0].startswith("C"))
    live = lambda rs: len({r[0] for r in rs if not r[0].startswith("C")})
    buyers = lambda rs: len({r[6] for r in rs if r[6]})
    got = {r.country_name: (r.total_revenue, r.total_orders, r.total_customers) for r in marts.mart_country_performance(star.country_totals(inv)).collect()}
    assert got == {k: (amount(v), live(v), buyers(v)) for k, v in by_country.items()}
    kpis = marts.mart_daily_kpis(inv, marts.first_purchases(star.dim_customer(inv)))
    got = {r.full_date: (r.total_revenue, r.total_orders, r.unique_customers, r.return_orders) for r in kpis.collect()}
    assert got == {k: (amount(v), live(v), buyers(v), len({r[0] for r in v if r[3] < 0})) for k, v in by_day.items()}
    products = marts.mart_product_performance(marts.product_sales(star.product_days(stg), fact), star.dim_product(star.product_days(stg)))
    assert products.agg(F.sum("total_revenue")).first()[0] == amount(data)
    shares = marts.mart_country_performance(star.country_totals(inv)).agg(F.sum("revenue_share_pct")).first()[0]
    assert abs(float(shares) - 100) < 0.1


def test_quality_checks_and_status(spark, raw, stg, fact, invoices):
    kpis = marts.mart_daily_kpis(invoices, marts.first_purchases(star.dim_customer(invoices)))
    t = {
        "raw_transactions": raw, "stg_transactions_clean": stg, "mart_daily_kpis": kpis, "mart_rfm": marts.rfm_metrics(invoices, kpis),
        "fact_sales": fact, "dim_date": star.dim_date(spark, "2010-12-01", "2010-12-02"),
    }
    out = {r.check_name: r for r in quality.run_dq_checks(quality.standard_checks(t), "r1").collect()}
    assert out["raw_row_count"].passed and out["raw_row_count"].actual_value == "16"
    assert out["staging_retention_rate"].actual_value == "43.75%" and out["staging_retention_rate"].severity == "warning"
    assert out["duplicate_invoice_lines"].actual_value == "1"
    assert out["fact_date_integrity"].actual_value == "2" and out["fact_date_integrity"].severity == "critical"
    assert out["date_range_check"].message == "Data spans: 2010-12-01 to 2010-12-03"
    results = list(out.values())
    assert quality.worst_status(results) == "failed"
    with pytest.raises(quality.DataQualityFailure, match="fact_date_integrity"):
        quality.raise_on_critical(results)


def test_checks_on_an_empty_warehouse(spark, raw, stg, fact, invoices):
    kpis = marts.mart_daily_kpis(invoices, marts.first_purchases(star.dim_customer(invoices)))
    none = lambda df: df.where("false")
    t = {
        "raw_transactions": none(raw), "stg_transactions_clean": none(stg), "mart_daily_kpis": none(kpis),
        "mart_rfm": none(kpis), "fact_sales": none(fact), "dim_date": star.dim_date(spark, "2010-12-01", "2010-12-02"),
    }
    out = {r.check_name: r.passed for r in quality.run_dq_checks(quality.standard_checks(t), "r1").collect()}
    assert not any(out[c] for c in ("raw_row_count", "staging_retention_rate", "customer_id_null_rate", "date_range_check"))
    assert out["duplicate_invoice_lines"] and out["fact_date_integrity"]


def test_country_counts_need_no_expand(spark, invoices):
    totals = star.country_totals(invoices)
    for df in (star.dim_country(totals), marts.mart_country_performance(totals)):
        plan = df._jdf.queryExecution().toString()
        assert "Expand" not in plan and "Exchange" in plan
    # An invoice of two countries counts in both, and once in all.
    both = spark.createDataFrame(
        [("1", "A", 1, False, "2.00"), ("1", "B", 1, False, "3.00"), ("2", "B", None, False, "4.00"), ("C3", "B", 2, True, "0.00"), ("1", "A", 3, False, "1.00")],
        "invoice_no string, country_name string, customer_id bigint, is_cancelled boolean, revenue string",
    ).withColumn("revenue", F.col("revenue").cast("decimal(20,2)"))
    got = {r.country_name: (r.total_orders, r.live_orders, r.counted_orders, r.total_customers, str(r.total_revenue)) for r in star.country_totals(both).collect()}
    assert got == {"A": (1, 1, 1, 2, "3.00"), "B": (3, 2, 1, 2, "7.00")}
    share = {r.country_name: str(r.orders_share_pct) for r in marts.mart_country_performance(star.country_totals(both)).collect()}
    assert share == {"A": "50.00", "B": "100.00"}


def test_product_days(stg):
    got = {(r.full_date.day, r.stock_code): r for r in star.product_days(stg).collect()}
    assert len(got) == 5
    first, returned, last = got[(1, "85123A")], got[(2, "71053")], got[(3, "85123A")]
    assert (first.quantity, str(first.revenue), first.valid_lines, first.priced_lines, str(first.prices)) == (7, "17.85", 2, 2, "5.10")
    assert (returned.quantity, returned.valid_lines, str(returned.revenue)) == (0, 0, "0.00")
    assert last.description == "HEART, WHITE" and last.first_at == last.last_at


def test_failed_checks_have_texts_of_their_own(spark):
    seen = {"raw_rows": 0, "staging_rows": 0, "no_customer": 0, "no_day": 0, "first_day": None, "last_day": None}
    bad = {r.check_name: r for r in quality.run_dq_checks(quality.batch_checks(spark, seen, 0), "b").collect()}
    assert bad["raw_row_count"].message == "CRITICAL: Raw table is empty!" and bad["mart_daily_kpis_populated"].message == "CRITICAL: Daily KPIs mart is empty!"
    assert bad["date_range_check"].message == "Data spans: N/A" and bad["staging_retention_rate"].severity == "warning"
    seen = {"raw_rows": 10, "staging_rows": 9, "no_customer": 2, "no_day": 0, "first_day": dt.date(2011, 1, 1), "last_day": dt.date(2011, 1, 2)}
    good = {r.check_name: r for r in quality.run_dq_checks(quality.batch_checks(spark, seen, 5), "b").collect()}
    assert all(r.passed for r in good.values()) and len(good) == 6
    assert good["raw_row_count"].message == "Raw table has 10 rows" and good["staging_retention_rate"].actual_value == "90.00%"
    assert good["customer_id_null_rate"].actual_value == "22.22%" and good["date_range_check"].actual_value == "2011-01-01 to 2011-01-02"


def test_profile_exact_and_near(spark, stg):
    columns = ["country", "quantity", "customer_id"]
    exact = {r.column_name: r for r in quality.profile_columns(stg, "stg", columns, exact=True).collect()}
    assert (exact["country"].distinct_count, exact["country"].min_value) == (3, "France")
    assert exact["customer_id"].null_count == 1 and str(exact["customer_id"].null_pct) == "14.29"
    assert exact["quantity"].mean_value == pytest.approx(2.0)
    near = {r.column_name: r for r in quality.profile_columns(stg, "stg", columns).collect()}
    for c in columns:
        assert [near[c][f] for f in ("total_rows", "null_count", "distinct_count", "min_value", "max_value")] == [exact[c][f] for f in ("total_rows", "null_count", "distinct_count", "min_value", "max_value")]
    assert near["quantity"].min_value == "-2" and near["country"].p50 is None
    plan = quality.profile_columns(stg, "stg", columns)._jdf.queryExecution().toString()
    assert "Expand" not in plan and plan.split("== Physical Plan ==")[1].count("InMemoryTableScan") == 1


def test_profile_estimates_stay_within_their_bounds(spark):
    n = 60_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("v"), (F.col("id") * F.col("id") / 7.0).alias("x"), F.lit(None).cast("string").alias("none"), F.lit("2011-01").alias("year_month"))
    got = {r.column_name: r for r in quality.profile_columns(df, "t", ["v", "x", "none"]).collect()}
    true = df.select("v").distinct().count()
    assert abs(got["v"].distinct_count - true) < 0.05 * true and abs(got["x"].distinct_count - n) < 0.05 * n
    for p in (25, 50, 75):
        rank = df.where(F.col("x") <= got["x"][f"p{p}"]).count() / n
        assert abs(rank - p / 100) < 0.03
    assert (got["none"].null_count, got["none"].distinct_count, got["none"].min_value, got["none"].p50) == (n, 0, None, None)


def test_sketches_of_months_add_up(spark):
    df = spark.range(3000).select(F.concat(F.lit("2011-0"), (F.col("id") % 3 + 1).cast("string")).alias("year_month"), (F.col("id") % 700).alias("v"))
    sketches = quality.column_sketches(df, ["v"])
    assert sketches.count() == 3
    one, many = quality.profile_columns(df, "t", ["v"]).first(), quality.profile_from_sketches(sketches, "t").first()
    assert [one[f] for f in ("total_rows", "min_value", "max_value", "mean_value")] == [many[f] for f in ("total_rows", "min_value", "max_value", "mean_value")]
    assert abs(many.distinct_count - 700) < 40
