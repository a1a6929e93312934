"""Analytic marts over the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlake.functions.amounts import MONEY, avg_exact, change_pct, money_sum, ratio, share
from basketlake.functions.rules import date_key, rfm_segment, segment_description
from basketlake.operators.ranking import with_ntiles, with_ranks
from basketlake.operators.star import distinct_per_key, left_join_all


def first_purchases(customers: DataFrame) -> DataFrame:
    """New customers per day of first purchase."""
    return (
        customers.where(F.col("first_purchase_date").isNotNull())
        .groupBy(F.col("first_purchase_date").alias("full_date"))
        .agg(F.count(F.lit(1)).alias("new_customers"))
    )


def mart_daily_kpis(invoices: DataFrame, new_customers: DataFrame) -> DataFrame:
    """Thirteen KPIs per day with sales, from invoice totals.

    An invoice is cancelled as a whole (the flag is its number's prefix), so
    counting (day, invoice) rows replaces four distinct counts. Customers
    are counted apart. ``new_customers`` is :func:`first_purchases` or the like. All
    joins are at day level: a few thousand rows.
    """
    per_invoice = invoices.groupBy("full_date", "invoice_no").agg(
        F.max("is_cancelled").alias("cancelled"),
        F.max("has_return").alias("returned"),
        *[F.sum(c).alias(c) for c in ("revenue", "items", "cancelled_amount", "returned_amount")],
    )
    days = per_invoice.groupBy("full_date").agg(
        F.sum("revenue").cast(MONEY).alias("total_revenue"),
        F.count_if(~F.col("cancelled")).alias("total_orders"),
        F.sum("items").alias("total_items_sold"),
        F.count_if("cancelled").alias("cancelled_orders"),
        F.abs(F.sum("cancelled_amount")).cast(MONEY).alias("cancelled_revenue"),
        F.count_if("returned").alias("return_orders"),
        F.abs(F.sum("returned_amount")).cast(MONEY).alias("return_revenue"),
        F.count(F.lit(1)).alias("_invoices"),
    )
    buyers = distinct_per_key(invoices, ["full_date"], "customer_id", "unique_customers")
    joined = left_join_all(days, [buyers, new_customers], ["full_date"])
    unique = F.coalesce("unique_customers", F.lit(0))
    new = F.coalesce("new_customers", F.lit(0))
    zero = F.lit(0)
    return joined.select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        "total_revenue",
        "total_orders",
        "total_items_sold",
        unique.alias("unique_customers"),
        F.coalesce(ratio(F.col("total_revenue"), F.col("total_orders"), 2), zero).cast(MONEY).alias("avg_order_value"),
        "cancelled_orders",
        "cancelled_revenue",
        "return_orders",
        "return_revenue",
        ratio(F.col("cancelled_orders"), F.col("_invoices"), 4).cast("decimal(5,4)").alias("cancellation_rate"),
        ratio(F.col("return_orders"), F.col("_invoices"), 4).cast("decimal(5,4)").alias("return_rate"),
        new.alias("new_customers"),
        F.greatest(unique - new, zero).alias("repeat_customers"),
    )


def rfm_metrics(invoices: DataFrame, kpis: DataFrame, as_of=None) -> DataFrame:
    """Recency, frequency and monetary value per customer over uncancelled invoices."""
    per_customer = (
        invoices.where("customer_id IS NOT NULL AND NOT is_cancelled")
        .groupBy("customer_id")
        .agg(
            F.max("full_date").alias("_last"),
            F.count_distinct("invoice_no").alias("frequency"),
            money_sum(F.col("revenue")).alias("monetary"),
        )
    )
    today = kpis.agg(F.max("full_date")).scalar() if as_of is None else F.lit(str(as_of)).cast("date")
    return per_customer.select(
        "customer_id", F.datediff(today, "_last").alias("recency_days"), "frequency", "monetary"
    )


def rfm_scores(metrics: DataFrame) -> DataFrame:
    """Quintiles of customers with positive value; ties broken by customer_id."""
    return with_ntiles(
        metrics.where("monetary > 0"),
        "customer_id",
        5,
        {"r_score": ("recency_days", True), "f_score": ("frequency", False), "m_score": ("monetary", False)},
    )


def mart_rfm(invoices: DataFrame, kpis: DataFrame, as_of=None, corrected: bool = False) -> DataFrame:
    return rfm_scores(rfm_metrics(invoices, kpis, as_of)).select(
        "*",
        F.concat("r_score", "f_score", "m_score").alias("rfm_score"),
        rfm_segment(corrected).alias("rfm_segment"),
        segment_description(corrected).alias("segment_description"),
    )


def mart_country_performance(totals: DataFrame) -> DataFrame:
    """Revenue, orders, customers, AOV and shares per country, from :func:`star.country_totals`.

    An invoice may span two countries, so the share's base is not the sum of their orders.
    """
    all_revenue = totals.agg(money_sum(F.col("total_revenue"))).scalar()
    all_orders = totals.agg(F.sum("counted_orders")).scalar()
    zero = F.lit(0)
    n_orders = F.col("live_orders")
    return totals.select(
        F.xxhash64("country_name").alias("country_key"),
        "country_name",
        "total_revenue",
        n_orders.alias("total_orders"),
        "total_customers",
        F.coalesce(ratio(F.col("total_revenue"), n_orders, 2), zero).cast(MONEY).alias("avg_order_value"),
        F.coalesce(share(F.col("total_revenue"), all_revenue), zero).cast("decimal(5,2)").alias("revenue_share_pct"),
        F.coalesce(ratio(n_orders, all_orders, 2, per=100), zero).cast("decimal(5,2)").alias("orders_share_pct"),
    )


def product_sales(days: DataFrame, fact: DataFrame) -> DataFrame:
    """Sums per article from :func:`star.product_days`, and its uncancelled invoices from the lines.

    An invoice may span days, so invoices are counted over the lines; that shuffle carries (article, invoice) only.
    """
    sums = days.groupBy("stock_code").agg(
        money_sum(F.col("revenue")).alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        ratio(F.sum("prices"), F.sum("priced_lines"), 2).cast(MONEY).alias("avg_unit_price"),
    )
    orders = distinct_per_key(fact.where(~F.col("is_cancelled")), ["stock_code"], "invoice_no", "total_orders")
    return sums.join(orders, "stock_code", "left").withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))


def product_ranks(sales: DataFrame) -> DataFrame:
    return with_ranks(
        sales, "stock_code", {"revenue_rank": ("total_revenue", True), "quantity_rank": ("total_quantity", True)}
    )


def mart_product_performance(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Ranked sales per article; ``sales`` from :func:`product_sales`."""
    return (
        product_ranks(sales)
        .join(products.select("stock_code", "product_key", "description", "product_category"), "stock_code")
        .select(
            "product_key",
            "stock_code",
            "description",
            "product_category",
            "total_revenue",
            "total_quantity",
            "total_orders",
            "avg_unit_price",
            F.col("revenue_rank").cast("bigint").alias("revenue_rank"),
            F.col("quantity_rank").cast("bigint").alias("quantity_rank"),
        )
    )


def mart_monthly_trends(kpis: DataFrame) -> DataFrame:
    """Month totals with month-over-month growth in percent.

    The window has no partition, but its input is one row per calendar month.
    """
    months = kpis.groupBy(F.date_format("full_date", "yyyy-MM").alias("year_month")).agg(
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("unique_customers").alias("total_customers"),
        avg_exact(F.col("avg_order_value")).cast(MONEY).alias("avg_order_value"),
        ratio(F.sum("total_revenue"), F.sum("total_orders"), 2).cast(MONEY).alias("aov_weighted"),
    )
    w = Window.orderBy("year_month")
    return months.select(
        "year_month",
        F.substring("year_month", 1, 4).cast("int").alias("year"),
        F.substring("year_month", 6, 2).cast("int").alias("month"),
        "total_revenue",
        "total_orders",
        "total_customers",
        "avg_order_value",
        "aov_weighted",
        change_pct(F.col("total_revenue"), F.lag("total_revenue").over(w), 4).alias("revenue_mom_growth"),
        change_pct(F.col("total_orders"), F.lag("total_orders").over(w), 4).alias("orders_mom_growth"),
    )


def yoy_growth(months: DataFrame) -> DataFrame:
    """Month against the same month a year earlier; months may be missing, so by key, not by lag."""
    prev = months.select(
        (F.col("year") + 1).alias("year"),
        "month",
        F.col("total_revenue").alias("prev_year_revenue"),
        F.col("total_orders").alias("prev_year_orders"),
    )
    return months.join(prev, ["year", "month"], "left").select(
        "year_month",
        "total_revenue",
        "prev_year_revenue",
        change_pct(F.col("total_revenue"), F.col("prev_year_revenue")).alias("revenue_yoy_pct"),
        "total_orders",
        "prev_year_orders",
        change_pct(F.col("total_orders"), F.col("prev_year_orders")).alias("orders_yoy_pct"),
    )
