"""Star schema: calendar, three member dimensions, the sales fact.

Surrogate keys are functions of the natural key, so every task computes the
same key without a lookup and the fact needs no join. The fact also carries the
natural keys (cheap as Parquet dictionaries): marts group by those, so a hash
collision could never merge two members.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlake.functions.amounts import money_sum, ratio, sum_if
from basketlake.functions.rules import date_key

VALID_SALE = "NOT is_cancelled AND NOT is_return"


def surrogate_key(natural: Column) -> Column:
    return F.xxhash64(natural)


def valid_sale() -> Column:
    return F.expr(VALID_SALE)


def distinct_per_key(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """COUNT(DISTINCT value) per key in two aggregations.

    The heavy shuffle is on (key, value), so a key holding a third of all rows
    is spread over the tasks; only one partial count per task meets at the key.
    """
    pairs = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def left_join_all(base: DataFrame, others: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left-join aggregates that are already hash-partitioned on the same keys."""
    return reduce(lambda a, b: a.join(b, keys, "left"), others, base)


# --- dimensions -----------------------------------------------------------------


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """Calendar from ``start`` to ``end`` (dates or ISO text), both included."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("start_date"), F.lit(str(end)).cast("date").alias("end_date")
    )
    return calendar(bounds)


def dim_date_for(sales: DataFrame, day: str = "full_date") -> DataFrame:
    """Calendar that covers the data, so no sale can fall outside it."""
    return calendar(sales.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date")))


def calendar(bounds: DataFrame) -> DataFrame:
    day = F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day")))
    d = F.col("full_date")
    return (
        bounds.where(F.col("start_date").isNotNull())
        .select(day.alias("full_date"))
        .select(
            date_key(d).alias("date_key"),
            d,
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.weekofyear(d).alias("week_of_year"),
            F.dayofmonth(d).alias("day_of_month"),
            (F.dayofweek(d) - 1).alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
            F.year(d).alias("fiscal_year"),
            F.quarter(d).alias("fiscal_quarter"),
        )
    )


def country_totals(invoices: DataFrame) -> DataFrame:
    """Per country: revenue, invoices, uncancelled invoices and customers, without a row blow-up.

    One shuffle on the invoice serves all counts of invoices: there an invoice has a row per country it names, and
    the first of its countries counts it once for the total over all countries. Customers take a second
    shuffle, on (country, customer). ``counted_orders`` summed up is the number of uncancelled invoices.
    """
    invoice = Window.partitionBy("invoice_no").orderBy("country_name")
    pairs = (
        invoices.repartition("invoice_no")
        .groupBy("invoice_no", "country_name")
        .agg(F.sum("revenue").alias("_revenue"), F.max("is_cancelled").alias("_cancelled"))
        .withColumn("_first", F.row_number().over(invoice) == 1)
    )
    live = ~F.col("_cancelled")
    totals = pairs.groupBy("country_name").agg(
        money_sum(F.col("_revenue")).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(live).alias("live_orders"),
        F.count_if(live & F.col("_first")).alias("counted_orders"),
    )
    customers = distinct_per_key(invoices, ["country_name"], "customer_id", "total_customers")
    joined = totals.join(customers, "country_name", "left")
    return joined.withColumn("total_customers", F.coalesce("total_customers", F.lit(0)))


def dim_country(totals: DataFrame) -> DataFrame:
    """Per country: customers, invoices (cancelled ones too), valid revenue; from :func:`country_totals`."""
    return totals.select(
        surrogate_key(F.col("country_name")).alias("country_key"),
        "country_name",
        F.lit(None).cast("string").alias("region"),
        "total_customers",
        "total_orders",
        "total_revenue",
    )


def product_days(stg: DataFrame) -> DataFrame:
    """Lines summed to (day, article): what product tables and trends are made from.

    ``description`` is the newest text of the day. An aggregate of one shuffle that combines map-side; a
    row_number window would send every line of a best seller to one task.
    """
    newest = F.max(F.struct("invoice_date", "description"))
    valid = valid_sale()
    return (
        stg.groupBy("year_month", "full_date", "stock_code")
        .agg(
            newest.alias("_newest"),
            F.min("invoice_date").alias("first_at"),
            F.sum("unit_price").alias("prices"),
            F.count("unit_price").alias("priced_lines"),
            F.count_if(valid).alias("valid_lines"),
            sum_if(valid, F.col("quantity")).cast("bigint").alias("quantity"),
            money_sum(F.when(valid, F.col("line_total")).otherwise(0)).alias("revenue"),
        )
        .select(
            "full_date", "stock_code", F.col("_newest.description").alias("description"), "first_at", F.col("_newest.invoice_date").alias("last_at"),
            F.col("prices").cast("decimal(20,2)").alias("prices"), "priced_lines", "valid_lines", "quantity", "revenue", "year_month",
        )
    )


def dim_product(days: DataFrame) -> DataFrame:
    """Per article: latest description, valid quantity and revenue, price, first and last sale; from :func:`product_days`."""
    return (
        days.groupBy("stock_code")
        .agg(
            F.max(F.struct("last_at", "description")).getField("description").alias("description"),
            ratio(F.sum("prices"), F.sum("priced_lines"), 2).alias("avg_unit_price"),
            F.sum("quantity").alias("total_quantity_sold"),
            money_sum(F.col("revenue")).alias("total_revenue"),
            F.min("first_at").cast("date").alias("first_sold_date"),
            F.max("last_at").cast("date").alias("last_sold_date"),
        )
        .select(
            surrogate_key(F.col("stock_code")).alias("product_key"),
            "stock_code",
            "description",
            F.lit(None).cast("string").alias("product_category"),
            "avg_unit_price",
            "total_quantity_sold",
            "total_revenue",
            "first_sold_date",
            "last_sold_date",
        )
    )


def dim_customer(invoices: DataFrame) -> DataFrame:
    """Per known customer: first and last date, invoices (cancelled ones too), revenue, AOV."""
    return (
        invoices.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.min("full_date").alias("first_purchase_date"),
            F.max("full_date").alias("last_purchase_date"),
            F.count_distinct("invoice_no").alias("total_orders"),
            money_sum(F.col("revenue")).alias("total_revenue"),
        )
        .select(
            surrogate_key(F.col("customer_id")).alias("customer_key"),
            "customer_id",
            "first_purchase_date",
            "last_purchase_date",
            "total_orders",
            "total_revenue",
            F.coalesce(ratio(F.col("total_revenue"), F.col("total_orders"), 2), F.lit(0)).alias("avg_order_value"),
            F.lit(None).cast("string").alias("customer_segment"),
        )
    )


def dim_customer_with_rfm(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    """Back-fill of the RFM scores and segment into the customer dimension."""
    scores = rfm.select(
        "customer_id",
        F.col("r_score").alias("rfm_recency_score"),
        F.col("f_score").alias("rfm_frequency_score"),
        F.col("m_score").alias("rfm_monetary_score"),
        "rfm_segment",
    )
    return scd1_aggregate_update(customers, scores, ["customer_id"])


# --- incremental dimension upkeep ----------------------------------------------


def new_dim_members(stg: DataFrame, existing: DataFrame, stg_key: str, dim_key: str) -> DataFrame:
    """Members seen in staging and missing from the dimension."""
    seen = stg.where(F.col(stg_key).isNotNull()).select(F.col(stg_key).alias(dim_key)).distinct()
    return seen.join(existing.select(dim_key), dim_key, "left_anti")


def scd1_aggregate_update(dim: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Overwrite dimension columns with fresh values where the key has any.

    Columns of ``fresh`` the dimension lacks are added.
    """
    names = [c for c in fresh.columns if c not in keys]
    renamed = fresh.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in names])
    out = dim.join(renamed, keys, "left")
    for c in names:
        old = F.col(c) if c in dim.columns else F.lit(None)
        out = out.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old))
    return out.drop("_hit", *[f"_new_{c}" for c in names])


def merge_dimension(existing: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Insert-only dimension: refreshed members take the new aggregates, others stay.

    Text a member got when it was first inserted (description) is kept, and a
    member that has vanished from staging keeps its last values.
    """
    update = fresh.drop("description") if "description" in fresh.columns else fresh
    updated = scd1_aggregate_update(existing, update, [key])
    added = fresh.join(existing.select(key), key, "left_anti")
    return updated.unionByName(added, allowMissingColumns=True)


# --- fact ------------------------------------------------------------------------


def fact_sales(stg: DataFrame) -> DataFrame:
    """One row per staging line: a projection, no shuffle.

    The warehouse keeps it as a view of staging, so the largest table is written
    once. Keys nobody selects are never computed, and filters on the day and the
    month reach the stored files.
    """
    d = F.col("full_date")
    return stg.select(
        date_key(d).alias("date_key"),
        F.when(F.col("customer_id").isNotNull(), surrogate_key(F.col("customer_id"))).alias("customer_key"),
        surrogate_key(F.col("stock_code")).alias("product_key"),
        surrogate_key(F.col("country")).alias("country_key"),
        "invoice_no",
        "quantity",
        "unit_price",
        "line_total",
        "is_cancelled",
        "is_return",
        "full_date",
        "customer_id",
        "stock_code",
        F.col("country").alias("country_name"),
        "year_month",
    )


def invoice_totals(fact: DataFrame) -> DataFrame:
    """Lines summed to (day, invoice, country, customer): what every count of invoices or
    customers is made from.

    One shuffle of the lines serves the daily, country and customer tables. An
    invoice that spans days, countries or customers keeps a row for each.
    """
    line = F.col("line_total")
    return fact.groupBy("full_date", "invoice_no", "country_name", "customer_id").agg(
        F.max("is_cancelled").alias("is_cancelled"),
        F.max("is_return").alias("has_return"),
        money_sum(F.when(valid_sale(), line).otherwise(0)).alias("revenue"),
        sum_if(valid_sale(), F.col("quantity")).cast("bigint").alias("items"),
        money_sum(F.when(F.col("is_cancelled"), line).otherwise(0)).alias("cancelled_amount"),
        money_sum(F.when(F.col("is_return"), line).otherwise(0)).alias("returned_amount"),
    )


def fact_sales_lookup(
    stg: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame, dates: DataFrame
) -> DataFrame:
    """Fact against dimensions that were loaded elsewhere (their keys, their coverage).

    Customer is a left join, the others are inner and drop uncovered lines. Lines
    without a customer, a large share of all, match none: they pass beside the join,
    so that no task gathers them. No side is forced to broadcast: Spark compares each
    dimension with its size threshold and AQE splits the hot keys of the shuffled joins.
    """
    lines = fact_sales(stg).drop("customer_key", "product_key", "country_key")
    keys = customers.select("customer_id", "customer_key")
    known = lines.where("customer_id IS NOT NULL").join(keys, "customer_id", "left")
    none = F.lit(None).cast(keys.schema["customer_key"].dataType)
    unknown = lines.where("customer_id IS NULL").withColumn("customer_key", none)
    return (
        known.unionByName(unknown)
        .join(products.select("stock_code", "product_key"), "stock_code")
        .join(countries.select("country_name", "country_key"), "country_name")
        .join(dates.select("date_key"), "date_key", "left_semi")
    )


def star_drill(fact: DataFrame, by: list[str], measures: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Drill-down over valid sales: filter, then one partial and one final aggregate."""
    sales = fact.where(valid_sale())
    if where is not None:
        sales = sales.where(where)
    return sales.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])
