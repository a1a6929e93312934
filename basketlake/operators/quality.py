"""Data quality checks, column profiles, run and refresh logs, freshness."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlake.functions.rules import freshness_status, hours_between


class DataQualityFailure(RuntimeError):
    """A critical check failed."""


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- measures: one-row frames ------------------------------------------------------


def retention_rate(raw: DataFrame, stg: DataFrame) -> DataFrame:
    """Staging rows as a percentage of raw rows, NULL when raw is empty."""
    staging_rows = stg.agg(F.count(F.lit(1))).scalar().alias("staging_rows")
    counts = raw.agg(F.count(F.lit(1)).alias("raw_rows")).select("raw_rows", staging_rows)
    return counts.withColumn("retention_pct", pct(F.col("staging_rows"), F.col("raw_rows")))


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    whole = F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return (part.cast("decimal(18,0)") * 100 / whole).cast(f"decimal(18,{scale})")


def null_rate(df: DataFrame, column: str) -> DataFrame:
    nulls = F.count_if(F.col(column).isNull())
    total = F.count(F.lit(1))
    return df.agg(total.alias("total_rows"), nulls.alias("null_rows"), pct(nulls, total).alias("null_pct"))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def date_range(df: DataFrame, day: str) -> DataFrame:
    lo, hi = F.min(day), F.max(day)
    text = F.when(lo.isNotNull(), F.concat_ws(" to ", lo.cast("string"), hi.cast("string")))
    return df.agg(lo.alias("first_day"), hi.alias("last_day"), text.alias("date_range"))


def orphans(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim.select(key), key, "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()])


# --- declarative checks -------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One check: ``measure`` is a one-row frame with a column ``actual`` (NULL fails).

    ``passes`` judges it; ``message`` is put around the actual value, and ``failure``, where there is one,
    takes its place for a check that fails.
    """

    name: str
    check_type: str
    table: str
    declared_severity: str
    measure: DataFrame
    passes: Column
    message: str
    expected: str | None = None
    column: str | None = None
    threshold: float | None = None
    unit: str = ""
    failed_severity: str = "warning"
    failure: str | None = None

    def result(self, run_id: str) -> DataFrame:
        ok = F.coalesce(self.passes, F.lit(False))
        actual = F.concat(F.col("actual").cast("string"), F.lit(self.unit))
        text = F.when(ok, self.message).otherwise(self.failure or self.message)
        return self.measure.select(
            F.lit(run_id).alias("run_id"),
            F.lit(self.name).alias("check_name"),
            F.lit(self.check_type).alias("check_type"),
            F.lit(self.table).alias("table_name"),
            F.lit(self.column).cast("string").alias("column_name"),
            F.lit(self.expected).cast("string").alias("expected_value"),
            actual.alias("actual_value"),
            F.lit(self.threshold).cast("decimal(10,4)").alias("threshold"),
            ok.alias("passed"),
            F.lit(self.declared_severity).alias("declared_severity"),
            F.when(ok, "info").otherwise(self.failed_severity).alias("severity"),
            F.replace(text, F.lit("{}"), F.coalesce(actual, F.lit("N/A"))).alias("message"),
        )


def row_count_check(name: str, table: str, measure: DataFrame, message: str, failure: str) -> Check:
    return Check(name, "row_count", table, "critical", measure, F.col("actual") > 0, message, ">0", failed_severity="critical", failure=failure)


def null_rate_check(name: str, table: str, measure: DataFrame, column: str, low: float, high: float, message: str) -> Check:
    return Check(
        name, "null_rate", table, "info", measure, F.col("actual").between(low, high), message,
        f"{low:g}-{high:g}%", column, unit="%",
    )


def duplicate_check(name: str, table: str, measure: DataFrame, limit: int, message: str) -> Check:
    return Check(name, "duplicate", table, "warning", measure, F.col("actual") < limit, message, f"<{limit}")


def range_check(name: str, table: str, measure: DataFrame, day: str, message: str) -> Check:
    return Check(name, "range", table, "info", measure, F.col("actual").isNotNull(), message, column=day, failed_severity="info")


def referential_check(name: str, table: str, measure: DataFrame, message: str) -> Check:
    return Check(name, "referential", table, "critical", measure, F.col("actual") == 0, message, "0", failed_severity="critical")


def checks_of(measures: dict[str, DataFrame]) -> list[Check]:
    """The checks for which there is a measure, a one-row frame with a column ``actual``."""
    m = measures.get
    # Names, limits, severities and message texts of the eight checks.
    every = {
        "raw_row_count": lambda x: row_count_check("raw_row_count", "raw_transactions", x, "Raw table has {} rows", "CRITICAL: Raw table is empty!"),
        "staging_retention_rate": lambda x: Check(
            "staging_retention_rate", "row_count", "stg_transactions_clean", "warning", x,
            F.col("actual") >= 85, "Staging retains {} of raw records", ">=85%", threshold=85, unit="%",
        ),
        "customer_id_null_rate": lambda x: null_rate_check(
            "customer_id_null_rate", "stg_transactions_clean", x, "customer_id", 15, 35, "CustomerID null rate: {} (anonymous purchases)"
        ),
        "duplicate_invoice_lines": lambda x: duplicate_check("duplicate_invoice_lines", "stg_transactions_clean", x, 1000, "Found {} potential duplicate line groups"),
        "mart_daily_kpis_populated": lambda x: row_count_check(
            "mart_daily_kpis_populated", "mart_daily_kpis", x, "Daily KPIs mart has {} days", "CRITICAL: Daily KPIs mart is empty!"
        ),
        "mart_rfm_populated": lambda x: row_count_check("mart_rfm_populated", "mart_rfm", x, "RFM mart has {} customers", "CRITICAL: RFM mart is empty!"),
        "date_range_check": lambda x: range_check("date_range_check", "mart_daily_kpis", x, "full_date", "Data spans: {}"),
        "fact_date_integrity": lambda x: referential_check("fact_date_integrity", "fact_sales", x, "{} fact rows have missing date dimension references"),
    }
    return [make(m(name)) for name, make in every.items() if m(name) is not None]


def standard_checks(t: dict[str, DataFrame]) -> list[Check]:
    """The eight checks of a warehouse refresh, measured on the stored tables."""
    rows = lambda df: df.agg(F.count(F.lit(1)).alias("actual"))
    stg = t["stg_transactions_clean"]
    return checks_of({
        "raw_row_count": rows(t["raw_transactions"]),
        "staging_retention_rate": retention_rate(t["raw_transactions"], stg).select(F.col("retention_pct").alias("actual")),
        "customer_id_null_rate": null_rate(stg, "customer_id").select(F.col("null_pct").alias("actual")),
        "duplicate_invoice_lines": rows(duplicate_groups(stg, ["invoice_no", "stock_code", "quantity"])),
        "mart_daily_kpis_populated": rows(t["mart_daily_kpis"]),
        "mart_rfm_populated": rows(t["mart_rfm"]),
        "date_range_check": date_range(t["mart_daily_kpis"], "full_date").select(F.col("date_range").alias("actual")),
        "fact_date_integrity": rows(orphans(t["fact_sales"], t["dim_date"], "date_key")),
    })


def raw_measures() -> dict[str, Column]:
    """Aggregates a write of raw lines takes in passing."""
    return {"raw_rows": F.count(F.lit(1))}


def staging_measures() -> dict[str, Column]:
    """Aggregates a write of staging lines takes in passing; a line without a date has no day in the calendar."""
    return {
        "staging_rows": F.count(F.lit(1)),
        "no_customer": F.count_if(F.col("customer_id").isNull()),
        "no_day": F.count_if(F.col("full_date").isNull()),
        "first_day": F.min("full_date"),
        "last_day": F.max("full_date"),
    }


def batch_checks(spark, seen: dict, mart_days: int) -> list[Check]:
    """The checks of one micro-batch, from what its writes measured: no line is read again."""
    one = spark.range(1)
    value = lambda c: one.select(c.alias("actual"))
    span = f"{seen['first_day']} to {seen['last_day']}" if seen["first_day"] else None
    return checks_of({
        "raw_row_count": value(F.lit(seen["raw_rows"])),
        "staging_retention_rate": value(pct(F.lit(seen["staging_rows"]), F.lit(seen["raw_rows"]))),
        "customer_id_null_rate": value(pct(F.lit(seen["no_customer"]), F.lit(seen["staging_rows"]))),
        "mart_daily_kpis_populated": value(F.lit(mart_days)),
        "date_range_check": value(F.lit(span).cast("string")),
        "fact_date_integrity": value(F.lit(seen["no_day"])),
    })


def run_dq_checks(checks: list[Check], run_id: str) -> DataFrame:
    """All checks as one lazy frame of result rows."""
    return union_all([c.result(run_id) for c in checks])


def run_status(results: DataFrame) -> DataFrame:
    """failed > warning > success per run, the worst failed check deciding."""
    weight = F.when(F.col("severity") == "critical", 2).when(F.col("severity") == "warning", 1).otherwise(0)
    worst = F.max(F.when(~F.col("passed"), weight).otherwise(0))
    return results.groupBy("run_id").agg(
        F.when(worst == 2, "failed").when(worst == 1, "warning").otherwise("success").alias("status")
    )


def worst_status(outcome: list) -> str:
    """The same rule for the collected results of one run."""
    bad = {r.severity for r in outcome if not r.passed}
    return "failed" if "critical" in bad else "warning" if "warning" in bad else "success"


def raise_on_critical(outcome: list) -> None:
    """Stops the run when a critical check failed."""
    bad = sorted(r.check_name for r in outcome if not r.passed and r.severity == "critical")
    if bad:
        raise DataQualityFailure("critical checks failed: " + ", ".join(bad))


# --- profile -------------------------------------------------------------------------


#: Sketch sizes as powers of two: relative error of distinct counts about 1.04 / sqrt(2^12), 1.6 %; rank error of quantiles about 1.3 %.
HLL_BITS, KLL_SIZE = 12, 200
SKETCHES = (
    "column_name string, total_rows bigint, non_null bigint, min_value string, max_value string, min_number double, max_number double,"
    "sum_value double, distinct_sketch binary, quantile_sketch binary, year_month string"
)


def column_sketches(df: DataFrame, columns: list[str] | None = None, by: str = "year_month") -> DataFrame:
    """Counts, extremes, sums and mergeable sketches per value of ``by`` and column: one scan, one row each.

    The sketches have a fixed size, so a task sends a few kilobytes a column and month, however many rows it reads.
    """
    columns = columns or [c for c in df.columns if c != by]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        number = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        aggs += [
            F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
            F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}"), F.sum(number).alias(f"s{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS)).alias(f"d{i}"),
            (F.kll_sketch_agg_double(number, F.lit(KLL_SIZE)) if c in numeric else F.lit(None).cast("binary")).alias(f"q{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col("_rows").alias("total_rows"), F.col(f"n{i}").alias("non_null"), F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
            F.col(f"a{i}").alias("min_number"), F.col(f"b{i}").alias("max_number"), F.col(f"s{i}").alias("sum_value"), F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch"),
        )
        for i, c in enumerate(columns)
    ]
    return df.groupBy(F.col(by)).agg(*aggs).select(F.explode(F.array(*rows)).alias("_r"), F.col(by).alias("year_month")).select("_r.*", "year_month")


def profile_from_sketches(sketches: DataFrame, table: str, probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all rows the sketches cover; numbers are compared as numbers, other values as text."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("non_null").alias("_n"), F.min("min_value").alias("_lo"), F.max("max_value").alias("_hi"),
        F.min_by("min_value", "min_number").alias("_a"), F.max_by("max_value", "max_number").alias("_b"), F.sum("sum_value").alias("_s"),
        F.hll_union_agg("distinct_sketch").alias("_d"), F.kll_merge_agg_double("quantile_sketch").alias("_q"), F.max("max_number").alias("_number"),
    )
    nulls = F.col("total_rows") - F.col("_n")
    number = F.col("_number").isNotNull()
    quantiles = [F.when(number, F.kll_sketch_get_quantile_double("_q", F.lit(p))).alias(f"p{round(100 * p)}") for p in probabilities]
    return merged.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "total_rows",
        nulls.alias("null_count"),
        pct(nulls, F.col("total_rows")).cast("decimal(5,2)").alias("null_pct"),
        F.when(F.col("_n") == 0, 0).otherwise(F.hll_sketch_estimate("_d")).cast("bigint").alias("distinct_count"),
        F.when(number, F.col("_a")).otherwise(F.col("_lo")).alias("min_value"),
        F.when(number, F.col("_b")).otherwise(F.col("_hi")).alias("max_value"),
        F.round(F.col("_s") / F.col("_n"), 4).alias("mean_value"),
        *quantiles,
    )


def profile_columns(df: DataFrame, table: str, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Rows, NULLs, distinct values, min, max and mean per column.

    One scan that fills sketches; distinct counts and the quartiles are then near. ``exact`` counts distinct values by
    unpivoting the columns to (column, value) pairs, which shuffle on both: one frequent value is
    combined map-side.
    """
    columns = columns or df.columns
    if not exact:
        return profile_from_sketches(column_sketches(df.withColumn("_all", F.lit("")), columns, "_all"), table)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for c in columns:
        aggs += [
            F.count(c).alias(f"n_{c}"),
            F.min(c).cast("string").alias(f"min_{c}"),
            F.max(c).cast("string").alias(f"max_{c}"),
            (F.avg(F.col(c).cast("double")) if c in numeric else F.lit(None).cast("double")).alias(f"mean_{c}"),
        ]
    parts = [f"'{c}', n_{c}, min_{c}, max_{c}, mean_{c}" for c in columns]
    wide = df.agg(*aggs).selectExpr(
        "total_rows", f"stack({len(columns)}, {', '.join(parts)}) as (column_name, _n, min_value, max_value, mean_value)"
    )
    pairs = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column_name", "_value")
    counted = pairs.where("_value IS NOT NULL").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("_d"))
    wide = wide.join(counted, "column_name", "left").withColumn("distinct_count", F.coalesce("_d", F.lit(0)))
    nulls = F.col("total_rows") - F.col("_n")
    return wide.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "total_rows",
        nulls.alias("null_count"),
        pct(nulls, F.col("total_rows")).cast("decimal(5,2)").alias("null_pct"),
        "distinct_count",
        "min_value",
        "max_value",
        F.round("mean_value", 4).alias("mean_value"),
    )


# --- logs ------------------------------------------------------------------------------


def refresh_row(spark, table: str, run_id: str, rows: int, ms: int, at, kind: str = "full") -> DataFrame:
    """One line of the refresh log; the log is keyed by table name."""
    return spark.range(1).select(
        F.lit(table).alias("table_name"),
        F.lit(str(at)).cast("timestamp_ntz").alias("last_refresh_at"),
        F.lit(run_id).alias("refresh_run_id"),
        F.lit(rows).cast("bigint").alias("row_count"),
        F.lit(ms).cast("bigint").alias("refresh_duration_ms"),
        F.lit(kind).alias("refresh_type"),
    )


def freshness(log: DataFrame, now: Column) -> DataFrame:
    """Age and status of every refreshed table at the time ``now``."""
    at = F.col("last_refresh_at")
    return log.select(
        "table_name",
        at,
        "row_count",
        F.round(hours_between(now, at), 4).alias("hours_since_refresh"),
        freshness_status(now, at).alias("freshness_status"),
    )


def dq_summary(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Passed, failed and critical counts per run; runs without checks show zeros."""
    counts = results.groupBy("run_id").agg(
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "critical")).alias("critical_failures"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return runs.join(counts, "run_id", "left").select(
        "run_id", "run_type", "started_at", "completed_at", "status",
        zero("checks_passed"), zero("checks_failed"), zero("critical_failures"),
    )
