"""Raw lines to staging, and the rows that did not make it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.functions.rules import (
    CLEANING_RULES,
    customer_number,
    known_text,
    reject_reason,
)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Apply the filter, impute, flag and derive rules; one narrow stage, no shuffle.

    The plain comparisons come first so they reach the Parquet scan.
    """
    col = F.col
    kept = raw.where(
        col("invoice_no").isNotNull()
        & col("stock_code").isNotNull()
        & col("invoice_date").isNotNull()
        & (col("unit_price") > 0)
        & (col("quantity") != 0)
    ).where(reject_reason().isNull())
    return kept.select(
        "invoice_no",
        "stock_code",
        known_text(col("description")).alias("description"),
        "quantity",
        "invoice_date",
        "unit_price",
        customer_number(col("customer_id")).alias("customer_id"),
        known_text(col("country")).alias("country"),
        F.round(col("quantity") * col("unit_price"), 2).cast("decimal(18,2)").alias("line_total"),
        col("invoice_no").startswith("C").alias("is_cancelled"),
        (col("quantity") < 0).alias("is_return"),
        col("invoice_date").cast("date").alias("full_date"),
        F.date_format("invoice_date", "yyyy-MM").alias("year_month"),
    )


def quarantine_rejects(raw: DataFrame) -> DataFrame:
    """Complement of :func:`clean_transactions` with the first rule each row broke."""
    return raw.withColumn("reject_reason", reject_reason()).where(F.col("reject_reason").isNotNull())


def rule_metrics(raw: DataFrame) -> DataFrame:
    """How many raw rows each cleaning rule touches: one scan for all rules."""
    counts = [F.count_if(F.coalesce(r.touches(), F.lit(False))).alias(r.name) for r in CLEANING_RULES]
    one_row = raw.agg(F.count(F.lit(1)).alias("total"), *counts)
    pairs = ", ".join(f"'{r.name}', `{r.name}`" for r in CLEANING_RULES)
    return one_row.selectExpr("total", f"stack({len(CLEANING_RULES)}, {pairs}) as (rule_name, affected)")


def cleaning_rules_catalog(raw: DataFrame) -> DataFrame:
    """The nine documented rules with the measured share of raw rows they touch."""
    meta = raw.sparkSession.createDataFrame(
        [(r.name, "raw_transactions", r.target_column, r.rule_type, r.logic, r.why, True) for r in CLEANING_RULES],
        "rule_name string, source_table string, target_column string, rule_type string,"
        "rule_logic string, business_justification string, is_active boolean",
    )
    pct = (
        F.col("affected").cast("decimal(18,0)") * 100 / F.nullif(F.col("total"), F.lit(0)).cast("decimal(18,0)")
    ).cast("decimal(5,2)")
    return meta.join(rule_metrics(raw), "rule_name").withColumn("records_affected_pct", pct).drop("total")
