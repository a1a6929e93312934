"""Declared schemas. Nothing in the package infers one.

Money totals use DECIMAL(20,2): a column sized for half a million rows would
overflow (and ANSI mode would raise) on the totals of a 100 TB fact table.
Identifiers that count rows or customers are BIGINT for the same reason.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# The eight columns of the transactions file, in file order.
CSV_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

# The same eight columns under their warehouse names.
RAW_COLUMNS = [
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
]

CSV_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS])


def names(ddl: str) -> list[str]:
    """Column names of one of the DDL texts below."""
    return [c.strip().split()[0] for c in re.split(r",(?![^(]*\))", ddl)]


RAW = (
    "invoice_no string, stock_code string, description string, quantity int,"
    "invoice_date timestamp_ntz, unit_price decimal(10,2), customer_id string, country string"
)

STAGING = (
    "invoice_no string, stock_code string, description string, quantity int,"
    "invoice_date timestamp_ntz, unit_price decimal(10,2), customer_id bigint, country string,"
    "line_total decimal(18,2), is_cancelled boolean, is_return boolean, full_date date, year_month string"
)

ETL_RUN_LOG = (
    "run_id string, run_type string, started_at timestamp_ntz, completed_at timestamp_ntz,"
    "status string, source_file string, rows_read bigint, rows_written bigint,"
    "rows_rejected bigint, error_message string, metadata string"
)

DQ_RESULTS = (
    "run_id string, check_name string, check_type string, table_name string, column_name string,"
    "expected_value string, actual_value string, threshold decimal(10,4), passed boolean,"
    "declared_severity string, severity string, message string"
)

TABLE_REFRESH_LOG = (
    "table_name string, last_refresh_at timestamp_ntz, refresh_run_id string, row_count bigint,"
    "refresh_duration_ms bigint, refresh_type string"
)

MODEL_RUNS = (
    "run_id string, run_timestamp timestamp_ntz, model_type string, target_metric string,"
    "train_start_date date, train_end_date date, train_samples int, parameters string,"
    "mape decimal(12,4), smape decimal(12,4), rmse decimal(20,4), mae decimal(20,4),"
    "baseline_mape decimal(12,4), baseline_rmse decimal(20,4),"
    "improvement_vs_baseline_pct decimal(12,4), model_version string, code_version string,"
    "status string, error_message string, created_by string, notes string"
)

BACKTEST_RESULTS = (
    "run_id string, metric_name string, model_type string, origin int, prediction_date date,"
    "actual_value decimal(20,2), predicted_value decimal(20,2), lower_bound decimal(20,2),"
    "upper_bound decimal(20,2), absolute_error decimal(20,2), percentage_error decimal(12,4),"
    "within_confidence_interval boolean"
)

FORECAST_DAILY = (
    "forecast_date date, metric_name string, predicted_value decimal(20,2),"
    "lower_bound decimal(20,2), upper_bound decimal(20,2), confidence_level decimal(5,2),"
    "model_run_id string, model_name string, model_version string"
)

ANOMALIES_DAILY = (
    "anomaly_date date, metric_name string, actual_value decimal(20,2),"
    "expected_value decimal(20,2), lower_bound decimal(20,2), upper_bound decimal(20,2),"
    "deviation_pct double, z_score double, anomaly_type string, severity string,"
    "is_weekend boolean, day_of_week int, is_holiday boolean, seasonality_adjusted boolean,"
    "probable_cause string, business_interpretation string, recommended_action string,"
    "is_alert_sent boolean, alert_sent_at timestamp_ntz, acknowledged boolean,"
    "acknowledged_by string, acknowledged_at timestamp_ntz, model_run_id string"
)

# Metrics of the daily KPI table that have a time series.
KPI_METRICS = [
    "total_revenue",
    "total_orders",
    "unique_customers",
    "avg_order_value",
    "total_items_sold",
]
