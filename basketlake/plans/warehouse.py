"""The warehouse: layered Parquet tables, each built from earlier ones.

A table is written once, under the shared folder, when it is first needed, and
read from there afterwards. That cuts lineage for good: a lost executor costs a
re-read, not a rebuild.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlake.operators import anomalies, clean, forecast, marts, quality, series, star
from basketlake.schemas import DQ_RESULTS, ETL_RUN_LOG, RAW, STAGING, TABLE_REFRESH_LOG, names
from basketlake.shared import shared_dir, shuffles_freed
from basketlake.sources import parts, sinks

TRAINED_METRICS = ["total_revenue", "total_orders"]
BY_MONTH = "year_month"

# A full refresh: tables of one group only need tables of earlier groups, so a group's
# writes are started together and share the cluster. The two that shuffle all lines come one after the other:
# each fills the cluster, and only one shuffle of that size lies on disk at a time.
STEPS = [
    ["stg_transactions_clean"],
    ["fact_sales"],
    ["agg_invoices"],
    ["agg_product_days"],
    ["agg_countries", "dim_date", "dim_product", "dim_customer"],
    ["dim_country", "mart_country_performance", "mart_product_performance"],
    ["mart_daily_kpis"],
    ["mart_rfm", "mart_monthly_trends"],
    # RFM columns go to a table of their own: no run rewrites a dimension it has just read.
    ["dim_customer_rfm"],
]
# A training, over the tables above. Its rows are merged by key, so that earlier forecasts can be
# held against what happened, and earlier runs stay.
TRAINING = [["backtest_days"], ["ml_backtest_results", "ml_forecast_daily", "ml_anomalies_daily"], ["ml_model_runs"]]
KEPT = {
    "ml_backtest_results": ["run_id", "origin", "prediction_date"],
    "ml_model_runs": ["run_id"],
    "ml_forecast_daily": ["forecast_date", "metric_name"],
    "ml_anomalies_daily": ["anomaly_date", "metric_name"],
}
# Stored tables that are views: the fact is a projection of staging.
VIEWS = {"fact_sales": "stg_transactions_clean"}
# Tables that streams add to, apart from what the source filled: (folder of the streamed part, schema). Reading the
# source again replaces its part and leaves the streamed one.
STREAMED = {"raw_transactions": ("stream_raw", RAW), "stg_transactions_clean": ("stream_staging", STAGING)}
# Logs, to which streams add likewise.
LOGS = {"dq_check_results": DQ_RESULTS, "etl_run_log": ETL_RUN_LOG}
MONTHLY = {"stg_transactions_clean", "agg_product_days"}


class Warehouse:
    """Tables by name. ``raw`` gives the raw transactions when none are stored yet.

    ``models`` are the forecast candidates; ``z_threshold``, ``robust_threshold`` and ``forest`` tune
    the anomaly table.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        raw: Callable[[], DataFrame] | None = None,
        models: tuple[str, ...] = tuple(forecast.NATIVE),
        z_threshold: float = anomalies.Z_THRESHOLD,
        forest: bool = False,
        horizon: int = 365,
        robust_threshold: float = anomalies.ROBUST_THRESHOLD,
    ):
        self.spark, self.root, self.raw = spark, root.rstrip("/"), raw
        self.models, self.z_threshold, self.forest, self.horizon = list(models), z_threshold, forest, horizon
        self.robust_threshold = robust_threshold
        self._as_of: dt.date | None = None
        self._train_id: str | None = None
        self._frames: dict[str, DataFrame] = {}
        # Of the tables written here: one partitioned by month that has no row has no file to tell its columns.
        self._schemas: dict = {}
        self.rows: dict[str, int] = {}

    @classmethod
    def for_source(cls, spark: SparkSession, name: str, raw: Callable[[], DataFrame], **options) -> "Warehouse":
        """Warehouse in the shared folder, private to this application and source."""
        tag = hashlib.sha256(repr((name, sorted(options.items()))).encode()).hexdigest()[:16]
        return cls(spark, f"{shared_dir(spark)}/basketlake/{spark.sparkContext.applicationId}/{tag}", raw, **options)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stored(self, name: str) -> bool:
        """Whether the table itself is stored; what streams brought does not count."""
        return sinks.table_exists(self.spark, self.path(name))

    def streamed(self, name: str, before: int | None = None) -> DataFrame | None:
        """What streams brought of a table, None if nothing."""
        folder, schema = STREAMED[name]
        found = parts.live(self.spark, self.path(folder), before)
        return parts.read(self.spark, self.path(folder), schema, before) if found else None

    def exists(self, name: str) -> bool:
        return name in self._frames or self.stored(name) or (name in STREAMED and self.streamed(name) is not None)

    def forget(self, *names: str) -> None:
        """Drop kept frames of tables that were written from elsewhere."""
        for name in names:
            self._frames.pop(name, None)
        self._as_of = None

    def table(self, name: str) -> DataFrame:
        """The stored table, built first when it is missing.

        The frame is kept, so the files of a table are listed once per refresh.
        """
        if name in VIEWS:
            return self.build(name)
        if not self.exists(name):
            self.refresh(name)
        if name not in self._frames:
            self._frames[name] = self._read(name)
        return self._frames[name]

    def _read(self, name: str, schema=None) -> DataFrame:
        own = sinks.read_table(self.spark, self.path(name), schema or self._schemas.get(name)) if self.stored(name) else None
        more = self.streamed(name) if name in STREAMED else None
        if own is None or more is None:
            return more if own is None else own
        return own.unionByName(more)

    def refresh(self, name: str) -> int:
        """(Re)build one table from the tables before it; returns its row count."""
        if name in VIEWS:
            source = VIEWS[name]
            return self.rows[source] if source in self.rows else self.table(source).count()
        if name in KEPT and self.exists(name):
            df = self.build(name)
            if name == "ml_anomalies_daily":
                df = anomalies.keep_acknowledgement(df, self.table(name))
            self._frames.pop(name, None)
            self.rows[name] = sinks.upsert_keyed(self.spark, self.path(name), df, KEPT[name])
            return self.rows[name]
        self._frames.pop(name, None)
        rows = 0
        if name not in STREAMED or self._has_source(name):
            df = self.build(name)
            self._schemas[name] = df.schema
            monthly = name in MONTHLY
            rows = sinks.write_table(df, self.path(name), partition_by=BY_MONTH if monthly else None, cluster=monthly)
        if name in STREAMED and (more := self.streamed(name)) is not None:
            rows += more.count()
        self.rows[name] = rows
        if name == "mart_daily_kpis":
            self._as_of = None
        return rows

    def _has_source(self, name: str) -> bool:
        """Whether there is anything but streamed rows to fill the table from."""
        return self.raw is not None or self.stored("raw_transactions") or self.streamed(name) is None

    def refresh_months(self, name: str, months: list[str]) -> int:
        """Rebuilds the given months of a monthly table, and leaves the files of the others."""
        source = {"agg_product_days": "stg_transactions_clean"}[name]
        lines = self.table(source).where(F.col(BY_MONTH).isin(months))
        rows = sinks.write_table(star.product_days(lines), self.path(name), partition_by=BY_MONTH, cluster=True, only_touched=True)
        self.forget(name)
        return rows

    def profile(self, months: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
        """The column profile of staging, from sketches stored per month.

        Without ``months`` those are sketched that have none yet; given months are sketched anew.
        """
        lines, path = self.table("stg_transactions_clean"), self.path("agg_column_sketches")
        if months is None:
            have = [r[0] for r in self._read("agg_column_sketches").select(BY_MONTH).distinct().collect()] if self.stored("agg_column_sketches") else []
            months = [r[0] for r in lines.select(BY_MONTH).distinct().collect() if r[0] not in have]
        if months:
            columns = columns or [c for c in lines.columns if c != BY_MONTH]
            fresh = quality.column_sketches(lines.where(F.col(BY_MONTH).isin(months)), columns)
            sinks.write_table(fresh, path, partition_by=BY_MONTH, cluster=True, only_touched=True)
        return quality.profile_from_sketches(sinks.read_table(self.spark, path, quality.SKETCHES), "stg_transactions_clean")

    def build(self, name: str) -> DataFrame:
        """The lazy plan of one table over its stored inputs."""
        t = self.table
        if name == "raw_transactions":
            if self.raw is None:
                raise ValueError("no raw transactions stored and no source given")
            return self.raw()
        plans: dict[str, Callable[[], DataFrame]] = {
            "stg_transactions_clean": lambda: clean.clean_transactions(self._source_rows()),
            "dim_date": lambda: star.dim_date_for(t("agg_invoices")),
            "agg_invoices": lambda: star.invoice_totals(t("fact_sales")),
            "agg_countries": lambda: star.country_totals(t("agg_invoices")),
            "agg_product_days": lambda: star.product_days(t("stg_transactions_clean")),
            "dim_country": lambda: star.dim_country(t("agg_countries")),
            "dim_product": lambda: star.dim_product(t("agg_product_days")),
            "dim_customer": lambda: star.dim_customer(t("agg_invoices")),
            "fact_sales": lambda: star.fact_sales(t("stg_transactions_clean")),
            "mart_daily_kpis": lambda: marts.mart_daily_kpis(t("agg_invoices"), marts.first_purchases(t("dim_customer"))),
            "mart_rfm": lambda: marts.mart_rfm(t("agg_invoices"), t("mart_daily_kpis")),
            "dim_customer_rfm": lambda: star.dim_customer_with_rfm(t("dim_customer"), t("mart_rfm")),
            "mart_country_performance": lambda: marts.mart_country_performance(t("agg_countries")),
            "mart_product_performance": lambda: marts.mart_product_performance(marts.product_sales(t("agg_product_days"), t("fact_sales")), t("dim_product")),
            "mart_monthly_trends": lambda: marts.mart_monthly_trends(t("mart_daily_kpis")),
            "backtest_days": lambda: forecast.backtest_days(self.metric_series(), self.models),
            "ml_backtest_results": lambda: forecast.backtest_rows(self.backtest_days(), self.train_id()),
            "ml_model_runs": self._model_runs,
            "ml_forecast_daily": self._forecasts,
            "ml_anomalies_daily": lambda: anomalies.anomaly_rows(self._found(self.metric_series()), self.train_id()),
            # No run has logged a refresh yet.
            "table_refresh_log": lambda: self.spark.createDataFrame([], TABLE_REFRESH_LOG),
        }
        return plans[name]()

    def _source_rows(self) -> DataFrame:
        """Raw rows that did not come by stream; those of a stream are cleaned batch by batch."""
        if not self.stored("raw_transactions"):
            self.refresh("raw_transactions")
        return sinks.read_table(self.spark, self.path("raw_transactions"))

    def ensure_source(self) -> None:
        """Reads the source once, so that a stream adds to its rows."""
        for name in STREAMED if self.raw is not None else ():
            if not self.stored(name):
                self.refresh(name)

    # --- training --------------------------------------------------------------------

    def metric_series(self, metrics: list[str] = TRAINED_METRICS) -> DataFrame:
        return series.unpivot_metrics(self.table("mart_daily_kpis"), metrics)

    def train_id(self) -> str:
        """The training's name: the newest day and a number no earlier training of that day has."""
        if self._train_id is None:
            day, n = f"train-{self.as_of()}", 1
            if self.stored("ml_model_runs"):
                number = F.regexp_extract("run_id", rf"^{day}-(\d+)-", 1).try_cast("int")
                n += self._read("ml_model_runs").agg(F.max(number)).first()[0] or 0
            self._train_id = f"{day}-{n}"
        return self._train_id

    def _found(self, days: DataFrame, lookback_days: int | None = None) -> DataFrame:
        return anomalies.detect_anomalies(
            days, z_threshold=self.z_threshold, forest=self.forest, robust_threshold=self.robust_threshold, lookback_days=lookback_days
        )

    def detect(self, metrics: list[str] = anomalies.DETECTED_METRICS, lookback_days: int = anomalies.LOOKBACK_DAYS) -> DataFrame:
        """Looks for anomalies in the newest days, merges them into the anomaly table and returns them.

        What was acknowledged stays so. Each metric with findings adds a row to the model runs.
        """
        self._train_id = None
        run, at = self.train_id(), dt.datetime.combine(self.as_of(), dt.time())
        days = self.metric_series(metrics)
        found = self._found(days, lookback_days)
        name = "ml_anomalies_daily"
        rows = anomalies.anomaly_rows(found, run)
        if self.stored(name):
            rows = anomalies.keep_acknowledgement(rows, self.table(name))
        sinks.upsert_keyed(self.spark, self.path(name), rows, KEPT[name])
        spans = forecast.train_spans(series.lookback_filter(days, lookback_days))
        runs = forecast.detection_runs(found, spans, run, at, {"lookback_days": lookback_days, **self._limits()})
        sinks.upsert_keyed(self.spark, self.path("ml_model_runs"), runs, KEPT["ml_model_runs"])
        self.forget(name, "ml_model_runs")
        self._train_id = None
        return self.table(name).where(F.col("model_run_id") == run)

    def _limits(self) -> dict:
        return {"z_threshold": self.z_threshold, "robust_threshold": self.robust_threshold}

    def backtest_days(self) -> DataFrame:
        """Hold-out predictions, stored once: scores, choice and back-test rows share them."""
        return self.table("backtest_days")

    def acknowledge(self, day, metric: str, by: str = "analyst", at=None) -> None:
        """Stores the acknowledgement of an anomaly; later trainings keep it."""
        name = "ml_anomalies_daily"
        sinks.write_table(anomalies.acknowledge_anomaly(self.table(name), day, metric, by, at), self.path(name))
        self.forget(name)

    def scores(self) -> DataFrame:
        return forecast.score_backtest(self.backtest_days())

    def best_models(self) -> DataFrame:
        return series.select_best_model(self.scores())

    def _forecasts(self) -> DataFrame:
        predicted = forecast.forecast_all(self.metric_series(), self.best_models(), self.horizon, models=self.models)
        return forecast.forecast_rows(predicted, self.train_id())

    def _model_runs(self) -> DataFrame:
        """A row for every candidate and for every metric in which the training's detection found days."""
        at = dt.datetime.combine(self.as_of(), dt.time())
        days, run = self.metric_series(), self.train_id()
        spans = forecast.train_spans(days)
        trained = forecast.record_model_runs(self.scores(), spans, self.best_models(), run, at)
        return trained.unionByName(forecast.detection_runs(self._found(days), spans, run, at, self._limits()))

    def as_of(self) -> dt.date:
        """Newest day with sales: one value, taken from the day-level mart. As a literal it
        prunes the fact's months, which a join with a one-row frame would not."""
        if self._as_of is None:
            self._as_of = self.table("mart_daily_kpis").agg(F.max("full_date")).first()[0]
        return self._as_of

    # --- full run --------------------------------------------------------------------

    def checks(self) -> list[quality.Check]:
        checked = [
            "raw_transactions", "stg_transactions_clean", "mart_daily_kpis", "mart_rfm", "fact_sales", "dim_date",
        ]
        return quality.standard_checks({n: self.table(n) for n in checked})

    def log(self, name: str, schema: str | None = None) -> DataFrame:
        """A log with what streams added to it."""
        schema = schema or LOGS[name]
        own = sinks.read_table(self.spark, self.path(name), schema) if self.stored(name) else self.spark.createDataFrame([], schema)
        return own.unionByName(parts.read(self.spark, self.path(f"stream_{name}"), schema)) if name in LOGS else own

    def run_etl(
        self,
        source_file: str = "",
        steps: list[list[str]] = STEPS,
        run_id: str | None = None,
        refresh_type: str = "full",
        fail_on_critical: bool = True,
        ingest: bool = True,
        train: bool | None = None,
    ) -> list[tuple[str, int, int, str]]:
        """Read the source again, rebuild the tables in order, check them and log the run.

        ``ingest=False`` starts from the stored raw table, as does a warehouse without a source.
        Tables of a training are brought up to date where they are stored; ``train`` makes it all or none.

        Returns (step, rows, milliseconds, status) per step. Row counts are taken
        while writing. The run ends failed, warning or success by its worst check;
        a failing step is logged as failed before the error goes on.
        """
        started = dt.datetime.now()
        run_id = run_id or f"run-{started:%Y%m%dT%H%M%S%f}"
        report: list[tuple[str, int, int, str]] = []
        times: dict[str, dt.datetime] = {}
        status, error = "running", None
        passed = failed = 0
        try:
            missing = not self.stored("raw_transactions") if self.raw is not None else not self.exists("raw_transactions")
            if missing or (ingest and self.raw is not None):
                steps = [["raw_transactions"], *steps]
            self._train_id = None
            wanted = [[n for n in group if train or (train is None and self.exists(n))] for group in TRAINING]
            steps = [*steps, *[group for group in wanted if group]]
            for group in steps:
                with ThreadPoolExecutor(len(group)) as pool:
                    for line in pool.map(inheritable_thread_target(self.spark)(self._step), group):
                        report.append(line)
                        times[line[0]] = dt.datetime.now()
            t0 = time.monotonic()
            with shuffles_freed(self.spark):
                results = quality.run_dq_checks(self.checks(), run_id).select(*names(DQ_RESULTS))
                outcome = results.collect()  # one row per check
            sinks.write_table(self.spark.createDataFrame(outcome, DQ_RESULTS), self.path("dq_check_results"), "append")
            status = quality.worst_status(outcome)
            passed = sum(r.passed for r in outcome)
            failed = len(outcome) - passed
            report.append(("data_quality_checks", len(outcome), _ms(t0), status))
            if fail_on_critical:
                quality.raise_on_critical(outcome)
        except Exception as exc:
            status, error = "failed", str(exc)
            raise
        finally:
            self._train_id = None
            rows = {name: n for name, n, _, _ in report}
            try:
                self._log_refreshes(report, times, run_id, refresh_type)
                self._log_run(run_id, started, status, source_file, rows, error, passed, failed, refresh_type)
            except Exception:
                if error is None:  # a run that failed ends with its own error, not with that of its log
                    raise
        return report

    def _step(self, name: str) -> tuple[str, int, int, str]:
        t0 = time.monotonic()
        rows = self.refresh(name)
        return name, rows, _ms(t0), "success"

    def _log_refreshes(self, report, times, run_id, refresh_type) -> None:
        done = [
            (name, times[name], run_id, rows, ms, refresh_type) for name, rows, ms, _ in report if name in times
        ]
        if done:
            updates = self.spark.createDataFrame(done, TABLE_REFRESH_LOG)
            sinks.upsert_keyed(self.spark, self.path("table_refresh_log"), updates, ["table_name"])

    def _log_run(self, run_id, started, status, source_file, rows, error, passed, failed, refresh_type) -> None:
        read, kept = rows.get("raw_transactions"), rows.get("stg_transactions_clean")
        if read is None and self.exists("raw_transactions"):
            read = self.table("raw_transactions").count()
        now = dt.datetime.now()
        facts = {
            "total_duration_ms": str(int((now - started).total_seconds() * 1000)),
            "staging_rows": str(kept),
            "fact_rows": str(rows.get("fact_sales")),
            "dq_checks_passed": str(passed),
            "dq_checks_failed": str(failed),
        }
        rejected = read - kept if read is not None and kept is not None else None
        row = (run_id, f"etl_{refresh_type}", started, now, status, source_file, read, rows.get("fact_sales"), rejected, error, None)
        meta = F.to_json(F.create_map(*[F.lit(x) for pair in facts.items() for x in pair]))
        line = self.spark.createDataFrame([row], ETL_RUN_LOG).withColumn("metadata", meta)
        sinks.write_table(line, self.path("etl_run_log"), "append")


def _ms(t0: float) -> int:
    return int((time.monotonic() - t0) * 1000)
