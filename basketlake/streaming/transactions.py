"""Transaction files arriving in a folder: append to raw, refresh what they touch.

Producers drop files; Spark's checkpoint remembers which were read. Every table
written here is a folder per batch (:mod:`basketlake.sources.parts`), a replayed batch overwrites its
own, and closed batches are merged, so at-least-once delivery leaves exactly-once tables of few files.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from basketlake.functions.amounts import MONEY, money_sum
from basketlake.operators import clean, marts, quality, star
from basketlake.plans.warehouse import Warehouse
from basketlake.schemas import DQ_RESULTS, ETL_RUN_LOG, RAW, STAGING, names
from basketlake.shared import cut_lineage
from basketlake.sources import parts, sinks
from basketlake.sources.readers import csv_options, rename_by_name, typed

_FIRST = "customer_id bigint, first_purchase_date date, bucket int"
_MOVES = "full_date date, delta bigint"


def read_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Typed rows of the CSV files in ``folder``, old and new ones."""
    reader = csv_options(spark.readStream).option("maxFilesPerTrigger", files_per_batch)
    return typed(rename_by_name(reader.csv(folder)))


def _start(stream: DataFrame, each: Callable, checkpoint: str, every: str | None, name: str | None = None) -> StreamingQuery:
    """``every=None`` reads what is there and stops; '30 seconds' keeps going."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def stream_transactions(
    spark: SparkSession,
    folder: str,
    raw_path: str,
    checkpoint: str,
    every: str | None = None,
    files_per_batch: int = 100,
    fan_out: int = parts.FAN_OUT,
    log_path: str | None = None,
) -> StreamingQuery:
    """Append arriving transactions to the raw table, to be read by :func:`parts.read`; ``log_path`` keeps a run log."""

    def each(df: DataFrame, batch_id: int) -> None:
        parts.write(df, raw_path, batch_id)
        parts.compact(spark, raw_path, RAW, batch_id, fan_out=fan_out)

    name = f"raw-{uuid.uuid4().hex}"
    if log_path:
        ProgressLog(spark, log_path, name, "stream_raw", folder).listen()
    return _start(read_stream(spark, folder, files_per_batch), each, checkpoint, every, name)


class ProgressLog(StreamingQueryListener):
    """Writes a line of the run log for each batch of one query, from the progress Spark reports, and one for its failure.

    Reports come after the batch, on a thread of their own: :meth:`wait` returns when the last one is written.
    """

    def __init__(self, spark: SparkSession, path: str, query: str, run_type: str, source: str, status: Callable[[int], str] = lambda batch: "success"):
        self.spark, self.path, self.query, self.run_type, self.source, self.status = spark, path, query, run_type, source, status
        self._done, self._run, self._last = threading.Event(), None, -1

    def listen(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.query or "addBatch" not in p.durationMs:  # a trigger without a batch
            return
        self._last = p.batchId
        ended = dt.datetime.now()
        total = int(p.durationMs.get("triggerExecution", 0))
        facts = {"total_duration_ms": total, "input_rows_per_second": p.inputRowsPerSecond, "processed_rows_per_second": p.processedRowsPerSecond}
        facts |= {f"{k}_ms": int(v) for k, v in p.durationMs.items()}
        self._write(p.batchId, ended - dt.timedelta(milliseconds=total), ended, self.status(p.batchId), int(p.numInputRows), None, facts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) != self._run:
            return
        if event.exception:
            now = dt.datetime.now()
            self._write(self._last + 1, now, now, "failed", None, event.exception, {})
        self._done.set()

    def _write(self, batch: int, started, ended, status: str, rows: int | None, error: str | None, facts: dict) -> None:
        line = (f"batch-{batch}", self.run_type, started, ended, status, self.source, rows, rows, None, error, None)
        meta = F.to_json(F.create_map(*[F.lit(str(x)) for pair in facts.items() for x in pair])) if facts else F.lit(None).cast("string")
        parts.write(self.spark.createDataFrame([line], ETL_RUN_LOG).withColumn("metadata", meta), self.path, batch)
        parts.compact(self.spark, self.path, ETL_RUN_LOG, batch)

    def wait(self, seconds: float = 60) -> None:
        """After the query has ended: until its last report is written."""
        if not self._done.wait(seconds):
            raise TimeoutError("the query's last report did not come")
        self.spark.streams.removeListener(self)


class StreamRefresh:
    """Micro-batch upkeep of a warehouse: raw, staging, daily KPIs and product days, with checks and logs per batch.

    What streams bring is stored beside what the source filled (``warehouse.STREAMED``), so a later full refresh
    that reads the source again keeps it; a source that was not read yet is read before the first batch.

    Only the days a batch touches are computed again, from the months they lie
    in. A batch touches its own days and, when it brings an earlier purchase of a
    known customer, the day that used to be the customer's first. First purchases lie in hash buckets of the
    customer, of which a batch reads those its customers fall into.

    With ``full_every=n`` every n-th batch also rebuilds and checks the whole
    warehouse; ``n=1`` is a full refresh per batch. A failed critical check marks the batch ``failed`` in the run log;
    with ``fail_on_critical`` it also ends the query, and the batch comes again after a restart.
    """

    def __init__(self, warehouse: Warehouse, full_every: int | None = None, buckets: int = 64, fan_out: int = parts.FAN_OUT, fail_on_critical: bool = False):
        self.w, self.full_every, self.buckets, self.fan_out, self.fail_on_critical = warehouse, full_every, buckets, fan_out, fail_on_critical
        self.log: ProgressLog | None = None
        self._status: dict[int, str] = {}

    def start(self, folder: str, checkpoint: str, every: str | None = None, files_per_batch: int = 100) -> StreamingQuery:
        name = f"refresh-{uuid.uuid4().hex}"
        path = self.w.path("stream_etl_run_log")
        self.log = ProgressLog(self.w.spark, path, name, "etl_incremental", folder, lambda b: self._status.pop(b, "success")).listen()
        return _start(read_stream(self.w.spark, folder, files_per_batch), self.batch, checkpoint, every, name)

    def run(self, folder: str, checkpoint: str, files_per_batch: int = 100) -> None:
        """Takes what is in the folder and returns when the last batch is logged."""
        self.start(folder, checkpoint, files_per_batch=files_per_batch).awaitTermination()
        self.log.wait()

    def batch(self, df: DataFrame, batch_id: int) -> None:
        t0 = time.monotonic()
        w = self.w
        w.ensure_source()
        # The checks' measures are taken by the writes themselves.
        seen = parts.write(df, w.path("stream_raw"), batch_id, measures=quality.raw_measures())
        fresh = clean.clean_transactions(parts.read_batch(w.spark, w.path("stream_raw"), RAW, batch_id))
        seen |= parts.write(fresh, w.path("stream_staging"), batch_id, ["year_month"], quality.staging_measures())
        w.forget("raw_transactions", "stg_transactions_clean")
        lines = parts.read_batch(w.spark, w.path("stream_staging"), STAGING, batch_id)
        days = cut_lineage(self._touched_days(lines, batch_id))
        # Days and months are bounded by the calendar.
        months = [r[0] for r in days.select(F.date_format("full_date", "yyyy-MM").alias("m")).distinct().collect()]
        rows = self._refresh_days(days, months)
        if months and w.stored("agg_product_days"):
            w.refresh_months("agg_product_days", months)
        w.forget("mart_daily_kpis", "table_refresh_log")
        self._check(seen, rows, batch_id)
        at = dt.datetime.now()
        log = quality.refresh_row(w.spark, "mart_daily_kpis", f"batch-{batch_id}", rows, int((time.monotonic() - t0) * 1000), at, "incremental")
        sinks.upsert_keyed(w.spark, w.path("table_refresh_log"), log, ["table_name"])
        self._compact(batch_id)
        if self.full_every and (batch_id + 1) % self.full_every == 0:
            w.run_etl(f"batch {batch_id}", refresh_type="incremental", run_id=f"refresh-{batch_id}", ingest=False, fail_on_critical=self.fail_on_critical)

    def _check(self, seen: dict, mart_days: int, batch_id: int) -> None:
        w = self.w
        results = quality.run_dq_checks(quality.batch_checks(w.spark, seen, mart_days), f"batch-{batch_id}").select(*names(DQ_RESULTS))
        outcome = results.collect()  # one row per check
        parts.write(w.spark.createDataFrame(outcome, DQ_RESULTS), w.path("stream_dq_check_results"), batch_id)
        self._status[batch_id] = quality.worst_status(outcome)
        if self.fail_on_critical:
            quality.raise_on_critical(outcome)

    # --- first purchases ---------------------------------------------------------------

    def _state(self, name: str) -> str:
        """Folder of a table that is derived from all lines so far: another one for each reading of the source."""
        base = sinks.current(self.w.spark, self.w.path("stg_transactions_clean"))
        return f"{self.w.path(name)}/{base.rsplit('/', 1)[-1] if base else 'stream'}"

    def _bucketed(self, customers: DataFrame) -> DataFrame:
        return customers.withColumn("bucket", F.pmod(F.xxhash64("customer_id"), F.lit(self.buckets)).cast("int"))

    def _seed(self, batch_id: int) -> None:
        """First purchases of the lines before this batch, where they are not stored: the source was read (again)."""
        w, path = self.w, self._state("stream_first_purchases")
        if parts.live(w.spark, path) and parts.live(w.spark, self._state("stream_first_purchase_moves")):
            return
        frames = [sinks.read_table(w.spark, w.path("stg_transactions_clean"), STAGING)] if w.stored("stg_transactions_clean") else []
        if (earlier := w.streamed("stg_transactions_clean", before=batch_id)) is not None:
            frames.append(earlier)
        if not frames:
            return
        for name in ("stream_first_purchases", "stream_first_purchase_moves"):  # of an earlier reading
            for old in parts.names_in(w.spark, w.path(name)):
                parts.delete(w.spark, f"{w.path(name)}/{old}")
        lines = quality.union_all(frames).where("customer_id IS NOT NULL")
        first = self._bucketed(lines.groupBy("customer_id").agg(F.min("full_date").alias("first_purchase_date")))
        parts.write(first, path, batch_id - 1, ["bucket"], first=-1)
        moves = parts.read(w.spark, path, _FIRST).groupBy(F.col("first_purchase_date").alias("full_date")).agg(F.count(F.lit(1)).alias("delta"))
        parts.write(moves, self._state("stream_first_purchase_moves"), batch_id - 1, first=-1)

    def _touched_days(self, lines: DataFrame, batch_id: int) -> DataFrame:
        """Days to compute again; also logs first purchases and how they moved."""
        w = self.w
        self._seed(batch_id)
        new = cut_lineage(self._bucketed(lines.where("customer_id IS NOT NULL").groupBy("customer_id").agg(F.min("full_date").alias("_new"))))
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # as many numbers as there are buckets at most
        # Earlier batches only: a replay must not meet its own first run.
        known = parts.read(w.spark, self._state("stream_first_purchases"), _FIRST, before=batch_id).where(F.col("bucket").isin(touched))
        old = known.join(new.select("customer_id"), "customer_id", "left_semi").groupBy("customer_id").agg(F.min("first_purchase_date").alias("_old"))
        moved = cut_lineage(new.join(old, "customer_id", "left").where(F.col("_old").isNull() | (F.col("_new") < F.col("_old"))))
        parts.write(moved.select("customer_id", F.col("_new").alias("first_purchase_date"), "bucket"), self._state("stream_first_purchases"), batch_id, ["bucket"])
        plus = moved.select(F.col("_new").alias("full_date"), F.lit(1).alias("delta"))
        minus = moved.where("_old IS NOT NULL").select(F.col("_old").alias("full_date"), F.lit(-1).alias("delta"))
        moves = plus.unionByName(minus).groupBy("full_date").agg(F.sum("delta").cast("bigint").alias("delta"))
        parts.write(moves, self._state("stream_first_purchase_moves"), batch_id)
        own = lines.select("full_date").distinct()
        return own.unionByName(minus.select("full_date")).distinct()

    def _refresh_days(self, days: DataFrame, months: list[str]) -> int:
        """Compute the touched days from their months and merge them into the mart; all days where there is no mart yet.

        The list of days is bounded by the calendar, so it may be broadcast and
        its months may prune the scan.
        """
        w = self.w
        whole = not w.stored("mart_daily_kpis")
        lines = w.table("stg_transactions_clean")
        moves = parts.read(w.spark, self._state("stream_first_purchase_moves"), _MOVES)
        if not whole:
            if not months:
                return w.table("mart_daily_kpis").count()
            lines = lines.where(F.col("year_month").isin(months)).join(F.broadcast(days), "full_date", "left_semi")
            moves = moves.join(F.broadcast(days), "full_date", "left_semi")
        first = moves.groupBy("full_date").agg(F.sum("delta").alias("new_customers"))
        fresh = marts.mart_daily_kpis(star.invoice_totals(star.fact_sales(lines)), first)
        return sinks.upsert_keyed(w.spark, w.path("mart_daily_kpis"), fresh, ["full_date"])

    # --- merging of closed batches ---------------------------------------------------------

    def _compact(self, batch_id: int) -> None:
        """Few files stay, however many batches came; a row is written again about log(batches) times."""
        w, f = self.w, self.fan_out
        merge = lambda path, schema, by=(), fold=None: parts.compact(w.spark, path, schema, batch_id, by, fold, f)
        merge(w.path("stream_raw"), RAW)
        merge(w.path("stream_staging"), STAGING, ["year_month"])
        earliest = lambda df: df.groupBy("customer_id", "bucket").agg(F.min("first_purchase_date").alias("first_purchase_date"))
        merge(self._state("stream_first_purchases"), _FIRST, ["bucket"], lambda df: earliest(df).select("customer_id", "first_purchase_date", "bucket"))
        merge(self._state("stream_first_purchase_moves"), _MOVES, (), lambda df: df.groupBy("full_date").agg(F.sum("delta").alias("delta")))
        merge(w.path("stream_dq_check_results"), DQ_RESULTS)
        w.forget("raw_transactions", "stg_transactions_clean")


# --- event-time days ----------------------------------------------------------------------


_DAYS = "full_date date, revenue decimal(20,2), items bigint, lines bigint, late_lines bigint, orders binary, newest timestamp_ntz"


class DailyKpis:
    """Revenue, items, lines and (approximate) orders per day, kept up by partial sums of each batch.

    A day closes ``late`` after the newest event any earlier batch brought: the watermark. Lines of closed
    days are not dropped: a batch writes them to a side table of late lines and, counted apart, into its partial sums, from which
    their days follow. Both are folders of the batch, so a replay replaces them. Sums and order sketches of closed
    batches are merged; what stays is a row per day and merge level.
    """

    def __init__(self, spark: SparkSession, path: str, late: str = "2 days", fan_out: int = parts.FAN_OUT):
        self.spark, self.days, self.late_path, self.late, self.fan_out = spark, f"{path}/days", f"{path}/late", late, fan_out

    def watermark(self, batch_id: int | None = None):
        """The time before which days are closed, as a text; None before the first event."""
        newest = parts.read(self.spark, self.days, _DAYS, batch_id).agg((F.max("newest") - F.expr(f"interval {self.late}")).cast("string").alias("at"))
        return newest.first().at

    def batch(self, df: DataFrame, batch_id: int) -> None:
        closed = self.watermark(batch_id)
        late = F.lit(False) if closed is None else F.col("invoice_date") < F.lit(closed).cast("timestamp_ntz")
        # Kept as parsed, before the rules: each of these would parse its texts again.
        parsed = df.persist()
        lines = clean.clean_transactions(parsed).withColumn("is_late", late)
        valid = star.valid_sale()
        try:
            parts.write(lines.where("is_late").drop("is_late"), self.late_path, batch_id, ["year_month"])
            sums = lines.groupBy("full_date").agg(
                money_sum(F.when(valid, F.col("line_total")).otherwise(0)).alias("revenue"),
                F.sum(F.when(valid, F.col("quantity")).otherwise(0)).cast("bigint").alias("items"),
                F.count(F.lit(1)).alias("lines"),
                F.count_if("is_late").alias("late_lines"),
                F.hll_sketch_agg(F.when(~F.col("is_cancelled"), F.col("invoice_no")), F.lit(12)).alias("orders"),
                F.max("invoice_date").alias("newest"),
            )
            parts.write(sums, self.days, batch_id)
        finally:
            parsed.unpersist()
        parts.compact(self.spark, self.days, _DAYS, batch_id, fold=self._fold, fan_out=self.fan_out)
        parts.compact(self.spark, self.late_path, STAGING, batch_id, ["year_month"], fan_out=self.fan_out)

    @staticmethod
    def _fold(df: DataFrame) -> DataFrame:
        return df.groupBy("full_date").agg(
            F.sum("revenue").cast(MONEY).alias("revenue"),
            *[F.sum(c).alias(c) for c in ("items", "lines", "late_lines")],
            F.hll_union_agg("orders").alias("orders"),
            F.max("newest").alias("newest"),
        )

    def table(self) -> DataFrame:
        return self._fold(parts.read(self.spark, self.days, _DAYS)).select(
            "full_date", F.col("revenue").alias("total_revenue"), F.col("items").alias("total_items_sold"), "lines", "late_lines",
            F.hll_sketch_estimate("orders").alias("approx_orders"),
        )

    def late_lines(self) -> DataFrame:
        return parts.read(self.spark, self.late_path, STAGING)


def stream_daily_kpis(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str, every: str | None = None, late: str = "2 days") -> StreamingQuery:
    """Keeps a table of days up to date with raw lines; read it through :class:`DailyKpis`."""
    return _start(stream, DailyKpis(spark, path, late).batch, checkpoint, every)
