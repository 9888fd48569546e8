"""Exact event-time semantics for the windowed outputs of a stream.

Spark's native watermark keeps a superset of the rows the reference keeps
(its late filter uses the previous micro-batch's watermark). This
``foreachBatch`` writer applies the exact per-row late rule instead: each
micro-batch is split with the batch operator, seeded with the largest event
time of earlier batches (a one-row table per batch), and its on-time rows become
counts and amount sums per window and key, plus the last-arrived transaction. These merge
associatively (sums; ``max_by`` on the whole order) with the table of open windows that the
batch before wrote. Windows that the watermark has passed go to ``closed`` and are final; the
others go to this batch's table of ``open`` windows, which holds as many rows as windows and
keys are open, whatever the stream's length.
:func:`read_exact_windows` joins both, and gives exactly the on-time results of the batch
form whatever the micro-batch cut. Writes are per ``batch_id`` and overwritten on replay.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardstream.functions.timecols import tumbling_end_ms
from cardstream.operators.late import late_flag, with_watermark_before
from cardstream.operators.metrics import amount_sums, with_average, with_totals
from cardstream.operators.sequence import STREAM_BUCKET_ROWS
from cardstream.operators.rules import window_alerts_from_counts
from cardstream.schema import (
    FIVE_MINUTE_WINDOW_MS, HIGH_FREQUENCY_MAX_TX, MERCHANT_BURST_MAX_TX,
    MERCHANT_BURST_NORMAL_LOAD, MINUTE_ALLOWED_LATENESS_MS, MINUTE_WINDOW_MS,
    OUT_OF_ORDERNESS_MS, RULE_HIGH_FREQUENCY, RULE_MERCHANT_BURST,
    RULE_WINDOW_MINUTES, TX_STRUCT, resolve_order, tx_struct,
)
from cardstream.streaming.progress import Progress, drop_folder, latest_time, newest_batch

RULE_WINDOW_MS = RULE_WINDOW_MINUTES * 60_000
# output -> (window ms, allowed lateness ms, key column or None)
WINDOWED = {
    "minute_totals": (MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS, None),
    "category_average": (FIVE_MINUTE_WINDOW_MS, 0, "merchant_category"),
    "country_counts": (FIVE_MINUTE_WINDOW_MS, 0, "country"),
    "high_frequency": (RULE_WINDOW_MS, 0, "card_id"),
    "merchant_burst": (RULE_WINDOW_MS, 0, "merchant_id"),
}
# A window of one output, with its key (none: null): what ``closed`` and ``open`` hold.
WINDOWS = T.StructType([
    T.StructField("output", T.StringType()), T.StructField("window_end", T.LongType()),
    T.StructField("closes", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("cents", T.DecimalType(38, 0)),
    T.StructField("rest", T.LongType()), T.StructField("tx", TX_STRUCT),
    T.StructField("last", T.StructType([          # the order of the last row: its number, and its tie-break
        T.StructField("seq", T.LongType()), T.StructField("tie", T.StringType())]))])


class ExactWindowsBatchWriter:
    """``foreachBatch`` function writing the windows that each micro-batch closes."""

    def __init__(self, out_path: str, delay_ms: int = OUT_OF_ORDERNESS_MS,
                 order_by: Sequence[str] | None = None):
        self.out = out_path.rstrip("/")
        self.delay_ms = delay_ms
        self.order_by = order_by

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        progress = Progress(batch.sparkSession, f"{self.out}/progress")
        carry = progress.before(batch_id).max_event_time
        order = resolve_order(batch, self.order_by)
        batch = batch.persist()              # read twice: for the buckets' maxima, and for the rows
        marked = with_watermark_before(batch, order, self.delay_ms, carry_ms=carry,
                                       bucket_rows=STREAM_BUCKET_ROWS).persist()
        try:
            latest = latest_time(marked, carry)
            self.write(marked, order, batch_id, latest)
        finally:
            marked.unpersist()
            batch.unpersist()
        progress.commit(batch_id, latest)

    def write(self, marked: DataFrame, order: Sequence[str], batch_id: int, latest: int | None) -> None:
        """Closed and open windows of a batch whose rows carry ``wm_before``; ``latest`` is the
        largest event time up to its end."""
        spark = marked.sparkSession
        parts = []
        tie = F.col(order[1]).cast("string") if len(order) > 1 else F.lit(None).cast("string")
        last = F.struct(F.col(order[0]).cast("bigint").alias("seq"), tie.alias("tie"))
        for name, (window_ms, lateness_ms, key) in WINDOWED.items():
            on = (marked.where(~late_flag(window_ms, lateness_ms))
                  .withColumn("window_end", tumbling_end_ms("event_time", window_ms)))
            keys = ["window_end"] + ([F.col(key).alias("key")] if key else [])
            aggs = [F.count(F.lit(1)).alias("n"), *amount_sums("")]
            if name in ("high_frequency", "merchant_burst"):
                aggs += [F.max_by(tx_struct(), last).alias("tx"), F.max(last).alias("last")]
            parts.append(on.groupBy(*keys).agg(*aggs).withColumns({
                "output": F.lit(name),
                "closes": F.col("window_end") + F.lit(lateness_ms)}))
        here = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if batch_id:
            here = here.unionByName(spark.read.schema(WINDOWS).parquet(
                f"{self.out}/open/batch_id={batch_id - 1}"), allowMissingColumns=True)
        merged = (here.groupBy("output", "window_end", "closes", "key").agg(
            *[F.sum(c).alias(c) for c in ("n", "cents", "rest")],
            F.max_by("tx", "last").alias("tx"), F.max("last").alias("last"))
            .select(*[F.col(f.name).cast(f.dataType) for f in WINDOWS.fields]).persist())
        closed = F.lit(False) if latest is None else F.col("closes") <= F.lit(latest - self.delay_ms)
        try:
            for table, rows in (("closed", merged.where(closed)), ("open", merged.where(~closed))):
                rows.write.mode("overwrite").parquet(f"{self.out}/{table}/batch_id={batch_id}")
        finally:
            merged.unpersist()
        # a replay of this batch reads the table before it; nothing reads older ones
        drop_folder(spark, f"{self.out}/open/batch_id={batch_id - 2}")

    def closed(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The windows that a batch closed."""
        return spark.read.schema(WINDOWS).parquet(f"{self.out}/closed/batch_id={batch_id}")


def _windows(spark: SparkSession, out: str, progress: str | None) -> DataFrame:
    """Every window of the stream once: the closed ones, and those that the newest committed
    batch left open."""
    root = out.rstrip("/")
    last = newest_batch(spark, progress or f"{root}/progress")
    if last < 0:
        return spark.createDataFrame([], WINDOWS)
    schema = T.StructType([*WINDOWS.fields, T.StructField("batch_id", T.LongType())])
    closed = spark.read.schema(schema).option("basePath", f"{root}/closed").parquet(f"{root}/closed")
    return (spark.read.schema(WINDOWS).parquet(f"{root}/open/batch_id={last}")
            .unionByName(closed.where(F.col("batch_id") <= last).drop("batch_id")))


def read_exact_windows(spark: SparkSession, out: str, progress: str | None = None) -> dict[str, DataFrame]:
    """On-time metrics and the two windowed alert outputs. ``progress`` names the writer's
    progress table, if it lies elsewhere."""
    return window_outputs(_windows(spark, out, progress))


def window_outputs(windows: DataFrame) -> dict[str, DataFrame]:
    """The outputs that rows of ``WINDOWS`` hold."""
    def of(name, *cols):
        return windows.where(F.col("output") == name).select("window_end", *cols)

    n_tx, sums = F.col("n").alias("n_tx"), [F.col("cents").alias("_cents"), F.col("rest").alias("_rest")]

    def alerts(name, entity, rule, threshold, suffix):
        counts = of(name, F.col("key").alias("entity_id"), F.col("n").alias("n_in_window"), "tx")
        return window_alerts_from_counts(counts, entity, rule, threshold,
                                         RULE_WINDOW_MINUTES, suffix)

    return {
        "minute_totals": with_totals(of("minute_totals", n_tx, *sums)),
        "category_average": with_average(
            of("category_average", F.col("key").alias("merchant_category"), n_tx, *sums)),
        "country_counts": of("country_counts", F.col("key").alias("country"), n_tx),
        "high_frequency_alerts": alerts("high_frequency", "Card", RULE_HIGH_FREQUENCY,
                                        HIGH_FREQUENCY_MAX_TX, ""),
        "merchant_burst_alerts": alerts("merchant_burst", "Merchant", RULE_MERCHANT_BURST,
                                        MERCHANT_BURST_MAX_TX, MERCHANT_BURST_NORMAL_LOAD),
    }
