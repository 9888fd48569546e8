"""Metric 1 as it is printed, on a stream (EVT-2): a line when a window fires, then an
updated line per row accepted within the allowed lateness, and nothing before.

Each micro-batch is marked with the batch operator (exact per-row watermark, seeded with
the largest event time of earlier batches) and meets the table of open windows that the
batch before it wrote: totals of the rows before the firing, and of the rows since. It
writes its lines (rows, and text as printed) and the next such table, both per ``batch_id`` with overwrite, so a
replayed batch gives the same rows. A window leaves the table once no row can join it, so
the table holds as many rows as windows are open, whatever the stream's length.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardstream.functions import format as fmt
from cardstream.functions.timecols import amount_rest, exact_sum, tumbling_end_ms
from cardstream.operators.late import late_flag, with_watermark_before
from cardstream.operators.metrics import with_totals
from cardstream.operators.sequence import STREAM_BUCKET_ROWS, keyed_running_totals
from cardstream.schema import (
    MINUTE_ALLOWED_LATENESS_MS, MINUTE_WINDOW_MS, OUT_OF_ORDERNESS_MS, resolve_order,
)
from cardstream.streaming.progress import Progress, drop_folder, latest_time, newest_batch

# Per open window: rows, cents and rests before it fired, the same since, and whether it fired.
SUMS = ("n_pre", "c_pre", "r_pre", "n_again", "c_again", "r_again")
OPEN_DDL = ("window_end bigint, n_pre bigint, c_pre decimal(38,0), r_pre bigint, "
            "n_again bigint, c_again decimal(38,0), r_again bigint, fired boolean")
LINE_DDL = "window_end bigint, emission bigint, fired_by string, n_tx bigint, _cents decimal(38,0), _rest bigint"


def _first_lines(windows: DataFrame, fired_by: str) -> DataFrame:
    return windows.where(F.col("n_pre") > 0).select(
        "window_end", F.lit(0).cast("bigint").alias("emission"), F.lit(fired_by).alias("fired_by"),
        F.col("n_pre").alias("n_tx"), F.col("c_pre").alias("_cents"), F.col("r_pre").alias("_rest"))


class MinuteEmissionsWriter:
    """``foreachBatch`` function writing the lines that each micro-batch prints."""

    def __init__(self, out_path: str, window_ms: int = MINUTE_WINDOW_MS,
                 lateness_ms: int = MINUTE_ALLOWED_LATENESS_MS, delay_ms: int = OUT_OF_ORDERNESS_MS,
                 order_by: Sequence[str] | None = None, bucket_width: int | None = None):
        self.out = out_path.rstrip("/")
        self.window_ms, self.lateness_ms, self.delay_ms = window_ms, lateness_ms, delay_ms
        self.order_by, self.bucket_width = order_by, bucket_width

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        progress = Progress(batch.sparkSession, f"{self.out}/progress")
        carry = progress.before(batch_id).max_event_time
        order = resolve_order(batch, self.order_by)
        batch = batch.persist()              # read twice: for the buckets' maxima, and for the rows
        marked = with_watermark_before(batch, order, self.delay_ms, self.bucket_width, carry,
                                       bucket_rows=STREAM_BUCKET_ROWS).persist()
        try:
            latest = latest_time(marked, carry)
            self.write(marked, order, batch_id, latest)
        finally:
            marked.unpersist()
            batch.unpersist()
        progress.commit(batch_id, latest)

    def write(self, marked: DataFrame, order: Sequence[str], batch_id: int, latest: int | None) -> None:
        """Lines and open windows of a batch whose rows carry ``wm_before``; ``latest`` is the
        largest event time up to its end."""
        spark = marked.sparkSession
        on = (marked.where(~late_flag(self.window_ms, self.lateness_ms))
              .withColumn("window_end", tumbling_end_ms("event_time", self.window_ms))
              .withColumn("_amount_rest", amount_rest())
              .withColumn("_pre", F.coalesce(F.col("wm_before") < F.col("window_end"), F.lit(True))))

        def sums(when, suffix):
            n = F.when(when, F.lit(1)).otherwise(F.lit(0))
            return [F.sum(n).alias(f"n_{suffix}"), exact_sum(n * F.col("amount_cents")).alias(f"c_{suffix}"),
                    F.sum(n * F.col("_amount_rest")).alias(f"r_{suffix}")]

        here = on.groupBy("window_end").agg(
            *sums(F.col("_pre"), "pre"), *sums(~F.col("_pre"), "again")).withColumn("fired", F.lit(False))
        before = (spark.read.schema(OPEN_DDL).parquet(f"{self.out}/open/batch_id={batch_id - 1}")
                  if batch_id else _as(here, OPEN_DDL).limit(0))
        merged = (here.unionByName(before).groupBy("window_end")
                  .agg(*[F.sum(c).alias(c) for c in SUMS], F.max("fired").alias("fired")))
        watermark = F.lit(None if latest is None else latest - self.delay_ms).cast("bigint")
        passed = F.coalesce(F.col("window_end") <= watermark, F.lit(False))
        fires = _first_lines(merged.where(passed & ~F.col("fired")), "watermark")
        carried = merged.select("window_end", "n_pre", "c_pre", "r_pre").join(
            before.select("window_end", "n_again", "c_again", "r_again"), "window_end", "left").na.fill(0)
        late = on.where(~F.col("_pre")).withColumn("amount_cents", F.col("amount_cents").cast("decimal(20,0)"))
        again = (keyed_running_totals(late, "window_end", order, ["amount_cents", "_amount_rest"], self.bucket_width)
                 .join(carried, "window_end").select(
                     "window_end", (F.col("n_again") + F.col("_run_n")).alias("emission"),
                     F.lit("late_row").alias("fired_by"),
                     (F.col("n_pre") + F.col("n_again") + F.col("_run_n")).alias("n_tx"),
                     (F.col("c_pre") + F.col("c_again") + F.col("_run_amount_cents")).alias("_cents"),
                     (F.col("r_pre") + F.col("r_again") + F.col("_run__amount_rest")).alias("_rest")))
        lines = f"{self.out}/lines/batch_id={batch_id}"
        _as(fires.unionByName(again), LINE_DDL).write.mode("overwrite").parquet(lines)
        (with_totals(spark.read.schema(LINE_DDL).parquet(lines)).select(fmt.minute_line().alias("value"))
         .write.mode("overwrite").text(f"{self.out}/text/batch_id={batch_id}"))
        closed = F.coalesce(F.col("window_end") + F.lit(self.lateness_ms) <= watermark, F.lit(False))
        (_as(merged.where(~closed).withColumn("fired", passed), OPEN_DDL)
         .write.mode("overwrite").parquet(f"{self.out}/open/batch_id={batch_id}"))
        # a replay of this batch reads the table before it; nothing reads older ones
        drop_folder(spark, f"{self.out}/open/batch_id={batch_id - 2}")


def _as(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with the columns and types of ``ddl`` (sums of sums widen)."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(ddl).fields])


def read_minute_emissions(spark: SparkSession, out: str, ended: bool = False,
                          progress: str | None = None) -> DataFrame:
    """The lines printed so far; with ``ended`` also those of the windows that the end of
    the input fires. ``progress`` names the writer's progress table, if it lies elsewhere."""
    root = out.rstrip("/")
    lines = spark.read.schema(LINE_DDL).parquet(f"{root}/lines/batch_id=*")
    last = newest_batch(spark, progress or f"{root}/progress") if ended else -1
    if last >= 0:
        newest = spark.read.schema(OPEN_DDL).parquet(f"{root}/open/batch_id={last}").where("NOT fired")
        lines = lines.unionByName(_first_lines(newest, "end_of_input"))
    return with_totals(lines).withColumn("line", fmt.minute_line())
