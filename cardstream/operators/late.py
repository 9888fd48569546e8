"""Exact late-row split in arrival order (EVT-3, EVT-4 in batch form).

Watermark seen by a row = max event time of all rows that arrived before it,
minus the out-of-orderness bound. A row is late for tumbling windows of size
``window_ms`` with ``lateness_ms`` allowed lateness iff

    window_end(event_time) + lateness_ms <= max_before - delay_ms

The running maximum is computed without an unpartitioned window over the
data: rows are bucketed by ranges of the first order column; each bucket
contributes its maximum, a cumulative max over the (few) bucket maxima gives
the carry into every bucket, and a running max inside each bucket finishes it.

Rows of a source of several partitions (``partitioned``, positions from ``packed_position``)
are judged by the rows of their own partition: how the partitions were interleaved is
chance, and the minimum over them, by which windows close, never runs ahead of one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardstream.functions.timecols import tumbling_end_ms
from cardstream.operators.sequence import (
    BUCKET_ROWS, PARTITION_BITS, counted_width, require_numeric_order, source_partition,
)
from cardstream.schema import OUT_OF_ORDERNESS_MS, resolve_order


def with_watermark_before(df: DataFrame, order_by: Sequence[str] | None = None,
                          delay_ms: int = OUT_OF_ORDERNESS_MS,
                          bucket_width: int | None = None,
                          carry_ms: int | None = None,
                          partitioned: bool = False,
                          carry: DataFrame | None = None,
                          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``wm_before``: watermark (ms) in force when the row arrived.

    ``carry_ms`` (optional) is the max event time of everything that arrived
    before ``df``; the streaming form passes the max of earlier micro-batches.
    With ``partitioned``, ``carry`` holds it per partition (``partition_times``).
    ``bucket_rows`` says how many rows a bucket has, about; streams pass a smaller number.
    """
    order = resolve_order(df, order_by)
    require_numeric_order(df, order)
    if partitioned:
        return _with_own_watermark(df, order, delay_ms, bucket_width or bucket_rows << PARTITION_BITS, carry)
    # a row without a position has no watermark: refuse it instead of misplacing it
    position = F.coalesce(F.col(order[0]), F.raise_error(
        F.lit("order column is null: pass order_by, or number the lines")).cast(df.schema[order[0]].dataType))
    bucket = F.floor(position / F.lit(bucket_width or counted_width(df, order[0], bucket_rows))).cast("long")
    b = df.withColumn("_bucket", bucket)
    # Bucket maxima: one row per bucket (rows / BUCKET_ROWS of them, e.g.
    # 15 * 10^6 rows for 10^12 input rows). The prefix max over this small table is
    # the only unpartitioned window here; it never sees the data rows.
    bucket_max = b.groupBy("_bucket").agg(F.max("event_time").alias("_bmax"))
    carries = bucket_max.select(
        "_bucket",
        F.max("_bmax").over(Window.orderBy("_bucket").rowsBetween(
            Window.unboundedPreceding, -1)).alias("_carry"))
    local = F.max("event_time").over(
        Window.partitionBy("_bucket").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1))
    out = (b.withColumn("_local", local)
           # The window has dealt the rows by bucket already: a join by bucket moves the
           # carries alone, and adaptive execution broadcasts them if measured small.
           .join(carries, on="_bucket", how="left"))
    before = F.greatest(F.col("_carry"), F.col("_local"))
    if carry_ms is not None:
        before = F.greatest(before, F.lit(int(carry_ms)).cast("long"))
    out = out.withColumn("wm_before", before - F.lit(delay_ms))
    return out.drop("_bucket", "_local", "_carry")


def _with_own_watermark(df: DataFrame, order: Sequence[str], delay_ms: int, bucket_width: int,
                        carry: DataFrame | None) -> DataFrame:
    """``wm_before`` by each row's own source partition: the same buckets, within partitions."""
    b = df.withColumns({"_part": source_partition(F.col(order[0])),
                        "_bucket": F.floor(F.col(order[0]) / F.lit(bucket_width)).cast("long")})
    bucket_max = b.groupBy("_part", "_bucket").agg(F.max("event_time").alias("_bmax"))
    if carry is not None:                     # one row per partition: a bucket before all others
        bucket_max = bucket_max.unionByName(carry.select(
            F.col("source_partition").alias("_part"), F.lit(-1).cast("long").alias("_bucket"),
            F.col("max_event_time").alias("_bmax")))
    before = Window.partitionBy("_part").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carries = bucket_max.select("_part", "_bucket", F.max("_bmax").over(before).alias("_carry")).where("_bucket >= 0")
    local = F.max("event_time").over(Window.partitionBy("_part", "_bucket").orderBy(*order)
                                     .rowsBetween(Window.unboundedPreceding, -1))
    out = b.withColumn("_local", local).join(carries, ["_part", "_bucket"], "left")
    return (out.withColumn("wm_before", F.greatest("_carry", "_local") - F.lit(delay_ms))
            .drop("_part", "_bucket", "_local", "_carry"))


def partition_times(df: DataFrame, carry: DataFrame | None = None, order_col: str = "arrival_seq") -> DataFrame:
    """(source_partition, max_event_time): the largest event time of each partition so far."""
    here = df.select(source_partition(F.col(order_col)).alias("source_partition"),
                     F.col("event_time").alias("max_event_time"))
    both = here if carry is None else here.unionByName(carry)
    return both.groupBy("source_partition").agg(F.max("max_event_time").alias("max_event_time"))


def late_flag(window_ms: int, lateness_ms: int = 0):
    end = tumbling_end_ms("event_time", window_ms)
    return F.coalesce(end + F.lit(lateness_ms) <= F.col("wm_before"), F.lit(False))


def split_late(df: DataFrame, window_ms: int, lateness_ms: int = 0,
               delay_ms: int = OUT_OF_ORDERNESS_MS,
               order_by: Sequence[str] | None = None,
               bucket_width: int | None = None,
               carry_ms: int | None = None,
               partitioned: bool = False,
               carry: DataFrame | None = None,
               bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """Return ``(on_time, late)`` for one window size / lateness setting."""
    marked = with_watermark_before(df, order_by, delay_ms, bucket_width, carry_ms, partitioned, carry, bucket_rows)
    marked = marked.withColumn("_late", late_flag(window_ms, lateness_ms))
    on_time = marked.where(~F.col("_late")).drop("_late", "wm_before")
    late = marked.where(F.col("_late")).drop("_late", "wm_before")
    return on_time, late
