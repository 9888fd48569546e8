"""Tumbling-window metrics (MET-1..3, AGG-1, AGG-2).

Cents and the rest beyond them are summed as integers that cannot overflow, so totals and
averages keep sub-cent amounts and do not depend on the order in which partial sums meet.
Every function runs unchanged on a batch DataFrame and on a watermarked streaming DataFrame.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardstream.functions import format as fmt
from cardstream.functions.timecols import (
    amount_rest, exact_cents, exact_sum, tumbling_end_ms, whole_cents, window_end_ms,
)
from cardstream.schema import (
    FIVE_MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS, MINUTE_WINDOW_MS,
    OUT_OF_ORDERNESS_MS, resolve_order,
)


def _window(window_ms: int):
    return F.window("ts", f"{int(window_ms)} milliseconds").alias("window")


def amount_sums(prefix: str = "_") -> list[Column]:
    """Sums of the two parts of the amounts, ``<prefix>cents`` and ``<prefix>rest``."""
    return [exact_sum("amount_cents").alias(f"{prefix}cents"), F.sum(amount_rest()).alias(f"{prefix}rest")]


def _money(cents, rest):
    return exact_cents(cents, rest) / F.lit(100.0)


def with_totals(agg: DataFrame) -> DataFrame:
    """``total_cents`` and ``total_amount`` in place of ``_cents`` and ``_rest``."""
    cents, rest = F.col("_cents"), F.col("_rest")
    return (agg.withColumn("total_cents", whole_cents(cents, rest))
            .withColumn("total_amount", _money(cents, rest)).drop("_cents", "_rest"))


def with_average(agg: DataFrame) -> DataFrame:
    """``sum_cents`` and ``avg_amount`` (over ``n_tx``) in place of ``_cents`` and ``_rest``."""
    cents, rest = F.col("_cents"), F.col("_rest")
    avg = F.when(F.col("n_tx") == 0, F.lit(0.0)).otherwise(
        exact_cents(cents, rest) / (F.col("n_tx") * 100).cast("double"))
    return (agg.withColumn("sum_cents", whole_cents(cents, rest))
            .withColumn("avg_amount", avg).drop("_cents", "_rest"))


def minute_totals(tx: DataFrame, window_ms: int = MINUTE_WINDOW_MS) -> DataFrame:
    """Metric 1: global count and total amount per window (not keyed)."""
    agg = tx.groupBy(_window(window_ms)).agg(
        F.count(F.lit(1)).alias("n_tx"), *amount_sums())
    return with_totals(agg.select(
        window_end_ms().alias("window_end"), "n_tx", "_cents", "_rest"))


def category_average(tx: DataFrame, window_ms: int = FIVE_MINUTE_WINDOW_MS) -> DataFrame:
    """Metric 2: average amount per merchant category per window."""
    agg = tx.groupBy(_window(window_ms), "merchant_category").agg(
        F.count(F.lit(1)).alias("n_tx"), *amount_sums())
    return with_average(agg.select(
        window_end_ms().alias("window_end"), "merchant_category", "n_tx", "_cents", "_rest"))


def country_counts(tx: DataFrame, window_ms: int = FIVE_MINUTE_WINDOW_MS) -> DataFrame:
    """Metric 3: transaction count per country per window."""
    agg = tx.groupBy(_window(window_ms), "country").agg(
        F.count(F.lit(1)).alias("n_tx"))
    return agg.select(window_end_ms().alias("window_end"), "country", "n_tx")


def minute_total_emissions(tx: DataFrame, window_ms: int = MINUTE_WINDOW_MS,
                           lateness_ms: int = MINUTE_ALLOWED_LATENESS_MS,
                           delay_ms: int = OUT_OF_ORDERNESS_MS,
                           order_by: Sequence[str] | None = None,
                           bucket_width: int | None = None) -> DataFrame:
    """Metric 1 as it is printed: one line when a window fires, then one
    updated line per row accepted within the allowed lateness (EVT-2).

    A window ending at ``e`` fires once the watermark passes it, i.e. when the
    max event time reaches ``e + delay``; so an on-time row of it arrived
    before the firing iff its ``wm_before < e``. The firing line totals those
    rows (``emission`` 0, ``fired_by`` watermark, or end_of_input if the input
    ends first); every later on-time row re-emits the running totals
    (``emission`` 1, 2, … in arrival order, ``fired_by`` late_row). The last
    line of each window equals its on-time total.
    """
    from cardstream.operators.late import late_flag, with_watermark_before
    from cardstream.operators.sequence import keyed_running_totals

    order = resolve_order(tx, order_by)
    marked = with_watermark_before(tx, order, delay_ms, bucket_width)
    on = (marked.where(~late_flag(window_ms, lateness_ms))
          .withColumn("window_end", tumbling_end_ms("event_time", window_ms))
          .withColumn("_amount_rest", amount_rest())
          .withColumn("_pre", F.col("wm_before").isNull()
                      | (F.col("wm_before") < F.col("window_end"))))
    pre = F.col("_pre")
    base = on.groupBy("window_end").agg(
        F.count(F.when(pre, F.lit(1))).alias("_n_pre"),
        F.coalesce(exact_sum(F.when(pre, F.col("amount_cents"))), F.lit(0)).alias("_c_pre"),
        F.coalesce(F.sum(F.when(pre, F.col("_amount_rest"))), F.lit(0)).alias("_r_pre"),
        F.max("event_time").alias("_wmax"))
    # Late rows never raise the maximum, so the max over on-time rows is the
    # max of the input. One row per window: a small, bounded window.
    base = base.withColumn("_gmax", F.max("_wmax").over(Window.partitionBy()))
    first = base.where(F.col("_n_pre") > 0).select(
        "window_end", F.lit(0).cast("long").alias("emission"),
        F.when(F.col("window_end") + F.lit(delay_ms) <= F.col("_gmax"), F.lit("watermark"))
        .otherwise(F.lit("end_of_input")).alias("fired_by"),
        F.col("_n_pre").alias("n_tx"), F.col("_c_pre").alias("_cents"), F.col("_r_pre").alias("_rest"))
    again = on.where(~pre).withColumn("amount_cents", F.col("amount_cents").cast("decimal(20,0)"))
    running = keyed_running_totals(again, "window_end", order,
                                   ["amount_cents", "_amount_rest"], bucket_width)
    again = running.join(base.select("window_end", "_n_pre", "_c_pre", "_r_pre"),
                         on="window_end", how="inner").select(
        "window_end", F.col("_run_n").cast("long").alias("emission"),
        F.lit("late_row").alias("fired_by"),
        (F.col("_n_pre") + F.col("_run_n")).alias("n_tx"),
        (F.col("_c_pre") + F.col("_run_amount_cents")).alias("_cents"),
        (F.col("_r_pre") + F.col("_run__amount_rest")).alias("_rest"))
    return with_totals(first.unionByName(again)).withColumn("line", fmt.minute_line())
