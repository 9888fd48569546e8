"""The four anomaly rules in batch form (RUL-1..4, AGG-3, AGG-4, FLT-2..4).

Windowed rules (1, 4) are ``groupBy(window, key)`` aggregates with partial
aggregation, and run unchanged on streams. The ordered rules (2, 3)
use ROWS windows along arrival order through :func:`keyed_frames`, which
splits very large keys; ``cardstream.streaming.ordered`` runs the same windows on streams.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardstream.functions import format as fmt
from cardstream.functions.timecols import amount_rest, exact_cents
from cardstream.operators.sequence import DEFAULT_HOT_ROWS, HotKeys, keyed_frames, written
from cardstream.schema import (
    HIGH_AMOUNT_HISTORY, HIGH_AMOUNT_MIN_AMOUNT, HIGH_AMOUNT_MIN_HISTORY,
    HIGH_AMOUNT_RATIO, HIGH_FREQUENCY_MAX_TX, MERCHANT_BURST_MAX_TX,
    MERCHANT_BURST_NORMAL_LOAD, RULE_HIGH_AMOUNT, RULE_HIGH_FREQUENCY,
    RULE_IMPOSSIBLE_TRAVEL, RULE_MERCHANT_BURST, RULE_WINDOW_MINUTES,
    TRAVEL_MAX_GAP_MS, TX_FIELDS, alert_frame, resolve_order, tx_struct,
)


def _order_key(order: Sequence[str]):
    if len(order) == 1:
        return F.col(order[0])
    return F.struct(*[F.col(c) for c in order])


def tx_type(df: DataFrame) -> T.DataType:
    return df.schema["tx"].dataType


# Up to so many rows, an aggregate that carries whole rows beats a second read of the input.
ONE_PASS_ROWS = DEFAULT_HOT_ROWS
# Fired groups whose positions (16 bytes each) are broadcast.
MAX_BROADCAST_FIRED = 1_000_000


def window_count_rule(tx: DataFrame, key: str, entity_type: str, rule: str,
                      threshold: int, window_minutes: int = RULE_WINDOW_MINUTES,
                      text_suffix: str = "", order_by: Sequence[str] | None = None,
                      rows: int | None = None, one_pass_rows: int = ONE_PASS_ROWS) -> DataFrame:
    """Count per key per tumbling window; alert when ``count > threshold``.

    The alert carries the last-arrived transaction of the window (max by the
    order columns) and its event time. ``rows`` bounds the rows of ``tx``, if known.
    """
    order = resolve_order(tx, order_by)
    window = F.window("ts", f"{int(window_minutes)} minutes").alias("window")
    agg = None
    if not tx.isStreaming and len(order) == 1 and isinstance(tx.schema[order[0]].dataType, T.IntegralType):
        if (tx.count() if rows is None else rows) > one_pass_rows:
            agg = _last_rows_fetched(tx, key, window, order[0], threshold)
    if agg is None:
        agg = tx.groupBy(window, F.col(key).alias("entity_id")).agg(
            F.count(F.lit(1)).alias("n_in_window"), F.max_by(tx_struct(), _order_key(order)).alias("tx"))
    return window_alerts_from_counts(agg, entity_type, rule, threshold,
                                     window_minutes, text_suffix)


def _last_rows_fetched(tx: DataFrame, key: str, window, seq: str, threshold: int) -> DataFrame | None:
    """Fired windows with their last row. Only two numbers per group are shuffled (a hash
    aggregate); the fired groups' last positions are written down, and their rows fetched by a
    broadcast of these. None where too many groups fire for that."""
    fired = (tx.groupBy(window, F.col(key).alias("entity_id"))
             .agg(F.count(F.lit(1)).alias("n_in_window"), F.max(seq).alias("_last"))
             .where(F.col("n_in_window") > F.lit(threshold))
             # a position tells a row; rows without one are refused below
             .select("window", "entity_id", "n_in_window", "_last"))
    fired = written(fired, "fired-windows")
    n = fired.count()
    if n > MAX_BROADCAST_FIRED:
        return None
    found = tx.join(F.broadcast(fired.select(F.col("_last").alias("_at"))), F.col(seq) == F.col("_at")).select(
        F.col("_at"), F.col(key).alias("_key"), tx_struct().alias("tx"))
    # both sides have no more rows than windows fired; equal positions are told apart by key
    rows = found.groupBy("_at", "_key").agg(F.first("tx").alias("tx"))
    return fired.join(rows, (F.col("_last") == F.col("_at")) & F.col("entity_id").eqNullSafe(F.col("_key")),
                      "left").select("window", "entity_id", "n_in_window", "tx")


def window_alerts_from_counts(counts: DataFrame, entity_type: str, rule: str,
                              threshold: int, window_minutes: int = RULE_WINDOW_MINUTES,
                              text_suffix: str = "") -> DataFrame:
    """Alerts from per-window rows (``entity_id``, ``n_in_window``, ``tx``)."""
    hits = counts.where(F.col("n_in_window") > F.lit(threshold))
    # rows without an order have no last one: refuse them instead of losing the alert
    hits = hits.withColumn("tx", F.coalesce("tx", F.raise_error(
        F.lit("order column is null: pass order_by, or number the lines")).cast(tx_type(counts))))
    text = F.concat(F.lit(f"Transactions in {int(window_minutes)} minutes: "),
                    F.col("n_in_window").cast("string"), F.lit(text_suffix))
    return hits.select(*alert_frame(
        F.col("tx.event_time"), entity_type, F.col("entity_id"), rule, text,
        F.col("tx"), n_in_window=F.col("n_in_window")))


def high_frequency_alerts(tx: DataFrame, threshold: int = HIGH_FREQUENCY_MAX_TX,
                          window_minutes: int = RULE_WINDOW_MINUTES,
                          order_by: Sequence[str] | None = None, rows: int | None = None) -> DataFrame:
    """Rule 1: more than ``threshold`` transactions per card per window."""
    return window_count_rule(tx, "card_id", "Card", RULE_HIGH_FREQUENCY,
                             threshold, window_minutes, "", order_by, rows)


def merchant_burst_alerts(tx: DataFrame, threshold: int = MERCHANT_BURST_MAX_TX,
                          window_minutes: int = RULE_WINDOW_MINUTES,
                          order_by: Sequence[str] | None = None, rows: int | None = None) -> DataFrame:
    """Rule 4: more than ``threshold`` transactions per merchant per window."""
    return window_count_rule(tx, "merchant_id", "Merchant", RULE_MERCHANT_BURST,
                             threshold, window_minutes,
                             MERCHANT_BURST_NORMAL_LOAD, order_by, rows)


def high_amount_condition(hist_n, hist_cents, min_history=HIGH_AMOUNT_MIN_HISTORY,
                          ratio=HIGH_AMOUNT_RATIO, min_amount=HIGH_AMOUNT_MIN_AMOUNT):
    """``amount >= ratio * avg(history)`` and ``amount > min_amount``.

    The average is compared as a sum (``hist_cents``, with its fraction), so that amounts
    of whole cents are compared without a division."""
    return ((hist_n >= F.lit(min_history))
            & (exact_cents(F.col("amount_cents") * hist_n, amount_rest() * hist_n)
               >= F.lit(float(ratio)) * hist_cents)
            & (F.col("amount") > F.lit(float(min_amount))))


def history_frames(history: int):
    """Window function of rule 2: number and sum (both parts) of the ``history`` amounts before a row."""
    def frames(df, part, order_cols):
        w = Window.partitionBy(*part).orderBy(*order_cols).rowsBetween(-history, -1)
        return df.withColumns({"hist_n": F.count("amount_cents").over(w),
                               "hist_sum_cents": F.sum("amount_cents").over(w),
                               "hist_sum_rest": F.sum("_amount_rest").over(w)})
    return frames


def previous_frames(df: DataFrame, part, order_cols) -> DataFrame:
    """Window function of rule 3: country and event time of the row before."""
    w = Window.partitionBy(*part).orderBy(*order_cols)
    return df.withColumns({"_has_prev": F.lag(F.lit(1)).over(w).isNotNull(),
                           "prev_country": F.lag("country").over(w),
                           "prev_event_time": F.lag("event_time").over(w)})


def high_amount_alerts(tx: DataFrame, history: int = HIGH_AMOUNT_HISTORY,
                       min_history: int = HIGH_AMOUNT_MIN_HISTORY,
                       ratio: float = HIGH_AMOUNT_RATIO,
                       min_amount: float = HIGH_AMOUNT_MIN_AMOUNT,
                       order_by: Sequence[str] | None = None,
                       hot_rows: int | None = DEFAULT_HOT_ROWS,
                       hot_keys: HotKeys | None = None) -> DataFrame:
    """Rule 2: amount far above the customer's previous ``history`` amounts.

    The check uses only rows that arrived before the current one (the check
    happens before the amount joins the history).
    """
    order = resolve_order(tx, order_by)

    cols = list(dict.fromkeys([*order, *TX_FIELDS, "amount_cents"]))
    rows = tx.select(*cols, amount_rest().alias("_amount_rest"))
    hist = keyed_frames(rows, "customer_id", order, history, history_frames(history),
                        hot_rows, hot_keys)
    return high_amount_from_history(hist, min_history, ratio, min_amount)


def high_amount_from_history(hist: DataFrame,
                             min_history: int = HIGH_AMOUNT_MIN_HISTORY,
                             ratio: float = HIGH_AMOUNT_RATIO,
                             min_amount: float = HIGH_AMOUNT_MIN_AMOUNT) -> DataFrame:
    """Alerts from rows carrying ``hist_n`` and the two parts of the history's sum,
    ``hist_sum_cents`` and ``hist_sum_rest`` (batch or stream)."""
    hist_cents = exact_cents(F.col("hist_sum_cents"), F.col("hist_sum_rest"))
    hits = hist.where(high_amount_condition(
        F.col("hist_n"), hist_cents, min_history, ratio, min_amount))
    avg = hist_cents / (F.col("hist_n") * 100).cast("double")
    text = F.format_string(fmt.HIGH_AMOUNT_TEXT, F.col("amount"), avg)
    return hits.select(*alert_frame(
        F.col("event_time"), "Customer", F.col("customer_id"), RULE_HIGH_AMOUNT,
        text, tx_struct(), hist_n=F.col("hist_n"), hist_avg=avg))


def impossible_travel_alerts(tx: DataFrame, max_gap_ms: int = TRAVEL_MAX_GAP_MS,
                             order_by: Sequence[str] | None = None,
                             hot_rows: int | None = DEFAULT_HOT_ROWS,
                             hot_keys: HotKeys | None = None) -> DataFrame:
    """Rule 3: previous-arrived transaction of the card in another country
    and ``event_time - previous < max_gap`` (a negative gap also fires)."""
    order = resolve_order(tx, order_by)

    cols = list(dict.fromkeys([*order, *TX_FIELDS]))
    prev = keyed_frames(tx.select(*cols), "card_id", order, 1, previous_frames, hot_rows,
                        hot_keys)
    return travel_from_previous(prev, max_gap_ms)


def travel_from_previous(prev: DataFrame,
                         max_gap_ms: int = TRAVEL_MAX_GAP_MS) -> DataFrame:
    """Alerts from rows carrying ``_has_prev``, ``prev_country`` and
    ``prev_event_time`` (batch or stream)."""
    gap = F.col("event_time") - F.col("prev_event_time")
    hits = prev.where(F.col("_has_prev")
                      & ~F.col("prev_country").eqNullSafe(F.col("country"))
                      & (gap < F.lit(max_gap_ms)))
    gap_minutes = F.expr("(event_time - prev_event_time) div 60000")
    text = F.format_string(fmt.TRAVEL_TEXT, F.col("prev_country"),
                           F.col("country"), gap_minutes)
    return hits.select(*alert_frame(
        F.col("event_time"), "Card", F.col("card_id"), RULE_IMPOSSIBLE_TRAVEL,
        text, tx_struct(), prev_country=F.col("prev_country"),
        gap_minutes=gap_minutes))
