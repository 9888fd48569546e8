"""Union of the rule outputs (SET-1) and the all-rules helper."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame

from cardstream.operators.rules import (
    high_amount_alerts, high_frequency_alerts, impossible_travel_alerts,
    merchant_burst_alerts,
)
from cardstream.operators.sequence import DEFAULT_HOT_ROWS, hot_key_tables
from cardstream.schema import ALERT_COLUMNS


def union_alerts(*streams: DataFrame) -> DataFrame:
    """UNION ALL of alert DataFrames with the common alert schema."""
    return reduce(lambda a, b: a.unionByName(b),
                  [s.select(*ALERT_COLUMNS) for s in streams])


def all_rule_alerts(tx: DataFrame, windowed_tx: DataFrame | None = None,
                    order_by: Sequence[str] | None = None,
                    hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """The four rules over ``tx``; windowed rules may read a different input
    (e.g. only on-time rows) through ``windowed_tx``."""
    wtx = tx if windowed_tx is None else windowed_tx
    rows = tx.count()                    # bounds every key's and window's rows
    hot = {"customer_id": None, "card_id": None}
    if hot_rows is not None:
        # One pass finds the hot customers and the hot cards for rules 2 and 3.
        hot = hot_key_tables(tx, ["customer_id", "card_id"], hot_rows, rows)
    return union_alerts(
        high_frequency_alerts(wtx, order_by=order_by, rows=rows),
        high_amount_alerts(tx, order_by=order_by, hot_rows=hot_rows,
                           hot_keys=hot["customer_id"]),
        impossible_travel_alerts(tx, order_by=order_by, hot_rows=hot_rows,
                                 hot_keys=hot["card_id"]),
        merchant_burst_alerts(wtx, order_by=order_by, rows=rows),
    )
