"""Row schemas, column groups and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values (must equal the reference for equal results) -----------
# Rule constants.
HIGH_FREQUENCY_MAX_TX = 5          # alert when count > 5 per card per window
MERCHANT_BURST_MAX_TX = 20         # alert when count > 20 per merchant per window
RULE_WINDOW_MINUTES = 2
HIGH_AMOUNT_HISTORY = 20           # last 20 amounts per customer
HIGH_AMOUNT_MIN_HISTORY = 5        # rule active from 5 prior transactions
HIGH_AMOUNT_RATIO = 3.0            # amount >= 3.0 * average
HIGH_AMOUNT_MIN_AMOUNT = 500.0     # and amount > 500
TRAVEL_MAX_GAP_MS = 30 * 60 * 1000  # less than 30 minutes apart
# Metric windows and event-time settings.
MINUTE_WINDOW_MS = 60_000
FIVE_MINUTE_WINDOW_MS = 300_000
OUT_OF_ORDERNESS_MS = 5_000
MINUTE_ALLOWED_LATENESS_MS = 10_000
# Rule names, entity types and base scores.
RULE_HIGH_FREQUENCY = "High Frequency"
RULE_HIGH_AMOUNT = "High Amount"
RULE_IMPOSSIBLE_TRAVEL = "Impossible Travel"
RULE_MERCHANT_BURST = "Merchant Burst"
BASE_SCORES = {
    "Impossible Travel": 60,
    "High Amount": 50,
    "High Frequency": 40,
    "Merchant Burst": 30,
}
DEFAULT_BASE_SCORE = 20
RISKY_MERCHANT_POINTS = 20
BLACKLISTED_COUNTRY_POINTS = 25
LARGE_AMOUNT_POINTS = 10
LARGE_AMOUNT = 1000.0              # strictly greater
MAX_SCORE = 100
HIGH_LEVEL_FROM = 70
MEDIUM_LEVEL_FROM = 40
# Default reference lists (one value per line in the list files).
DEFAULT_RISKY_MERCHANTS = ("m-7", "m-13", "m-23")
DEFAULT_BLACKLISTED_COUNTRIES = ("NL", "ES")
MERCHANT_BURST_NORMAL_LOAD = " (normal load ~9)"
LATE_LABEL = "LATE EVENT (side output)"
# --------------------------------------------------------------------------

# Transaction fields in the reference's JSON order.
TX_FIELDS = (
    "transaction_id", "card_id", "customer_id", "merchant_id",
    "merchant_category", "country", "event_time", "amount",
)
KEY_FIELDS = ("card_id", "customer_id", "merchant_id", "merchant_category",
              "country")

TX_STRUCT = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("card_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("amount", T.DoubleType()),
])

# Typed decision columns next to the decision text.
DECISION_COLUMNS = (
    ("n_in_window", T.LongType()),
    ("hist_n", T.LongType()),
    ("hist_avg", T.DoubleType()),
    ("prev_country", T.StringType()),
    ("gap_minutes", T.LongType()),
)

ALERT_STRUCT = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("decision_values", T.StringType()),
        T.StructField("tx", TX_STRUCT),
    ]
    + [T.StructField(n, t) for n, t in DECISION_COLUMNS]
)
ALERT_COLUMNS = tuple(f.name for f in ALERT_STRUCT.fields)


def tx_struct(prefix: str = "") -> Column:
    """The ``tx`` struct of an alert built from flat transaction columns."""
    return F.struct(*[F.col(prefix + c).alias(c) for c in TX_FIELDS])


def default_order(df: DataFrame) -> list[str]:
    """Arrival order when known, else event time with the id as tie-break."""
    if "arrival_seq" in df.columns:
        return ["arrival_seq"]
    return ["event_time", "transaction_id"]


def resolve_order(df: DataFrame, order_by) -> list[str]:
    if order_by is None:
        return default_order(df)
    if isinstance(order_by, str):
        return [order_by]
    return list(order_by)


def alert_frame(timestamp: Column, entity_type: str, entity_id: Column,
                rule: str, decision_values: Column, tx: Column,
                **decisions: Column) -> list[Column]:
    """Columns of the common alert schema, missing decision columns null."""
    cols = [
        timestamp.cast("bigint").alias("timestamp"),
        F.lit(entity_type).alias("entity_type"),
        entity_id.alias("entity_id"),
        F.lit(rule).alias("rule"),
        decision_values.alias("decision_values"),
        tx.alias("tx"),
    ]
    for name, dtype in DECISION_COLUMNS:
        value = decisions.get(name)
        cols.append((value if value is not None else F.lit(None))
                    .cast(dtype).alias(name))
    return cols


def flatten_alerts(alerts: DataFrame) -> DataFrame:
    """Alert rows with the nested transaction spread into ``tx_*`` columns."""
    keep = [c for c in alerts.columns if c != "tx"]
    return alerts.select(
        *keep, *[F.col(f"tx.{c}").alias(f"tx_{c}") for c in TX_FIELDS])
