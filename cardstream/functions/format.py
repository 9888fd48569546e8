"""Text renderings of metrics, alerts and transactions (PRJ-3..7, SNK-4).

``format_string`` runs the JVM's formatter with ``Locale.US``, so ``%.2f``
rounds exactly like the reference (half-up on the shortest decimal form).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardstream.schema import LATE_LABEL, TX_FIELDS

# --- Fixed text formats ----------------------------------------------------
MINUTE_LINE = "Timestamp: %d, Total Transactions: %d, Total Amount: %.2f"
CATEGORY_LINE = "Timestamp: %d, Category: %s, Average Amount: %.2f"
COUNTRY_LINE = "Timestamp: %d, Country: %s, Transactions: %d"
TX_SUMMARY = "%s, merchant %s (%s), country %s, amount %.2f"
RISK_PART = " | Risk Score: %d/100 (%s)"
ALERT_LINE = ("Anomaly Detected! Timestamp: %d, %s: %s, Rule: %s, %s%s"
              " | Suspicious Tx: %s")
HIGH_AMOUNT_TEXT = "Amount: %.2f, Historical Avg: %.2f"
TRAVEL_TEXT = "Previous Country: %s, Current Country: %s, Time Gap Minutes: %d"
TX_JSON = ('{"transaction_id":"%s","card_id":"%s","customer_id":"%s",'
           '"merchant_id":"%s","merchant_category":"%s",'
           '"country":"%s","event_time":%d,"amount":%.2f}')
# ---------------------------------------------------------------------------


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def minute_line(window_end="window_end", n="n_tx", total="total_amount") -> Column:
    return F.format_string(MINUTE_LINE, _c(window_end), _c(n), _c(total))


def category_line(window_end="window_end", category="merchant_category",
                  avg="avg_amount") -> Column:
    return F.format_string(CATEGORY_LINE, _c(window_end), _c(category), _c(avg))


def country_line(window_end="window_end", country="country", n="n_tx") -> Column:
    return F.format_string(COUNTRY_LINE, _c(window_end), _c(country), _c(n))


def describe_tx(tx: Column | str = "tx") -> Column:
    """One-line transaction summary; ``n/a`` for a missing transaction."""
    tx = _c(tx)
    return F.when(tx.isNull(), F.lit("n/a")).otherwise(F.format_string(
        TX_SUMMARY, tx["transaction_id"], tx["merchant_id"],
        tx["merchant_category"], tx["country"], tx["amount"]))


def alert_line(prefix: str = "") -> Column:
    """The alert text; the risk part is left out while the level is empty."""
    level = F.col(prefix + "risk_level")
    risk = F.when(level.isNull() | (level == ""), F.lit("")).otherwise(
        F.format_string(RISK_PART, F.col(prefix + "risk_score"), level))
    return F.format_string(
        ALERT_LINE, F.col(prefix + "timestamp"), F.col(prefix + "entity_type"),
        F.col(prefix + "entity_id"), F.col(prefix + "rule"),
        F.col(prefix + "decision_values"), risk, describe_tx(F.col(prefix + "tx")))


def tx_json(prefix: str = "") -> Column:
    """Reference JSON line of a transaction (fixed field order, no escaping)."""
    return F.format_string(TX_JSON, *[F.col(prefix + c) for c in TX_FIELDS])


def tx_json_with_seq(prefix: str = "") -> Column:
    """The reference JSON line with the arrival position as a last field."""
    fmt_seq = TX_JSON[:-1] + ',"arrival_seq":%d}'
    return F.format_string(fmt_seq, *[F.col(prefix + c) for c in TX_FIELDS],
                           F.col(prefix + "arrival_seq"))


def tx_json_escaped(prefix: str = "") -> Column:
    """Escape-safe JSON of the same eight fields (``to_json``)."""
    return F.to_json(F.struct(*[F.col(prefix + c).alias(c) for c in TX_FIELDS]))


def late_line(prefix: str = "") -> Column:
    """A late row as the reference reports it: ``<label>> <json>``."""
    return F.concat(F.lit(LATE_LABEL + "> "), tx_json(prefix))
