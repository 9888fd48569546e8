"""Adapter from the given ``events`` table to transactions.

Time is divided by 720 so the 30-day table becomes one hour of traffic at
about the reference's rate, which lets the reference's thresholds apply
unchanged. About 1 % of rows are backdated by 45-120 s to exercise late data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.functions.timecols import amount_cents, epoch_micros

# --- Fixed values of the fixture mapping -----------------------------------
EPOCH_START_MS = 1704067200000            # 2024-01-01T00:00:00Z
TIME_DIVISOR = 720                        # 30 days -> 1 hour
MERCHANT_COUNT = 30
CATEGORIES = ("groceries", "fuel", "restaurants", "electronics", "travel")
COUNTRIES = ("IL", "US", "FR", "DE", "UK", "IT", "ES", "NL")
LATE_EVERY = 97                           # event_id % 97 == 96 is backdated
LATE_BASE_MS = 45000
LATE_SPREAD_MS = 75000
LATE_MULTIPLIER = 7919
TX_ID_BASE = 100000
# ---------------------------------------------------------------------------

TX_COLUMNS = ("arrival_seq", "transaction_id", "card_id", "customer_id",
              "merchant_id", "merchant_category", "country", "event_time",
              "amount", "amount_cents")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin rows over the cluster when the scan has fewer splits than
    the default parallelism (e.g. one parquet row group). Large inputs keep
    their natural splits and pay no extra shuffle."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))


def transactions_from_events(events: DataFrame, sub_cent: bool = False) -> DataFrame:
    """Flat transactions (plus ``arrival_seq`` and ``amount_cents``); of two decimals, or
    with ``sub_cent`` sevenths of the value."""
    k = F.get_json_object("props", "$.k").cast("int")
    cardno = F.col("user_id") * 2 + F.col("event_id") % 2
    travel_shift = F.when((F.col("event_type") == "error") & (k < 10), 1).otherwise(0)
    # Zone-free micros of the wall-clock ts, then integer division.
    events = events.withColumn("_micros", epoch_micros("ts", events.schema["ts"].dataType))
    base_ms = F.lit(EPOCH_START_MS) + F.expr(
        f"(_micros - {EPOCH_START_MS * 1000}) div {TIME_DIVISOR * 1000}")
    backdate = F.when(
        F.col("event_id") % LATE_EVERY == LATE_EVERY - 1,
        F.lit(LATE_BASE_MS) + (F.col("event_id") * LATE_MULTIPLIER) % LATE_SPREAD_MS,
    ).otherwise(0)
    value = F.col("value")
    amount = value * 100 / F.lit(7.0) if sub_cent else F.round(value * 10, 2)
    return (
        events.select(
            F.col("event_id").alias("arrival_seq"),
            F.concat(F.lit("tx-"), (F.col("event_id") + TX_ID_BASE).cast("string"))
            .alias("transaction_id"),
            F.concat(F.lit("card-"), cardno.cast("string")).alias("card_id"),
            F.concat(F.lit("cust-"), F.col("user_id").cast("string")).alias("customer_id"),
            F.concat(F.lit("m-"), (k % MERCHANT_COUNT).cast("string")).alias("merchant_id"),
            F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]),
                         ((k % MERCHANT_COUNT) % len(CATEGORIES) + 1).cast("int"))
            .alias("merchant_category"),
            F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]),
                         ((cardno + travel_shift) % len(COUNTRIES) + 1).cast("int"))
            .alias("country"),
            (base_ms - backdate).cast("bigint").alias("event_time"),
            amount.alias("amount"),
        )
        .withColumn("amount_cents", amount_cents("amount"))
    )


def fixture_transactions(spark: SparkSession, sf_dir: str, sub_cent: bool = False) -> DataFrame:
    return transactions_from_events(read_events(spark, sf_dir), sub_cent)
