"""Risk scoring of alerts (SCR-1..3) with reference-list lookups (JN-1)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.schema import (
    BASE_SCORES, BLACKLISTED_COUNTRY_POINTS, DEFAULT_BASE_SCORE, HIGH_LEVEL_FROM,
    LARGE_AMOUNT, LARGE_AMOUNT_POINTS, MAX_SCORE, MEDIUM_LEVEL_FROM,
    RISKY_MERCHANT_POINTS,
)

# Largest reference list we broadcast; above it the lookup is a shuffle join.
MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def reference_frame(spark: SparkSession, values: Iterable[str]) -> DataFrame:
    """A one-column (``value``) reference list from in-code values.

    Built on ``spark.range`` so the planner knows its exact (tiny) size.
    """
    vals = list(values)
    if not vals:
        return spark.createDataFrame([], "value string")
    arr = F.array(*[F.lit(v) for v in vals])
    return spark.range(len(vals)).select(
        F.element_at(arr, (F.col("id") + 1).cast("int")).alias("value"))


def base_score(rule: Column) -> Column:
    expr = None
    for name, score in BASE_SCORES.items():
        expr = (F.when(rule == name, F.lit(score)) if expr is None
                else expr.when(rule == name, F.lit(score)))
    return expr.otherwise(F.lit(DEFAULT_BASE_SCORE))


def risk_level(score: Column) -> Column:
    return (F.when(score >= HIGH_LEVEL_FROM, F.lit("HIGH"))
            .when(score >= MEDIUM_LEVEL_FROM, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def score_alerts(alerts: DataFrame, risky_merchants: DataFrame,
                 blacklisted_countries: DataFrame,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                 check_rows: bool = False) -> DataFrame:
    """Add ``risk_score`` (0-100) and ``risk_level`` to every alert.

    Base score by rule; +20 risky merchant, +25 blacklisted country, +10 when
    amount > 1000 (enrichment skipped for alerts without a transaction);
    capped at 100. Every alert is kept (left joins on de-duplicated lists).
    ``check_rows=True`` counts each list first and broadcasts it explicitly
    when it has at most ``max_broadcast_rows`` rows.
    """
    rm = (risky_merchants.select(F.col("value").alias("_rm_value")).distinct()
          .withColumn("_rm_hit", F.lit(True)))
    bl = (blacklisted_countries.select(F.col("value").alias("_bl_value")).distinct()
          .withColumn("_bl_hit", F.lit(True)))
    if check_rows:
        rm = bounded_broadcast(rm, max_broadcast_rows)
        bl = bounded_broadcast(bl, max_broadcast_rows)
    # Otherwise Spark's own size check picks the join: a broadcast when the
    # list's size estimate (exact for in-code lists and text files) or, with
    # AQE, its measured size is under the broadcast threshold; a shuffle join
    # beyond it. No extra job is run either way.
    joined = (alerts
              .join(rm, F.col("tx.merchant_id") == F.col("_rm_value"), "left")
              .join(bl, F.col("tx.country") == F.col("_bl_value"), "left"))
    has_tx = F.col("tx").isNotNull()
    extra = (F.when(F.col("_rm_hit"), F.lit(RISKY_MERCHANT_POINTS)).otherwise(F.lit(0))
             + F.when(F.col("_bl_hit"), F.lit(BLACKLISTED_COUNTRY_POINTS)).otherwise(F.lit(0))
             + F.when(F.col("tx.amount") > F.lit(LARGE_AMOUNT),
                      F.lit(LARGE_AMOUNT_POINTS)).otherwise(F.lit(0)))
    raw = base_score(F.col("rule")) + F.when(has_tx, extra).otherwise(F.lit(0))
    score = F.least(F.lit(MAX_SCORE), raw).cast("int")
    return (joined.withColumn("risk_score", score)
            .withColumn("risk_level", risk_level(F.col("risk_score")))
            .drop("_rm_value", "_rm_hit", "_bl_value", "_bl_hit"))
