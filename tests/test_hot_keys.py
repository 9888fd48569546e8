"""The split path for very large keys gives exactly the plain per-key result."""

from pyspark.sql import functions as F

from conftest import SF01
from cardstream.operators import rules
from cardstream.plans.catalog import load_tx
from cardstream.schema import flatten_alerts


def _rows(df):
    return sorted(tuple(r) for r in flatten_alerts(df).collect())


def _skewed(spark):
    """The fixture with one customer and one card holding a third of all rows."""
    tx = load_tx(spark, SF01)
    hot = F.col("arrival_seq") % 3 == 0
    return (tx.withColumn("customer_id", F.when(hot, F.lit("cust-hot"))
                          .otherwise(F.col("customer_id")))
            .withColumn("card_id", F.when(hot, F.lit("card-hot")).otherwise(F.col("card_id"))))


def test_high_amount_split_equals_plain(spark):
    tx = _skewed(spark)
    plain = _rows(rules.high_amount_alerts(tx, hot_rows=None))
    split = _rows(rules.high_amount_alerts(tx, hot_rows=150))
    assert len(plain) > 0 and plain == split


def test_travel_split_equals_plain(spark):
    tx = _skewed(spark)
    plain = _rows(rules.impossible_travel_alerts(tx, hot_rows=None))
    split = _rows(rules.impossible_travel_alerts(tx, hot_rows=40))
    assert len(plain) > 0 and plain == split


def test_split_on_unskewed_fixture(spark):
    tx = load_tx(spark, SF01)
    assert _rows(rules.high_amount_alerts(tx, hot_rows=10)) == \
        _rows(rules.high_amount_alerts(tx, hot_rows=None))


def test_split_with_event_time_order(spark):
    """Fallback order (event_time, transaction_id)."""
    tx = _skewed(spark).drop("arrival_seq")
    order = ["event_time", "transaction_id"]
    for rule, hot in ((rules.high_amount_alerts, 150), (rules.impossible_travel_alerts, 40)):
        plain = _rows(rule(tx, order_by=order, hot_rows=None))
        split = _rows(rule(tx, order_by=order, hot_rows=hot))
        assert len(plain) > 0 and plain == split


def test_one_pass_detection_for_both_rules(spark):
    from cardstream.operators.alerts import all_rule_alerts
    from cardstream.operators.sequence import hot_key_tables
    tx = _skewed(spark)
    hot = hot_key_tables(tx, ["customer_id", "card_id"], 150)
    assert [r.customer_id for r in hot["customer_id"][0].collect()] == ["cust-hot"]
    assert hot["customer_id"][1] == 1
    assert "card-hot" in [r.card_id for r in hot["card_id"][0].collect()]
    assert _rows(all_rule_alerts(tx, hot_rows=150)) == _rows(all_rule_alerts(tx, hot_rows=None))


def test_ranges_hold_despite_gaps_and_ties(spark):
    """One row at time 0 far from the rest, and half of all rows at one time."""
    from cardstream.operators.sequence import deal_by_range
    start = 1_700_000_000_000
    rows = spark.range(40_000).select(
        F.lit("k").alias("key"), F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") == 0, 0).when(F.col("id") % 2 == 0, start)
        .otherwise(F.lit(start) + F.col("id") * 60_000).alias("event_time"))
    dealt = deal_by_range(rows, ["key", "event_time", "transaction_id"], 40_000, 2_500)
    sizes = [r["count"] for r in dealt.groupBy("_sub").count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 10_000 and sum(sizes) == 40_000
