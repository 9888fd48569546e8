"""Late-row split: boundary equality and bucketed == single pass."""

from conftest import SF01, make_tx
from oracle_compare import compare, duck

from cardstream.operators.late import split_late
from cardstream.plans.catalog import load_tx
from cardstream.plans.oracle import BATCH_SQL


def test_late_at_equality(spark):
    # window [0, 60000) ends 60000; with lateness 10000 and delay 5000 a row
    # of that window is late once max_before >= 75000
    rows = [dict(event_time=75_000, arrival_seq=0), dict(event_time=59_999, arrival_seq=1)]
    on, late = split_late(make_tx(spark, rows), 60_000, 10_000)
    assert [r.event_time for r in late.collect()] == [59_999]
    rows = [dict(event_time=74_999, arrival_seq=0), dict(event_time=59_999, arrival_seq=1)]
    on, late = split_late(make_tx(spark, rows), 60_000, 10_000)
    assert late.count() == 0 and on.count() == 2


def test_first_row_never_late(spark):
    on, late = split_late(make_tx(spark, [dict(event_time=5)]), 60_000)
    assert late.count() == 0


def test_small_buckets_equal_oracle(spark):
    # many buckets exercise the carried maximum across buckets
    tx = load_tx(spark, SF01)
    _, late = split_late(tx, 60_000, 10_000, bucket_width=97)
    from cardstream.functions import format as fmt
    from cardstream.sources.fixtures import TX_COLUMNS
    df = late.select(*TX_COLUMNS, fmt.tx_json().alias("line"))
    res = compare(df, duck(SF01), BATCH_SQL["late_transactions"])
    assert res["ok"], res


def test_order_column_must_be_numeric(spark):
    import pytest
    tx = make_tx(spark, [dict(event_time=1)])
    with pytest.raises(ValueError, match="must be numeric"):
        split_late(tx, 60_000, order_by=["transaction_id"])


def test_bucket_width_follows_the_rows(spark):
    """Sparse positions and event times: about as many buckets as the rows fill, one task's worth each."""
    from cardstream.operators import sequence
    from pyspark.sql import functions as F
    rows = spark.range(1000).select((F.col("id") * 10**9).alias("offset"), F.col("id").alias("arrival_seq"))
    assert sequence.counted_width(rows, "arrival_seq") == sequence.BUCKET_ROWS
    assert sequence.counted_width(rows, "offset") > 999 * 10**9
    assert sequence.counted_width(rows.limit(0), "offset") == 1
