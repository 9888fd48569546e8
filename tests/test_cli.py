"""Command line runs the whole batch job from text lines."""

from conftest import SF001
from cardstream.cli import run
from cardstream.session import scratch_path
from cardstream.sources.fixtures import fixture_transactions
from cardstream.streaming.source import json_lines_with_seq


def test_batch_cli(spark):
    root = scratch_path(spark, "t-cli")
    json_lines_with_seq(fixture_transactions(spark, SF001)).select("value") \
        .write.text(f"{root}/in")
    assert run(spark, ["batch", "--input", f"{root}/in", "--out", f"{root}/out"]) == 0
    assert spark.read.parquet(f"{root}/out/alerts").count() == 73
    # a retried run replaces its alerts, another run adds its own
    assert run(spark, ["batch", "--input", f"{root}/in", "--out", f"{root}/out"]) == 0
    assert spark.read.text(f"{root}/out/alert_lines").count() == 73
    assert run(spark, ["batch", "--input", f"{root}/in", "--out", f"{root}/out", "--run-id", "second"]) == 0
    assert spark.read.text(f"{root}/out/alert_lines").count() == 2 * 73
    assert spark.read.parquet(f"{root}/out/late_transactions").count() == 7
    assert spark.read.parquet(f"{root}/out/rejects").count() == 0


def test_stream_cli(spark):
    from cardstream.streaming.source import write_drop_folder
    root = scratch_path(spark, "t-cli-stream")
    drop = write_drop_folder(spark, fixture_transactions(spark, SF001), f"{root}/in", 2)
    assert run(spark, ["stream", "--source", drop, "--out", f"{root}/out",
                       "--available-now", "--max-files-per-trigger", "1"]) == 0
    alerts = spark.read.parquet(f"{root}/out/alerts/batch_id=*")
    by_rule = {r.rule: r["count"] for r in alerts.groupBy("rule").count().collect()}
    assert by_rule["High Amount"] == 42 and by_rule["Impossible Travel"] == 30


def test_batch_cli_without_arrival_seq(spark):
    """Plain reference lines (no arrival_seq): order falls back to event time."""
    from pyspark.sql import functions as F
    from cardstream.functions import format as fmt
    root = scratch_path(spark, "t-cli-noseq")
    tx = fixture_transactions(spark, SF001)
    tx.orderBy("arrival_seq").select(fmt.tx_json().alias("value")).write.text(f"{root}/in")
    assert run(spark, ["batch", "--input", f"{root}/in", "--out", f"{root}/out",
                       "--no-seq", "--complete"]) == 0
    alerts = spark.read.parquet(f"{root}/out/alerts")
    assert "arrival_seq" not in spark.read.parquet(f"{root}/out/transactions").columns
    # with event-time order no backdated row precedes its card's later rows,
    # so no travel gap is negative
    travel = alerts.where(F.col("rule") == "Impossible Travel")
    assert travel.count() > 0 and travel.where(F.col("gap_minutes") < 0).count() == 0


def test_numbered_lines_follow_the_files(spark):
    """Positions are dense and follow file time, then the lines, over many splits."""
    from pyspark.sql import functions as F
    from cardstream.sources.json_lines import read_numbered_lines
    from cardstream.streaming.source import write_lines_folder
    lines = spark.range(5000).select(F.col("id").alias("arrival_seq"),
                                     F.concat(F.lit("line "), F.col("id").cast("string")).alias("value"))
    folder = write_lines_folder(spark, lines, scratch_path(spark, "t-lines"), 5)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = read_numbered_lines(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.arrival_seq, r.value) for r in rows) == sorted((i, f"line {i}") for i in range(5000))


def test_windowed_rules_refuse_rows_without_order(spark):
    import pytest
    from cardstream.operators import rules
    from cardstream.plans.catalog import load_tx
    from pyspark.sql import functions as F
    tx = load_tx(spark, SF001).withColumn("arrival_seq", F.when(F.col("event_time") < 0, F.col("event_time")))
    with pytest.raises(Exception, match="order column is null"):
        rules.high_frequency_alerts(tx).collect()


def test_stream_cli_plain_lines(spark):
    """Reference lines on a stream: the windowed rules fire."""
    from pyspark.sql import functions as F
    from cardstream.functions import format as fmt
    from cardstream.streaming.source import write_lines_folder
    root = scratch_path(spark, "t-cli-plain")
    tx = fixture_transactions(spark, SF001)
    lines = tx.select("arrival_seq", fmt.tx_json().alias("value"))
    last = tx.agg((F.max("arrival_seq") + 1).alias("arrival_seq"), F.max("event_time").alias("m")).select(
        "arrival_seq", F.format_string('{"heartbeat_time":%d}', F.col("m") + 86_400_000).alias("value"))
    drop = write_lines_folder(spark, lines.unionByName(last), f"{root}/in", 2)
    assert run(spark, ["stream", "--source", drop, "--out", f"{root}/out", "--available-now", "--number-lines"]) == 0
    assert spark.read.parquet(f"{root}/out/late/batch_id=*").count() == 7
    alerts = spark.read.parquet(f"{root}/out/alerts/batch_id=*")
    assert alerts.where(F.col("rule") == "High Frequency").count() == 1
