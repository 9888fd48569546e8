"""Upsert log for update-mode metrics (SNK-1)."""

from cardstream.session import scratch_path
from cardstream.streaming.sinks import UpsertBatchWriter, read_upserts


def test_latest_version_per_key_and_idempotent_replay(spark):
    path = scratch_path(spark, "t-upsert")
    w = UpsertBatchWriter(path)
    ddl = "window_end bigint, n_tx bigint"
    w(spark.createDataFrame([(60_000, 3), (120_000, 1)], ddl), 0)
    w(spark.createDataFrame([(120_000, 2)], ddl), 1)
    w(spark.createDataFrame([(120_000, 5), (180_000, 1)], ddl), 2)
    w(spark.createDataFrame([(120_000, 5), (180_000, 1)], ddl), 2)   # replayed batch
    got = sorted(tuple(r) for r in read_upserts(spark, path, ["window_end"]).collect())
    assert got == [(60_000, 3), (120_000, 5), (180_000, 1)]


def test_alert_log_sink_writes_one_line_per_alert(spark):
    from conftest import SF001
    from cardstream.plans import stream_catalog as sc
    from cardstream.sources.fixtures import fixture_transactions
    from cardstream.streaming.sinks import alert_log_sink
    from cardstream.streaming.source import (
        decoded_stream, watermarked_transactions, write_drop_folder,
    )
    from cardstream.session import ensure_streaming_conf
    ensure_streaming_conf(spark)
    root = scratch_path(spark, "t-alert-log")
    drop = write_drop_folder(spark, fixture_transactions(spark, SF001), f"{root}/in", 2)
    tx = watermarked_transactions(decoded_stream(spark, drop), "10 minutes")
    q = alert_log_sink(sc.stream_scored(spark, tx), f"{root}/log", f"{root}/ckpt",
                       {"availableNow": True})
    q.awaitTermination()
    lines = [r.value for r in spark.read.text(f"{root}/log").collect()]
    assert len(lines) == 73
    assert all(x.startswith("Anomaly Detected! Timestamp: ") and " | Risk Score: " in x
               for x in lines)
