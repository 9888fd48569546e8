"""Stream == batch for every stream form, under different micro-batch cuts,
and across a restart from the checkpoint."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from cardstream.functions.timecols import with_event_time
from cardstream.operators import rules
from cardstream.operators.late import split_late
from cardstream.plans import stream_catalog as sc
from cardstream.plans.catalog import scored_alerts
from cardstream.schema import flatten_alerts
from cardstream.session import ensure_streaming_conf, scratch_path
from cardstream.sources.fixtures import TX_COLUMNS, fixture_transactions
from cardstream.streaming.late import LateSplitBatchWriter
from cardstream.schema import RULE_HIGH_AMOUNT, RULE_IMPOSSIBLE_TRAVEL
from cardstream.streaming.ordered import OrderedRules, read_ordered_alerts
from cardstream.streaming.sinks import append_sink
from cardstream.streaming.source import (
    decoded_stream, watermarked_transactions, write_drop_folder, write_lines_folder,
)


def _rows(df, drop=()):
    df = flatten_alerts(df) if "tx" in df.columns else df
    return sorted(tuple(r) for r in df.drop(*drop).collect())


@pytest.fixture(scope="module")
def tx(spark):
    ensure_streaming_conf(spark)
    return fixture_transactions(spark, SF001)


def _run(spark, source, build, root, ckpt=None):
    stream_tx = watermarked_transactions(decoded_stream(spark, source), "10 minutes")
    out = build(stream_tx)
    q = append_sink(out, f"{root}/out", ckpt or f"{root}/ckpt", "parquet",
                    {"availableNow": True})
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def _ordered(spark, source, root, **options):
    stx = decoded_stream(spark, source).where(F.col("_kind") == "tx").select(*TX_COLUMNS)
    q = (stx.writeStream.option("checkpointLocation", f"{root}/ckpt-ordered")
         .foreachBatch(OrderedRules(f"{root}/ordered", **options)).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_ordered_alerts(spark, f"{root}/ordered")


def _both_ordered(tx):
    from cardstream.operators.alerts import union_alerts
    return _rows(union_alerts(rules.high_amount_alerts(tx), rules.impossible_travel_alerts(tx)))


@pytest.mark.parametrize("n_files,merge_every", [(2, 16), (7, 2), (7, 3)])
def test_ordered_rules_over_key_tails(spark, tx, n_files, merge_every):
    root = scratch_path(spark, f"t-ordered-{n_files}")
    drop = write_drop_folder(spark, tx, f"{root}/in", n_files)
    got = _ordered(spark, drop, root, merge_every=merge_every)
    assert _rows(got) == _both_ordered(with_event_time(tx))
    assert got.count() == 72


def test_windowed_rules_under_the_native_watermark(spark, tx):
    root = scratch_path(spark, "t-windowed")
    drop = write_drop_folder(spark, tx, f"{root}/in", 3)
    got = _run(spark, drop, sc.windowed_alerts, root)
    want = with_event_time(tx)
    assert _rows(got) == sorted(_rows(rules.high_frequency_alerts(want)) + _rows(rules.merchant_burst_alerts(want)))


def test_ordered_rules_replay_skew_and_null_keys(spark, tx):
    """A hot customer and card are split; a batch that comes twice changes nothing; null keys
    and amounts beyond cents are carried from batch to batch."""
    hot = F.col("arrival_seq") % 3 == 0
    skewed = with_event_time(
        tx.withColumn("customer_id", F.when(hot, "cust-hot").when(F.col("arrival_seq") % 7 > 0, F.col("customer_id")))
        .withColumn("card_id", F.when(hot, "card-hot").otherwise(F.col("card_id")))
        .withColumn("amount", F.col("amount") / 7 * 6))
    skewed = skewed.drop("amount_cents").transform(with_event_time).cache()
    writer = OrderedRules(out := scratch_path(spark, "t-ordered-skew"), hot_rows=60, merge_every=2)
    n = skewed.count()
    for i in [0, 1, 1, 2, 3, 3, 4]:
        writer(skewed.where(F.floor(F.col("arrival_seq") * 5 / n) == i), i)
    got = read_ordered_alerts(spark, out)
    assert _rows(got) == _both_ordered(skewed) and got.count() > 20
    bases = spark.read.option("basePath", f"{out}/base").parquet(f"{out}/base").select("batch_id").distinct().count()
    assert bases == 1                                   # older tables are gone
    rows = writer.with_halo(skewed, 4)
    plan = writer.alerts(rows, ["arrival_seq"], True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    skewed.unpersist()


def test_restart_from_checkpoint(spark, tx):
    root = scratch_path(spark, "t-restart")
    first = tx.where(F.col("arrival_seq") < 500)
    second = tx.where(F.col("arrival_seq") >= 500)
    write_drop_folder(spark, first, f"{root}/in1", 3, heartbeat_after_ms=None)
    part = _ordered(spark, f"{root}/in*/drop", root).count()
    write_drop_folder(spark, second, f"{root}/in2", 3)
    full = _ordered(spark, f"{root}/in*/drop", root)
    assert 0 < part < full.count()
    assert _rows(full) == _both_ordered(with_event_time(tx))


@pytest.mark.parametrize("n_files", [3, 5])
def test_late_split_stream(spark, tx, n_files):
    root = scratch_path(spark, f"t-late-{n_files}")
    drop = write_drop_folder(spark, tx, f"{root}/in", n_files)
    decoded = decoded_stream(spark, drop)
    stx = decoded.where(F.col("_kind") == "tx").select(*TX_COLUMNS)
    q = (stx.writeStream.option("checkpointLocation", f"{root}/ckpt")
         .foreachBatch(LateSplitBatchWriter(f"{root}/out", 60_000, 10_000))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.schema(stx.schema).parquet(f"{root}/out/late/batch_id=*")
    _, late = split_late(with_event_time(tx), 60_000, 10_000)
    assert _rows(got) == _rows(late.select(*TX_COLUMNS))
    assert got.count() == 7


def _job(spark, drop, out, **options):
    from cardstream.plans.job import start_streaming_job
    start_streaming_job(spark, drop, out, trigger={"availableNow": True}, max_files_per_trigger=1,
                        **options).awaitTermination()
    return out


def _ontime(spark):
    from cardstream.plans.catalog import q_scored_alerts_ontime
    return q_scored_alerts_ontime(spark, SF001)


def _text(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


@pytest.mark.parametrize("n_files,split_bytes", [(1, None), (9, None), (2, 20_000)])
def test_job_from_plain_lines(spark, tx, n_files, split_bytes):
    """Positions come from the files: the same outputs whatever the cut into files and splits,
    each alert once, every window closed and every line printed after the heartbeat."""
    from cardstream.functions import format as fmt
    from cardstream.operators.metrics import minute_total_emissions
    from cardstream.plans.job import read_job_alerts, read_job_windows
    root = scratch_path(spark, f"t-job-{n_files}")
    drop = write_lines_folder(spark, sc.plain_lines(tx), f"{root}/in", n_files)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        out = _job(spark, drop, f"{root}/out", number_file_lines=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = _ontime(spark)
    alerts = read_job_alerts(spark, out)
    assert _rows(flatten_alerts(alerts).select(*want.columns)) == _rows(want) and alerts.count() == 73
    assert _text(spark, f"{out}/alert_lines/batch_id=*") == sorted(r.l for r in alerts.select(fmt.alert_line().alias("l")).collect())
    _, late = split_late(with_event_time(tx), 60_000, 10_000)
    got = spark.read.parquet(f"{out}/late/batch_id=*")
    assert _rows(got.select(*TX_COLUMNS)) == _rows(late.select(*TX_COLUMNS)) and got.count() == 7
    assert spark.read.parquet(f"{out}/exact/open/batch_id={n_files - 1}").count() == 0
    assert read_job_windows(spark, out)["minute_totals"].count() == 60
    printed = [r.line for r in minute_total_emissions(with_event_time(tx)).collect()]
    assert _text(spark, f"{out}/minute_emissions/text/batch_id=*") == sorted(printed)
    assert len(_text(spark, f"{out}/category_average_lines/batch_id=*")) == 60
    # a backlog of n micro-batches is n batches of every output
    for output in ("bronze", "late", "alerts", "exact/closed", "minute_emissions/lines", "ordered/delta", "progress"):
        batches = spark.read.option("basePath", f"{out}/{output}").parquet(f"{out}/{output}").inputFiles()
        assert len({f.split("batch_id=")[1].split("/")[0] for f in batches}) == n_files, output


def test_job_replay_and_idle_feed(spark, tx):
    """A batch that fails between its outputs and its commit comes again; a heartbeat alone closes
    the windows of the batches before."""
    from cardstream.plans.catalog import default_refs
    from cardstream.plans.job import JobBatchWriter, read_job_alerts
    lines = sc.plain_lines(tx, None)
    beat = spark.createDataFrame([(10**6, '{"heartbeat_time":1999999999999}'), (10**6 + 1, "broken"), (10**6 + 2, " ")],
                                 "arrival_seq bigint, value string")
    out = scratch_path(spark, "t-job-replay")
    writer = JobBatchWriter(out, *default_refs(spark), numbering="column")
    half = lines.where("arrival_seq < 480"), lines.where("arrival_seq >= 480"), beat
    for i in (0, 0, 1, 1, 2, 2):
        writer(half[i], i)
    want = _ontime(spark)
    assert _rows(flatten_alerts(read_job_alerts(spark, out)).select(*want.columns)) == _rows(want)
    assert len(_text(spark, f"{out}/alert_lines/batch_id=*")) == 73
    assert spark.read.parquet(f"{out}/exact/open/batch_id=2").count() == 0
    assert [tuple(r) for r in spark.read.parquet(f"{out}/rejects/batch_id=*").collect()] == [("broken", "malformed_json")]
    before = spark.read.text(f"{out}/minute_emissions/text/batch_id=*").count()
    writer(beat.limit(0), 3)                            # an empty batch
    assert spark.read.text(f"{out}/minute_emissions/text/batch_id=*").count() == before


def test_windows_keep_the_whole_order(spark):
    """Equal milliseconds: the last row of a window is the batch form's, by transaction id."""
    from conftest import make_tx
    from cardstream.streaming.exact import ExactWindowsBatchWriter, read_exact_windows
    rows = make_tx(spark, [{"event_time": 1_700_000_000_000, "transaction_id": f"t{i}"} for i in (3, 9, 1, 7, 5, 8, 2)])
    rows = rows.drop("arrival_seq")
    writer = ExactWindowsBatchWriter(out := scratch_path(spark, "t-exact-ties"))
    writer(rows.where("transaction_id > 't4'"), 0)
    writer(rows.where("transaction_id <= 't4'"), 1)
    got = read_exact_windows(spark, out)["high_frequency_alerts"]
    assert [r.tx.transaction_id for r in got.collect()] == ["t9"]
    assert _rows(got) == _rows(rules.high_frequency_alerts(rows))


def test_batch_job_reference_semantics(spark, tx):
    """The batch job reproduces the reference's outputs (FIXTURES counts)."""
    from cardstream.plans.job import run_batch_job
    from cardstream.streaming.source import json_lines_with_seq
    out = run_batch_job(spark, lines=json_lines_with_seq(tx).select("value"))
    assert out["rejects"].count() == 0
    assert out["late_transactions"].count() == 7
    by_rule = {r.rule: r["count"] for r in out["alerts"].groupBy("rule").count().collect()}
    assert by_rule == {"High Frequency": 1, "High Amount": 42, "Impossible Travel": 30}
    levels = {r.risk_level: r["count"] for r in out["alerts"].groupBy("risk_level").count().collect()}
    assert levels == {"HIGH": 20, "MEDIUM": 53}
    assert out["minute_totals"].count() == 60
    assert out["alert_lines"].count() == 73


@pytest.mark.parametrize("n_files", [1, 9])
def test_minute_emissions_stream(spark, tx, n_files):
    """Lines of the stream equal the batch replay, and none is printed before its window fires."""
    from cardstream.operators.metrics import minute_total_emissions
    from cardstream.streaming.emissions import MinuteEmissionsWriter, read_minute_emissions
    root = scratch_path(spark, f"t-emissions-{n_files}")
    drop = write_drop_folder(spark, tx, f"{root}/in", n_files)
    stx = decoded_stream(spark, drop).where(F.col("_kind") == "tx").select(*TX_COLUMNS)
    q = (stx.writeStream.option("checkpointLocation", f"{root}/ckpt")
         .foreachBatch(MinuteEmissionsWriter(f"{root}/out")).trigger(availableNow=True).start())
    q.awaitTermination()
    want = minute_total_emissions(with_event_time(tx))
    got = read_minute_emissions(spark, f"{root}/out", ended=True)
    assert _rows(got.select(*want.columns)) == _rows(want)
    printed = read_minute_emissions(spark, f"{root}/out")
    assert set(r.fired_by for r in printed.select("fired_by").collect()) <= {"watermark", "late_row"}
    assert (sorted(r.value for r in spark.read.text(f"{root}/out/text/batch_id=*").collect())
            == sorted(r.line for r in printed.select("line").collect()))
    # the newest two tables of open windows stay, each a few windows wide
    left = spark.read.option("basePath", f"{root}/out/open").parquet(f"{root}/out/open")
    assert 0 < left.count() <= 2 * 3 * 2


def test_exact_windows_keep_open_windows_only(spark, tx):
    from cardstream.streaming.exact import ExactWindowsBatchWriter
    writer = ExactWindowsBatchWriter(out := scratch_path(spark, "t-exact-open"))
    n = tx.count()
    for i in list(range(6)) + [5]:                  # the last batch comes twice, as after a failure
        writer(tx.where(F.floor(F.col("arrival_seq") * 6 / n) == i), i)
    folders = {r.batch_id for r in spark.read.option("basePath", f"{out}/open").parquet(f"{out}/open")
               .select("batch_id").distinct().collect()}
    assert folders == {4, 5}
    closed = spark.read.option("basePath", f"{out}/closed").parquet(f"{out}/closed")
    assert closed.where("output = 'minute_totals'").groupBy("window_end").count().where("count > 1").count() == 0
    from cardstream.streaming.exact import read_exact_windows
    assert read_exact_windows(spark, out)["minute_totals"].count() == 60
