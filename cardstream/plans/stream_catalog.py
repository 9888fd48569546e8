"""Registered streaming queries (``stream_*``).

Each one turns the ``events`` table into JSON-line files in arrival order (the
drop folder a producer would fill), runs the streaming form of the operator
over it with ``availableNow`` and several micro-batches, and reads the sink
back. Windowed streams use a watermark delay as long as the table's largest
disorder, as measured, so they must equal the batch results over all rows;
the stateful rules, the late split and the scored union equal their batch
twins whatever the micro-batch cut.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.operators import metrics, rules
from cardstream.operators.alerts import union_alerts
from cardstream.operators.scoring import score_alerts
from cardstream.operators.late import with_watermark_before
from cardstream.operators.sequence import PARTITION_BITS
from cardstream.plans.catalog import (
    SOURCE_PARTITIONS, TX_COLUMNS, card_partition, damaged_lines, default_refs, load_tx,
)
from cardstream.plans.job import (
    exact_scored_alerts, read_job_alerts, read_job_windows, start_streaming_job,
)
from cardstream.plans.oracle import BATCH_SQL, PARTITIONED_MINUTE_SQL
from cardstream.schema import (
    MINUTE_ALLOWED_LATENESS_MS, MINUTE_WINDOW_MS, RULE_HIGH_AMOUNT, RULE_IMPOSSIBLE_TRAVEL, TX_FIELDS,
    flatten_alerts,
)
from cardstream.session import ensure_streaming_conf, scratch_path, stream_partitions
from cardstream.sources.fixtures import fixture_transactions
from cardstream.sources.json_lines import HEARTBEAT_FORMAT, positioned_lines, stream_lines
from cardstream.functions import format as fmt
from cardstream.streaming.emissions import MinuteEmissionsWriter, read_minute_emissions
from cardstream.streaming.exact import ExactWindowsBatchWriter, read_exact_windows
from cardstream.streaming.late import LateSplitBatchWriter
from cardstream.streaming.ordered import OrderedRules, read_ordered_alerts
from cardstream.streaming.sinks import append_sink, read_upserts, upsert_sink
from cardstream.streaming.source import (
    decoded_stream, stream_rejects, watermarked_transactions, write_drop_folder,
    write_lines_folder,
)

# Drop files (one per micro-batch): several even of a small table, and of a large one as
# many as keep a file near this many rows.
MIN_STREAM_FILES = 6
ROWS_PER_STREAM_FILE = 5_000_000
AVAILABLE_NOW = {"availableNow": True}


# State partitions: about this many rows per partition per micro-batch,
# between 2 and the cluster's default parallelism (what applies at scale).
ROWS_PER_STATE_PARTITION = 5_000


def event_rows(spark: SparkSession, sf_dir: str) -> int:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()        # parquet footers


def stream_files(spark: SparkSession, sf_dir: str) -> int:
    rows = event_rows(spark, sf_dir)
    return max(MIN_STREAM_FILES, -(-rows // ROWS_PER_STREAM_FILE))


def stream_delay(spark: SparkSession, sf_dir: str) -> str:
    """The watermark delay that drops no row of the table: the longest that an event time
    lies behind one that arrived before it."""
    marked = with_watermark_before(load_tx(spark, sf_dir), delay_ms=0)
    lag = marked.agg(F.max(F.col("wm_before") - F.col("event_time"))).first()[0]
    return f"{max(lag or 0, 0) + 1} milliseconds"


def state_partitions_for(spark: SparkSession, sf_dir: str) -> int:
    rows = event_rows(spark, sf_dir)
    per_batch = max(1, rows // stream_files(spark, sf_dir))
    n = -(-per_batch // ROWS_PER_STATE_PARTITION)
    return max(2, min(spark.sparkContext.defaultParallelism, n))


def _drop(spark: SparkSession, sf_dir: str, root: str) -> str:
    tx = fixture_transactions(spark, sf_dir)
    return write_drop_folder(spark, tx, f"{root}/in", stream_files(spark, sf_dir))


def run_append(spark: SparkSession, sf_dir: str, name: str,
               build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``build(watermarked tx stream)`` to completion; read the sink."""
    ensure_streaming_conf(spark)
    root = scratch_path(spark, name)
    drop = _drop(spark, sf_dir, root)
    tx = watermarked_transactions(decoded_stream(spark, drop), stream_delay(spark, sf_dir))
    result = build(tx)
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        q = append_sink(result, f"{root}/out", f"{root}/ckpt", "parquet", AVAILABLE_NOW)
    q.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{root}/out")


def s_minute_totals(spark, sf_dir):
    return run_append(spark, sf_dir, "stream_minute_totals", metrics.minute_totals)


def s_category_average(spark, sf_dir):
    return run_append(spark, sf_dir, "stream_category_average", metrics.category_average)


def s_country_counts(spark, sf_dir):
    return run_append(spark, sf_dir, "stream_country_counts", metrics.country_counts)


def s_high_frequency_alerts(spark, sf_dir):
    return flatten_alerts(run_append(spark, sf_dir, "stream_high_frequency",
                                     rules.high_frequency_alerts))


def s_merchant_burst_alerts(spark, sf_dir):
    return flatten_alerts(run_append(spark, sf_dir, "stream_merchant_burst",
                                     rules.merchant_burst_alerts))


def _tx_stream(spark: SparkSession, folder: str) -> DataFrame:
    return decoded_stream(spark, folder).where(F.col("_kind") == "tx").select(*TX_COLUMNS)


def _foreach(spark: SparkSession, sf_dir: str, rows: DataFrame, writer, checkpoint: str):
    """Start ``writer`` over the micro-batches of ``rows``."""
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        return (rows.writeStream.option("checkpointLocation", checkpoint)
                .foreachBatch(writer).trigger(**AVAILABLE_NOW).start())


def run_ordered(spark: SparkSession, sf_dir: str, name: str, rule: str) -> DataFrame:
    """An ordered rule on a stream: halo rows from the tables of key tails."""
    root = scratch_path(spark, name)
    tx = _tx_stream(spark, _drop(spark, sf_dir, root))
    _foreach(spark, sf_dir, tx, OrderedRules(f"{root}/out", [rule]), f"{root}/ckpt").awaitTermination()
    return read_ordered_alerts(spark, f"{root}/out")


def s_high_amount_alerts(spark, sf_dir):
    return flatten_alerts(run_ordered(spark, sf_dir, "stream_high_amount", RULE_HIGH_AMOUNT))


def s_impossible_travel_alerts(spark, sf_dir):
    return flatten_alerts(run_ordered(spark, sf_dir, "stream_impossible_travel", RULE_IMPOSSIBLE_TRAVEL))


def windowed_alerts(tx: DataFrame) -> DataFrame:
    """Rules 1 and 4 over a watermarked stream."""
    return union_alerts(rules.high_frequency_alerts(tx), rules.merchant_burst_alerts(tx))


def s_scored_alerts(spark, sf_dir):
    """The four rules over one drop folder: the windowed ones under Spark's watermark, the
    ordered ones over their key tails; united and scored."""
    ensure_streaming_conf(spark)
    root = scratch_path(spark, "stream_scored_alerts")
    drop = _drop(spark, sf_dir, root)
    windowed = windowed_alerts(watermarked_transactions(decoded_stream(spark, drop), stream_delay(spark, sf_dir)))
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        started = [append_sink(windowed, f"{root}/windowed", f"{root}/ckpt-windowed", "parquet", AVAILABLE_NOW)]
    started.append(_foreach(spark, sf_dir, _tx_stream(spark, drop), OrderedRules(f"{root}/ordered"), f"{root}/ckpt-ordered"))
    for q in started:
        q.awaitTermination()
    rows = spark.read.schema(windowed.schema).parquet(f"{root}/windowed")
    alerts = union_alerts(rows, read_ordered_alerts(spark, f"{root}/ordered"))
    return flatten_alerts(score_alerts(alerts, *default_refs(spark)))


def s_late_transactions(spark, sf_dir):
    ensure_streaming_conf(spark)
    root = scratch_path(spark, "stream_late")
    drop = _drop(spark, sf_dir, root)
    decoded = decoded_stream(spark, drop)
    tx = decoded.where(F.col("_kind") == "tx").select(*TX_COLUMNS)
    writer = LateSplitBatchWriter(f"{root}/out", MINUTE_WINDOW_MS,
                                  MINUTE_ALLOWED_LATENESS_MS)
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        q = (tx.writeStream.option("checkpointLocation", f"{root}/ckpt")
             .foreachBatch(writer).trigger(availableNow=True).start())
    q.awaitTermination()
    late = spark.read.schema(tx.schema).parquet(f"{root}/out/late/batch_id=*")
    return late.select(*TX_COLUMNS, fmt.tx_json().alias("line"))


def s_minute_totals_upsert(spark, sf_dir):
    """Metric 1 in update mode (EVT-2 re-emission) through the upsert log."""
    ensure_streaming_conf(spark)
    root = scratch_path(spark, "stream_minute_upsert")
    drop = _drop(spark, sf_dir, root)
    tx = watermarked_transactions(decoded_stream(spark, drop), stream_delay(spark, sf_dir))
    totals = metrics.minute_totals(tx)
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        q = upsert_sink(totals, f"{root}/out", f"{root}/ckpt", AVAILABLE_NOW)
    q.awaitTermination()
    return read_upserts(spark, f"{root}/out", ["window_end"]).select(*totals.columns)


def s_rejects(spark, sf_dir):
    """Undecodable lines of a damaged feed, kept aside by the stream."""
    root = scratch_path(spark, "stream_rejects")
    lines = damaged_lines(fixture_transactions(spark, sf_dir))
    drop = write_lines_folder(spark, lines, f"{root}/in", stream_files(spark, sf_dir))
    rejects = stream_rejects(decoded_stream(spark, drop))
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        q = append_sink(rejects, f"{root}/out", f"{root}/ckpt", "parquet", AVAILABLE_NOW)
    q.awaitTermination()
    return spark.read.schema(rejects.schema).parquet(f"{root}/out")


def run_exact_windows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Windowed outputs with the reference's exact late-row dropping, from a
    stream (per-micro-batch split + partial aggregates)."""
    root = scratch_path(spark, f"stream_exact_{name}")
    drop = _drop(spark, sf_dir, root)
    tx = decoded_stream(spark, drop).where(F.col("_kind") == "tx").select(*TX_COLUMNS)
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        q = (tx.writeStream.option("checkpointLocation", f"{root}/ckpt")
             .foreachBatch(ExactWindowsBatchWriter(f"{root}/out"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    out = read_exact_windows(spark, f"{root}/out")[name]
    return flatten_alerts(out) if "tx" in out.columns else out


def s_scored_alerts_ontime(spark, sf_dir):
    """The job's alerts with exact late-row dropping: windowed rules from the exact
    windows, ordered rules over every row."""
    ensure_streaming_conf(spark)
    root = scratch_path(spark, "stream_scored_ontime")
    drop = _drop(spark, sf_dir, root)
    tx = decoded_stream(spark, drop).where(F.col("_kind") == "tx").select(*TX_COLUMNS)
    started = [_foreach(spark, sf_dir, tx, OrderedRules(f"{root}/ordered"), f"{root}/ckpt-ordered"),
               _foreach(spark, sf_dir, tx, ExactWindowsBatchWriter(f"{root}/exact"), f"{root}/ckpt-exact")]
    for q in started:
        q.awaitTermination()
    rows = read_ordered_alerts(spark, f"{root}/ordered")
    return flatten_alerts(exact_scored_alerts(spark, f"{root}/exact", rows, *default_refs(spark)))


def s_minute_total_emissions(spark, sf_dir):
    """Metric 1 as printed by a stream: firing lines and re-emissions, then those of the end."""
    ensure_streaming_conf(spark)
    root = scratch_path(spark, "stream_minute_emissions")
    drop = _drop(spark, sf_dir, root)
    tx = decoded_stream(spark, drop).where(F.col("_kind") == "tx").select(*TX_COLUMNS)
    with stream_partitions(spark, state_partitions_for(spark, sf_dir)):
        q = (tx.writeStream.option("checkpointLocation", f"{root}/ckpt")
             .foreachBatch(MinuteEmissionsWriter(f"{root}/out")).trigger(**AVAILABLE_NOW).start())
    q.awaitTermination()
    return read_minute_emissions(spark, f"{root}/out", ended=True)


def s_high_amount_alerts_subcent(spark, sf_dir):
    """Rule 2 over lines whose amounts have all their decimals."""
    ensure_streaming_conf(spark)
    root = scratch_path(spark, "stream_high_amount_subcent")
    tx = fixture_transactions(spark, sf_dir, sub_cent=True)
    lines = tx.select("arrival_seq", F.to_json(F.struct(*TX_FIELDS, "arrival_seq")).alias("value"))
    drop = write_lines_folder(spark, lines, f"{root}/in", stream_files(spark, sf_dir))
    writer = OrderedRules(f"{root}/out", [RULE_HIGH_AMOUNT])
    _foreach(spark, sf_dir, _tx_stream(spark, drop), writer, f"{root}/ckpt").awaitTermination()
    return flatten_alerts(read_ordered_alerts(spark, f"{root}/out"))


def plain_lines(tx: DataFrame, heartbeat_after_ms: int | None = 86_400_000) -> DataFrame:
    """Lines as the reference writes them (no position in them), and a last heartbeat."""
    lines = tx.select("arrival_seq", fmt.tx_json().alias("value"))
    if heartbeat_after_ms is None:
        return lines
    last = tx.agg(F.max("arrival_seq").alias("s"), F.max("event_time").alias("m")).select(
        (F.col("s") + 1).alias("arrival_seq"),
        F.format_string(HEARTBEAT_FORMAT, F.col("m") + F.lit(int(heartbeat_after_ms))).alias("value"))
    return lines.unionByName(last)


def run_job(spark: SparkSession, sf_dir: str) -> str:
    """The whole streaming job over a drop folder of plain lines; its output folder. Each query
    runs it anew, so that it reads the table as it is and takes the same time whatever ran before."""
    root = scratch_path(spark, "stream-job")
    drop = write_lines_folder(spark, plain_lines(fixture_transactions(spark, sf_dir)), f"{root}/in",
                              stream_files(spark, sf_dir))
    start_streaming_job(spark, drop, f"{root}/out", trigger=AVAILABLE_NOW, max_files_per_trigger=1,
                        number_file_lines=True,
                        state_partitions=state_partitions_for(spark, sf_dir)).awaitTermination()
    return f"{root}/out"


def s_job_scored_alerts(spark, sf_dir):
    """The job's alert log: every on-time alert once."""
    return flatten_alerts(read_job_alerts(spark, run_job(spark, sf_dir)))


def s_job_late_transactions(spark, sf_dir):
    """The job's late output, with positions taken from the files."""
    late = spark.read.parquet(run_job(spark, sf_dir) + "/late/batch_id=*")
    return late.select(*TX_COLUMNS, fmt.tx_json().alias("line"))


def s_job_minute_total_emissions(spark, sf_dir):
    """What the job prints of metric 1, up to the last heartbeat."""
    out = run_job(spark, sf_dir)
    return read_minute_emissions(spark, f"{out}/minute_emissions", True, f"{out}/progress")


def s_job_metrics(name: str):
    """A metric of the job, from its closed windows."""
    return lambda spark, sf_dir: read_job_windows(spark, run_job(spark, sf_dir))[name]


def run_partitioned_job(spark: SparkSession, sf_dir: str) -> str:
    """The job over records (partition, offset, line) of a source of several partitions, each of
    which ends with a heartbeat; its output folder."""
    root, tx = scratch_path(spark, "stream-job-partitioned"), fixture_transactions(spark, sf_dir)
    lines = tx.select("arrival_seq", card_partition().alias("partition"), fmt.tx_json().alias("value"))
    beats = tx.agg(F.max("arrival_seq").alias("s"), F.max("event_time").alias("m")).select(
        F.explode(F.sequence(F.lit(0), F.lit(SOURCE_PARTITIONS - 1))).alias("partition"), "s", "m").select(
        (F.col("s") + 1 + F.col("partition")).alias("arrival_seq"), "partition",
        F.format_string(HEARTBEAT_FORMAT, F.col("m") + F.lit(86_400_000)).alias("value"))
    record = F.to_json(F.struct("partition", F.col("arrival_seq").alias("offset"), "value"))
    drop = write_lines_folder(spark, lines.unionByName(beats).select("arrival_seq", record.alias("value")),
                              f"{root}/in", stream_files(spark, sf_dir))
    records = stream_lines(spark, drop, 1).select(
        F.from_json("value", "partition int, offset bigint, value string").alias("r")).select("r.*")
    start_streaming_job(spark, positioned_lines(records, SOURCE_PARTITIONS), f"{root}/out", trigger=AVAILABLE_NOW,
                        source_partitions=SOURCE_PARTITIONS,
                        state_partitions=state_partitions_for(spark, sf_dir)).awaitTermination()
    return f"{root}/out"


def s_partitioned_late(spark, sf_dir):
    late = spark.read.parquet(run_partitioned_job(spark, sf_dir) + "/late/batch_id=*")
    return (late.withColumn("arrival_seq", F.shiftright("arrival_seq", PARTITION_BITS))
            .select(*TX_COLUMNS, fmt.tx_json().alias("line")))


def s_partitioned_minute_totals(spark, sf_dir):
    return read_job_windows(spark, run_partitioned_job(spark, sf_dir))["minute_totals"]


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_minute_totals": s_minute_totals,
    "stream_category_average": s_category_average,
    "stream_country_counts": s_country_counts,
    "stream_high_frequency_alerts": s_high_frequency_alerts,
    "stream_high_amount_alerts": s_high_amount_alerts,
    "stream_impossible_travel_alerts": s_impossible_travel_alerts,
    "stream_merchant_burst_alerts": s_merchant_burst_alerts,
    "stream_late_transactions": s_late_transactions,
    "stream_scored_alerts": s_scored_alerts,
    "stream_minute_totals_upsert": s_minute_totals_upsert,
    "stream_rejects": s_rejects,
    "stream_minute_total_emissions": s_minute_total_emissions,
    "stream_high_amount_alerts_subcent": s_high_amount_alerts_subcent,
    "stream_minute_totals_ontime":
        lambda spark, sf_dir: run_exact_windows(spark, sf_dir, "minute_totals"),
    "stream_category_average_ontime":
        lambda spark, sf_dir: run_exact_windows(spark, sf_dir, "category_average"),
    "stream_country_counts_ontime":
        lambda spark, sf_dir: run_exact_windows(spark, sf_dir, "country_counts"),
    "stream_high_frequency_alerts_ontime":
        lambda spark, sf_dir: run_exact_windows(spark, sf_dir, "high_frequency_alerts"),
    "stream_merchant_burst_alerts_ontime":
        lambda spark, sf_dir: run_exact_windows(spark, sf_dir, "merchant_burst_alerts"),
    "stream_scored_alerts_ontime": s_scored_alerts_ontime,
    "stream_job_scored_alerts": s_job_scored_alerts,
    "stream_job_late_transactions": s_job_late_transactions,
    "stream_job_minute_total_emissions": s_job_minute_total_emissions,
    "stream_job_category_average": s_job_metrics("category_average"),
    "stream_job_country_counts": s_job_metrics("country_counts"),
    "stream_job_partitioned_late": s_partitioned_late,
    "stream_job_partitioned_minute_totals": s_partitioned_minute_totals,
}

_TWIN = {
    "stream_minute_totals_upsert": "minute_totals",
    "stream_job_scored_alerts": "scored_alerts_ontime",
    "stream_job_late_transactions": "late_transactions",
    "stream_job_partitioned_late": "late_transactions_partitioned",
    "stream_job_category_average": "category_average_ontime",
    "stream_job_country_counts": "country_counts_ontime",
}
STREAM_ORACLE: dict[str, str] = {
    name: BATCH_SQL[_TWIN.get(name, name[len("stream_"):])] for name in STREAM_QUERIES
    if name not in ("stream_job_minute_total_emissions", "stream_job_partitioned_minute_totals")
}
STREAM_ORACLE["stream_job_partitioned_minute_totals"] = PARTITIONED_MINUTE_SQL
# After the feed's last heartbeat the watermark has fired every window.
STREAM_ORACLE["stream_job_minute_total_emissions"] = (
    BATCH_SQL["minute_total_emissions"].replace("'end_of_input'", "'watermark'"))
