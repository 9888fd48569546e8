"""The whole job (PIPE-1): source -> metrics + late rows + four rules ->
union -> risk score -> separate outputs, in batch and streaming form.

Batch defaults reproduce the reference's event-time behaviour: metric 1
drops rows later than its 10 s allowed lateness (they go to
``late_transactions``), metrics 2-3 and rules 1 and 4 drop rows late for
their windows, rules 2 and 3 see every row. ``complete=True`` counts every
row everywhere instead.
"""

from __future__ import annotations

import warnings
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardstream.functions import format as fmt
from cardstream.functions.timecols import with_event_time
from cardstream.operators import metrics, rules
from cardstream.operators.alerts import all_rule_alerts, union_alerts
from cardstream.operators.late import late_flag, partition_times, with_watermark_before
from cardstream.operators.scoring import score_alerts
from cardstream.operators.sequence import DEFAULT_HOT_ROWS, STREAM_BUCKET_ROWS
from cardstream.schema import (
    FIVE_MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS, MINUTE_WINDOW_MS,
    OUT_OF_ORDERNESS_MS, RULE_WINDOW_MINUTES,
)
from cardstream.session import scratch_path, stream_partitions
from cardstream.sources.json_lines import (
    number_lines, parse_lines, stream_lines, stream_placed_lines, tx_columns,
)
from cardstream.streaming.emissions import MinuteEmissionsWriter
from cardstream.streaming.exact import ExactWindowsBatchWriter, read_exact_windows, window_outputs
from cardstream.streaming.ordered import OrderedRules
from cardstream.streaming.progress import Progress, together
from cardstream.streaming.sinks import write_lines

PARTITION_DDL = "source_partition bigint, max_event_time bigint"


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the parse) and lets every output share one decoded copy.
    """
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _warn_no_order() -> None:
    warnings.warn("no arrival order: rows are taken in the order of event time, in which hardly any row is "
                  "late. Number the lines to get the late rows of the feed.", stacklevel=3)


def run_batch_job(spark: SparkSession, lines: DataFrame | None = None,
                  risky_merchants: DataFrame | None = None,
                  blacklisted_countries: DataFrame | None = None,
                  transactions: DataFrame | None = None,
                  complete: bool = False,
                  order_by: Sequence[str] | None = None,
                  hot_rows: int | None = DEFAULT_HOT_ROWS,
                  materialize_input: bool = True,
                  lines_carry_seq: bool = True) -> dict[str, DataFrame]:
    """All outputs of the job as DataFrames (nothing is collected).

    Pass raw text ``lines`` (column ``value``) or decoded ``transactions``. Arrival
    order is the ``arrival_seq`` column of ``lines`` (``read_numbered_lines`` takes it
    from the input files), else the field of that name in every line; with
    ``lines_carry_seq=False`` it falls back to event time.

    With ``materialize_input`` every shared stage is computed once and
    written to the checkpoint folder: the decoded lines (one JSON parse for
    transactions and rejects), the transactions with the watermark each row
    saw (one pass for all late splits) and the scored alerts (shared by the
    alert rows and the alert lines).
    """
    rejects = None
    if transactions is None:
        numbered = "arrival_seq" in lines.columns
        if not (numbered or lines_carry_seq):
            _warn_no_order()
        typed = parse_lines(lines, seq_col="arrival_seq" if numbered else None, carry_seq=lines_carry_seq)
        typed = typed.withColumn(
            "line", F.when(F.col("_kind") == "reject", F.col("line")))
        if materialize_input:
            typed = materialize(spark, typed, "decoded")
        transactions = (typed.where(F.col("_kind") == "tx")
                        .select(*tx_columns(numbered or lines_carry_seq)))
        rejects = typed.where(F.col("_kind") == "reject").select("line", "reason")
    tx = with_event_time(transactions)
    if risky_merchants is None or blacklisted_countries is None:
        from cardstream.plans.catalog import default_refs
        risky_merchants, blacklisted_countries = default_refs(spark)

    # The watermark a row saw does not depend on the window size: compute it
    # once and derive the three late splits from the same column.
    marked = with_watermark_before(tx, order_by)
    if materialize_input:
        marked = materialize(spark, marked, "watermarked")
    tx = marked.drop("wm_before")
    late_1m = late_flag(MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS)
    late = marked.where(late_1m).drop("wm_before")
    if complete:
        m1_in = m5_in = rule_in = tx
    else:
        m1_in = marked.where(~late_1m).drop("wm_before")
        m5_in = marked.where(~late_flag(FIVE_MINUTE_WINDOW_MS)).drop("wm_before")
        rule_in = marked.where(~late_flag(RULE_WINDOW_MINUTES * 60_000)).drop("wm_before")
    alerts = all_rule_alerts(tx, windowed_tx=rule_in, order_by=order_by,
                             hot_rows=hot_rows)
    scored = score_alerts(alerts, risky_merchants, blacklisted_countries)
    if materialize_input:
        scored = materialize(spark, scored, "alerts")
    out = {
        "transactions": tx.drop("ts"),
        "minute_totals": metrics.minute_totals(m1_in),
        "category_average": metrics.category_average(m5_in),
        "country_counts": metrics.country_counts(m5_in),
        "late_transactions": late.drop("ts").withColumn("line", fmt.tx_json()),
        "late_lines": late.select(fmt.late_line().alias("value")),
        "alerts": scored,
        "alert_lines": scored.select(fmt.alert_line().alias("value")),
    }
    if rejects is not None:
        out["rejects"] = rejects
    return out


class JobBatchWriter:
    """``foreachBatch`` function of the whole job: all outputs of one micro-batch.

    The micro-batch is decoded and numbered once, written to ``bronze``, and every output
    takes exactly that batch; so a backlog of n micro-batches is n batches of every output,
    each as large as the source's limit. Every output is one folder per batch, overwritten when
    the batch comes again; the batch's row in ``progress`` is written last.

    Heartbeats take part in the running maximum of event time and in nothing else: windows
    close and lines are printed after one though no transaction came.

    With ``source_partitions`` n > 1 positions are ``packed_position``s of partitions 0 to n - 1.
    A table per batch (``partition_times``) carries each partition's maximum; rows are late by
    their own partition's, windows close by the least of them, none before every partition
    has had a line (a heartbeat moves its own partition's). Metric 1 then prints one line per window,
    when it closes, as an order of updates across partitions would be chance.
    """

    def __init__(self, out_root: str, risky_merchants: DataFrame, blacklisted_countries: DataFrame,
                 numbering: str = "field", delay_ms: int = OUT_OF_ORDERNESS_MS,
                 hot_rows: int = DEFAULT_HOT_ROWS, source_partitions: int = 1):
        if source_partitions > 1 and numbering != "column":
            raise ValueError("several source partitions need lines with packed positions in arrival_seq")
        self.out = out_root.rstrip("/")
        self.source_partitions = source_partitions
        self.refs = (risky_merchants, blacklisted_countries)
        self.numbering, self.delay_ms = numbering, delay_ms
        self.order = ["event_time", "transaction_id"] if numbering == "none" else ["arrival_seq"]
        self.exact = ExactWindowsBatchWriter(f"{self.out}/exact", delay_ms)
        self.emissions = MinuteEmissionsWriter(f"{self.out}/minute_emissions", delay_ms=delay_ms)
        self.ordered = OrderedRules(f"{self.out}/ordered", hot_rows=hot_rows)

    def _decode(self, batch: DataFrame, first: int) -> DataFrame:
        if self.numbering == "files":
            lines = number_lines(batch.withColumn("_row", F.monotonically_increasing_id()), first)
            return parse_lines(lines, seq_col="arrival_seq")
        if self.numbering == "column":
            return parse_lines(batch, seq_col="arrival_seq")
        return parse_lines(batch, carry_seq=self.numbering == "field")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        progress = Progress(spark, f"{self.out}/progress")
        before = progress.before(batch_id)
        batch = batch.persist()
        try:
            typed = self._decode(batch, before.lines)
            typed = typed.withColumn("line", F.when(F.col("_kind") == "reject", F.col("line")))
            typed.write.mode("overwrite").parquet(f"{self.out}/bronze/batch_id={batch_id}")
            lines = before.lines + batch.count()
        finally:
            batch.unpersist()
        typed = spark.read.schema(typed.schema).parquet(f"{self.out}/bronze/batch_id={batch_id}")
        # a heartbeat without a position counts once the batch's rows are in
        beats = typed.where("_kind = 'heartbeat'" if self.numbering in ("field", "none") else "false")
        timed = (typed.where("_kind <> 'reject'" if self.numbering in ("files", "column") else "_kind = 'tx'")
                 .withColumn("event_time", F.coalesce("heartbeat_time", "event_time")))
        several, carry = self.source_partitions > 1, None
        if several and batch_id:
            carry = spark.read.schema(PARTITION_DDL).parquet(f"{self.out}/partition_times/batch_id={batch_id - 1}")
        events = (with_watermark_before(timed, self.order, self.delay_ms, partitioned=several, carry=carry,
                                        carry_ms=None if several else before.max_event_time,
                                        bucket_rows=STREAM_BUCKET_ROWS)
                  .select("_kind", *tx_columns(True), "wm_before").persist())
        try:
            here = events.agg(F.max("event_time").alias("m"), F.count(F.lit(1)).alias("n")).crossJoin(
                beats.agg(F.max("heartbeat_time").alias("beat"))).first()            # one row each
            n = here.n
            latest = max((v for v in (before.max_event_time, here.m, here.beat) if v is not None), default=None)
            if several:
                latest = self._least_time(events, carry, batch_id)
            tx = events.where("_kind = 'tx'").drop("_kind")
            if self.numbering == "none":
                tx = tx.drop("arrival_seq")
            self._outputs(typed, tx, batch_id, latest, n)
        finally:
            events.unpersist()
        progress.commit(batch_id, latest, lines)

    def _least_time(self, events: DataFrame, carry: DataFrame | None, batch_id: int) -> int | None:
        """The least of the partitions' largest event times; none until each has one."""
        at = f"{self.out}/partition_times/batch_id={batch_id}"
        partition_times(events, carry).coalesce(1).write.mode("overwrite").parquet(at)
        times = events.sparkSession.read.schema(PARTITION_DDL).parquet(at)
        here = times.agg(F.count(F.lit(1)).alias("n"), F.min("max_event_time").alias("least")).first()
        if here.n > self.source_partitions:
            raise ValueError(f"lines of {here.n} partitions, {self.source_partitions} declared")
        return here.least if here.n == self.source_partitions else None

    def _outputs(self, typed: DataFrame, tx: DataFrame, batch_id: int, latest: int | None, n: int) -> None:
        at, spark = f"batch_id={batch_id}", tx.sparkSession

        def rejects():
            (typed.where("_kind = 'reject'").select("line", "reason")
             .write.mode("overwrite").parquet(f"{self.out}/rejects/{at}"))

        def late():
            rows = tx.where(late_flag(MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS)).drop("wm_before")
            rows.write.mode("overwrite").parquet(f"{self.out}/late/{at}")
            write_lines(rows, fmt.late_line(), f"{self.out}/late_lines/{at}")

        def emissions():
            if self.source_partitions == 1:
                self.emissions.write(tx, self.order, batch_id, latest)

        together(spark, rejects, late, emissions, lambda: self.exact.write(tx, self.order, batch_id, latest))
        closed = window_outputs(self.exact.closed(spark, batch_id))
        large = n > self.ordered.hot_rows

        def lines(name, line):
            return lambda: write_lines(closed[name], line(), f"{self.out}/{name}_lines/{at}")

        def alerts():
            found = union_alerts(closed["high_frequency_alerts"], closed["merchant_burst_alerts"],
                                 self.ordered.alerts(rows, self.order, large))
            scored = score_alerts(found, *self.refs)
            scored.write.mode("overwrite").parquet(f"{self.out}/alerts/{at}")
            write_lines(spark.read.schema(scored.schema).parquet(f"{self.out}/alerts/{at}"), fmt.alert_line(),
                        f"{self.out}/alert_lines/{at}")

        with self.ordered.prepared(tx.drop("wm_before"), batch_id, large) as rows:
            together(spark, alerts, lambda: self.ordered.commit(rows, self.order, batch_id),
                     lines("category_average", fmt.category_line), lines("country_counts", fmt.country_line),
                     *([lines("minute_totals", fmt.minute_line)] if self.source_partitions > 1 else []))


def start_streaming_job(spark: SparkSession, source: str | DataFrame, out_root: str,
                        risky_merchants: DataFrame | None = None,
                        blacklisted_countries: DataFrame | None = None,
                        delay_ms: int = OUT_OF_ORDERNESS_MS,
                        trigger: dict | None = None,
                        max_files_per_trigger: int | None = None,
                        state_partitions: int | None = None,
                        lines_carry_seq: bool = True,
                        number_file_lines: bool = False,
                        hot_rows: int = DEFAULT_HOT_ROWS,
                        source_partitions: int = 1) -> StreamingQuery:
    """Start the streaming job: one query, whose outputs are those of the reference's job.

    ``source`` is a drop folder or any streaming DataFrame of lines (``value``, and
    ``arrival_seq`` where the source knows it, as ``stream_kafka_lines`` does). Arrival order
    is that column; with ``number_file_lines`` the place of the line in the drop folder's files
    (by modification time, path and line; lines as the reference writes them); else the field
    ``arrival_seq`` of every line; with ``lines_carry_seq=False`` event time.

    Under ``out_root``, one folder per micro-batch each: ``bronze`` (decoded lines), ``rejects``,
    ``late`` and ``late_lines``, ``minute_emissions`` (metric 1 as printed), ``exact`` (windows,
    closed and open), ``category_average_lines`` and ``country_counts_lines`` (as windows close),
    ``alerts`` and ``alert_lines``: each alert once, those of a window when it closes, with the
    reference's dropping of late rows. Read them with the ``read_job_*`` functions.

    ``max_files_per_trigger`` bounds the micro-batches of a drop folder, and so those of
    every output. ``source_partitions`` says how many partitions the source has (see
    ``JobBatchWriter``); its lines come from ``positioned_lines`` with the same number.
    """
    if risky_merchants is None or blacklisted_countries is None:
        from cardstream.plans.catalog import default_refs
        risky_merchants, blacklisted_countries = default_refs(spark)
    if isinstance(source, str):
        numbering = "files" if number_file_lines else "field" if lines_carry_seq else "none"
        read = stream_placed_lines if number_file_lines else stream_lines
        lines = read(spark, source, max_files_per_trigger)
    else:
        numbering = "column" if "arrival_seq" in source.columns else "field" if lines_carry_seq else "none"
        lines = source
    if numbering == "none":
        _warn_no_order()
    out = out_root.rstrip("/")
    writer = JobBatchWriter(out, risky_merchants, blacklisted_countries, numbering, delay_ms, hot_rows,
                            source_partitions)
    with stream_partitions(spark, state_partitions):
        w = (lines.writeStream.option("checkpointLocation", f"{out}/_checkpoints/job").foreachBatch(writer))
        return (w.trigger(**trigger) if trigger else w).start()


def read_job_alerts(spark: SparkSession, out_root: str) -> DataFrame:
    """The alert log of a streaming job, as rows."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/alerts/batch_id=*")


def read_job_windows(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    """Metrics and windowed alerts of a streaming job up to now, open windows included."""
    out = out_root.rstrip("/")
    return read_exact_windows(spark, f"{out}/exact", f"{out}/progress")


def exact_scored_alerts(spark: SparkSession, exact_out: str, ordered: DataFrame,
                        risky_merchants: DataFrame, blacklisted_countries: DataFrame) -> DataFrame:
    """Scored alerts of a stream with the reference's late-row dropping: the windowed
    rules' alerts from the exact windows in ``exact_out``, and the ``ordered`` rules' alerts."""
    exact = read_exact_windows(spark, exact_out)
    return score_alerts(union_alerts(exact["high_frequency_alerts"], exact["merchant_burst_alerts"], ordered),
                        risky_merchants, blacklisted_countries)
