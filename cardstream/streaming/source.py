"""Streaming transactions from a drop folder of JSON-line files (SRC-1 S form).

``stream_transactions`` decodes lines exactly like the batch source, applies
the event-time watermark on every row (heartbeats included, so the last
windows close), and then keeps only transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.functions import format as fmt
from cardstream.sources.json_lines import HEARTBEAT_FORMAT, parse_lines, stream_lines
from cardstream.sources.json_lines import tx_columns


def decoded_stream(spark: SparkSession, folder: str,
                   max_files_per_trigger: int | None = 1) -> DataFrame:
    """All decoded lines (``_kind`` tx / reject / heartbeat) of the folder."""
    return parse_lines(stream_lines(spark, folder, max_files_per_trigger))


def watermarked_transactions(decoded: DataFrame, delay: str, with_seq: bool = True) -> DataFrame:
    """Transactions with ``ts``, watermarked by ``delay`` over tx+heartbeats."""
    timed = (decoded.where(F.col("_kind").isin("tx", "heartbeat"))
             .withColumn("ts", F.timestamp_millis(
                 F.coalesce(F.col("heartbeat_time"), F.col("event_time"))))
             .withWatermark("ts", delay))
    # The filter must reference ``ts``: Catalyst pushes predicates that do not
    # use the event-time column below the watermark, which would hide the
    # heartbeats from it. A row whose ``ts`` is its own event time is a
    # transaction; a heartbeat's ``ts`` comes from ``heartbeat_time``.
    is_tx = F.col("ts") == F.timestamp_millis(
        F.when(F.col("_kind") == "tx", F.col("event_time")))
    return timed.where(is_tx).select(*tx_columns(with_seq), "ts")


def stream_rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("_kind") == "reject").select("line", "reason")


def json_lines_with_seq(tx: DataFrame) -> DataFrame:
    """Reference JSON lines with the arrival position as an extra field."""
    return tx.select("arrival_seq", fmt.tx_json_with_seq().alias("value"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def write_drop_folder(spark: SparkSession, tx: DataFrame, folder: str,
                      n_files: int, heartbeat_after_ms: int | None = 86_400_000) -> str:
    """Write ``tx`` as ``n_files`` JSON-line files in arrival order.

    Files are range-partitioned on ``arrival_seq`` and given increasing
    modification times so the file source reads them in arrival order. By
    default the last file ends with a heartbeat ``heartbeat_after_ms`` after
    the largest event time, which lets the stream close every open window.
    """
    lines = json_lines_with_seq(tx)
    if heartbeat_after_ms is not None:
        hb = tx.agg(F.max("event_time").alias("m"), F.max("arrival_seq").alias("s")).select(
            (F.col("s") + 1).alias("arrival_seq"),
            F.format_string(HEARTBEAT_FORMAT,
                            F.col("m") + F.lit(int(heartbeat_after_ms))).alias("value"))
        lines = lines.unionByName(hb)
    return write_lines_folder(spark, lines, folder, n_files)


# Up to so many files, the positions at which they are cut stand in the plan.
MAX_LITERAL_CUTS = 64


def _dealt_in_order(lines: DataFrame, n_files: int) -> DataFrame:
    """``lines`` in ``n_files`` partitions of about equal size along ``arrival_seq``. The cuts come
    from that column alone: ``repartitionByRange`` would make every line twice, once for its sample."""
    if n_files > MAX_LITERAL_CUTS:
        return lines.repartitionByRange(n_files, "arrival_seq")
    cuts = lines.agg(F.percentile_approx("arrival_seq", [i / n_files for i in range(1, n_files)] or [0.5],
                                         100 * MAX_LITERAL_CUTS)).first()[0] or []
    place = F.lit(0)
    for cut in sorted(set(cuts)) if n_files > 1 else []:
        place = place + F.when(F.col("arrival_seq") > F.lit(cut), 1).otherwise(0)
    return lines.repartitionById(n_files, place)


def write_lines_folder(spark: SparkSession, lines: DataFrame, folder: str,
                       n_files: int) -> str:
    """Write text ``lines`` (``arrival_seq``, ``value``) as ``n_files`` files
    whose names and modification times follow arrival order."""
    data = f"{folder.rstrip('/')}/drop"
    (_dealt_in_order(lines, n_files)
     .sortWithinPartitions("arrival_seq").select("value")
     .write.mode("errorifexists").text(data))
    fs, root = _fs(spark, data)
    parts = sorted(str(s.getPath().getName()) for s in fs.listStatus(root)
                   if str(s.getPath().getName()).startswith("part-"))
    jvm = spark.sparkContext._jvm
    base = int(jvm.java.lang.System.currentTimeMillis()) // 1000 * 1000
    for i, name in enumerate(parts):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(root, name), base + i * 1000, -1)
    return data
