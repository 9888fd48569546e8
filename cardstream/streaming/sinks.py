"""Stream sinks (SNK-1..3).

* append sinks (parquet or text) with a checkpoint: exactly-once files;
* rows plus their text lines per micro-batch (metric and alert lines);
* an upsert log for metrics in update mode: every micro-batch's updated rows
  land in their own ``batch_id=`` folder (overwritten on replay), and
  :func:`read_upserts` returns the latest row per key.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardstream.functions import format as fmt


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def append_sink(df: DataFrame, path: str, checkpoint: str, fmt_name: str = "parquet",
                trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    writer = (df.writeStream.format(fmt_name).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start(path)


def alert_log_sink(alerts: DataFrame, path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Dedicated alert output: one text line per scored alert."""
    return append_sink(alerts.select(fmt.alert_line().alias("value")), path,
                       checkpoint, "text", trigger)


class UpsertBatchWriter:
    """``foreachBatch`` writer for update-mode outputs (metric upserts).

    With ``line`` (a Column builder) every emitted row is also written as a
    text line under ``<path>_lines`` — one line per (re-)emission, like the
    reference's printed metric lines.
    """

    def __init__(self, path: str, fmt_name: str = "parquet",
                 line: Callable[[], Column] | None = None):
        self.path = path.rstrip("/")
        self.fmt_name = fmt_name
        self.line = line

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.line is not None:
            batch = batch.persist()
        try:
            (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").format(self.fmt_name)
             .save(f"{self.path}/batch={batch_id}"))
            if self.line is not None:
                write_lines(batch, self.line(), f"{self.path}_lines/batch={batch_id}")
        finally:
            if self.line is not None:
                batch.unpersist()


class RowsAndLinesBatchWriter:
    """``foreachBatch`` writer for append outputs: parquet rows plus their
    text lines, each per micro-batch (overwritten on replay)."""

    def __init__(self, path: str, line: Callable[[], Column]):
        self.path = path.rstrip("/")
        self.line = line

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
            write_lines(batch, self.line(), f"{self.path}_lines/batch_id={batch_id}")
        finally:
            batch.unpersist()


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def upsert_sink(df: DataFrame, path: str, checkpoint: str,
                trigger: dict | None = None,
                line: Callable[[], Column] | None = None) -> StreamingQuery:
    writer = (df.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(UpsertBatchWriter(path, line=line)))
    return _trigger(writer, trigger).start()


def rows_and_lines_sink(df: DataFrame, path: str, checkpoint: str,
                        line: Callable[[], Column],
                        trigger: dict | None = None) -> StreamingQuery:
    writer = (df.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(RowsAndLinesBatchWriter(path, line)))
    return _trigger(writer, trigger).start()


def read_upserts(spark: SparkSession, path: str, key_cols: Sequence[str],
                 schema=None) -> DataFrame:
    """Latest version of every key from an upsert log."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.option("basePath", path).parquet(f"{path}/batch=*")
    latest = Window.partitionBy(*key_cols).orderBy(F.col("batch_id").desc())
    return (rows.withColumn("_r", F.row_number().over(latest))
            .where(F.col("_r") == 1).drop("_r", "batch_id", "batch"))
