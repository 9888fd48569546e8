"""What a stream's writer carries from micro-batch to micro-batch: a one-row table each.

A batch's row is written after all its outputs. A replayed batch therefore finds the row of
the batch before it, overwrites its own outputs, and gives the same rows; readers take
outputs up to the newest row.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

PROGRESS_DDL = "max_event_time bigint, lines bigint"


class Progress:
    """Largest event time and number of lines up to and with each micro-batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def before(self, batch_id: int) -> Row:
        """The row of the batch before ``batch_id`` (micro-batches are numbered from 0)."""
        if batch_id == 0:
            return Row(max_event_time=None, lines=0)
        return self.spark.read.schema(PROGRESS_DDL).parquet(f"{self.path}/batch_id={batch_id - 1}").first()

    def commit(self, batch_id: int, max_event_time: int | None, lines: int = 0) -> None:
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(max_event_time).cast("bigint").alias("max_event_time"), F.lit(lines).cast("bigint").alias("lines"))
        row.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def newest_batch(spark: SparkSession, path: str) -> int:
    """The newest committed batch, -1 if there is none."""
    rows = spark.read.schema(f"{PROGRESS_DDL}, batch_id bigint").option("basePath", path).parquet(path)
    last = rows.agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a table that no batch will read again; one that is gone is no error."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def latest_time(marked: DataFrame, carry: int | None) -> int | None:
    """The largest event time so far: of ``marked`` rows and of those before them."""
    here = marked.agg(F.max("event_time")).first()[0]
    return max((v for v in (carry, here) if v is not None), default=None)


def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes of a micro-batch at the same time: most of what a small one takes
    is planning, not tasks. The first error is raised once all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]
    for s in started:
        s.result()
