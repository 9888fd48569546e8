"""Helpers shared by the operators: shared tables, Arrow batches, text keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.session import scratch_path

WORD_CLASS = r"[^\x20\x09-\x0D]+"     # a run without ASCII white space
ROW = "__row"                          # a whole input row, carried as one struct


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_tables", default=None)


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collects the tables that ``written`` makes inside the ``with`` block, for ``remove`` once
    what reads them is stored. Tables made outside any scope stay."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(token)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Cut lineage: write ``df`` under ``spark.checkpoint.dir`` and read it back.

    The folder is shared by all executors, so a lost executor loses nothing. With ``keep``
    the table belongs to no scope.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    made = _SCOPE.get()
    if made is not None and not keep:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing will read again."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def text_bytes(col: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def whole_rows(docs: DataFrame) -> Column:
    """The row as one struct, so that no input column can clash with a computed one."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` with one function per batch (Spark bounds a batch's rows and bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out
        del batches
        give_back_memory()
    return df.mapInArrow(run, schema)


def pieces(text: bytes, stop: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes, each but the last ending at ``stop``."""
    at = 0
    while len(text) - at > size:
        end = text.find(stop, at + size) + 1
        if not end:
            break
        yield text[at: end]
        at = end
    yield text[at:] if at else text


def give_back_memory() -> None:
    """Return what a task's Arrow and C heaps have free: the worker lives on, idle, beside
    those that run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc alone has it
    if trim is not None:
        trim(0)


def with_columns(batch: pa.RecordBatch, drop: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without ``drop``, followed by ``new``."""
    names = [n for n in batch.schema.names if n not in drop]
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays(arrays + list(new.values()), names=names + list(new))


def ddl(df: DataFrame, columns: list[str], extra: str) -> str:
    """DDL of some input columns followed by ``extra``."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in columns]
    return ", ".join([*kept, extra])
