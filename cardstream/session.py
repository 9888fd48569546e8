"""Spark session helpers and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "cardstream") -> SparkSession:
    """Session for tests and the local bench (the cluster brings its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        # Python state/UDF channel over a socket file instead of a TCP port.
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) do we set a private one.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cardstream-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)      # DataFrame.checkpoint() writes here
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/cardstream/{name}-{uuid.uuid4().hex[:12]}"


def ensure_streaming_conf(spark: SparkSession) -> None:
    """Runtime settings needed by ``transformWithStateInPandas``."""
    current = spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    if current != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                       ROCKSDB_PROVIDER)
    # Commit small per-batch changelogs instead of a full snapshot each batch.
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


@contextmanager
def stream_partitions(spark: SparkSession, partitions: int | None = None):
    """Shuffle/state partitions for streams started inside the block.

    A stream fixes its state partition count from ``spark.sql.shuffle.partitions``
    when it starts (then keeps it in its checkpoint). Batch-sized defaults (200)
    make every micro-batch run hundreds of near-empty state tasks, so streams get
    ``partitions`` (default: the cluster's default parallelism) and the session
    setting is restored afterwards.
    """
    n = int(partitions or spark.sparkContext.defaultParallelism)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
