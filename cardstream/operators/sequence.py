"""Ordered per-key frames that stay balanced when one key is huge.

Rules 2 and 3 look back a fixed number of rows (20, resp. 1) along a key's
arrival order. A plain ``Window.partitionBy(key)`` sends each key to one task,
so a key holding a third of the data would become one giant task. Here keys
with more than ``hot_rows`` rows take a second, exact path:

1. keys with more than ``hot_rows`` rows are *hot*. There are fewer than
   ``rows / hot_rows`` of them; their table is written down and broadcast up to
   MAX_BROADCAST_KEYS;
2. hot keys' rows are range-partitioned by key and all order columns. Spark cuts the
   ranges by sampled counts, so gaps and ties in an order column crowd no range;
   per range counts (a small table) give each range its starting rank, so every
   hot row gets its exact rank in its key;
3. ranks are cut into blocks of ``block`` rows, and the last ``lookback``
   rows of each block are copied into the next block as *halo* rows;
4. the caller's window runs over ``(key, block)``: every real row sees all of
   its ``lookback`` predecessors; halo rows are then removed.

Cold keys (the usual case) take a single ``partitionBy(key)`` window; when no
key is hot the plan is just that window. Both paths give exactly the rows a
single ordered pass per key would give.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardstream.session import scratch_path

# Rows per key above which a key is split (≈ a comfortable task at scale).
DEFAULT_HOT_ROWS = 4_000_000
# Ranges per block of ranked rows.
RANGES_PER_BLOCK = 4
# Hot-key tables up to this many keys are broadcast (always < rows/hot_rows).
MAX_BROADCAST_KEYS = 1_000_000

FrameFn = Callable[[DataFrame, Sequence[Column | str], Sequence[str]], DataFrame]


def require_numeric_order(df: DataFrame, order_cols: Sequence[str]) -> None:
    """Buckets are cut on the first order column: it must be a number (an
    arrival position or an epoch time)."""
    dtype = df.schema[order_cols[0]].dataType
    if not isinstance(dtype, T.NumericType):
        raise ValueError(f"first order column {order_cols[0]!r} must be numeric, "
                         f"not {dtype.simpleString()}")


_HELPERS = ("_sub", "_start", "_lrn", "_rn", "_copy", "_block", "_halo")


HotKeys = tuple  # (DataFrame of hot keys with their rows _n, number of hot keys)


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_key_tables(df: DataFrame, keys: Sequence[str], hot_rows: int = DEFAULT_HOT_ROWS,
                   rows: int | None = None) -> dict[str, HotKeys]:
    """Hot keys of several key columns in one pass (grouping sets).

    One aggregate over ``(key1), (key2), …`` reads the key columns once; the
    small result is written down, and one tiny job counts it per key.
    """
    keys = list(keys)
    if (df.count() if rows is None else rows) <= hot_rows:      # then no key has more
        return {k: (None, 0) for k in keys}
    agg = written(df.groupingSets([[k] for k in keys], *keys)
                   .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"))
                   .where(F.col("_n") > F.lit(int(hot_rows))), "hot-keys")
    counts = {r["_gid"]: r["count"] for r in agg.groupBy("_gid").count().collect()}
    out = {}
    for i, k in enumerate(keys):
        # grouping_id has a 1 bit for every key column not grouped in the set
        gid = sum(1 << (len(keys) - 1 - j) for j in range(len(keys)) if j != i)
        out[k] = (agg.where(F.col("_gid") == gid).select(k, "_n"),
                  counts.get(gid, 0))
    return out


def deal_by_range(df: DataFrame, by: Sequence[str], rows: int, per_range: int) -> DataFrame:
    """``df`` (of ``rows`` rows) with ``_sub``, its range of about ``per_range`` rows in the
    order of ``by``. Written down, so that every later step sees the same ranges."""
    ranges = max(1, -(-int(rows) // int(per_range)))
    return written(df.repartitionByRange(ranges, *by).withColumn("_sub", F.spark_partition_id()),
                    "hot-rows")


def keyed_frames(df: DataFrame, key: str, order_cols: Sequence[str],
                 lookback: int, frame_fn: FrameFn,
                 hot_rows: int | None = DEFAULT_HOT_ROWS,
                 hot_keys: HotKeys | None = None) -> DataFrame:
    """Apply ``frame_fn(df, partition_cols, order_cols)`` per key, skew-safe.

    ``frame_fn`` must only look back at most ``lookback`` rows (ROWS frames
    ending at or before the current row, or ``lag`` up to ``lookback``).
    ``hot_rows=None`` disables the split (one window per key). ``hot_keys``
    passes tables already found by :func:`hot_key_tables`.
    """
    order_cols = list(order_cols)
    if df.isStreaming:
        raise ValueError("keyed_frames is the batch form; streams run it over their "
                         "micro-batches (streaming.ordered)")
    if hot_rows is None:
        return frame_fn(df, [key], order_cols)
    block = max(int(hot_rows), lookback + 1)

    if hot_keys is None:
        # One job over the key column. The table is small: fewer than
        # total_rows / hot_rows keys can exceed hot_rows.
        hot_keys = hot_key_tables(df, [key], hot_rows)[key]
    stats, n_hot = hot_keys
    if n_hot == 0:
        return frame_fn(df, [key], order_cols)
    hot = F.broadcast(stats) if n_hot <= MAX_BROADCAST_KEYS else stats

    cold = df.join(hot.select(key), on=key, how="left_anti")
    cold_out = frame_fn(cold, [key], order_cols)

    hot_rows_df = deal_by_range(
        df.join(hot.select(key), on=key, how="left_semi"), [key, *order_cols],
        stats.agg(F.sum("_n")).first()[0], max(lookback + 1, block // RANGES_PER_BLOCK))

    starts = (hot_rows_df.groupBy(key, "_sub").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_start", F.coalesce(F.sum("_c").over(
                  Window.partitionBy(key).orderBy("_sub")
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select(key, "_sub", "_start"))
    ranked = (hot_rows_df
              .withColumn("_lrn", F.row_number().over(
                  Window.partitionBy(key, "_sub").orderBy(*order_cols)))
              # Small (one row per range chunk); joined on the window's own
              # partitioning, AQE broadcasts it when its measured size allows.
              .join(starts, on=[key, "_sub"], how="inner")
              .withColumn("_rn", F.col("_start") + F.col("_lrn") - 1))
    in_tail = F.pmod(F.col("_rn"), F.lit(block)) >= F.lit(block - lookback)
    copies = F.when(in_tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    blocked = (ranked
               .withColumn("_copy", F.explode(copies))
               .withColumn("_block", F.floor(F.col("_rn") / F.lit(block)) + F.col("_copy"))
               .withColumn("_halo", F.col("_copy") == 1))
    hot_out = frame_fn(blocked, [key, "_block"], order_cols).where(~F.col("_halo"))
    hot_out = hot_out.drop(*[c for c in _HELPERS if c in hot_out.columns])
    return cold_out.unionByName(hot_out.select(*cold_out.columns))


# Rows of a bucket, about: a bucket is one task's at least, so it is small beside a task.
BUCKET_ROWS = 1 << 16
# The same in a micro-batch, whose rows are bounded: enough buckets to keep all cores at work.
STREAM_BUCKET_ROWS = 1 << 13


PARTITION_BITS = 16                       # a source has up to 65,536 partitions


def packed_position(partition: Column, offset: Column) -> Column:
    """One arrival position for a line of a source of several partitions: ordered by offset, then
    partition, whatever the order in which the partitions are read."""
    known = partition.between(0, (1 << PARTITION_BITS) - 1)
    return F.when(known, F.shiftleft(offset.cast("bigint"), PARTITION_BITS).bitwiseOR(partition.cast("bigint"))).otherwise(
        F.raise_error(F.lit("source partition out of range")).cast("bigint"))


def source_partition(position: Column) -> Column:
    """The partition in a packed position."""
    return position.bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))


def counted_width(df: DataFrame, col: str, rows: int = BUCKET_ROWS) -> int:
    """Width of ranges of ``col`` that hold about ``rows`` rows each: of a dense position
    that number, else (an event time, sparse offsets) by the count and the span of the rows."""
    if col == "arrival_seq":
        return rows
    low, high, n = df.agg(F.min(col), F.max(col), F.count(F.lit(1))).first()
    if low is None:
        return 1
    return max(1, -(-(int(high) - int(low) + 1) // max(1, -(-n // rows))))


def keyed_running_totals(df: DataFrame, key: str, order_cols: Sequence[str],
                         values: Sequence[str], bucket_width: int | None = None) -> DataFrame:
    """Running count and sums of ``values`` per key in order (current row
    included): ``_run_n`` and ``_run_<value>``.

    Skew-safe without a per-key window over all of a key's rows: rows are
    bucketed by ranges of the first order column; per (key, bucket) totals
    (a small table) give each bucket its carried totals, and a running total
    inside each (key, bucket) — about ``BUCKET_ROWS`` rows of all keys, or
    ``bucket_width`` positions — finishes it.
    """
    order_cols = list(order_cols)
    require_numeric_order(df, order_cols)
    width = bucket_width or counted_width(df, order_cols[0])
    b = df.withColumn("_rbk", F.floor(F.col(order_cols[0]) / F.lit(width)).cast("long"))
    per_bucket = b.groupBy(key, "_rbk").agg(F.count(F.lit(1)).alias("_bn"),
                                           *[F.sum(v).alias(f"_b_{v}") for v in values])
    before = Window.partitionBy(key).orderBy("_rbk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        key, "_rbk",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_cn"),
        *[F.coalesce(F.sum(f"_b_{v}").over(before), F.lit(0)).alias(f"_c_{v}") for v in values])
    local = (Window.partitionBy(key, "_rbk").orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, 0))
    sums = {f"_l_{v}": F.sum(v).over(local) for v in values}
    out = (b.withColumns({"_ln": F.count(F.lit(1)).over(local), **sums})
           .join(carry, on=[key, "_rbk"], how="inner"))
    return (out.withColumn("_run_n", F.col("_cn") + F.col("_ln"))
            .withColumns({f"_run_{v}": F.col(f"_c_{v}") + F.col(f"_l_{v}") for v in values})
            .drop("_rbk", "_ln", "_cn", *sums, *[f"_c_{v}" for v in values]))
