"""The ordered rules on streams (RUL-2 / STA-1, RUL-3 / STA-2), without Python workers.

What a key's next rows need from the past is its *tail*: a customer's last 20 amounts, a
card's last place. Tails are tables. Each micro-batch reads the tails of the keys that it
touches, puts them before its own rows as halo rows, runs the window of the batch rule over
both, and writes the new tails of those keys. So the rules have one form in batch and on
streams, and a key that holds a third of a micro-batch is split like any large key.

A tail table is versioned by micro-batch: ``delta`` holds what one batch wrote, and every
``merge_every`` batches the newest tail of every key goes to a ``base``, in folders by hash of
the key, of which a batch reads those that its keys fall into. Which tables hold the state
before a batch follows from its number alone, so a replayed batch reads the same state and
overwrites its own outputs.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardstream.functions.timecols import amount_rest
from cardstream.operators.alerts import union_alerts
from cardstream.operators.rules import (
    high_amount_from_history, history_frames, previous_frames, travel_from_previous,
)
from cardstream.operators.sequence import DEFAULT_HOT_ROWS, keyed_frames
from cardstream.schema import (
    ALERT_STRUCT, HIGH_AMOUNT_HISTORY, RULE_HIGH_AMOUNT, RULE_IMPOSSIBLE_TRAVEL, TX_FIELDS, resolve_order,
)
from cardstream.streaming.progress import drop_folder, together

# rule -> (key, rows of a key's tail, columns that a later row looks at)
TAILS = {
    RULE_HIGH_AMOUNT: ("customer_id", HIGH_AMOUNT_HISTORY, ["amount_cents", "_amount_rest"]),
    RULE_IMPOSSIBLE_TRAVEL: ("card_id", 1, ["country", "event_time"]),
}
TAIL_DDL = ("rule string, key string, version bigint, "
            "tail array<struct<amount_cents:bigint,_amount_rest:bigint,country:string,event_time:bigint>>")
TAIL_FIELDS = {"amount_cents": "bigint", "_amount_rest": "bigint", "country": "string", "event_time": "bigint"}
MERGE_EVERY = 16         # micro-batches between two merged tables
BUCKETS = 64             # folders of a merged table
PLACE = "_place"         # 0 for a row of the batch, negative for a halo row


class OrderedRules:
    """Rules 2 and 3 over micro-batches that come in arrival order."""

    def __init__(self, out_path: str, rules: Sequence[str] = tuple(TAILS), order_by: Sequence[str] | None = None,
                 hot_rows: int = DEFAULT_HOT_ROWS, merge_every: int = MERGE_EVERY):
        self.out = out_path.rstrip("/")
        self.rules, self.order_by = list(rules), order_by
        self.hot_rows, self.merge_every = hot_rows, merge_every

    # --- state ---

    def _tables(self, batch_id: int) -> tuple[int, range]:
        """The base (or -1) and the deltas that hold the state before ``batch_id``."""
        base = batch_id // self.merge_every * self.merge_every - 1
        return base, range(base + 1, batch_id)

    def _state(self, spark: SparkSession, batch_id: int, touched: DataFrame | None = None) -> DataFrame | None:
        """Tail rows before ``batch_id``, several versions of a key; of the base only the folders
        that the ``touched`` keys fall into."""
        base, deltas = self._tables(batch_id)
        parts = []
        if base >= 0:
            rows = spark.read.schema(f"{TAIL_DDL}, bucket int").parquet(f"{self.out}/base/batch_id={base}")
            if touched is not None:
                found = touched.select(_bucket("key").alias("b")).distinct().collect()    # BUCKETS at most
                rows = rows.where(F.col("bucket").isin([r["b"] for r in found]))
            parts.append(rows.drop("bucket"))
        if deltas:
            parts.append(spark.read.schema(TAIL_DDL).parquet(*[f"{self.out}/delta/batch_id={i}" for i in deltas]))
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def with_halo(self, batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        """Per rule: the batch's rows and the tails of their keys, told apart by ``PLACE``."""
        spark = batch.sparkSession
        keys = [F.struct(F.lit(r).alias("rule"), F.col(TAILS[r][0]).alias("key")) for r in self.rules]
        touched = batch.select(F.explode(F.array(*keys)).alias("k")).select("k.*").distinct()
        state = self._state(spark, batch_id, touched)
        rows = batch.withColumns({"_amount_rest": amount_rest(), PLACE: F.lit(0)})
        if state is None:
            return {r: rows for r in self.rules}
        t = touched.select(F.col("rule").alias("t_rule"), F.col("key").alias("t_key"))
        newest = (state.join(t, (F.col("rule") == F.col("t_rule")) & F.col("key").eqNullSafe(F.col("t_key")), "left_semi")
                  .groupBy("rule", "key").agg(F.max_by("tail", "version").alias("tail")))
        halo = newest.select("rule", "key", F.posexplode("tail").alias("at", "row"), F.size("tail").alias("n"))
        out = {}
        for rule in self.rules:
            key, _, columns = TAILS[rule]
            past = halo.where(F.col("rule") == rule).select(
                F.col("key").alias(key), (F.col("at") - F.col("n")).alias(PLACE),
                *[F.col(f"row.{c}").alias(c) for c in columns])
            out[rule] = rows.unionByName(past, allowMissingColumns=True)
        return out

    @contextmanager
    def prepared(self, batch: DataFrame, batch_id: int, large: bool):
        """``with_halo`` for use by ``alerts`` and ``commit``: of a batch that no key can make
        large, the rows are dealt by key once, for both."""
        rows = self.with_halo(batch, batch_id)
        if large:
            yield rows
            return
        rows = {r: df.repartition(TAILS[r][0]).persist() for r, df in rows.items()}
        try:
            yield rows
        finally:
            for df in rows.values():
                df.unpersist()

    def _tails(self, rows: dict[str, DataFrame], order: Sequence[str], batch_id: int) -> DataFrame:
        """The last rows of each touched key. Spark cuts each key's rows to that number before
        the shuffle, so a large key is no large partition."""
        parts = []
        for rule, df in rows.items():
            key, n, columns = TAILS[rule]
            by = [PLACE, *order]
            last = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in by]))
            row = F.struct(*[(F.col(c) if c in columns else F.lit(None)).cast(t).alias(c) for c, t in TAIL_FIELDS.items()])
            kept = df.select(key, *[c for c in dict.fromkeys([*by, *columns]) if c != key]).withColumn("_last", last)
            tail = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("_last")).alias("o"), row.alias("row")))),
                               lambda x: x["row"])
            parts.append(kept.where(F.col("_last") <= n).groupBy(F.col(key).alias("key")).agg(tail.alias("tail"))
                         .select(F.lit(rule).alias("rule"), "key", F.lit(batch_id).cast("bigint").alias("version"), "tail"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # --- micro-batches ---

    def alerts(self, rows: dict[str, DataFrame], order: Sequence[str], large: bool) -> DataFrame:
        """Alerts of the batch's rows. ``large``: a key may have more than ``hot_rows`` rows."""
        parts = []
        for rule, df in rows.items():
            key, lookback, columns = TAILS[rule]
            by = [PLACE, *order]
            frames = history_frames(lookback) if rule == RULE_HIGH_AMOUNT else previous_frames
            needed = df.select(*dict.fromkeys([*by, *TX_FIELDS, "amount_cents", *columns]))
            seen = keyed_frames(needed, key, by, lookback, frames, self.hot_rows if large else None)
            seen = seen.where(F.col(PLACE) == 0)
            parts.append(high_amount_from_history(seen) if rule == RULE_HIGH_AMOUNT else travel_from_previous(seen))
        return union_alerts(*parts)

    def commit(self, rows: dict[str, DataFrame], order: Sequence[str], batch_id: int) -> None:
        """Write the state after ``batch_id``."""
        spark = next(iter(rows.values())).sparkSession
        if batch_id % self.merge_every == 0:        # what the base before holds, no batch reads again
            base, _ = self._tables(batch_id)
            for i in range(base - self.merge_every + 1, base + 1):
                drop_folder(spark, f"{self.out}/delta/batch_id={i}")
            drop_folder(spark, f"{self.out}/base/batch_id={base - self.merge_every}")
        self._tails(rows, order, batch_id).write.mode("overwrite").parquet(f"{self.out}/delta/batch_id={batch_id}")
        if (batch_id + 1) % self.merge_every == 0:
            _, deltas = self._tables(batch_id)
            state = spark.read.schema(TAIL_DDL).parquet(*[f"{self.out}/delta/batch_id={i}" for i in [*deltas, batch_id]])
            base = self._tables(batch_id)[0]
            if base >= 0:
                old = spark.read.schema(f"{TAIL_DDL}, bucket int").parquet(f"{self.out}/base/batch_id={base}")
                state = state.unionByName(old.drop("bucket"))
            merged = (state.groupBy("rule", "key").agg(F.max("version").alias("version"),
                                                      F.max_by("tail", "version").alias("tail"))
                      .withColumn("bucket", _bucket("key")))
            (merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{self.out}/base/batch_id={batch_id}"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch``: the batch's alerts under ``alerts``, and the state after it."""
        order = resolve_order(batch, self.order_by)
        batch = batch.persist()
        try:
            large = batch.count() > self.hot_rows
            with self.prepared(batch, batch_id, large) as rows:
                alerts = self.alerts(rows, order, large)
                together(batch.sparkSession,
                         lambda: alerts.write.mode("overwrite").parquet(f"{self.out}/alerts/batch_id={batch_id}"),
                         lambda: self.commit(rows, order, batch_id))
        finally:
            batch.unpersist()


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def read_ordered_alerts(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(ALERT_STRUCT).parquet(f"{out_path.rstrip('/')}/alerts/batch_id=*")
