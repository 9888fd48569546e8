"""Minimax contiguous partition of documents into shards (law ``bytes``).

Documents of equal text form an atomic group. Groups are put in the order of
their text's hash; a shard is a run of consecutive groups, and the largest shard
is as small as any such cut allows. The smallest feasible capacity is found by
binary search, each capacity checked greedily: fill a shard until the next group
would not fit.

The check needs only prefix sums, looked up at the few places where a shard could
end. The driver holds a bounded table of cut places: first the last one in each
of ``CELLS`` equal cells of bytes, then, for the stretches in which the optimal
cuts must lie, ever finer cells, until every place in them is known. Rows
themselves never leave Spark. Row numbers come from one range shuffle of narrow
rows (hash, id, size), summed within its partitions and carried over by their
totals, so neither a hot group nor a hot key meets in one task.

Defined cases: null text counts as no bytes and is equal to other null and empty
texts; repeated rows and equal ids each get a slot; a null id comes first in its
group; an empty table gives no rows; fewer groups than shards leave shards
empty; other columns are never read by ``assign_shards``.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARDS = 24
OVERHEAD = 8          # bytes that a document takes besides its text
CELLS = 65_536        # cut places that the driver holds, at most so many

GROUP = ["hash", "text_crc32", "text_bytes"]


def ordered_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, at, place, starts): ``at`` bytes and ``place`` rows stand before
    the row in the order of (text, id); ``starts`` where a group begins with it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), F.crc32(text).alias("text_crc32"),
        F.octet_length(text).cast("bigint").alias("text_bytes"))
    order = [*GROUP, "doc_id"]
    dealt = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-rows")
    size = F.col("text_bytes") + OVERHEAD
    # one row per partition of the range shuffle
    parts = (dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"),
                                       F.max(F.struct(*GROUP)).alias("last")).orderBy("part").collect())
    carried, n0, size0, last = [], 0, 0, (None, None, None)
    for p in parts:
        carried.append((p.part, n0, size0, *last))
        n0, size0, last = n0 + p.n, size0 + p["size"], tuple(p.last)
    carry = docs.sparkSession.createDataFrame(
        carried, "c_part int, n0 bigint, size0 bigint, last_hash bigint, last_crc bigint, last_bytes bigint")
    run = Window.partitionBy("part").orderBy(*order)
    numbered = dealt.withColumns({
        "before": F.coalesce(F.sum(size).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rank": F.row_number().over(run) - 1,
        "previous": F.lag(F.struct(*GROUP)).over(run),
    }).join(F.broadcast(carry), F.col("part") == F.col("c_part"))
    previous = F.coalesce("previous", F.struct(*[F.col(a).alias(b) for a, b in zip(
        ("last_hash", "last_crc", "last_bytes"), GROUP)]))
    return written(numbered.select(
        "doc_id", size.alias("size"), "text_crc32",
        (F.col("size0") + F.col("before")).alias("at"), (F.col("n0") + F.col("rank")).alias("place"),
        (~previous.eqNullSafe(F.struct(*GROUP))).alias("starts")), "shard-order")


def greedy(places: list[int], capacity: int, shards: int) -> list[int] | None:
    """Ends of the shards when each is filled as far as ``capacity`` allows; None if
    ``shards`` don't suffice. ``places`` are the allowed ends, ascending."""
    cuts, done = [], 0
    while done < places[-1]:
        k = bisect_right(places, done + capacity) - 1
        if k < 0 or places[k] <= done or len(cuts) == shards:
            return None
        done = places[k]
        cuts.append(done)
    return cuts


def smallest_capacity(places: list[int], shards: int, low: int, high: int) -> int:
    """The least feasible capacity in (low, high]; ``high`` is feasible."""
    while high - low > 1:
        middle = (low + high) // 2
        if greedy(places, middle, shards) is None:
            low = middle
        else:
            high = middle
    return high


def _places(cuts: DataFrame, stretches: list[tuple[int, int]], cell: int, total: int) -> list[int]:
    """The last allowed cut of each cell in the stretches: any cut has one less than a cell after it."""
    inside = F.lit(False)
    for a, b in stretches:
        inside |= F.col("at").between(a, b)
    found = cuts.where(inside).groupBy(F.expr(f"at div {cell}L").alias("cell")).agg(F.max("at").alias("at"))
    return sorted({r["at"] for r in found.select("at").collect()} | {total})


def minimax_cuts(rows: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> list[int]:
    """Ends, in bytes, of the shards of the best cut.

    With the last cut of each cell alone, a capacity is feasible if it is so for all cuts
    and a cell more; so each pass leaves a range of capacities no wider than a cell, and
    stretches around the greedy cuts of that range, for the next pass to refine.
    """
    total = rows.agg(F.max(F.col("at") + F.col("size"))).first()[0]
    if not total:
        return []
    cuts = rows.where("starts and at > 0").select("at")
    stretches, cell, low, high = [(0, total)], max(1, -(-total // cells)), 0, total
    while True:
        places = _places(cuts, stretches, cell, total)
        high = smallest_capacity(places, shards, low, min(total, high + cell))
        if cell == 1:
            return greedy(places, high, shards)
        low = max(low, high - cell - 1)
        first = _reach(places, low, shards)
        last = _reach(places, high + 2 * cell, shards)
        stretches = _merge(list(zip(first, last)))
        cell = max(1, min(cell // 2, -(-sum(b - a + 1 for a, b in stretches) // cells)))


def _reach(places: list[int], capacity: int, shards: int) -> list[int]:
    """Ends of ``shards`` greedy shards, where they stop (capacity may be too small)."""
    out, done = [], 0
    for _ in range(shards):
        done = max(done, places[bisect_right(places, done + capacity) - 1]) if places[0] <= done + capacity else done
        out.append(done)
    return out


def _merge(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = ordered_rows(docs, id_col)
    cuts = minimax_cuts(rows, shards)
    spark = docs.sparkSession
    shard = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("at") >= F.lit(c)).cast("int")
    starts = dict((r["at"], r["place"]) for r in
                  rows.where(F.col("at").isin(cuts)).groupBy("at").agg(F.min("place").alias("place")).collect()) if cuts else {}
    offsets = spark.createDataFrame([(k, starts.get(c, 0)) for k, c in enumerate([0, *cuts[:-1]])] or [(0, 0)],
                                    "o_shard int, start bigint")        # one row per shard
    return (rows.withColumn("shard", shard).join(F.broadcast(offsets), F.col("shard") == F.col("o_shard"))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("place") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id") -> None:
    """Write the documents as Parquet, a folder per shard (``shard=<k>``). Needs unique ids."""
    dealt = assign_shards(docs, shards, id_col).select(F.col("doc_id").alias("__id"), "shard", "slot")
    (docs.join(dealt, F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
