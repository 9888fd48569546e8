"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has 64 bits; two texts are linked when at most ``MAX_BITS``
bits differ. The bits are grouped into partitions (correlated bits together), and
each partition gets its own threshold t, -1 (not probed) upwards, with the
thresholds' sum ``MAX_BITS - partitions + 1``. Then any linked pair differs by at
most t bits in some partition, so probing every partition finds every link. A
dynamic programme picks the thresholds, and the number of partitions, of least
cost: rows probed plus candidate pairs, the latter estimated from a bounded
sample of fingerprints. The sample steers cost alone; links never depend on it.

Probing is symmetric: for threshold t a fingerprint is filed under its partition's
bits with every choice of t of them masked out, and two fingerprints that share a
file are candidates. Files are verified bit by bit. A file larger than ``BLOCK`` is
split into blocks and every pair of its blocks is verified in a task of its own,
so no file is too large for one. A task hands on only a spanning forest of the
links it finds, never all pairs of a group; connected components then join them.
Exact copies share a fingerprint and are one node.

Defined cases: null or empty text, or text without a word, has fingerprint zero
and is linked like any other; repeated rows share a component; null ids never name
a component (its id is the smallest id that is not null, or null); ``near_duplicates``
works on rows, so extra columns may have any names; a very long text is read whole; ties (bits set in
just half the hashes are 0, equal ids are one) need no order; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, ddl, map_batches, text_bytes, whole_rows, with_columns, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SAMPLE = 1_000             # fingerprints that the driver plans with
BLOCK = 4_096              # fingerprints of one file that a task compares at once
MAX_BROADCAST_FILES = 200_000
PAIR_COST, ROW_COST = 1.0, 200.0


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """64 bits, each set if set in over half of the shingles' hashes (signed)."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= n:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: len(words) - n].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[n - 1:] - 1).tolist())]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo: lo + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(df: DataFrame, n: int = SHINGLE, text: str = "text") -> DataFrame:
    """``df`` with its text bytes replaced by ``fp``."""
    carried = [c for c in df.columns if c != text]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(x.as_py(), n) for x in batch.column(batch.schema.get_field_index(text))]
        return with_columns(batch, [text], {"fp": pa.array(fps, pa.int64())})

    return map_batches(df, run, ddl(df, carried, "fp bigint"))


# ---------------------------------------------------------------- plan

def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` groups of nearly equal size, correlated bits together."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    spread = bits - bits.mean(axis=0)
    scale = np.sqrt((spread ** 2).sum(axis=0)) + 1e-9
    corr = np.abs(spread.T @ spread) / np.outer(scale, scale)
    np.fill_diagonal(corr, 0)
    free, groups = set(range(64)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        left = sorted(free)
        group = [max(left, key=lambda b: corr[b, left].sum())]
        while len(group) < size:
            left = sorted(free.difference(group))
            group.append(max(left, key=lambda b: corr[b, group].sum()))
        groups.append(sorted(group))
        free -= set(group)
    return groups


def choose(n: int, k: int) -> int:
    return len(list(itertools.combinations(range(n), k)))


def shared_files(sample: np.ndarray, group: list[int], threshold: int) -> float:
    """Expected files that two random fingerprints share, by the sample's pairs."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, group]
    width, n = len(group), len(sample)
    values = bits.astype(np.float32)
    same = values @ values.T + (1 - values) @ (1 - values).T
    differ = np.rint(width - same[np.triu_indices(n, 1)]).astype(int)
    total = 0.0
    for d in range(threshold + 1):
        # masks of ``threshold`` bits that cover the d differing ones
        total += float((differ == d).sum()) * choose(width - d, threshold - d)
    return (total + 0.5 * choose(width, threshold) / 2.0 ** max(width - threshold, 0)) / max(len(differ), 1)


def allocate(costs: list[dict[int, float]], budget: int) -> tuple[float, list[int]]:
    """Dynamic programme: thresholds of least total cost whose sum is ``budget``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, chosen) in best.items():
            for t, extra in cost.items():
                found = (c + extra, [*chosen, t])
                if spent + t not in step or found < step[spent + t]:
                    step[spent + t] = found
        best = step
    return best[budget]


def plan(sample: np.ndarray, total: int, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """Partitions (their bits) and thresholds of least estimated cost."""
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(2, max_bits + 2):
        groups = group_bits(sample, parts)
        costs = []
        for g in groups:
            by_t = {-1: 0.0}
            for t in range(min(max_bits, 3)):
                rows = float(total) * choose(len(g), t)
                by_t[t] = ROW_COST * rows + PAIR_COST * float(total) ** 2 / 2 * shared_files(sample, g, t)
            costs.append(by_t)
        try:
            cost, thresholds = allocate(costs, max_bits - parts + 1)
        except KeyError:                       # thresholds of at most 2 can't add up
            continue
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0])
    return best[1]


def masks(chosen: list[tuple[list[int], int]]) -> list[int]:
    """Signed 64-bit masks, one per file family."""
    out = []
    for group, t in chosen:
        for hidden in itertools.combinations(group, t):
            value = sum(1 << b for b in group if b not in hidden)
            out.append(value - (1 << 64) if value >> 63 else value)
    return out


# ---------------------------------------------------------------- probe and verify

def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints (each tree a star)."""
    links: list[tuple[int, int]] = []
    bits = np.ascontiguousarray(fps).view(np.uint64)      # counted without their sign
    left = np.arange(len(fps))
    if len(fps) <= 512:                       # most files hold no link: one look shows it
        near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= max_bits
        left = np.flatnonzero(near.sum(axis=1) > 1)
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            hit = np.bitwise_count(bits[left] ^ bits[front.pop()]) <= max_bits
            if hit.any():
                found = left[hit]
                links += [(int(fps[root]), int(fps[f])) for f in found]
                front += found.tolist()
                left = left[~hit]
    return links


def _verify(max_bits: int):
    """Runs of equal (mask, key, block pair) in a sorted partition -> links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: np.ndarray | None = None
        names = ["mask", "key", "b1", "b2"]

        def links_of(rows: np.ndarray, ends: np.ndarray) -> pa.RecordBatch | None:
            out: list[tuple[int, int]] = []
            starts = np.concatenate([[0], ends[:-1]])
            several = ends - starts > 1
            for a, b in zip(starts[several].tolist(), ends[several].tolist()):
                out += spanning_links(rows[a:b, 4], max_bits)
            if not out:
                return None
            a, b = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                                    for i in range(len(names) + 1)])
            if carry is not None:
                rows = np.concatenate([carry, rows])
            change = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            cut = int(change[-1]) if len(change) else 0
            found = links_of(rows[:cut], change) if cut else None
            carry = rows[cut:]                # at most 2 * BLOCK rows: a file's block pair
            if found is not None:
                yield found
        if carry is not None and (found := links_of(carry, np.array([len(carry)]))) is not None:
            yield found
    return run


def links(nodes: DataFrame, chosen: list[tuple[list[int], int]], max_bits: int = MAX_BITS,
          block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect every two fingerprints of ``nodes`` (distinct ``fp``) that
    differ in at most ``max_bits`` bits, directly or through others."""
    family = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(masks(chosen))])
    filed = nodes.select("fp", F.explode(family).alias("f")).select("f.mask", "f.key", "fp")
    # files beyond a block: at most rows / BLOCK of them
    large = filed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    large = written(large.select(F.col("mask").alias("l_mask"), F.col("key").alias("l_key"),
                                 F.ceil(F.col("n") * 2 / block).cast("int").alias("blocks")), "simhash-large")
    if large.limit(MAX_BROADCAST_FILES + 1).count() <= MAX_BROADCAST_FILES:
        large = F.broadcast(large)
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
                        lambda b: F.struct(F.least(b, F.col("own")).alias("b1"), F.greatest(b, F.col("own")).alias("b2")))
    dealt = (filed.join(large, (F.col("mask") == F.col("l_mask")) & (F.col("key") == F.col("l_key")), "left")
             .withColumn("own", own).withColumn("p", F.explode(pairs))
             .select("mask", "key", "p.b1", "p.b2", "fp"))
    by = ["mask", "key", "b1", "b2"]
    return (dealt.repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(_verify(max_bits), "a bigint, b bigint").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), the root its component's smallest node.

    Alternates large-star and small-star steps until the stars stand still; both
    are an aggregate and a join, so a node with very many links is dealt over tasks.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    count = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = (both.join(least, F.col("u") == F.col("w")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(least, F.col("u") == F.col("w"))
        step = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        step = written(step, "links")
        state = step.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if state == count:
            break
        now, count = step, state
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def near_groups(fps: DataFrame, id_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(g_fp, root, component_id): each fingerprint's component by a node of it, and the
    smallest id that its links reach."""
    nodes = written(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-nodes")
    total = nodes.count()
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("fp")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(total, 1)))
    sample = np.array([r.fp for r in nodes.where(draw).select("fp").limit(2 * SAMPLE).collect()], np.int64)
    if len(sample) < 2:
        sample = np.array([0, -1], np.int64)
    roots = components(links(nodes.select("fp"), plan(sample, total, max_bits), max_bits))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(smallest.withColumnRenamed("root", "r"), F.col("root") == F.col("r")).select(
        F.col("fp").alias("g_fp"), "root", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def simhash_components(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, fingerprint (16 hex digits), component_id."""
    fps = written(fingerprints(docs.select(F.col(id_col), text_bytes().alias("text"))), "simhash")
    groups = near_groups(fps, id_col)
    return fps.join(groups, F.col("fp") == F.col("g_fp")).select(
        id_col, hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def near_duplicates_removed(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Whole rows, one per near-duplicate group: that with the group's smallest id (of
    equal ids the first row; a group without any id keeps one row)."""
    keyed = docs.select(whole_rows(docs), F.col(f"`{id_col}`").alias("id"),
                        F.monotonically_increasing_id().alias("row"), text_bytes().alias("text"))
    fps = written(fingerprints(keyed), "simhash-rows")     # from here on ``row`` is fixed
    groups = near_groups(fps.select("id", "fp"), "id")
    kept = (fps.select("fp", "id", "row").join(groups, F.col("fp") == F.col("g_fp"))
            .where(F.col("id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min("row").alias("kept_row")).select("kept_row"))
    return fps.join(kept, F.col("row") == F.col("kept_row"), "left_semi").select(f"{ROW}.*")
