"""Removal of repeated passages by suffix order and a common-prefix interval tree.

A passage is a string of ``LENGTH`` bytes that starts at two or more places of
the corpus; every byte that one covers goes. Any two equal windows of ``LENGTH``
bytes have the same least-hashed ``K``-gram at the same place inside, so windows
are filed under that anchor: one row stands for all neighbouring windows that
share an anchor place. Then:

1. anchors seen once are dropped, and rows whose whole context (the union of
   their windows) occurs again are settled by its hash, with no text moved;
2. for what is left, one context per distinct text is fetched. The contexts of
   one anchor, sorted by what follows it, are an enhanced suffix array. A
   stack scan yields its common-prefix intervals; an interval whose members'
   left extensions are diverse is a maximal repeat, and each member's longest left
   extension shared with any other member (not just with neighbours in suffix
   order) is read off their left order. All occurrences come out;
3. an anchor with more than ``GROUP`` distinct contexts is first split by the
   windows' offset, again and again, each half filed under the longer string that
   its windows share, and contexts that have become equal are settled; at one
   offset the file is the window itself. So no anchor is too common for a task.

Rows are known by a 64-bit hash of id and text, windows by two 64-bit hashes.

Defined cases: null text counts as empty; texts shorter than ``LENGTH`` bytes lose
nothing; fully repeated rows repeat each other's text; overlapping repeats
within one text count; an empty table gives no rows; a null id counts as a value like any other; a very
long text is read whole, in pieces that overlap; ``repeats_removed`` keeps whole
characters (a character is removed only if all its bytes are) and works on rows of
any further columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, ddl, map_batches, text_bytes, whole_rows, with_columns, written

LENGTH = 200
K = 32                       # anchor grams
CHUNK = 1 << 19              # bytes hashed at once
GROUP = 2_048                # contexts of one anchor that a task takes at once

_M = 0x9E3779B97F4A7C15 | 1
_WRAP = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_M))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _M), ("down", pow(_M, -1, 1 << 64))):
            out = np.ones(n, np.uint64)
            out[1:] = np.uint64(base)
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """Anchors of the texts that lie in ``data`` between consecutive ``bounds``.

    (text number, place, least and greatest offset of its windows before it, anchor hash,
    context hash).
    """
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:-1], out=sums[1:])
    grams = _mix((sums[k:] - sums[:-k]) * down[: len(data) - k + 1])
    width = length - k + 1
    place_bits = np.uint64(20)
    packed = (grams >> place_bits << place_bits) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min(packed, width) & np.uint64((1 << 20) - 1)
    edge = np.zeros(len(data) + 1, np.int32)
    lasts = bounds[1:] - length + 1                      # window starts of a text: [start, last)
    long = lasts > bounds[:-1]
    np.add.at(edge, bounds[:-1][long], 1)
    np.add.at(edge, lasts[long], -1)
    starts = np.flatnonzero(np.cumsum(edge[: len(least)]))
    if not len(starts):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    at = least[starts].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    s1, s2, place = starts[new], starts[np.concatenate([new[1:] - 1, [len(starts) - 1]])], at[new]
    window = lambda s: _mix((sums[s + length] - sums[s]) * down[s])
    lo, hi = place - s2, place - s1
    context = _mix(window(s1) + _mix(window(s2) + (lo * 1024 + hi).astype(np.uint64)))
    text = np.searchsorted(bounds, place, side="right") - 1
    return text, place - bounds[text], lo, hi, grams[place], context


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in chunks of about ``CHUNK`` bytes; a longer text in pieces that overlap by a window."""
    numbers, offsets, parts, size = [], [], [], 0
    for n, text in enumerate(texts):
        for lo in range(0, max(len(text) - length + 1, 0), CHUNK):
            part = text[lo: lo + CHUNK + length - 1]
            if size + len(part) > CHUNK and parts:
                yield numbers, offsets, parts
                numbers, offsets, parts, size = [], [], [], 0
            numbers.append(n)
            offsets.append(lo)
            parts.append(part)
            size += len(part)
    if parts:
        yield numbers, offsets, parts


ANCHOR_DDL = "uid bigint, pos bigint, lo int, hi int, h bigint, g bigint, n int"


def anchor_rows(keyed: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """Anchors of (uid, text). ``n`` counts a batch's rows of equal context: its first row
    stands for them all, and rows with ``n = 0`` are settled as repeated."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        uids = batch.column(0).to_numpy(zero_copy_only=False)
        texts = [x.as_py() for x in batch.column(1)]
        found = []
        for numbers, offsets, parts in _pieces(texts, length):
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            part, pos, *rest = anchors(np.frombuffer(b"".join(parts), np.uint8), bounds, length, k)
            found.append((uids[np.array(numbers)[part]], pos + np.array(offsets)[part], *rest))
        if not found:
            return None
        uid, pos, lo, hi, h, g = (np.concatenate(c) for c in zip(*found))
        _, first, inverse, count = np.unique(g, return_index=True, return_inverse=True, return_counts=True)
        several = count[inverse] > 1
        rows = np.concatenate([first, np.flatnonzero(several)])
        n = np.concatenate([count, np.zeros(int(several.sum()), np.int64)])
        cols = [uid[rows], pos[rows], lo[rows].astype(np.int32), hi[rows].astype(np.int32),
                h[rows].view(np.int64), g[rows].view(np.int64), n.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["uid", "pos", "lo", "hi", "h", "g", "n"])

    return map_batches(keyed, run, ANCHOR_DDL)


# ---------------------------------------------------------------- contexts of one anchor

def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n                      # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (depth, first, last) of a suffix array, deepest first inside
    each, by a stack scan. ``lcp[i]`` is shared by members i and i + 1."""
    stack: list[tuple[int, int]] = []               # (depth, first member)
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] >= depth:
            d, first = stack.pop()
            if d > depth:
                yield d, first, i
        if depth >= 0:
            stack.append((depth, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(member, left, right) extents of repeats of ``length`` or more around one anchor.

    ``lefts`` run backwards from the anchor, ``rights`` forwards. An interval of the suffix
    order shares its depth to the right; a member's left extent is the longest that any
    other member of the interval shares with it.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    out, reached = [], [-1] * len(rights)
    for depth, first, last in intervals(lcp):
        inside = sorted(order[first: last + 1], key=lefts.__getitem__)
        shared = [_common(lefts[a], lefts[b]) for a, b in zip(inside, inside[1:])]
        if max(shared) + depth < length:
            continue
        for i, member in enumerate(inside):         # left-diverse: neighbours in left order
            left = max(shared[i - 1] if i else -1, shared[i] if i < len(shared) else -1)
            if left + depth >= length and left > reached[member]:
                reached[member] = left
                out.append((member, left, depth))
    return out


SPAN_DDL = "uid bigint, start bigint, stop bigint, repeat bigint"


def _match(length: int):
    """Runs of equal key in a sorted partition -> spans of their maximal repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(rows: list[tuple]) -> list[tuple]:
            lefts, rights = [r[1][::-1] for r in rows], [r[2] for r in rows]
            return [(rows[i][3], rows[i][4] - left, rows[i][4] + right,
                     xxhash.xxh64_intdigest(lefts[i][:left][::-1] + rights[i][:right]) - (1 << 63))
                    for i, left, right in maximal_repeats(lefts, rights, length)]

        held: list[tuple] = []                     # one key's rows: at most GROUP
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    if len(held) > 1:
                        out += spans(held)
                    held = []
                held.append(row)
            if out:
                yield _span_batch(out)
        if len(held) > 1 and (out := spans(held)):
            yield _span_batch(out)
    return run


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      names=["uid", "start", "stop", "repeat"])


def _span(length: int) -> list[Column]:
    return [F.col("uid"), (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("stop")]


def _split_large(contexts: DataFrame, length: int, width: int, group: int) -> tuple[DataFrame, list[DataFrame]]:
    """Contexts refiled until no key has more than ``group``; spans settled on the way."""
    ready, settled = [], []
    same = ["key", "c1", "c2", "lo", "hi", "left", "right"]
    now = contexts.withColumns({"c1": F.lit(0), "c2": F.lit(width - 1)})
    while True:
        sizes = now.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > group)
        sizes = written(sizes.select(F.col("key").alias("l_key")), "suffix-large")
        if sizes.isEmpty():
            ready.append(now.drop("c1", "c2"))
            break
        ready.append(now.join(sizes, F.col("key") == F.col("l_key"), "left_anti").drop("c1", "c2"))
        large = now.join(sizes, F.col("key") == F.col("l_key"), "left_semi")
        mid = F.expr("(c1 + c2) div 2")
        halves = F.array(F.struct(F.col("c1").alias("c1"), mid.alias("c2")), F.struct((mid + 1).alias("c1"), F.col("c2").alias("c2")))
        half = (large.withColumn("c", F.explode(halves)).where("c.c1 <= c.c2")
                .withColumns({"c1": F.col("c.c1"), "c2": F.col("c.c2"),
                              "lo": F.greatest("lo", "c.c1"), "hi": F.least("hi", "c.c2")})
                .where("lo <= hi").drop("c"))
        half = half.withColumns({                     # a half's own windows alone
            "left": F.expr("substring(left, octet_length(left) - hi + 1, hi)"),
            "right": F.expr(f"substring(right, 1, {length} - lo)")})
        core = [F.expr("substring(left, octet_length(left) - c1 + 1, c1)"), F.expr(f"substring(right, 1, {length} - c2)")]
        half = written(half.withColumn("key", F.xxhash64("key", "c1", "c2", *core)), "suffix-halves")
        equal = written(half.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "pos")).alias("m")),
                        "suffix-equal")
        twice = equal.where("n > 1").select(*[F.col(c).alias(f"t_{c}") for c in same])
        on = F.lit(True)
        for c in same:
            on &= F.col(c) == F.col(f"t_{c}")
        settled.append(half.join(twice, on, "left_semi").select(
            *_span(length), F.xxhash64("left", "right").alias("repeat")))
        # one of equal contexts goes on, for the others that it overlaps
        now = equal.select("key", "left", "right", "m.uid", "m.pos", "lo", "hi", "c1", "c2")
        now = now.where(F.col("c1") < F.col("c2"))    # at one offset, equal is all there is
        if now.isEmpty():
            break
    out = ready[0]
    for r in ready[1:]:
        out = out.unionByName(r)
    return out, settled


def repeats(keyed: DataFrame, length: int = LENGTH, k: int = K, group: int = GROUP) -> DataFrame:
    """(uid, start, stop, repeat): all occurrences of the repeats in (uid, text), as byte
    spans; ``repeat`` is the same for occurrences of one string found around one anchor."""
    all_rows = written(anchor_rows(keyed, length, k), "suffix-anchors")
    local = all_rows.where("n = 0").select(*_span(length), F.col("g").alias("repeat"))
    rows = all_rows.where("n > 0")
    common = (rows.groupBy("h").agg(F.sum("n").alias("total"), F.min("g").alias("g0"), F.max("g").alias("g1"))
              .where("total > 1").select(F.col("h").alias("c_h"), (F.col("g0") == F.col("g1")).alias("alike")))
    shared = written(rows.join(common, F.col("h") == F.col("c_h")).drop("c_h"), "suffix-shared")
    alike = shared.where("alike and n = 1").select(*_span(length), F.col("g").alias("repeat"))
    mixed = shared.where("not alike")
    by_context = written(mixed.groupBy("h", "g").agg(
        F.sum("n").alias("total"), F.min(F.struct("uid", "pos", "lo", "hi")).alias("m")), "suffix-contexts")
    twice = by_context.where("total > 1").select(F.col("h").alias("t_h"), F.col("g").alias("t_g"))
    again = (mixed.where("n = 1").join(twice, (F.col("h") == F.col("t_h")) & (F.col("g") == F.col("t_g")), "left_semi")
             .select(*_span(length), F.col("g").alias("repeat")))

    wanted = (by_context.select("h", "m.*").groupBy("uid")
              .agg(F.collect_list(F.struct("h", "pos", "lo", "hi")).alias("wanted"))   # of one text
              .withColumnRenamed("uid", "w_uid"))
    one_each = keyed.join(wanted, F.col("uid") == F.col("w_uid")).drop("w_uid")
    contexts = one_each.select("uid", "text", F.explode("wanted").alias("w")).select(
        F.col("w.h").alias("key"),
        F.expr("substring(text, cast(w.pos - w.hi + 1 as int), w.hi)").alias("left"),
        F.expr(f"substring(text, cast(w.pos + 1 as int), {length} - w.lo)").alias("right"),
        "uid", "w.pos", "w.lo", "w.hi")
    contexts = written(contexts, "suffix-texts")
    ready, settled = _split_large(contexts, length, length - k + 1, group)
    matched = (ready.select("key", "left", "right", "uid", "pos").repartition("key").sortWithinPartitions("key")
               .mapInArrow(_match(length), SPAN_DDL))
    spans = local.unionByName(alike).unionByName(again).unionByName(matched)
    for s in settled:
        spans = spans.unionByName(s)
    return spans


# ---------------------------------------------------------------- removal

def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def row_key(id_col: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")))


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with ``spans``, the list of their text's spans (null: none)."""
    lists = (spans.select("uid", "start", "stop").distinct().groupBy("uid")
             .agg(F.collect_list(F.struct("start", "stop")).alias("spans")).withColumnRenamed("uid", "s_uid"))
    return rows.join(lists, F.col("uid") == F.col("s_uid"), "left").drop("s_uid")


def _cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *[b for _, b in runs]]
    return b"".join(text[a:b] for a, b in zip(ends, [*[a for a, _ in runs], len(text)]))


def _runs(value) -> list[tuple[int, int]]:
    return merged([(s["start"], s["stop"]) for s in value or ()])


def repeat_digest(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), row_key(id_col).alias("uid"), text_bytes().alias("text"))
    joined = _with_spans(keyed, repeats(keyed.select("uid", "text"))).drop("uid")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            text, runs = text.as_py(), _runs(spans.as_py())
            kept = _cut(text, runs) if runs else text
            out.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*out))
        return with_columns(batch, ["text", "spans"], {
            n: pa.array(c, pa.string() if n == "kept_sha256" else pa.int64())
            for n, c in zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), cols)})

    return map_batches(joined.select("doc_id", "text", "spans"), run, ddl(
        joined, ["doc_id"], "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))


def whole_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs drawn in to character borders."""
    out = []
    for a, b in runs:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def repeats_removed(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Whole rows with the repeated passages taken out of ``text`` (null stays null)."""
    keyed = docs.select(whole_rows(docs), row_key(id_col).alias("uid"), text_bytes().alias("text"))
    joined = _with_spans(keyed, repeats(keyed.select("uid", "text")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            text = text.as_py()
            kept.append(_cut(text, whole_characters(text, _runs(spans.as_py()))))
        return with_columns(batch, ["text", "spans"], {"kept": pa.array(kept, pa.binary())})

    out = map_batches(joined.select(ROW, "text", "spans"), run, ddl(joined, [ROW], "kept binary"))
    text = F.when(F.col(f"{ROW}.text").isNotNull(), F.col("kept").cast("string"))
    return out.select(*[(text if c == "text" else F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns])
