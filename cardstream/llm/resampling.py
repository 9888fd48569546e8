"""Target-distribution importance resampling.

Documents are scored by how much likelier their words are in a target set of texts
than in the corpus itself. A feature is a run of consecutive words and falls into one
of ``BUCKETS`` hash buckets; both sides are counted per bucket, smoothed, and the log
ratio of a bucket is its gain, in thousandths. A document's weight is the sum of
``gains[bucket]`` over its features, read from one array. Gumbel noise that depends on
the id alone turns "the highest scores" into a draw without replacement by weight.

The draw is a quickselect over the whole table, never a sort of it: each round takes a
few random rows of the interval that still holds the k-th key as pivots, counts exactly
how many keys lie below, at and between them, and keeps the one gap that holds the k-th
key. Keys are (score descending, id, row number) and therefore all different, so a
score that a third of the rows share does not stop the narrowing. Only the winners are
then sorted, by range, and ranked with the row counts of the ranges.

Passes: texts are read twice, by the same light scan (once for the bucket counts, once
for the weights); the rounds read the narrow scored table.

Defined cases: null and empty texts have no features (weight 0) and are not drawn, as
are all below ``MIN_WORDS`` words; a very long text is scanned in pieces; ties go to the
smaller id, null ids last, and between rows of one id any order is right; repeated rows
are scored and drawn each for itself; an empty table gives an empty result; an empty
target gives gains from smoothing alone; other columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back_memory, map_batches, pieces, text_bytes, written

BUCKETS = 10_000
RUN = 1                # consecutive words of a feature, at most
SEED = "2024"
MIN_WORDS = 20         # documents of fewer words are not drawn
SHARE = 10             # per cent of the others that are drawn
RESULT = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
PIVOTS = 15            # random pivot keys of a round
REMEMBERED = 500_000   # short words whose bucket a worker remembers

#: Everything but 0-9, a-z and bytes of non-ASCII characters separates words.
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


class _Buckets(dict):
    """Bucket of a feature; those of short ones are remembered."""

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % BUCKETS
        if len(feature) <= 32:
            if len(self) >= REMEMBERED:
                self.clear()
            self[feature] = bucket
        return bucket


_KNOWN = _Buckets()


def feature_buckets(text: bytes, run: int = RUN) -> Iterator[tuple[int, np.ndarray]]:
    """Per piece of the text: its words and the buckets of its features."""
    last: list[bytes] = []
    for piece in pieces(text.translate(_SPLIT), b" "):
        words = piece.split()
        found = [np.fromiter(map(_KNOWN.__getitem__, words), np.int32, len(words))]
        for k in range(2, run + 1):                  # longer runs reach back into the piece before
            joined = last[len(last) - min(len(last), k - 1):] + words
            runs = [b" ".join(joined[i: i + k]) for i in range(len(joined) - k + 1)]
            found.append(np.fromiter(map(_KNOWN.__getitem__, runs), np.int32, len(runs)))
        if run > 1:
            last = (last + words)[-(run - 1):]
        yield len(words), np.concatenate(found)


def bucket_counts(docs: DataFrame, run: int = RUN) -> np.ndarray:
    """Features per bucket over all texts: one vector a task, added up by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, buckets in feature_buckets(text.as_py(), run):
                    total += np.bincount(buckets, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                                         names=["bucket", "n"])
        del batches
        give_back_memory()

    per_task = docs.select(text_bytes().alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for r in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():      # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed shares, target to corpus, in thousandths."""
    s_all, t_all = int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000.0 * math.log((float(t) + 1.0) * (s_all + BUCKETS) / ((float(s) + 1.0) * (t_all + BUCKETS))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, run: int = RUN, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes().alias("text"))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column(1):
            words = features = weight = 0
            for n, buckets in feature_buckets(text.as_py(), run):
                words, features, weight = words + n, features + len(buckets), weight + int(gain[buckets].sum())
            out.append((words, features, weight))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*out))],
            names=["doc_id", "n_words", "n_features", "weight"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, score, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(seed: str = SEED) -> Column:
    """Gumbel noise of an id, in thousandths (a null id counts as an empty one)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def _after(pivot) -> Column:
    """Whether a row's key comes after the pivot's: 1 or 0; nulls of the id come last."""
    score, name, row = pivot
    known = F.lit(name)
    later = F.col("doc_id").isNull() | (F.col("doc_id") > known) if name is not None else F.lit(False)
    same = F.col("doc_id").eqNullSafe(known)
    return (F.col("score") < score) | ((F.col("score") == score) & (later | (same & (F.col("row") > row))))


def _is(pivot) -> Column:
    return F.col("row") == pivot[2]                   # row numbers are unique


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th key (from 1) of rows (score, doc_id, row), in the order score descending, id,
    row; None if there is none. Every round is two passes over the rows still in question."""
    low = high = None                                 # the k-th key lies strictly between
    before = 0                                        # keys up to and with ``low``
    inside, turn = keys, 0
    while True:
        # one random row of each of ``pivots`` random parts: the least hash in it
        h = F.xxhash64("row", F.lit(turn))
        drawn = (inside.groupBy(F.pmod(h, F.lit(pivots)).alias("part"))
                 .agg(F.min_by(F.struct("score", "doc_id", "row"), F.xxhash64(h)).alias("key")).collect())
        if not drawn or k < 1:
            return None
        chosen = sorted((tuple(r["key"]) for r in drawn),
                        key=lambda p: (-p[0], p[1] is None, 0 if p[1] is None else p[1], p[2]))
        # slot 2i: keys between pivots i-1 and i; slot 2i+1: pivot i itself
        slot = F.lit(0)
        for p in chosen:
            slot = slot + F.when(_is(p), 1).when(_after(p), 2).otherwise(0)
        counts = {r["slot"]: r["n"] for r in
                  inside.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for s in sorted(counts):
            if before + counts[s] >= k:
                break
            before += counts[s]
        else:
            return None                               # fewer than k keys
        if s % 2:
            return chosen[s // 2]
        low = chosen[s // 2 - 1] if s else low
        high = chosen[s // 2] if s // 2 < len(chosen) else high
        inside, turn = keys, turn + 1
        if low is not None:
            inside = inside.where((F.col("score") <= low[0]) & _after(low) & ~_is(low))
        if high is not None:
            inside = inside.where((F.col("score") >= high[0]) & ~_after(high) & ~_is(high))


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` from 1, by one range shuffle of them alone: a rank is the rows of
    the ranges before and the place in its own."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    dealt = written(winners.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "resample-drawn")
    carried, n = [], 0
    for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():   # one a range
        carried.append((r["part"], n))
        n += r["n"]
    starts = winners.sparkSession.createDataFrame(carried, "c_part int, before bigint")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return (dealt.withColumn("place", place).join(F.broadcast(starts), F.col("part") == F.col("c_part"))
            .withColumn("rank", F.col("before") + F.col("place"))
            .select(*winners.columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, run: int = RUN, seed: str = SEED,
             min_words: int = MIN_WORDS, id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (null: not drawn) and n_words.

    ``share`` per cent of the documents of ``min_words`` words and more are drawn.
    """
    gain = gains(bucket_counts(docs, run), bucket_counts(target, run))
    scored = written(weighted(docs, gain, run, id_col)
                     .withColumn("score", F.col("weight") + noise(seed))
                     .withColumn("row", F.monotonically_increasing_id()), "resample-scored")
    able = scored.where(F.col("n_words") >= min_words)
    keys = able.select("score", "doc_id", "row")
    last = kth_key(keys, share * keys.count() // 100)
    none = F.lit(None).cast("bigint")
    if last is None:
        return scored.withColumn("rank", none).select(*RESULT)
    drawn = (F.col("n_words") >= min_words) & (_is(last) | ~_after(last))
    others = scored.where(~drawn).withColumn("rank", none)
    return ranked(scored.where(drawn)).unionByName(others).select(*RESULT)
