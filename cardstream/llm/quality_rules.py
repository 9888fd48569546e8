"""Quality rules with adaptive thresholds.

Every document gets counts of its words, symbols, repeated lines and repeated
five-word windows. Thresholds are not fixed: each (language, source) group
keeps a mergeable quantile sketch of every ratio, fences are read off the
sketches, and documents are filtered by a join with their group's fences.

The sketch is a log-linear histogram: a ratio in parts per million is an
integer, and its bucket is the integer with all but its top seven bits
cleared, so a quantile is right to one part in 64. Two sketches merge by adding
counts; merging is exact, needs no order and no random numbers. A language's sketch
is merged with the whole corpus's at the weight of ``PRIOR`` documents, and a group's
with its language's in the same way: a small group is judged by its language, a large
one by itself, and no size switches between the two.

A fence lies ``FENCE`` spreads beyond the median, and the spread is twice the distance from the
median to the quartile on the other side. Up to nearly half of a group's documents can then lie
beyond the fence without moving it far: they shift the median and the far quartile within the
values of the rest, and are never the quartile that is read.

Defined cases: null text counts as empty (no words, so the base rule rejects
it); null ``lang`` or ``source`` is a group of its own; a very long text is counted
whole; a value on a fence is inside; repeated rows each get the same result; an empty table gives an empty result; extra columns are
carried by ``quality_filter`` whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, ddl, map_batches, text_bytes, whole_rows, with_columns, written

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines"]

# ratio -> (lower fence?, least spread in parts per million). The least spread keeps
# a group whose values are all alike from rejecting what differs a little.
RATIOS = {
    "symbols_per_word": (False, 30_000),
    "chars_per_word": (True, 300_000),
    "repeat_share": (False, 30_000),
    "upper_share": (False, 60_000),
    "dup_line_share": (False, 60_000),      # one repeated line of three is inside
}
FENCE = 6              # spreads beyond the median
PRIOR = 50             # documents that a language's sketch counts for in a group's, and the corpus's in its
UNIT = 100             # parts of a document that merged sketches count in
MAX_BROADCAST_GROUPS = 100_000
MAX_BROADCAST_BUCKETS = 1_000_000


def _repeat_words(words: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more in the text."""
    n = len(words)
    if n < 6:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    grams = w[: n - 4]
    size = len(ids)
    for k in range(1, 5):
        if size > 2**62 // len(ids):                     # renumber before it overflows
            values, grams = np.unique(grams, return_inverse=True)
            size = len(values)
        grams = grams * len(ids) + w[k: n - 4 + k]
        size *= len(ids)
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    if not hit.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + 5, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def count_text(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = text.split()                       # bytes.split(): exactly \x20 and \x09-\x0D
    chars = sum(map(len, words))
    if not text.isascii():
        raw = np.frombuffer(text, np.uint8)
        chars -= int(np.count_nonzero((raw & 0xC0) == 0x80))
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (len(words), chars, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), _repeat_words(words), upper, len(lines))


def quality_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its text column replaced by the counts."""
    carried = [c for c in df.columns if c != text]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text))
        cols = list(zip(*(count_text(x.as_py()) for x in texts)))
        return with_columns(batch, [text], {n: pa.array(c, pa.int64()) for n, c in zip(COUNTS, cols)})

    return map_batches(df, run, ddl(df, carried, ", ".join(f"{c} bigint" for c in COUNTS)))


def ratios() -> dict[str, Column]:
    """The ratios in parts per million, as integers."""
    return {
        "symbols_per_word": F.expr("n_symbols * 1000000 div greatest(n_words, 1)"),
        "chars_per_word": F.expr("word_chars * 1000000 div greatest(n_words, 1)"),
        "repeat_share": F.expr("n_repeat_words * 1000000 div greatest(n_words, 1)"),
        "upper_share": F.expr("n_upper * 1000000 div greatest(word_chars, 1)"),
        "dup_line_share": F.expr("n_dup_lines * 1000000 div greatest(n_lines, 1)"),
    }


def bucket(value: Column) -> Column:
    """The value with all but its top seven bits cleared (the sketch's bucket)."""
    drop = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(counts: DataFrame) -> DataFrame:
    """Sketch rows (lang, source, level, ratio, bucket, n): level 0 per group, 1 per
    language, 2 for all. Documents without words are left out."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("ratio"), bucket(value).alias("bucket"))
        for name, value in ratios().items()])).alias("r")
    group = (counts.where("n_words > 0").select("lang", "source", pairs)
             .groupBy("lang", "source", F.col("r.ratio").alias("ratio"),
                      F.col("r.bucket").alias("bucket"))
             .agg(F.count(F.lit(1)).alias("n")))
    null = F.lit(None).cast("string")
    lang = group.groupBy("lang", "ratio", "bucket").agg(F.sum("n").alias("n"))
    whole = lang.groupBy("ratio", "bucket").agg(F.sum("n").alias("n"))
    order = ["lang", "source", "level", "ratio", "bucket", "n"]
    return (group.withColumn("level", F.lit(0)).select(order)
            .unionByName(lang.withColumns({"source": null, "level": F.lit(1)}).select(order))
            .unionByName(whole.withColumns({"lang": null, "source": null, "level": F.lit(2)}).select(order)))


def _merged(own: DataFrame, parent: DataFrame, keys: list[str], shared: list[str]) -> DataFrame:
    """Sketch rows (keys, bucket, n in units): ``own`` (keys, bucket, n in units) plus the
    ``parent``'s (shared, bucket, n) at the weight of ``PRIOR`` documents."""
    whole = F.sum("n").over(Window.partitionBy(*shared))              # one sketch of the parent
    prior = parent.select(*[F.col(c).alias(f"p_{c}") for c in shared], "bucket",
                          F.expr(f"{PRIOR * UNIT}L * n").alias("n"), whole.alias("whole"))
    prior = prior.selectExpr(*[f"p_{c}" for c in shared], "bucket", "n div whole AS n").where("n > 0")
    prior = written(prior, "quality-prior")
    if prior.limit(MAX_BROADCAST_BUCKETS + 1).count() <= MAX_BROADCAST_BUCKETS:
        prior = F.broadcast(prior)
    on = F.lit(True)
    for c in shared:
        on &= F.col(c).eqNullSafe(F.col(f"p_{c}"))
    given = own.select(*keys).distinct().join(prior, on).select(*keys, "bucket", "n")
    return own.unionByName(given).groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def smoothed(sketch: DataFrame) -> DataFrame:
    """Sketches of the groups (lang, source, ratio, bucket, n in units), each merged with its
    language's, and that with the corpus's."""
    level = lambda k, *keys: sketch.where(F.col("level") == k).select(
        *keys, "ratio", "bucket", (F.col("n") * UNIT).alias("n"))
    lang = _merged(level(1, "lang"), level(2), ["lang", "ratio"], ["ratio"])
    return _merged(level(0, "lang", "source"), lang, ["lang", "source", "ratio"], ["lang", "ratio"])


def fences(sketch: DataFrame) -> DataFrame:
    """Per (lang, source): a lower and an upper fence per ratio.

    A window holds one sketch: its buckets, at most 64 for each power of two.
    """
    keys = ["lang", "source", "ratio"]
    rank = Window.partitionBy(*keys).orderBy("bucket")
    cum = sketch.withColumns({
        "upto": F.sum("n").over(rank),
        "total": F.sum("n").over(Window.partitionBy(*keys)),
    })
    quartile = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bucket")))
    least = F.create_map(*[x for r, (_, s) in RATIOS.items() for x in (F.lit(r), F.lit(s))])[F.col("ratio")]
    lower = F.col("ratio").isin([r for r, (low, _) in RATIOS.items() if low])
    away = lambda near, far: FENCE * F.greatest(2 * (F.col(far) - F.col(near)), least)
    per_ratio = (cum.groupBy(*keys)
                 .agg(quartile(1).alias("q1"), quartile(2).alias("q2"), quartile(3).alias("q3"))
                 .withColumn("hi", F.col("q2") + away("q1", "q2"))
                 .withColumn("lo", F.when(lower, F.col("q2") - away("q2", "q3"))))
    return (per_ratio.groupBy("lang", "source")
            .agg(*[F.max(F.when(F.col("ratio") == r, F.col(side))).alias(f"{r}_{side}")
                   for r in RATIOS for side in ("lo", "hi")]))


def thresholds(counts: DataFrame) -> DataFrame:
    """One row per (lang, source): the fences of its smoothed sketches."""
    sides = [f"{r}_{s}" for r in RATIOS for s in ("lo", "hi")]
    return fences(smoothed(written(sketches(counts), "quality-sketches"))).select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.struct(*sides).alias("fence"))


def verdict(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """``counts`` with ``base_failed`` and ``kept``: the filter joined by group.

    The limits are one row per group: broadcast behind a count of them, else a
    shuffle join whose large groups adaptive execution splits.
    """
    if limits.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    joined = counts.join(limits, F.col("lang").eqNullSafe(F.col("t_lang"))
                         & F.col("source").eqNullSafe(F.col("t_source")), "left")
    inside = F.lit(True)
    for name, value in ratios().items():
        inside &= F.coalesce(value <= F.col(f"fence.{name}_hi"), F.lit(True))
        inside &= F.coalesce(value >= F.col(f"fence.{name}_lo"), F.lit(True))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (joined.withColumn("base_failed", base)
            .withColumn("kept", ~base & inside).drop("t_lang", "t_source", "fence"))


def _strings(docs: DataFrame, *names: str) -> list[Column]:
    """Columns by name; a missing one is null."""
    return [(F.col(f"`{n}`").cast("string") if n in docs.columns else F.lit(None).cast("string")).alias(n)
            for n in names]


def quality_rules(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, lang, source, counts, ``base_failed``, ``kept``."""
    counts = quality_counts(docs.select(F.col(id_col), *_strings(docs, "lang", "source"),
                                        text_bytes().alias("text")))
    counts = written(counts, "quality-counts")
    return verdict(counts, written(thresholds(counts), "quality-limits"))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The whole rows of the documents that the rules keep."""
    counts = quality_counts(docs.select(whole_rows(docs), *_strings(docs, "lang", "source"),
                                        text_bytes().alias("text")))
    counts = written(counts, "quality-rows")
    limits = written(thresholds(counts.drop(ROW)), "quality-limits")
    return verdict(counts, limits).where("kept").select(f"{ROW}.*")
