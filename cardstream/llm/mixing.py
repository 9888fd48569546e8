"""Mixing sources to target weights by iterative proportional fitting.

The tokens of every (source, language, topic) cell are raked: their weights are
scaled in turn so that the sources', then the languages', then the topics' sums
meet the targets, until no sum is off by more than ``TOLERANCE``. Targets that no
weights can meet together (a source and a language that only occur with each other,
say) leave sums that stand still beside their targets: raking then ends with a warning
that names the marginals and how far off they are, and topics, raked last, are met.

A document's weight is its cell's fitted weight over the cell's tokens. Documents are
sampled in proportion to it, at a rate that the bulk of the corpus sets: cells of
the largest weights that together hold at most ``SHORT`` of the fitted weight are drawn
whole (probability ``rate``, 1 by default), and the largest weight below them has that probability as well.
So a rare value, which would need more documents than it has, does not thin out the
others; the expected share of any value is off by at most ``SHORT`` through it. The draw is a
hash of the row and a seed, so a run repeats itself on any cluster.

Targets are shares per value; by default each marginal is tempered: a value's
share is its share of tokens to the power ``TEMPER``, scaled to add up to one, which moves weight
from what is plentiful to what is rare. Only cells are iterated over; rows are
read once to count and once to draw.

Defined cases: null and empty source, language or topic are one value,
``(none)``; null text counts as no tokens, and a document without tokens takes part
with one; values named by a target but absent are left out and the rest scaled up; values
absent from a given target get weight zero; a very long text counts by its whole length;
repeated rows share one draw, and so do equal texts of one id (no tie is broken); an
empty table gives no rows; extra columns may have any names.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, whole_rows, written

TEMPER = {"source": 0.9, "lang": 0.95, "topic": 0.95}
TOLERANCE = 1e-6
STILL = 1e-3                  # raking stands still when three rounds gain less than this share
SHORT = 0.01                  # fitted weight that cells too small for the rate may hold
STEPS = 64                    # weights are ranked in so many steps per power of two
SEED = 20
MARGINS = ("source", "lang", "topic")
MAX_BROADCAST_CELLS = 100_000


def tokens(text: str = "text") -> Column:
    """Estimated tokens: a quarter of the text's bytes, at least one."""
    size = F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("bigint")
    return F.greatest(F.expr("1L"), F.ceil(size / 4).cast("bigint"))


def topic(text: str = "text") -> Column:
    """A coarse topic by form, for tables without a topic column: how long the text is
    and whether it has columns (``|``)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    length = (F.when(F.octet_length(body) < 500, "note").when(F.octet_length(body) < 4000, "article")
              .otherwise("book"))
    return F.when(F.size(F.split(body, r"\|", 8)) >= 8, "table").otherwise(length)


def named(col: Column) -> Column:
    """Null and empty values as one."""
    return F.coalesce(F.nullif(col.cast("string"), F.lit("")), F.lit("(none)"))


def cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))


def target_shares(cell: DataFrame, margin: str, given: dict[str, float] | None) -> DataFrame:
    """(value, share) of a marginal; shares of the values present add up to one."""
    if given is None:
        raw = cell.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(TEMPER[margin])).alias("raw"))
    else:
        wanted = cell.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in given.items()], f"{margin} string, raw double")
        raw = cell.select(margin).distinct().join(wanted, margin, "left").withColumn(
            "raw", F.coalesce("raw", F.lit(0.0)))
    whole = raw.agg(F.sum("raw").alias("whole"))
    return raw.join(F.broadcast(whole), F.lit(True)).select(                    # one row
        F.col(margin).alias("value"), (F.col("raw") / F.col("whole")).alias("share"))


def rake(cell: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """``cell`` with ``weight``: fitted shares, starting from the cells' tokens."""
    whole = cell.agg(F.sum("tokens").alias("whole"))
    now = written(cell.join(F.broadcast(whole), F.lit(True)).withColumn(
        "weight", F.col("tokens") / F.col("whole")).drop("whole"), "mix-cells")
    shares = {m: written(t, f"mix-{m}") for m, t in targets.items()}
    best, idle = float("inf"), 0
    while True:
        step = now.drop(*[f"off_{m}" for m in MARGINS])
        for m in MARGINS:
            sums = step.groupBy(m).agg(F.sum("weight").alias("sum"))
            scale = sums.join(shares[m], F.col(m) == F.col("value")).select(
                F.col(m).alias("s_value"), F.abs(F.col("sum") - F.col("share")).alias(f"off_{m}"),
                F.when(F.col("sum") > 0, F.col("share") / F.col("sum")).otherwise(0.0).alias("scale"))
            step = step.join(scale, F.col(m) == F.col("s_value")).withColumn(
                "weight", F.col("weight") * F.col("scale")).drop("s_value", "scale")
        now = written(step, "mix-cells")
        off = now.agg(*[F.max(f"off_{m}").alias(m) for m in MARGINS]).first().asDict()
        worst = max((x for x in off.values() if x is not None), default=0.0)
        if worst <= tolerance:
            break
        idle = idle + 1 if worst > best * (1 - STILL) else 0
        best = min(best, worst)
        if idle == 3:
            told = ", ".join(f"{m} {x:.6f}" for m, x in off.items())
            warnings.warn(f"targets contradict each other: largest deviations that remain are {told}")
            break
    return now.select(*cell.columns, "weight")


def common_top(each: DataFrame, short: float) -> DataFrame:
    """One row, ``top``: the largest weight per token once the cells of the largest ones,
    ``short`` of the whole weight at most, are set aside.

    Cells are counted into steps of a 64th of a power of two, a table bounded by the
    range of doubles, in which the steps are summed from above.
    """
    steps = (each.where("each > 0").groupBy(F.floor(F.log2("each") * STEPS).alias("step"))
             .agg(F.sum("weight").alias("weight"), F.max("each").alias("most")))
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.withColumns({"down_to": F.sum("weight").over(above),
                              "whole": F.sum("weight").over(Window.partitionBy())}).where(
        F.col("down_to") > F.lit(short) * F.col("whole")).agg(F.max("most").alias("top"))


def probabilities(fitted: DataFrame, rate: float = 1.0, short: float = SHORT) -> DataFrame:
    """Cells with the probability with which each of their documents is drawn."""
    each = fitted.withColumn("each", F.col("weight") / F.col("tokens"))
    return each.join(F.broadcast(common_top(each, short)), F.lit(True)).select(        # one row
        *[F.col(m).alias(f"p_{m}") for m in MARGINS], "weight",
        F.when(F.col("top") > 0, F.lit(min(rate, 1.0)) * F.least(F.lit(1.0), F.col("each") / F.col("top")))
        .otherwise(0.0).alias("probability"))


def draw(*cols: Column) -> Column:
    """A uniform number in [0, 1) from the row's hash."""
    return F.pmod(F.xxhash64(F.lit(SEED), *cols), F.expr("1L << 40")) / float(1 << 40)


def mixture(docs: DataFrame, id_col: str = "doc_id", topic_col: Column | None = None,
            targets: dict[str, dict[str, float]] | None = None, rate: float = 1.0,
            short: float = SHORT, carry: bool = False) -> DataFrame:
    """Per document: doc_id, source, lang, topic, tokens, weight, probability, sampled
    (and the whole row, with ``carry``)."""
    column = lambda n: F.col(f"`{n}`") if n in docs.columns else F.lit(None)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), named(column("source")).alias("source"),
        named(column("lang")).alias("lang"), named(topic() if topic_col is None else topic_col).alias("topic"),
        tokens().alias("tokens"), draw(F.col(f"`{id_col}`"), F.col("text")).alias("drawn"),
        *([whole_rows(docs)] if carry else []))
    narrow = written(cells(rows), "mix-counts")
    given = targets or {}
    fitted = rake(narrow, {m: target_shares(narrow, m, given.get(m)) for m in MARGINS})
    chance = written(probabilities(fitted, rate, short), "mix-chance")
    if chance.limit(MAX_BROADCAST_CELLS + 1).count() <= MAX_BROADCAST_CELLS:
        chance = F.broadcast(chance)
    on = [F.col(m) == F.col(f"p_{m}") for m in MARGINS]
    return (rows.join(chance, on[0] & on[1] & on[2])
            .withColumn("sampled", F.col("drawn") < F.col("probability")).drop("drawn", "p_source", "p_lang", "p_topic"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The whole rows of the documents drawn."""
    return mixture(docs, carry=True, **options).where("sampled").select(f"{ROW}.*")
