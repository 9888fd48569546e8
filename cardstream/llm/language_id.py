"""Language identification by word-first backoff.

Training counts, per language, the words of a sample of labelled documents and
their character n-grams (with word-edge marks) of lengths four down to one.
A text is scored word by word: a known word adds its log frequency in every
language; an unseen word falls back to its known four-grams, failing those to
its three-grams, and so on down to single letters. The best total wins.

The classifier is fitted on a bounded sample: at most about ``MAX_TRAIN_DOCS``
documents per language, chosen by a hash of the row, and it keeps the
``MAX_ENTRIES`` most frequent grams of each order and language, however many languages
there are. These two bounds are parameters. The model is sparse: a gram holds the
languages that have it, so it grows with the languages and not with their square. Prediction
reads every whole text.

Defined cases: null text or text without a letter is ``und`` with score 0, as is
every text where nothing could be learned; null ``lang`` is never trained on;
ties go to the alphabetically first language; a null id counts as the empty text
for the fold; a very long text is read whole, word by distinct word; repeated rows each get the same
result and each count in training; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ddl, map_batches, text_bytes, with_columns, written

MAX_TRAIN_DOCS = 4_000        # per language, in expectation
MAX_ENTRIES = 30_000          # per gram order and language
ORDERS = (4, 3, 2, 1)         # n-gram lengths of the backoff; order 0 is the word itself
SMOOTH = 0.5
MAX_BROADCAST_LANGS = 10_000
CACHE_WORDS = 400_000         # unseen words a worker remembers
MAX_ROWS = 1 << 16            # grams of a text that are summed at a time

LETTERS = regex.compile(r"\p{L}+")


def held_out(id_col: str = "doc_id", fold: int = 2) -> Column:
    """Fold of the id: crc32 of its text, modulo four."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == fold


def grams_of(word: str, n: int) -> list[str]:
    marked = word if n == 1 else f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def training_sample(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> DataFrame:
    """Labelled rows outside the held-out fold, thinned per language by a hash of the row.

    Rates come from counts that read ``lang`` and the id alone.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out())
    rate = (labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("lang").alias("r_lang"), (F.lit(float(max_docs)) / F.col("n")).alias("rate")))
    if rate.limit(MAX_BROADCAST_LANGS + 1).count() <= MAX_BROADCAST_LANGS:
        rate = F.broadcast(rate)
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id"), F.length("text")), F.lit(1 << 30)) / float(1 << 30)
    return (labelled.join(rate, F.col("lang") == F.col("r_lang")).where(draw < F.col("rate"))
            .select("lang", text_bytes().alias("text")))


def gram_counts(sample: DataFrame) -> DataFrame:
    """(lang, ord, gram, n) over the sample; each batch counts before the shuffle."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[tuple[str, int], Counter] = {}
        langs = batch.column(0).to_pylist()
        for lang, text in zip(langs, batch.column(1)):
            words = LETTERS.findall(text.as_py().decode("utf-8", "replace").lower())
            counts.setdefault((lang, 0), Counter()).update(words)
        for lang in set(langs):
            for word, n in counts[lang, 0].items():
                for order in ORDERS:
                    c = counts.setdefault((lang, order), Counter())
                    for g in grams_of(word, order):
                        c[g] += n
        rows = [(k[0], k[1], g, n) for k, c in counts.items() for g, n in c.items()]
        cols = list(zip(*rows)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
             pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
            names=["lang", "ord", "gram", "n"])

    part = map_batches(sample, run, "lang string, ord int, gram string, n bigint")
    return part.groupBy("lang", "ord", "gram").agg(F.sum("n").alias("n"))


class Grams:
    """One order's log frequencies: ``base`` of a gram that a language does not have, and per gram
    (``index``: its row) the languages that have it, ``cols``, with what they have above that, ``more``."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, index: dict[str, int], total: np.ndarray):
        by_row = np.argsort(rows, kind="stable")
        self.index = index
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(index)))])
        self.cols = cols[by_row]
        self.more = np.log(counts[by_row] + SMOOTH) - np.log(SMOOTH)
        self.base = np.log(SMOOTH) - np.log(total + SMOOTH * (len(index) + 1))

    def summed(self, rows: list[int], times: list[float]) -> np.ndarray:
        """Per language: the log frequencies of the rows, each as often as ``times`` says."""
        at, times = np.array(rows), np.array(times, float)
        begin = self.ends[at]
        sizes = self.ends[at + 1] - begin
        upto = np.cumsum(sizes)
        each = np.arange(upto[-1]) + np.repeat(begin - upto + sizes, sizes)
        return times.sum() * self.base + np.bincount(
            self.cols[each], self.more[each] * np.repeat(times, sizes), len(self.base))


class Model:
    """The learned languages and each order's grams."""

    def __init__(self, langs: list[str], grams: dict[int, Grams]):
        self.langs, self.grams = langs, grams
        self.cache: dict[str, tuple[int, list[int]] | None] = {}

    @classmethod
    def fit(cls, sample: DataFrame, max_entries: int = MAX_ENTRIES) -> "Model":
        """Collects at most ``max_entries`` grams of each order and language."""
        counts = written(gram_counts(sample), "language-grams")
        totals = counts.groupBy("lang", "ord").agg(F.sum("n").alias("n")).collect()
        langs = sorted({r.lang for r in totals})
        rank = Window.partitionBy("lang", "ord").orderBy(F.desc("n"), "gram")
        top = counts.withColumn("k", F.row_number().over(rank)).where(F.col("k") <= max_entries)
        # the other languages' counts of a chosen gram count too
        chosen = top.select("ord", "gram").distinct()
        found = counts.join(chosen, ["ord", "gram"]).select("lang", "ord", "gram", "n").toArrow()
        col = {lang: i for i, lang in enumerate(langs)}
        total = {o: np.zeros(len(langs)) for o in (0, *ORDERS)}
        for r in totals:
            total[r.ord][col[r.lang]] = r.n
        grams = {}
        for o, t in total.items():
            own = found.filter(pc.equal(found["ord"], o))
            names = own["gram"].to_pylist()
            index: dict[str, int] = {}
            rows = np.array([index.setdefault(g, len(index)) for g in names], np.int64)
            cols = np.array([col[x] for x in own["lang"].to_pylist()], np.int64)
            grams[o] = Grams(rows, cols, own["n"].to_numpy(), index, t)
        return cls(langs, grams)

    def unseen(self, word: str) -> tuple[int, list[int]] | None:
        """The word's known n-grams of the longest length that has any: that length and their rows."""
        for order in ORDERS:
            index = self.grams[order].index
            known = [index[g] for g in grams_of(word, order) if g in index]
            if known:
                return order, known
        return None

    def score(self, text: str) -> tuple[str, float]:
        counts = Counter(LETTERS.findall(text.lower()))
        if not counts or not self.langs:
            return "und", 0.0
        index, cache = self.grams[0].index, self.cache
        found: dict[int, tuple[list[int], list[float]]] = {o: ([], []) for o in self.grams}
        weight, total = 0, np.zeros(len(self.langs))
        for word, n in counts.items():
            row = index.get(word)
            if row is not None:
                order, rows = 0, [row]
            else:
                if word in cache:
                    fallback = cache[word]
                else:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    fallback = self.unseen(word)
                    if len(word) <= 40:
                        cache[word] = fallback
                if fallback is None:
                    continue
                order, rows = fallback
            at, times = found[order]
            at += rows
            times += [n / len(rows)] * len(rows)          # an unseen word scores the mean of its grams
            weight += n
            if len(at) >= MAX_ROWS:
                total += self.grams[order].summed(at, times)
                found[order] = [], []
        for order, (at, times) in found.items():
            if at:
                total += self.grams[order].summed(at, times)
        best = int(np.argmax(total))
        if not weight:                                # letters of no learned script
            return self.langs[best], 0.0
        share = np.exp((total - total[best]) / weight)
        return self.langs[best], float(share[best] / share.sum())


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` (its UTF-8 bytes) replaced by ``lang_pred`` and ``score``."""
    carried = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.grams))
    local: dict[str, Model] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "model" not in local:
            local["model"] = Model(*shared.value)
        own = local["model"]
        pairs = [own.score(x.as_py().decode("utf-8", "replace"))
                 for x in batch.column(batch.schema.get_field_index(text))]
        return with_columns(batch, [text], {"lang_pred": pa.array([p[0] for p in pairs], pa.string()),
                                            "score": pa.array([p[1] for p in pairs], pa.float64())})

    return map_batches(docs, run, ddl(docs, carried, "lang_pred string, score double"))


def language_id(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    model = Model.fit(training_sample(docs))
    return identify(docs.select("doc_id", held_out().alias("held_out"), text_bytes().alias("text")), model)
