"""Spelling variant grouping.

Every word of the vocabulary is linked to its most frequent neighbour at one edit, if
that one is ``RATIO`` times as frequent; following the links gives a root.

Neighbours come from a scan of sorted word lists. For one word, the rows of the
(banded) edit matrix against the list's words are kept by prefix length: the next word
of the list reuses the rows of the prefix that it shares with the one before it (their
LCP), and once a row has no cell of one edit or less, all words with that prefix are
skipped at a stroke.

The lists are blocks. Two words at one edit agree on at least half of the shorter one,
before or after the edit; so a word enters the blocks of its first and of its last half,
for either length that the shorter word of a pair could have. What is left of a word in
a block is again one edit off its neighbours', so a block of more than ``BLOCK`` words
is cut the same way, as often as needed: blocks whose words are left with a character
or two hold at most 90 + 90 * 90 of them, by the alphabet. A pair that meets in several
blocks is counted in the first of them alone. A block hands on one row per word (its
neighbours counted, the best of them), not its pairs.

Defined cases: null and empty texts have no words; a null id counts as an empty one; a
very long text is scanned in pieces; ties between neighbours go to the smaller word in
code-point order; repeated rows count each; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back_memory, text_bytes, written

MIN_LENGTH = 6         # code points of a word
MIN_COUNT = 5          # occurrences of a word
RATIO = 5              # how much more frequent a word's form is
SLIP = 199             # one in so many (id, word) pairs loses a code point
BLOCK = 128            # words of a block, unless no more can be cut
HELD_WORDS = 300_000   # words that a task counts before it hands them on
PIECE = 1 << 20

_STOP = re.compile("[^a-zÀ-ÿ]")
_WORD = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)       # a shorter run gives no word
_LAST = "Ā"                                                 # after every letter


def text_runs(text: bytes) -> Iterator[list[str]]:
    """The text's runs of letters (the long ones), lower-cased A-Z, piece by piece."""
    whole = text.lower().decode("utf-8", "replace")              # bytes.lower(): A-Z alone
    if len(whole) <= PIECE:
        yield _WORD.findall(whole)
        return
    at = 0
    while at < len(whole):
        stop = _STOP.search(whole, at + PIECE)
        end = stop.end() if stop else len(whole)
        yield _WORD.findall(whole, at, end)
        at = end


def slipped(run: str, prefix_crc: int) -> str:
    """The run, or the run less a code point where its document misspells it."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % SLIP:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``MIN_LENGTH`` code points and ``min_count`` occurrences."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_bytes().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                prefix = zlib.crc32(f"{name}:".encode())
                for runs in text_runs(text.as_py()):
                    for run, n in Counter(runs).items():
                        held[slipped(run, prefix)] += n
                if len(held) > HELD_WORDS:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)
        del batches, held
        give_back_memory()

    return (rows.mapInArrow(count, "word string, n bigint").where(F.char_length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                      names=["word", "n"])


# A block: words that share ``head`` and ``tail``, of ``short`` or ``short + 1`` code points.
# Pairs whose common prefix reaches ``below`` belong to another block.
KEY = ["short", "head", "tail", "below"]
ENTRY = [*KEY, "word", "n"]


def _halves(entries: DataFrame) -> DataFrame:
    """Each entry in the two blocks that share half of what is left of the shorter word more."""
    head, tail = F.char_length("head"), F.char_length("tail")
    half = F.floor((F.col("short") - head - tail) / 2).cast("int")
    length = F.char_length("word")
    first = F.struct(F.substring("word", F.lit(1), head + half).alias("head"), F.col("tail").alias("tail"),
                     F.col("below").alias("below"))
    last = F.struct(F.col("head").alias("head"), F.substring("word", length - tail - half + 1, tail + half).alias("tail"),
                    F.least(F.col("below"), head + half).alias("below"))
    return (entries.withColumn("b", F.explode(F.array(first, last)))
            .select("short", "b.head", "b.tail", "b.below", "word", "n")
            .where(F.char_length("head") < F.col("below")))         # else no pair of it counts


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Entries of all blocks: written tables, one per round of cutting."""
    length = F.char_length("word")
    short = F.explode(F.when(length > MIN_LENGTH, F.array(length, length - 1)).otherwise(F.array(length)))
    start = words.select(short.alias("short"), F.lit("").alias("head"), F.lit("").alias("tail"),
                         F.lit(1 << 30).alias("below"), "word", "n")
    entries, done = written(_halves(start), "spelling-entries"), []
    while True:
        left = F.col("short") - F.char_length("head") - F.char_length("tail")
        large = written(entries.where(left >= 2).groupBy(*KEY).agg(F.count(F.lit(1)).alias("size"))
                        .where(F.col("size") > block).select(*KEY), "spelling-large")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, entries])
        done.append(entries.join(large, KEY, "left_anti").select(*ENTRY))
        entries = written(_halves(entries.join(large, KEY, "left_semi").select(*ENTRY)), "spelling-entries")


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


def scan(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs (i, j), i < j, of words at exactly one edit; ``words`` are sorted and distinct.

    A matrix row holds the distances of a prefix of length d to the word's prefixes of lengths
    d - 1, d and d + 1; 2 stands for more than one edit.
    """
    n = len(words)
    shared = [0, *(common_prefix(a, b) for a, b in zip(words, words[1:]))]
    rows: list[tuple[int, int, int]] = [(2, 0, 1)] * (max(map(len, words), default=0) + 1)
    for i, word in enumerate(words):
        size = len(word)
        rows[0] = (2, 0, 1 if size else 2)
        have, j = 0, i + 1
        if j < n:
            # the first word after shares a prefix with the word itself: rows without an edit
            for d in range(1, shared[j] + 1):
                rows[d] = (1, 0, 1 if d < size else 2)
            have = shared[j]
        while j < n:
            other = words[j]
            d = min(have, shared[j])
            before, at, after = rows[d]
            stop = len(other)
            while d < stop:
                x = other[d]
                d += 1
                before = min(before + (d < 2 or d - 2 >= size or x != word[d - 2]), at + 1)
                at = min(at + (d > size or x != word[d - 1]), after + 1, before + 1) if d <= size else 2
                after = min(after + (x != word[d]), at + 1) if d < size else 2
                if before > 1 and at > 1 and after > 1:
                    break
                rows[d] = (before, at, after)
            else:
                have = d
                gap = size - stop
                if (before if gap == -1 else at if gap == 0 else after if gap == 1 else 2) == 1:
                    yield i, j
                j += 1
                continue
            have = d - 1
            j = bisect_left(words, other[:d] + _LAST, j + 1)     # no word with this prefix is near


def _block_rows(short: int, head: str, tail: str, below: int, members: list[tuple[str, int]]) -> list[tuple]:
    """Per word of the block with neighbours in it: (word, n_near, best n, best word)."""
    a, b = len(head), len(tail)
    rest = sorted((w[a: len(w) - b], w, n) for w, n in members)
    found: dict[int, list[int]] = {}
    for i, j in scan([r[0] for r in rest]):
        x, y = rest[i], rest[j]
        if min(len(x[1]), len(y[1])) != short or a + common_prefix(x[0], y[0]) >= below:
            continue
        found.setdefault(i, []).append(j)
        found.setdefault(j, []).append(i)
    out = []
    for i, near in found.items():
        minus_n, form = min((-rest[k][2], rest[k][1]) for k in near)
        out.append((rest[i][1], len(near), -minus_n, form))
    return out


def block_neighbours(entries: DataFrame) -> DataFrame:
    """(word, near, best_n, best): one row per word and block with neighbours in it."""
    dealt = entries.repartition(*KEY).sortWithinPartitions(*KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []                    # a block may go on in the next batch
        out: list[tuple] = []
        for batch in batches:
            for *k, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if len(members) > 1:
                        out += _block_rows(*key, members)
                    key, members = k, []
                members.append((word, n))
            if out:
                yield _near(out)
                out = []
        if len(members) > 1:
            out += _block_rows(*key, members)
        if out:
            yield _near(out)
        del batches
        give_back_memory()

    return dealt.select(*ENTRY).mapInArrow(run, "word string, near bigint, best_n bigint, best string")


def _near(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
         pa.array(cols[3], pa.string())], names=["word", "near", "best_n", "best"])


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): links are followed by doubling. Frequencies rise
    ``RATIO``-fold along a chain, so a chain has few links and no circle."""
    at = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("a_word"), F.col("root").alias("a_root"))
        step = written(at.join(ahead, F.col("root") == F.col("a_word"), "left")
                       .select("word", F.coalesce("a_root", "root").alias("root"),
                               F.col("a_root").isNotNull().alias("moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return at
        at = step.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Per word of the vocabulary: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs, id_col), "spelling-words")
    best: Column = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("form"))).alias("b")
    near = (block_neighbours(blocks(words, block)).groupBy("word")
            .agg(F.sum("near").alias("n_near"), best)
            .select(F.col("word").alias("w"), "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.form").alias("best")))
    fits = F.col("best_n") >= ratio * F.col("n")
    formed = written(words.join(near, F.col("word") == F.col("w"), "left")
                     .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                             F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")),
                     "spelling-forms")
    root = roots(formed.where("form IS NOT NULL")).select(F.col("word").alias("w"), "root")
    return (formed.join(root, F.col("word") == F.col("w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
