"""Order MinHash fingerprints, sensitive to edit distance.

A text's k-mers are its runs of ``K`` words. Each is numbered by its occurrence
(first, second, ...), so that equal k-mers differ, and hashed. Sketch ``j`` of
``SKETCHES`` ranks the k-mers by a hash of its own: the one hash, turned round by ``j`` parts
of its range, so that its least k-mers are those from the start of part ``j`` on, and behind
the last part from the first on. The ``TUPLE`` k-mers of least rank are selected, put back in the
order in which the text has them, and hashed as a tuple. So every sketch has a whole tuple, also in
short texts, where neighbouring sketches may have the same.
The fingerprint is the list of these tuple hashes: it changes with what k-mers a
text has, how often, and in what order. Likeness is the share of equal tuple hashes.

Every step is a Spark SQL expression over one row's arrays; nothing is
exploded or shuffled for a fingerprint.

Defined cases: null text counts as empty; a text without a word has no tuple (all hashes 0), and
two such texts have likeness 1; a text of fewer than ``K`` words is one k-mer; a text of fewer than ``TUPLE``
k-mers has them all in every tuple; k-mers whose hashes agree in their first 32 bits are ranked by position; equal
texts have equal fingerprints. In the order of ``next_heads``, fully repeated rows are
one document; a null id comes last; one document alone is its own next; a very long text is read whole;
an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K = 3
SKETCHES = 64          # a long text and its half-copy share no tuple in (8/9)**64 = 0.05 % of cases
TUPLE = 2
POS_BITS = 31          # every position an array can have
EMPTY = "0" * 16


def _barrier(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with columns computed once: the optimizer does not copy them into later uses."""
    row = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.inline(F.array(row)))


def packed(h: Column, i: Column) -> Column:
    """A number per k-mer that sorts by its hash's first bits and ends in its position."""
    shift = 63 - POS_BITS
    return F.shiftleft(F.shiftrightunsigned(h, 64 - shift), POS_BITS).bitwiseOR(i.cast("bigint"))


def place(number: Column) -> Column:
    """The position that a packed number ends in."""
    return number.bitwiseAND(F.lit((1 << POS_BITS) - 1))


def with_fingerprint(df: DataFrame, text: Column, name: str = "fp", k: int = K,
                     sketches: int = SKETCHES, size: int = TUPLE) -> DataFrame:
    """``df`` with ``name``: the fingerprint of ``text``, an array of ``sketches`` hashes (0: text without words)."""
    kept = df.columns
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = _barrier(df, __words=words)
    last = F.greatest(F.size("__words") - k, F.lit(0))
    hashes = F.when(F.size("__words") == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(F.col("__words"), i, k))))
    df = _barrier(df, __h=hashes).drop("__words")

    # occurrence numbers, where a k-mer comes twice: sort by (hash, position), number each run
    by_hash = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    df = _barrier(df, __s=F.when(repeats, by_hash))
    n = F.size("__s")
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda j: (j == 0) | (
        F.get("__s", j - 1)["h"] != F.get("__s", j)["h"]))
    df = _barrier(df, __b=F.when(F.col("__s").isNotNull(), begins))
    lengths = F.zip_with(F.col("__b"), F.concat(F.slice("__b", 2, F.greatest(F.size("__b") - 1, F.lit(0))), F.array(n)),
                         lambda a, b: F.sequence(F.lit(0), b - a - 1))
    numbered = F.transform(F.arrays_zip(F.col("__s").alias("s"), F.flatten(lengths).alias("o")),
                           lambda x: F.struct(F.xxhash64(x["s"]["h"], x["o"]).alias("h"), x["s"]["i"].alias("i")))
    first = F.transform("__h", lambda h, i: F.struct(F.xxhash64(h, F.lit(0)).alias("h"), i.alias("i")))
    df = _barrier(df, __t=F.when(F.size("__h") > 0, F.sort_array(F.transform(
        F.when(F.col("__s").isNotNull(), numbered).otherwise(first), lambda x: packed(x["h"], x["i"])))))
    bits = sketches.bit_length() - 1
    if 1 << bits != sketches:
        raise ValueError("sketches must be a power of two")
    bin_at = lambda j: F.shiftright(F.get("__t", j), 63 - bits).cast("int")
    many = F.size("__t")
    # where each bin that has k-mers begins; a sketch begins with the first k-mer at or after its own bin's start
    begin = F.filter(F.sequence(F.lit(0), many - 1), lambda j: (j == 0) | (bin_at(j - 1) != bin_at(j)))
    df = _barrier(df, __f=F.when(F.col("__t").isNotNull(), F.transform(
        begin, lambda j: F.struct(bin_at(j).alias("b"), j.alias("j")))))
    before = lambda i: F.coalesce(F.get("__f", i - 1)["b"], F.lit(-1))
    starts = F.concat(
        F.flatten(F.transform("__f", lambda x, i: F.array_repeat(x["j"], x["b"] - before(i)))),
        F.array_repeat(F.lit(0), F.lit(sketches - 1) - F.element_at("__f", -1)["b"]))     # behind the last: the first
    df = _barrier(df, __a=F.when(F.col("__f").isNotNull(), starts))
    ring = F.sequence(F.lit(0), F.least(many, F.lit(size)) - 1)
    chosen = lambda j: F.sort_array(F.transform(ring, lambda o: place(F.get("__t", (j + o) % many)).cast("int")))
    fp = F.transform("__a", lambda j: F.xxhash64(F.transform(chosen(j), lambda p: F.get("__h", p))))
    fp = F.when(F.col("__a").isNull(), F.array_repeat(F.lit(0).cast("bigint"), sketches)).otherwise(fp)
    return _barrier(df, **{name: fp}).select(*kept, name)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuple hashes; 1 if neither text has any."""
    pair = F.arrays_zip(a.alias("a"), b.alias("b"))
    filled = F.size(F.filter(pair, lambda x: (x["a"] != 0) | (x["b"] != 0)))
    equal = F.size(F.filter(pair, lambda x: (x["a"] == x["b"]) & (x["a"] != 0)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled)


def hex_string(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def next_keys(keys: DataFrame) -> DataFrame:
    """(k1, k2) -> the next key in descending order (n1, n2), the first one's after the last.

    ``keys`` holds distinct (k1, k2). A range shuffle orders them; inside a partition
    the next row is the next key, and a partition's last row takes the following partition's
    first (one row per partition).
    """
    order = [F.desc_nulls_last("k1"), F.desc_nulls_last("k2")]
    dealt = written(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "omh-order")
    run = Window.partitionBy("part").orderBy(*order)
    numbered = dealt.withColumns({"next": F.lead(F.struct("k1", "k2")).over(run), "rank": F.row_number().over(run)})
    numbered = written(numbered, "omh-next")
    firsts = numbered.where("rank = 1").select("part", F.struct("k1", "k2").alias("first")).orderBy("part").collect()
    heads = [(f.part, *firsts[(i + 1) % len(firsts)]["first"]) for i, f in enumerate(firsts)]
    heads = keys.sparkSession.createDataFrame(
        heads, "h_part int, h1 " + keys.schema["k1"].dataType.simpleString() + ", h2 bigint")
    after = F.coalesce("next", F.struct(F.col("h1").alias("k1"), F.col("h2").alias("k2")))
    return (numbered.join(F.broadcast(heads), F.col("part") == F.col("h_part"))      # one row per partition
            .select("k1", "k2", after["k1"].alias("n1"), after["k2"].alias("n2")))


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", sketches: int = SKETCHES) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has its second half replaced by the next
    document's head. (The least long stands for a null id, which orders the same.)"""
    text = F.coalesce(F.col("text"), F.lit(""))
    no_id = F.lit(-(1 << 63))
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), no_id).alias("k1"), F.xxhash64(text).alias("k2"),
                       text.alias("body"), F.char_length(text).alias("n"))
    keys = written(rows.select("k1", "k2", "n").distinct(), "omh-keys")
    after = next_keys(keys.select("k1", "k2")).select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), "n1", "n2")
    # each key with the one before it and how many characters that one wants
    want = (keys.join(after, (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")))
            .select("n1", "n2", F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.expr("n div 2").alias("wanted")))
    # both uses read the same columns, so that one shuffle of the texts serves them
    printed = with_fingerprint(rows, F.col("body"), sketches=sketches)
    heads = (printed.join(want, (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")))
             .select("p1", "p2", F.expr("left(body, least(wanted, n))").alias("head"), F.col("fp").alias("next_fp"))
             .dropDuplicates(["p1", "p2"]))
    edited = (printed.join(heads, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")))
              .select("k1", "n", "fp", "next_fp",
                      F.concat(F.expr("left(body, n - n div 2)"), F.col("head")).alias("edited")))
    both = with_fingerprint(edited, F.col("edited"), "efp", sketches=sketches)
    return both.select(
        F.nullif(F.col("k1"), no_id).alias("doc_id"), F.col("n").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        hex_string(F.col("fp")).alias("fingerprint"), hex_string(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
