"""Line-delimited JSON transactions (SRC-1, SRC-2, FLT-1).

Decoding follows the reference's lenient JSON reader: unknown fields are
ignored, a missing ``event_time``/``amount`` is 0, numbers may be quoted,
a fractional ``event_time`` is truncated, blank lines are not events, and a
line that cannot be decoded is kept aside (``rejects``) instead of failing.
Every field is read as text first and then cast, so one bad value rejects
only its own line. A missing key column (card, customer, merchant, category,
country) also rejects the line (the reference would fail on it).

A line holding only ``heartbeat_time`` is a *heartbeat*: it advances event
time in streams (so the last windows close) and is never a transaction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardstream.functions.timecols import amount_cents
from cardstream.operators.sequence import packed_position
from cardstream.schema import KEY_FIELDS, TX_FIELDS
from cardstream.session import scratch_path

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in TX_FIELDS]
    + [T.StructField("arrival_seq", T.StringType()),
       T.StructField("heartbeat_time", T.StringType()),
       T.StructField("_corrupt", T.StringType())])

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# What the job can count in exact integers: event times whose microseconds, and amounts whose
# cents, fit a 64-bit integer (sums of amounts have 38 digits).
MAX_EVENT_TIME = 9_000_000_000_000_000
MAX_AMOUNT = 1e12

STRING_FIELDS = tuple(c for c in TX_FIELDS if c not in ("event_time", "amount"))


# Characters Java's String.trim removes: every code point <= U+0020.
JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))


def java_trim(col: Column) -> Column:
    """Strip every character <= U+0020 at both ends, like Java ``trim``."""
    return F.btrim(col, F.lit(JAVA_TRIM_CHARS))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch source: one row (``value``) per text line."""
    return spark.read.text(path)


MAX_BROADCAST_SPLITS = 1_000_000
# Where a line stands: its file (by modification time, then path), and its split in the file.
SPLIT = ("_time", "_path", "_block")
_SPLIT_META = ("file_modification_time", "file_path", "file_block_start")


def _with_split(lines: DataFrame) -> DataFrame:
    return lines.select("value", *[F.col(f"_metadata.{m}").alias(c) for m, c in zip(_SPLIT_META, SPLIT)])


def number_lines(lines: DataFrame, first: int = 0) -> DataFrame:
    """``value`` and ``arrival_seq`` from ``first`` on, of lines with their split and ``_row``
    (ascending in a split): a running count over the splits, one row each, plus the line's
    place in its split."""
    splits = lines.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(*[F.col(c).alias(f"{c}_s") for c in SPLIT], (
        F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(first) - F.col("_first")).alias("_offset"))
    if splits.limit(MAX_BROADCAST_SPLITS + 1).count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    on = [F.col(c) == F.col(f"{c}_s") for c in SPLIT]
    return lines.join(splits, on[0] & on[1] & on[2]).select(
        "value", (F.col("_row") + F.col("_offset")).alias("arrival_seq"))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines (``value``) with ``arrival_seq``, their dense position in the input.

    The order is that of the files (modification time, then path), of the splits in
    a file, and of the lines in a split. The lines are written to the shared folder once.
    """
    lines = _with_split(spark.read.text(path)).withColumn("_row", F.monotonically_increasing_id())
    target = scratch_path(spark, "numbered-lines")
    lines.write.parquet(target)
    return number_lines(spark.read.schema(lines.schema).parquet(target))


def stream_placed_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines of a drop folder with their split, for ``number_lines`` in each micro-batch."""
    return _with_split(stream_lines(spark, path, max_files_per_trigger))


def stream_lines(spark: SparkSession, path: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source over a drop folder of text files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def stream_kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str,
                       starting_offsets: str = "earliest",
                       max_offsets_per_trigger: int | None = None,
                       source_partitions: int = 1) -> DataFrame:
    """Streaming lines from a Kafka topic (needs the Kafka connector on the
    classpath). ``arrival_seq`` is the record offset, i.e. arrival order for a
    single-partition topic (the reference reads one ordered feed); of a topic with several,
    partition and offset (``positioned_lines``)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return positioned_lines(reader.load(), source_partitions)


def positioned_lines(records: DataFrame, source_partitions: int = 1) -> DataFrame:
    """``value`` and ``arrival_seq`` of records with ``value``, ``partition`` and ``offset``."""
    position = (F.col("offset").cast("bigint") if source_partitions == 1
                else packed_position(F.col("partition"), F.col("offset")))
    return records.select(F.col("value").cast("string").alias("value"), position.alias("arrival_seq"))


def _whole_long(text: Column) -> Column:
    # "12.9" -> 12 and "1.78e12" -> 1780000000000, like a lenient long reader.
    return text.try_cast(T.DecimalType(38, 9)).try_cast(T.LongType())


def _json_container(line: Column, text: Column, field: str) -> Column:
    """Whether a field that is read as text is a JSON object or array in its line, rather than a
    string that looks like one. Only lines with such a look are parsed as VARIANT, which keeps
    the types; one that VARIANT refuses (a field twice) counts as a container."""
    first = F.substring(java_trim(text), 1, 1)
    looks = first.isin("{", "[") & F.get_json_object(text, "$").isNotNull()
    value = F.try_variant_get(F.try_parse_json(line), f"$.{field}", "variant")
    return F.when(looks, F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(True))).otherwise(False)


def _has_container(line: Column, parsed: Column) -> Column:
    """Whether one of the string fields is a JSON object or array in its line. A line with no
    bracket, no second brace and no escape holds none, and is not looked at any closer."""
    after_first = F.substring(line, F.instr(line, "{") + F.lit(1), F.length(line))
    possible = (F.instr(line, "[") > 0) | (F.instr(line, "\\") > 0) | (F.instr(after_first, "{") > 0)
    found = reduce(lambda a, b: a | b, [
        F.coalesce(_json_container(line, parsed[c], c), F.lit(False)) for c in STRING_FIELDS])
    return F.when(possible, found).otherwise(F.lit(False))


def parse_lines(lines: DataFrame, value_col: str = "value",
                seq_col: str | None = None, carry_seq: bool = True) -> DataFrame:
    """Typed rows with ``_kind`` in {tx, reject, heartbeat} and ``line``.

    ``arrival_seq`` comes from column ``seq_col`` of ``lines`` (a position, the Kafka offset)
    when given, else from the line's own ``arrival_seq`` field; without ``carry_seq`` such a
    field is any unknown one, and the column is null.
    """
    v = F.col(value_col)
    p = F.from_json(v, RAW_SCHEMA, JSON_OPTIONS)
    extra = [F.col(seq_col).cast("long").alias("_seq_in")] if seq_col else []
    # A one-element ``inline`` evaluates the line and its parse once per row:
    # filters and projections above it cannot inline (and so repeat) either
    # the parse or an expensive expression that produced the line. The test for containers
    # stands in a lambda, which Spark generates no code for: its six copies would make the
    # decoder's method too long for the JVM to compile, and every line slow.
    raw = lines.select(F.inline(F.transform(
        F.array(F.struct(v.alias("line"), *extra, p.alias("_p"))),
        lambda x: x.withField("_container", _has_container(x["line"], x["_p"])))))
    line = F.col("line")
    raw = raw.where(line.isNotNull() & (java_trim(line) != ""))
    r = lambda c: F.col(f"_p.{c}")
    event_time = _whole_long(r("event_time"))
    amount = r("amount").try_cast(T.DoubleType())
    own_seq = carry_seq and not seq_col
    seq = (F.col("_seq_in") if seq_col else _whole_long(r("arrival_seq")) if own_seq
           else F.lit(None).cast("bigint"))
    heartbeat = _whole_long(r("heartbeat_time"))
    heartbeat = F.when(F.abs(heartbeat) <= F.lit(MAX_EVENT_TIME), heartbeat)
    malformed = F.col("_p").isNull() | r("_corrupt").isNotNull()
    bad_value = ((r("event_time").isNotNull() & event_time.isNull())
                 | (r("amount").isNotNull() & amount.isNull()))
    if own_seq:
        bad_value = bad_value | (r("arrival_seq").isNotNull() & seq.isNull())
    bad_value = bad_value | F.col("_container")
    missing_key = F.lit(False)
    for c in KEY_FIELDS:
        missing_key = missing_key | r(c).isNull()
    # ANSI casts would fail the whole job on such a value: it rejects its line alone
    out_of_range = (
        (F.abs(F.coalesce(event_time, F.lit(0))) > F.lit(MAX_EVENT_TIME))
        | F.isnan(F.coalesce(amount, F.lit(0.0))) | (F.abs(F.coalesce(amount, F.lit(0.0))) > F.lit(MAX_AMOUNT)))
    is_heartbeat = (r("heartbeat_time").isNotNull() & heartbeat.isNotNull()
                    & r("transaction_id").isNull())
    reason = (F.when(malformed, F.lit("malformed_json"))
              .when(is_heartbeat, F.lit(None))
              .when(bad_value, F.lit("bad_value"))
              .when(out_of_range, F.lit("out_of_range"))
              .when(missing_key, F.lit("missing_key")))
    kind = (F.when(malformed, F.lit("reject"))
            .when(is_heartbeat, F.lit("heartbeat"))
            .when(reason.isNotNull(), F.lit("reject"))
            .otherwise(F.lit("tx")))
    typed = raw.select(
        "line",
        kind.alias("_kind"),
        reason.alias("reason"),
        seq.alias("arrival_seq"),
        *[r(c).alias(c) for c in STRING_FIELDS],
        F.when(out_of_range, F.lit(0)).otherwise(
            F.coalesce(event_time, F.lit(0))).cast("bigint").alias("event_time"),
        F.when(out_of_range, F.lit(0.0)).otherwise(F.coalesce(amount, F.lit(0.0))).alias("amount"),
        heartbeat.alias("heartbeat_time"),
    )
    return typed.withColumn("amount_cents", amount_cents("amount"))


def tx_columns(with_seq: bool) -> list[str]:
    return (["arrival_seq"] if with_seq else []) + list(TX_FIELDS) + ["amount_cents"]


def parse_transactions(lines: DataFrame, value_col: str = "value",
                       with_seq: bool = False,
                       seq_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Decode lines into ``(transactions, rejects)``; heartbeats are dropped."""
    typed = parse_lines(lines, value_col, seq_col, carry_seq=with_seq)
    tx = typed.where(F.col("_kind") == "tx").select(*tx_columns(with_seq))
    rejects = typed.where(F.col("_kind") == "reject").select("line", "reason")
    return tx, rejects


# A producer's heartbeat: advances event time when the feed is idle.
HEARTBEAT_FORMAT = '{"heartbeat_time":%d}'


def heartbeat_line(event_time_ms: int) -> str:
    return HEARTBEAT_FORMAT % int(event_time_ms)
