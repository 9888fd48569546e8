"""What the streaming and batch jobs take must follow the rows: compiled decoding, small buckets, own runs."""

from pyspark.sql import functions as F

from conftest import make_tx
from cardstream.operators.late import with_watermark_before
from cardstream.operators.sequence import STREAM_BUCKET_ROWS
from cardstream.session import scratch_path
from cardstream.sources.json_lines import parse_lines

JIT_LIMIT = 8000        # bytes of a method beyond which the JVM interprets it for good


def test_decoder_methods_are_short_enough_to_be_compiled(spark):
    path = scratch_path(spark, "t-decoder")
    spark.range(10).select(F.lit("{}").alias("value"), F.col("id").alias("arrival_seq")).write.parquet(path)
    typed = parse_lines(spark.read.parquet(path), seq_col="arrival_seq")
    parts = typed._jdf.queryExecution().debug().codegenToSeq()
    sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    assert sizes and max(sizes) <= JIT_LIMIT, sizes


def test_containers_are_found_wherever_they_stand(spark):
    line = ('{"transaction_id":%s,"card_id":"c","customer_id":"u","merchant_id":"m",'
            '"merchant_category":"g","country":%s,"event_time":1,"amount":1}')
    cases = [('"t"', '"IL"', "tx"), ('"t"', '{"code":"IL"}', "reject"), ('["t"]', '"IL"', "reject"),
             ('"{}"', '"IL"', "tx"), ('"\\u007b\\u007d"', '"IL"', "tx"), ('"[t"', '"{IL"', "tx"),
             ('"t"', '" {\\"a\\":1}"', "tx"), ('{}', '"IL"', "reject")]
    rows = [(i, line % c[:2]) for i, c in enumerate(cases)] + [(len(cases), "  " + line % ('"t"', "[]"))]
    got = {r.arrival_seq: r._kind for r in parse_lines(
        spark.createDataFrame(rows, "arrival_seq bigint, value string"), seq_col="arrival_seq").collect()}
    assert got == {**{i: c[2] for i, c in enumerate(cases)}, len(cases): "reject"}


def test_a_micro_batch_is_dealt_to_many_tasks(spark):
    n = 16 * STREAM_BUCKET_ROWS
    tx = spark.range(n).select(F.col("id").alias("arrival_seq"),
                               ((F.col("id") * 7919) % 100_003).alias("event_time"))
    out = with_watermark_before(tx, ["arrival_seq"], 0, carry_ms=5, bucket_rows=STREAM_BUCKET_ROWS)
    used = with_watermark_before(tx, ["arrival_seq"], 0, carry_ms=5, bucket_rows=n)
    assert out.exceptAll(used).isEmpty()
    buckets = out._jdf.queryExecution().optimizedPlan().toString()
    assert str(STREAM_BUCKET_ROWS) in buckets
    assert out.select((F.col("arrival_seq") / STREAM_BUCKET_ROWS).cast("int").alias("b"),
                      F.spark_partition_id().alias("p")).select("p").distinct().count() > 2


def test_a_job_query_runs_on_the_table_as_it_is(spark, monkeypatch):
    """The second query of an application must not get what the first computed of another table."""
    from cardstream.plans import catalog
    tables = [make_tx(spark, [dict(arrival_seq=i, event_time=1000 * i, amount=1.0) for i in range(k)]) for k in (3, 5)]
    monkeypatch.setattr(catalog, "fixture_transactions", lambda spark, sf_dir: tables[0])
    first = catalog.job_outputs(spark, "/same")["minute_totals"].agg(F.sum("n_tx")).first()[0]
    monkeypatch.setattr(catalog, "fixture_transactions", lambda spark, sf_dir: tables[1])
    second = catalog.job_outputs(spark, "/same")["minute_totals"].agg(F.sum("n_tx")).first()[0]
    assert (first, second) == (3, 5)


def test_a_drop_folder_makes_each_line_once(spark):
    """No second pass over the lines for a sample of their order; files of about equal size in order."""
    from cardstream.streaming.source import write_lines_folder
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def line(i):
        made.add(1)
        return str(i)

    lines = spark.range(2000).select((F.col("id") * F.col("id")).alias("arrival_seq"), line("id").alias("value"))
    folder = write_lines_folder(spark, lines, scratch_path(spark, "t-lines-once"), 4)
    assert made.value == 2000
    files = {}
    for r in spark.read.text(folder).select("value", "_metadata.file_path").collect():
        files.setdefault(r.file_path, []).append(int(r.value))
    got = [files[f] for f in sorted(files)]
    assert [i for part in got for i in part] == list(range(2000))
    assert len(got) == 4 and max(map(len, got)) < 550


def test_a_drop_folder_of_few_or_no_lines(spark):
    from cardstream.streaming.source import write_lines_folder
    for rows, n_files in ([], 3), ([(5, "a")], 1), ([(5, "a"), (5, "b"), (6, "c")], 6), ([(None, "a"), (1, "b")], 2):
        lines = spark.createDataFrame(rows, "arrival_seq bigint, value string")
        folder = write_lines_folder(spark, lines, scratch_path(spark, "t-lines-few"), n_files)
        assert sorted(r.value for r in spark.read.text(folder).collect()) == sorted(r[1] for r in rows)
