"""Sources of several partitions: results do not depend on how the partitions interleave."""

from conftest import SF001, make_tx
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardstream.operators.late import partition_times, split_late
from cardstream.operators.sequence import packed_position, source_partition
from cardstream.plans import stream_catalog as sc
from cardstream.plans.catalog import default_refs, load_tx
from cardstream.plans.job import JobBatchWriter, read_job_alerts, read_job_windows
from cardstream.session import scratch_path
from cardstream.sources.json_lines import positioned_lines

import pytest


def brute_late(rows, window_ms, lateness_ms, delay_ms=5_000):
    """(partition, offset) of the rows late by their own partition's maximum."""
    out, top = set(), {}
    for part, offset, at in sorted(rows, key=lambda r: (r[1], r[0])):
        end = at // window_ms * window_ms + window_ms
        if part in top and end + lateness_ms <= top[part] - delay_ms:
            out.add((part, offset))
        top[part] = max(top.get(part, at), at)
    return out


def partitioned(tx, n):
    """``tx`` dealt to ``n`` partitions by card, each with offsets of its own."""
    part = F.pmod(F.xxhash64("card_id"), F.lit(n)).cast("int")
    offset = F.row_number().over(Window.partitionBy("partition").orderBy("arrival_seq")) - 1
    return tx.withColumn("partition", part).withColumn("offset", offset)


@pytest.mark.parametrize("width", [None, 37 << 16])
def test_late_by_the_own_partition(spark, width):
    tx = partitioned(load_tx(spark, SF001), 3)
    placed = tx.withColumn("arrival_seq", packed_position(F.col("partition"), F.col("offset")))
    want = brute_late([tuple(r) for r in tx.select("partition", "offset", "event_time").collect()], 60_000, 10_000)
    assert want
    _, late = split_late(placed, 60_000, 10_000, bucket_width=width, partitioned=True)
    assert {(r.partition, r.offset) for r in late.select("partition", "offset").collect()} == want
    assert all(r.p == r.partition for r in placed.select(source_partition(F.col("arrival_seq")).alias("p"), "partition").collect())
    # in two steps, with the partitions' maxima carried, however the first step cuts each of them
    for first in (F.col("offset") < 100, F.col("partition") == 1, F.col("offset") < 40 * F.col("partition")):
        head, tail = placed.where(first), placed.where(~first)
        got = [split_late(head, 60_000, 10_000, partitioned=True)[1],
               split_late(tail, 60_000, 10_000, partitioned=True, carry=partition_times(head))[1]]
        assert {(r.partition, r.offset) for d in got for r in d.select("partition", "offset").collect()} == want


def test_packed_positions(spark):
    rows = spark.createDataFrame([("a", 65_535, 2**46), ("b", 0, 0), ("c", 1, 0), ("d", 0, 1)], "value string, partition int, offset bigint")
    got = positioned_lines(rows, 65_536).orderBy("arrival_seq").collect()
    assert [r.value for r in got] == ["b", "c", "d", "a"]
    assert [r.arrival_seq for r in positioned_lines(rows.where("value = 'd'")).collect()] == [1]
    with pytest.raises(Exception, match="out of range"):
        positioned_lines(rows.select("value", F.lit(70_000).alias("partition"), "offset"), 2).collect()


def test_job_results_free_of_interleaving(spark):
    """One job over two partitions, read at once, one after the other, and in unequal turns."""
    tx = partitioned(load_tx(spark, SF001), 2)
    plain = sc.plain_lines(tx.drop("partition", "offset"), None)
    lines = plain.join(tx.select("arrival_seq", "partition", "offset"), "arrival_seq")
    beats = spark.createDataFrame([('{"heartbeat_time":1999999999999}', p, 10**6) for p in (0, 1)],
                                  "value string, partition int, offset bigint")
    lines = positioned_lines(lines.select("value", "partition", "offset").unionByName(beats), 2).persist()
    part, offset = source_partition(F.col("arrival_seq")), F.shiftright("arrival_seq", 16)
    turns = {
        "at once": [F.lit(True)],
        "one by one": [part == 0, part == 1],
        "in turns": [(offset < 300) & (part == 1), (offset < 50) & (part == 0), (offset >= 50) & (part == 0),
                     (offset >= 300) & (part == 1)],
    }
    found = {}
    for name, cuts in turns.items():
        out = scratch_path(spark, "t-partitions")
        writer = JobBatchWriter(out, *default_refs(spark), numbering="column", source_partitions=2)
        for i, cut in enumerate(cuts):
            writer(lines.where(cut), i)
            if i + 1 < len(cuts) and name == "one by one":      # no window closes while a partition is unknown
                assert spark.read.parquet(f"{out}/exact/closed/batch_id={i}").count() == 0
        windows = read_job_windows(spark, out)
        assert spark.read.parquet(f"{out}/exact/open/batch_id={len(cuts) - 1}").count() == 0
        rows = lambda df: sorted(map(str, df.collect()))
        found[name] = {
            "late": rows(spark.read.parquet(f"{out}/late/batch_id=*").select("arrival_seq", "transaction_id")),
            "alerts": rows(read_job_alerts(spark, out).where("rule <> 'High Amount'")),        # its key is the customer
            "lines": rows(spark.read.text(f"{out}/minute_totals_lines/batch_id=*")),
            **{k: rows(windows[k]) for k in ("minute_totals", "category_average", "country_counts")}}
    assert found["at once"] == found["one by one"] == found["in turns"]
    assert len(found["at once"]["late"]) and len(found["at once"]["lines"]) == 60 and found["at once"]["alerts"]


def test_job_refuses_what_it_cannot_order(spark):
    with pytest.raises(ValueError, match="packed positions"):
        JobBatchWriter(scratch_path(spark, "t-partitions"), *default_refs(spark), source_partitions=2)
