"""Registered queries over the given tables (batch forms).

Every query reads the ``events`` table of ``sf_dir`` through the fixture
adapter, so its work grows with the table. Alert outputs are flattened
(``tx_*`` columns) so they compare column by column with the SQL oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.functions import format as fmt
from cardstream.functions.timecols import with_event_time
from cardstream.operators import metrics, rules
from cardstream.operators.alerts import all_rule_alerts
from cardstream.operators.late import split_late
from cardstream.operators.sequence import packed_position
from cardstream.operators.scoring import reference_frame, score_alerts
from cardstream.schema import (
    DEFAULT_BLACKLISTED_COUNTRIES, DEFAULT_RISKY_MERCHANTS,
    FIVE_MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS, MINUTE_WINDOW_MS,
    RULE_WINDOW_MINUTES, flatten_alerts,
)
from cardstream.sources.fixtures import TX_COLUMNS, fixture_transactions
from cardstream.session import scratch_path
from cardstream.sources.json_lines import parse_lines, parse_transactions, read_numbered_lines
from cardstream.sources.reference import load_reference_list
from cardstream.streaming.source import write_lines_folder

Query = Callable[[SparkSession, str], DataFrame]

RULE_WINDOW_MS = RULE_WINDOW_MINUTES * 60_000
# Every REJECT_EVERY-th line of the fixture corpus is cut in half.
REJECT_EVERY = 50


def load_tx(spark: SparkSession, sf_dir: str, sub_cent: bool = False) -> DataFrame:
    return with_event_time(fixture_transactions(spark, sf_dir, sub_cent))


def on_time(tx: DataFrame, window_ms: int, lateness_ms: int = 0) -> DataFrame:
    return split_late(tx, window_ms, lateness_ms)[0]


def default_refs(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return (reference_frame(spark, DEFAULT_RISKY_MERCHANTS),
            reference_frame(spark, DEFAULT_BLACKLISTED_COUNTRIES))


def json_lines(tx: DataFrame) -> DataFrame:
    return tx.select("arrival_seq", fmt.tx_json().alias("line"))


# --- sources / encode / decode ----------------------------------------------
def q_transactions(spark, sf_dir):
    return fixture_transactions(spark, sf_dir).select(*TX_COLUMNS)


def q_transaction_json_lines(spark, sf_dir):
    return json_lines(fixture_transactions(spark, sf_dir))


def q_parse_roundtrip(spark, sf_dir):
    lines = json_lines(fixture_transactions(spark, sf_dir))
    tx, _ = parse_transactions(lines, "line")
    return tx


def damaged_lines(tx: DataFrame) -> DataFrame:
    """JSON lines (``arrival_seq``, ``value``) with every REJECT_EVERY-th line
    cut in half, as a broken producer would leave them."""
    lines = json_lines(tx)
    cut = F.when(F.col("arrival_seq") % REJECT_EVERY == 0,
                 F.expr("substring(line, 1, length(line) div 2)")).otherwise(F.col("line"))
    return lines.select("arrival_seq", cut.alias("value"))


def q_rejects(spark, sf_dir):
    _, rejects = parse_transactions(damaged_lines(fixture_transactions(spark, sf_dir)))
    return rejects


def classified_lines(tx: DataFrame) -> DataFrame:
    """JSON lines (``arrival_seq``, ``value``): of every twelve, one of each way in which a
    line can be bad, a blank one, one of spaces, and good ones."""
    line = fmt.tx_json()
    kind = F.col("arrival_seq") % 12
    amount = lambda v: F.regexp_replace(line, '"amount":[^}]*', f'"amount":{v}')
    broken = (F.when(kind == 0, F.expr("substring(l, 1, length(l) div 2)"))
              .when(kind == 1, F.col("text_amount")).when(kind == 2, F.col("nan")).when(kind == 3, F.col("huge"))
              .when(kind == 4, F.regexp_replace("l", '"event_time":[0-9]+', '"event_time":9000000000000000001'))
              .when(kind == 5, F.regexp_replace("l", '"card_id":"[^"]*",', ""))
              .when(kind == 6, F.regexp_replace("l", '"country":"[^"]*"', '"country":{"code":"IL"}'))
              .when(kind == 7, F.lit("")).when(kind == 8, F.lit(" \t ")).otherwise(F.col("l")))
    lines = tx.select("arrival_seq", line.alias("l"), amount('"abc"').alias("text_amount"),
                      amount('"NaN"').alias("nan"), amount("1e300").alias("huge"))
    return lines.select("arrival_seq", broken.alias("value"))


def q_reject_classes(spark, sf_dir):
    """What becomes of every line of a corpus with all classes of bad lines."""
    typed = parse_lines(classified_lines(fixture_transactions(spark, sf_dir)), seq_col="arrival_seq")
    return typed.select("arrival_seq", F.col("_kind").alias("kind"), "reason")


def q_reference_list(spark, sf_dir):
    """The merchants, written as a list file with comments, blanks and padding, and loaded."""
    tx = fixture_transactions(spark, sf_dir)
    lines = tx.select(F.explode(F.array(
        F.concat(F.lit(" \t"), "merchant_id", F.lit("\r")), F.concat(F.lit("# "), "merchant_id"),
        F.lit(""))).alias("value")).distinct()
    path = scratch_path(spark, "reference-list")
    lines.write.text(path)
    return load_reference_list(spark, path)


def job_outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The whole job's outputs from plain lines, whose order is that of their files. Each query
    runs it anew, so that it reads the table as it is and takes the same time whatever ran before."""
    from cardstream.plans.job import run_batch_job
    lines = fixture_transactions(spark, sf_dir).select("arrival_seq", fmt.tx_json().alias("value"))
    files = max(2, min(64, spark.sparkContext.defaultParallelism))
    folder = write_lines_folder(spark, lines, scratch_path(spark, "job-lines"), files)
    return run_batch_job(spark, lines=read_numbered_lines(spark, folder))


def q_job_scored_alerts(spark, sf_dir):
    return flatten_alerts(job_outputs(spark, sf_dir)["alerts"])


def q_job_late_transactions(spark, sf_dir):
    return job_outputs(spark, sf_dir)["late_transactions"].select(*TX_COLUMNS, "line")


def q_job_metric(name: str) -> Query:
    return lambda spark, sf_dir: job_outputs(spark, sf_dir)[name]


# --- metrics ----------------------------------------------------------------
def q_minute_totals(spark, sf_dir):
    return metrics.minute_totals(load_tx(spark, sf_dir))


def q_minute_totals_ontime(spark, sf_dir):
    tx = on_time(load_tx(spark, sf_dir), MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS)
    return metrics.minute_totals(tx)


def q_minute_total_emissions(spark, sf_dir):
    """Metric 1 lines as printed: firing plus re-emissions within lateness."""
    return metrics.minute_total_emissions(load_tx(spark, sf_dir))


def q_late_transactions(spark, sf_dir):
    _, late = split_late(load_tx(spark, sf_dir), MINUTE_WINDOW_MS,
                         MINUTE_ALLOWED_LATENESS_MS)
    return late.select(*TX_COLUMNS, fmt.tx_json().alias("line"))


SOURCE_PARTITIONS = 4


def card_partition():
    """Partition of a row where a source deals its lines to ``SOURCE_PARTITIONS`` by card number."""
    return (F.substring("card_id", 6, 20).cast("bigint") % SOURCE_PARTITIONS).cast("int")


def q_late_transactions_partitioned(spark, sf_dir):
    """Late rows of a source of several partitions, each by its own partition's rows."""
    tx = load_tx(spark, sf_dir).withColumn("position", packed_position(card_partition(), F.col("arrival_seq")))
    _, late = split_late(tx, MINUTE_WINDOW_MS, MINUTE_ALLOWED_LATENESS_MS, order_by=["position"], partitioned=True)
    return late.select(*TX_COLUMNS, fmt.tx_json().alias("line"))


def q_category_average(spark, sf_dir):
    return metrics.category_average(load_tx(spark, sf_dir))


def q_category_average_ontime(spark, sf_dir):
    return metrics.category_average(on_time(load_tx(spark, sf_dir), FIVE_MINUTE_WINDOW_MS))


def q_country_counts(spark, sf_dir):
    return metrics.country_counts(load_tx(spark, sf_dir))


def q_country_counts_ontime(spark, sf_dir):
    return metrics.country_counts(on_time(load_tx(spark, sf_dir), FIVE_MINUTE_WINDOW_MS))


def metric_lines(tx: DataFrame) -> DataFrame:
    m1 = metrics.minute_totals(tx).select(
        F.lit("minute_totals").alias("metric"), "window_end",
        F.lit(None).cast("string").alias("key"), fmt.minute_line().alias("line"))
    m2 = metrics.category_average(tx).select(
        F.lit("category_average").alias("metric"), "window_end",
        F.col("merchant_category").alias("key"), fmt.category_line().alias("line"))
    m3 = metrics.country_counts(tx).select(
        F.lit("country_counts").alias("metric"), "window_end",
        F.col("country").alias("key"), fmt.country_line().alias("line"))
    return m1.unionByName(m2).unionByName(m3)


def q_metric_lines(spark, sf_dir):
    return metric_lines(load_tx(spark, sf_dir))


# --- amounts of more than two decimals ----------------------------------------
def q_minute_totals_subcent(spark, sf_dir):
    return metrics.minute_totals(load_tx(spark, sf_dir, sub_cent=True))


def q_category_average_subcent(spark, sf_dir):
    return metrics.category_average(load_tx(spark, sf_dir, sub_cent=True))


def q_minute_total_emissions_subcent(spark, sf_dir):
    return metrics.minute_total_emissions(load_tx(spark, sf_dir, sub_cent=True))


def q_high_amount_alerts_subcent(spark, sf_dir):
    return flatten_alerts(rules.high_amount_alerts(load_tx(spark, sf_dir, sub_cent=True)))


# --- rules ------------------------------------------------------------------
def q_high_frequency_alerts(spark, sf_dir):
    return flatten_alerts(rules.high_frequency_alerts(load_tx(spark, sf_dir)))


def q_high_frequency_alerts_ontime(spark, sf_dir):
    tx = on_time(load_tx(spark, sf_dir), RULE_WINDOW_MS)
    return flatten_alerts(rules.high_frequency_alerts(tx))


def q_high_amount_alerts(spark, sf_dir):
    return flatten_alerts(rules.high_amount_alerts(load_tx(spark, sf_dir)))


def q_impossible_travel_alerts(spark, sf_dir):
    return flatten_alerts(rules.impossible_travel_alerts(load_tx(spark, sf_dir)))


def q_merchant_burst_alerts(spark, sf_dir):
    return flatten_alerts(rules.merchant_burst_alerts(load_tx(spark, sf_dir)))


def q_merchant_burst_alerts_ontime(spark, sf_dir):
    tx = on_time(load_tx(spark, sf_dir), RULE_WINDOW_MS)
    return flatten_alerts(rules.merchant_burst_alerts(tx))


def all_alerts(tx: DataFrame) -> DataFrame:
    return all_rule_alerts(tx)


def scored_alerts(spark: SparkSession, tx: DataFrame) -> DataFrame:
    risky, blacklist = default_refs(spark)
    return score_alerts(all_alerts(tx), risky, blacklist)


def q_all_alerts(spark, sf_dir):
    return flatten_alerts(all_alerts(load_tx(spark, sf_dir)))


def q_scored_alerts(spark, sf_dir):
    return flatten_alerts(scored_alerts(spark, load_tx(spark, sf_dir)))


def q_scored_alerts_ontime(spark, sf_dir):
    """The reference job's alert set: windowed rules drop rows late for their
    2-minute windows, the keyed-state rules see every row."""
    tx = load_tx(spark, sf_dir)
    risky, blacklist = default_refs(spark)
    alerts = all_rule_alerts(tx, windowed_tx=on_time(tx, RULE_WINDOW_MS))
    return flatten_alerts(score_alerts(alerts, risky, blacklist))


def q_alert_lines(spark, sf_dir):
    scored = scored_alerts(spark, load_tx(spark, sf_dir))
    return scored.select("rule", "entity_id", "timestamp",
                         F.col("tx.transaction_id").alias("tx_transaction_id"),
                         fmt.alert_line().alias("line"))


BATCH_QUERIES: dict[str, Query] = {
    "transactions": q_transactions,
    "transaction_json_lines": q_transaction_json_lines,
    "parse_roundtrip": q_parse_roundtrip,
    "rejects": q_rejects,
    "reject_classes": q_reject_classes,
    "reference_list": q_reference_list,
    "job_scored_alerts": q_job_scored_alerts,
    "job_late_transactions": q_job_late_transactions,
    "job_minute_totals": q_job_metric("minute_totals"),
    "job_category_average": q_job_metric("category_average"),
    "job_country_counts": q_job_metric("country_counts"),
    "minute_totals": q_minute_totals,
    "minute_totals_ontime": q_minute_totals_ontime,
    "minute_total_emissions": q_minute_total_emissions,
    "late_transactions": q_late_transactions,
    "late_transactions_partitioned": q_late_transactions_partitioned,
    "category_average": q_category_average,
    "category_average_ontime": q_category_average_ontime,
    "country_counts": q_country_counts,
    "country_counts_ontime": q_country_counts_ontime,
    "metric_lines": q_metric_lines,
    "minute_totals_subcent": q_minute_totals_subcent,
    "category_average_subcent": q_category_average_subcent,
    "minute_total_emissions_subcent": q_minute_total_emissions_subcent,
    "high_amount_alerts_subcent": q_high_amount_alerts_subcent,
    "high_frequency_alerts": q_high_frequency_alerts,
    "high_frequency_alerts_ontime": q_high_frequency_alerts_ontime,
    "high_amount_alerts": q_high_amount_alerts,
    "impossible_travel_alerts": q_impossible_travel_alerts,
    "merchant_burst_alerts": q_merchant_burst_alerts,
    "merchant_burst_alerts_ontime": q_merchant_burst_alerts_ontime,
    "all_alerts": q_all_alerts,
    "scored_alerts": q_scored_alerts,
    "scored_alerts_ontime": q_scored_alerts_ontime,
    "alert_lines": q_alert_lines,
}
