"""Reference lists (SRC-3), risk scoring (SCR-1..3), text goldens (PRJ-3..7)."""

import os
import tempfile

from pyspark.sql import functions as F
from conftest import make_tx

from cardstream.functions import format as fmt
from cardstream.operators.scoring import reference_frame, score_alerts
from cardstream.schema import alert_frame, tx_struct
from cardstream.sources.reference import load_reference_list


def test_reference_list_trim_comments_dedup(spark):
    d = tempfile.mkdtemp(prefix="cardstream-test-")
    path = os.path.join(d, "list.txt")
    with open(path, "w") as f:
        f.write("# comment\n\tm-7\r\n  m-13  \n\n   \nm-7\n  # indented comment\nm-23\n")
    vals = sorted(r.value for r in load_reference_list(spark, path).collect())
    assert vals == ["m-13", "m-23", "m-7"]


def test_reference_list_missing_file(spark):
    df = load_reference_list(spark, "/nonexistent/cardstream/list.txt")
    assert df.count() == 0 and df.columns == ["value"]


def test_shipped_lists_match_defaults(spark):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    rm = load_reference_list(spark, os.path.join(root, "conf", "risky_merchants.txt"))
    bl = load_reference_list(spark, os.path.join(root, "conf", "country_blacklist.txt"))
    assert sorted(r.value for r in rm.collect()) == ["m-13", "m-23", "m-7"]
    assert sorted(r.value for r in bl.collect()) == ["ES", "NL"]


def _alerts(spark, specs):
    """specs: (rule, merchant, country, amount, with_tx)."""
    rows = [dict(arrival_seq=i, merchant_id=m, country=c, amount=a, event_time=i)
            for i, (_, m, c, a, _) in enumerate(specs)]
    tx = make_tx(spark, rows)
    rule_of = F.element_at(F.array(*[F.lit(s[0]) for s in specs]),
                           (F.col("arrival_seq") + 1).cast("int"))
    keep = F.element_at(F.array(*[F.lit(s[4]) for s in specs]),
                        (F.col("arrival_seq") + 1).cast("int"))
    out = tx.select(*alert_frame(F.col("event_time"), "Card", F.col("card_id"),
                                 "x", F.lit("d"), F.when(keep, tx_struct())),
                    rule_of.alias("_rule"))
    return out.withColumn("rule", F.col("_rule")).drop("_rule")


def test_scores_and_levels(spark):
    specs = [
        ("Impossible Travel", "m-7", "NL", 1500.0, True),   # 60+20+25+10=115 -> 100
        ("High Amount", "m-1", "IL", 1000.0, True),         # 50 (not > 1000)
        ("High Frequency", "m-13", "IL", 5.0, True),        # 40+20 = 60
        ("Merchant Burst", "m-2", "ES", 1.0, True),         # 30+25 = 55
        ("Merchant Burst", "m-2", "IL", 1.0, True),         # 30 LOW
        ("Something Else", "m-23", "NL", 1000.01, False),   # no tx -> base 20
        ("Something Else", "m-1", "IL", 1.0, True),         # 20 LOW
    ]
    scored = score_alerts(_alerts(spark, specs), reference_frame(spark, ["m-7", "m-13", "m-23"]),
                          reference_frame(spark, ["NL", "ES", "NL"]))
    got = [(r.risk_score, r.risk_level) for r in scored.orderBy("timestamp").collect()]
    assert got == [(100, "HIGH"), (50, "MEDIUM"), (60, "MEDIUM"), (55, "MEDIUM"),
                   (30, "LOW"), (20, "LOW"), (20, "LOW")]
    assert scored.count() == len(specs)


def test_alert_line_goldens(spark):
    rows = [dict(transaction_id="tx-100627", card_id="card-111", merchant_id="m-20",
                 merchant_category="groceries", country="NL", amount=128.82,
                 event_time=1781161196980)]
    tx = make_tx(spark, rows)
    a = tx.select(*alert_frame(
        F.col("event_time"), "Card", F.col("card_id"), "Impossible Travel",
        F.lit("Previous Country: IL, Current Country: NL, Time Gap Minutes: 0"), tx_struct()))
    scored = a.withColumn("risk_score", F.lit(85)).withColumn("risk_level", F.lit("HIGH"))
    line = scored.select(fmt.alert_line().alias("l")).first().l
    assert line == (
        "Anomaly Detected! Timestamp: 1781161196980, Card: card-111, Rule: Impossible Travel, "
        "Previous Country: IL, Current Country: NL, Time Gap Minutes: 0 | Risk Score: 85/100 "
        "(HIGH) | Suspicious Tx: tx-100627, merchant m-20 (groceries), country NL, amount 128.82")
    unscored = a.withColumn("risk_score", F.lit(0)).withColumn("risk_level", F.lit(""))
    line = unscored.select(fmt.alert_line().alias("l")).first().l
    assert " | Risk Score" not in line and line.endswith("amount 128.82")
    no_tx = a.withColumn("tx", F.lit(None).cast(a.schema["tx"].dataType)) \
        .withColumn("risk_score", F.lit(20)).withColumn("risk_level", F.lit("LOW"))
    assert no_tx.select(fmt.alert_line().alias("l")).first().l.endswith("Suspicious Tx: n/a")


def test_metric_and_json_goldens(spark):
    df = spark.createDataFrame(
        [(1715606460000, 854, 428930.70, "electronics", 611.35, "IL", 497)],
        "we bigint, n bigint, total double, cat string, avg double, c string, cn bigint")
    r = df.select(fmt.minute_line("we", "n", "total").alias("a"),
                  fmt.category_line("we", "cat", "avg").alias("b"),
                  fmt.country_line("we", "c", "cn").alias("c")).first()
    assert r.a == "Timestamp: 1715606460000, Total Transactions: 854, Total Amount: 428930.70"
    assert r.b == "Timestamp: 1715606460000, Category: electronics, Average Amount: 611.35"
    assert r.c == "Timestamp: 1715606460000, Country: IL, Transactions: 497"
    tx = make_tx(spark, [dict(transaction_id="tx-100002", card_id="card-4",
                              customer_id="cust-4", merchant_id="m-16",
                              merchant_category="electronics", country="DE",
                              event_time=1781117688095, amount=1255.49)])
    assert tx.select(fmt.tx_json().alias("j")).first().j == (
        '{"transaction_id":"tx-100002","card_id":"card-4","customer_id":"cust-4",'
        '"merchant_id":"m-16","merchant_category":"electronics","country":"DE",'
        '"event_time":1781117688095,"amount":1255.49}')


def test_java_half_up_rounding(spark):
    df = spark.createDataFrame([(2.675, 0.125, None)], "a double, b double, c string")
    r = df.select(F.format_string("%.2f %.2f %s", "a", "b", "c").alias("s")).first()
    assert r.s == "2.68 0.13 null"


def test_late_line(spark):
    tx = make_tx(spark, [dict(transaction_id="tx-1", event_time=5, amount=1.5)])
    line = tx.select(fmt.late_line().alias("l")).first().l
    assert line.startswith('LATE EVENT (side output)> {"transaction_id":"tx-1",')
    assert line.endswith('"event_time":5,"amount":1.50}')
