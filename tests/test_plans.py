"""Physical-plan shape: the plans we want at scale stay the plans we get."""

import re

from conftest import SF01
from cardstream.operators import rules
from cardstream.plans.catalog import load_tx, q_scored_alerts
from cardstream.sources.json_lines import parse_lines


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_ordered_rule_is_one_window_shuffle_without_hot_keys(spark):
    df = rules.high_amount_alerts(load_tx(spark, SF01))
    p = plan(df)
    # one hash exchange on the key (plus the initial rebalance of the single
    # row group of the fixture file), no joins on the data path
    assert len(re.findall(r"Arguments: hashpartitioning\(customer_id", p)) == 1
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p
    assert "Window" in p


def test_json_decoded_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    df = parse_lines(lines).where("_kind = 'tx'")
    p = plan(df, "extended")
    physical = p[p.index("== Physical Plan =="):]
    assert physical.count("from_json(") == 1


def test_reference_lists_are_broadcast(spark):
    p = plan(q_scored_alerts(spark, SF01))
    assert p.count("BroadcastHashJoin") >= 2
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_scan_reads_only_needed_columns(spark):
    from cardstream.operators.metrics import country_counts
    df = country_counts(load_tx(spark, SF01))
    p = plan(df)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas and all("value" not in s for s in schemas)


def test_fixture_does_not_depend_on_session_time_zone(spark):
    from cardstream.sources.fixtures import fixture_transactions
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = sorted(tuple(r) for r in fixture_transactions(spark, SF01).collect())
        # +7:30 in 1970 but +8:00 in 2024: a zone-dependent cast would shift times
        spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
        sg = sorted(tuple(r) for r in fixture_transactions(spark, SF01).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == sg


def test_windowed_rule_joins_no_rows(spark):
    """One aggregate; or beyond its size, a narrow one and a broadcast of the fired positions."""
    from cardstream.operators.rules import window_count_rule
    from cardstream.schema import flatten_alerts
    tx = load_tx(spark, SF01)
    one = window_count_rule(tx, "merchant_id", "Merchant", "r", 10)
    assert "Join" not in plan(one) and len(re.findall(r"\) Exchange", plan(one))) <= 2
    two = window_count_rule(tx, "merchant_id", "Merchant", "r", 10, one_pass_rows=0)
    p = plan(two)
    # all rows meet the fired positions by broadcast; only fetched rows are shuffled
    assert "BroadcastHashJoin" in p and "hashpartitioning(arrival_seq" not in p
    rows = lambda df: sorted(tuple(r) for r in flatten_alerts(df).collect())
    assert len(rows(one)) > 100 and rows(one) == rows(two)


def test_windowed_rule_with_equal_positions(spark):
    """Positions that repeat over keys: every alert keeps a row of its own key."""
    from conftest import make_tx
    from cardstream.operators.rules import window_count_rule
    tx = make_tx(spark, [{"event_time": 60_000, "arrival_seq": i % 7, "card_id": f"c{i // 7}"} for i in range(21)])
    got = window_count_rule(tx, "card_id", "Card", "r", 5, one_pass_rows=0).collect()
    assert sorted((r.entity_id, r.tx.card_id, r.n_in_window) for r in got) == [(f"c{k}", f"c{k}", 7) for k in range(3)]
