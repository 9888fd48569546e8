"""Decoding corpus and JSON encode round trip."""

import pytest

from cardstream.sources.json_lines import parse_lines, parse_transactions

FULL = ('{"transaction_id":"t%s","card_id":"c","customer_id":"u","merchant_id":"m",'
        '"merchant_category":"fuel","country":"IL","event_time":%s,"amount":%s}')

CASES = [
    # (line, kind, reason, event_time, amount)
    (FULL % (1, 1000, "12.50"), "tx", None, 1000, 12.5),
    (FULL % (2, 1000, '"1.5"'), "tx", None, 1000, 1.5),               # quoted number
    (FULL % (3, "12.9", 1), "tx", None, 12, 1.0),                      # truncated long
    (FULL % (4, "1.78e12", 1), "tx", None, 1780000000000, 1.0),
    (FULL % (5, '"77"', 1), "tx", None, 77, 1.0),
    ('{"transaction_id":"t6","card_id":"c","customer_id":"u","merchant_id":"m",'
     '"merchant_category":"fuel","country":"IL"}', "tx", None, 0, 0.0),  # defaults
    (FULL[:-1] % (7, 1, 1) + ',"extra":{"x":[1,2]}}', "tx", None, 1, 1.0),  # unknown field
    (FULL % (8, 1, "null"), "tx", None, 1, 0.0),                       # null amount -> 0
    ('{"transaction_id":"t9","card_id":"c","card_id":"c2","customer_id":"u",'
     '"merchant_id":"m","merchant_category":"fuel","country":"IL","event_time":1,'
     '"amount":1}', "tx", None, 1, 1.0),                               # duplicate key
    (FULL.replace('"card_id":"c"', '"card_id":"{text"') % (10, 1, 1), "tx", None, 1, 1.0),
    ("not json", "reject", "malformed_json", None, None),
    ('{"transaction_id":"t11","card_id":"c","customer_id"', "reject", "malformed_json",
     None, None),
    ("[]", "reject", "malformed_json", None, None),
    ("[{}]", "reject", "malformed_json", None, None),
    ("null", "reject", "malformed_json", None, None),
    (FULL.replace('"IL"', "'IL'") % (12, 1, 1), "reject", "malformed_json", None, None),
    (FULL % (13, 1, "NaN"), "reject", "malformed_json", None, None),
    (FULL % (14, 1, '"abc"'), "reject", "bad_value", None, None),
    (FULL % (15, '"soon"', 1), "reject", "bad_value", None, None),
    (FULL.replace('"card_id":"c"', '"card_id":{"a":1}') % (16, 1, 1), "reject",
     "bad_value", None, None),
    (FULL.replace('"country":"IL",', '') % (17, 1, 1), "reject", "missing_key", None, None),
    ('{"heartbeat_time":99}', "heartbeat", None, 0, 0.0),
]


@pytest.fixture(scope="module")
def decoded(spark):
    lines = [c[0] for c in CASES] + ["", "   ", "\t\r"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return {r.line: r for r in parse_lines(df).collect()}


def test_blank_lines_are_not_events(decoded):
    assert len(decoded) == len(CASES)


@pytest.mark.parametrize("case", CASES, ids=[f"line{i}" for i in range(len(CASES))])
def test_case(decoded, case):
    line, kind, reason, et, amount = case
    r = decoded[line]
    assert (r._kind, r.reason) == (kind, reason)
    if kind == "tx":
        assert (r.event_time, r.amount) == (et, amount)


def test_roundtrip_keeps_values(spark):
    from conftest import make_tx
    from cardstream.functions import format as fmt
    tx = make_tx(spark, [dict(event_time=1704067200123, amount=2.675),
                         dict(event_time=5, amount=1255.49, arrival_seq=7)])
    lines = tx.select(fmt.tx_json().alias("value"))
    assert lines.first().value.endswith('"event_time":1704067200123,"amount":2.68}')
    back, rejects = parse_transactions(lines)
    assert rejects.count() == 0
    assert sorted(r.amount for r in back.collect()) == [2.68, 1255.49]


def test_sequence_from_a_column(spark):
    from cardstream.sources.json_lines import parse_transactions
    line = FULL % (1, 1000, "1.00")
    df = spark.createDataFrame([(line, 41), (line.replace('"t1"', '"t2"'), 42)],
                               "value string, offset bigint")
    tx, _ = parse_transactions(df, with_seq=True, seq_col="offset")
    assert sorted((r.transaction_id, r.arrival_seq) for r in tx.collect()) == \
        [("t1", 41), ("t2", 42)]


def test_escaped_encoder_roundtrip(spark):
    from conftest import make_tx
    from cardstream.functions import format as fmt
    tx = make_tx(spark, [dict(transaction_id='tx "quoted"', merchant_category="a\\b",
                              event_time=7, amount=12.5)])
    back, rejects = parse_transactions(tx.select(fmt.tx_json_escaped().alias("value")))
    assert rejects.count() == 0
    r = back.first()
    assert (r.transaction_id, r.merchant_category, r.amount) == ('tx "quoted"', "a\\b", 12.5)


def test_no_value_stops_the_job(spark):
    """Non-finite and out-of-range values reject their own line alone."""
    from cardstream.functions.timecols import with_event_time
    good = ('{"transaction_id":"t","card_id":"c","customer_id":"u","merchant_id":"m",'
            '"merchant_category":"fuel","country":"IL","event_time":%s,"amount":%s}')
    lines = [good % (1, 2.5), good % (1, '"NaN"'), good % (1, '"Infinity"'), good % (1, "1e300"), good % (1, "1e17"),
             good % ("9000000000000000001", 1), good % ("-9000000000000000001", 1), good % ("1e30", 1),
             '{"heartbeat_time":9000000000000000001}', "", "  "]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    tx, rejects = parse_transactions(df)
    assert with_event_time(tx).count() == 1
    reasons = sorted(r.reason for r in rejects.collect())
    assert reasons.count("out_of_range") >= 6 and len(reasons) == 8


def _line(**fields):
    import json
    return json.dumps({**{k: "x" for k in ("transaction_id", "card_id", "customer_id", "merchant_id",
                                           "merchant_category", "country")}, "event_time": 1, "amount": 2, **fields})


def test_text_that_looks_like_json_is_text(spark):
    """A quoted object is a string; an object, an array or a field given twice is not."""
    from cardstream.sources.json_lines import parse_lines
    lines = [_line(merchant_id='{"a": 1}'), _line(merchant_id="[1, 2]"), _line(merchant_id=" {} "),
             _line(merchant_id={"a": 1}), _line(merchant_id=[1]), _line(merchant_id="{not json"),
             '{"merchant_id":"x","x":1,' + _line(merchant_id='{"a": 1}')[1:]]
    rows = parse_lines(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    got = [(r["_kind"], r["reason"], r["merchant_id"]) for r in rows]
    assert [g[:2] for g in got] == [("tx", None)] * 3 + [("reject", "bad_value")] * 2 + [("tx", None), ("reject", "bad_value")]
    assert [g[2] for g in got[:3]] == ['{"a": 1}', "[1, 2]", " {} "]


def test_foreign_position_field_is_ignored(spark):
    from cardstream.sources.json_lines import parse_lines
    lines = spark.createDataFrame([(0, _line(arrival_seq="x7"))], "arrival_seq bigint, value string")
    assert [r["_kind"] for r in parse_lines(lines, carry_seq=False).collect()] == ["tx"]
    assert [(r["_kind"], r.arrival_seq) for r in parse_lines(lines, seq_col="arrival_seq").collect()] == [("tx", 0)]
    assert [r.reason for r in parse_lines(lines).collect()] == ["bad_value"]


def test_sums_of_the_largest_amounts(spark):
    """100,000 accepted lines of 1e12 in one minute: a total, in batch and on a stream."""
    from pyspark.sql import functions as F
    from cardstream.operators.metrics import category_average, minute_total_emissions, minute_totals
    from cardstream.session import scratch_path
    from cardstream.sources.json_lines import parse_lines
    from cardstream.functions.timecols import with_event_time
    from cardstream.streaming.exact import ExactWindowsBatchWriter, read_exact_windows
    lines = spark.range(100_000).select(F.col("id").alias("arrival_seq"), F.lit(_line(amount=1e12)).alias("value"))
    tx = with_event_time(parse_lines(lines, seq_col="arrival_seq"))
    row = minute_totals(tx).first()
    assert row.total_amount == 1e17 and row.total_cents is None and row.n_tx == 100_000
    assert category_average(tx).first().avg_amount == 1e12
    assert minute_total_emissions(tx).first().total_amount == 1e17
    writer = ExactWindowsBatchWriter(out := scratch_path(spark, "t-large-sums"))
    writer(tx.where("arrival_seq < 60000"), 0)
    writer(tx.where("arrival_seq >= 60000"), 1)
    assert read_exact_windows(spark, out)["minute_totals"].first().total_amount == 1e17
    small = minute_totals(tx.where("arrival_seq < 3")).first()
    assert small.total_cents == 3 * 10**14
