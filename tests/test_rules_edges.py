"""Boundary rows for the four rules (FIXTURES.md 4)."""

from conftest import make_tx

from cardstream.operators import rules


def test_high_frequency_5_vs_6_and_last_arrived(spark):
    five = [dict(card_id="A", event_time=1000 * i) for i in range(5)]
    # six rows; the last-arrived one has the *smallest* event time
    six = [dict(card_id="B", event_time=10_000 + 1000 * i, transaction_id=f"b{i}")
           for i in range(5)] + [dict(card_id="B", event_time=5_000, transaction_id="b-last")]
    out = rules.high_frequency_alerts(make_tx(spark, five + six)).collect()
    assert len(out) == 1
    a = out[0]
    assert (a.entity_id, a.n_in_window, a.tx.transaction_id, a.timestamp) == ("B", 6, "b-last", 5_000)
    assert a.decision_values == "Transactions in 2 minutes: 6"
    assert (a.entity_type, a.rule) == ("Card", "High Frequency")


def test_high_frequency_window_edge(spark):
    # 3 rows in [0, 120000) and 3 rows at exactly 120000 -> no window has 6
    rows = [dict(event_time=t) for t in (0, 1, 119_999, 120_000, 120_000, 120_001)]
    assert rules.high_frequency_alerts(make_tx(spark, rows)).count() == 0


def test_merchant_burst_20_vs_21(spark):
    rows = ([dict(merchant_id="m-20", card_id=f"c{i}", event_time=i) for i in range(20)]
            + [dict(merchant_id="m-21", card_id=f"d{i}", event_time=i) for i in range(21)])
    out = rules.merchant_burst_alerts(make_tx(spark, rows)).collect()
    assert [(a.entity_id, a.n_in_window) for a in out] == [("m-21", 21)]
    assert out[0].decision_values == "Transactions in 2 minutes: 21 (normal load ~9)"
    assert out[0].entity_type == "Merchant"


def _amount_rows(cust, history, amount):
    rows = [dict(customer_id=cust, amount=a, event_time=i) for i, a in enumerate(history)]
    rows.append(dict(customer_id=cust, amount=amount, event_time=len(history)))
    return rows


def _ha(spark, rows):
    return {a.entity_id: a for a in rules.high_amount_alerts(make_tx(spark, rows)).collect()}


def test_high_amount_history_4_vs_5(spark):
    rows = (_amount_rows("h4", [10.0] * 4, 5000.0) + _amount_rows("h5", [10.0] * 5, 5000.0))
    rows = [dict(r, arrival_seq=i) for i, r in enumerate(rows)]
    out = _ha(spark, rows)
    assert set(out) == {"h5"}
    assert out["h5"].decision_values == "Amount: 5000.00, Historical Avg: 10.00"
    assert (out["h5"].hist_n, out["h5"].entity_type) == (5, "Customer")


def test_high_amount_exact_thresholds(spark):
    cases = {
        "eq500": ([100.0] * 5, 500.0),      # not > 500
        "over500": ([100.0] * 5, 500.01),   # fires
        "eq3x": ([200.0] * 5, 600.0),       # exactly 3x -> fires (>=)
        "below3x": ([200.0] * 5, 599.99),   # no
    }
    rows = []
    for cust, (hist, amt) in cases.items():
        rows += _amount_rows(cust, hist, amt)
    rows = [dict(r, arrival_seq=i) for i, r in enumerate(rows)]
    assert set(_ha(spark, rows)) == {"over500", "eq3x"}


def test_high_amount_window_is_last_20(spark):
    # 21 prior rows: a huge first one falls out of the last-20 window
    h21 = _amount_rows("h21", [100000.0] + [100.0] * 20, 900.0)
    h20 = _amount_rows("h20", [100000.0] + [100.0] * 19, 900.0)
    rows = [dict(r, arrival_seq=i) for i, r in enumerate(h21 + h20)]
    out = _ha(spark, rows)
    assert set(out) == {"h21"}
    assert out["h21"].hist_n == 20
    assert out["h21"].hist_avg == 100.0


def test_high_amount_check_before_append(spark):
    # the spike itself must not dilute its own baseline
    rows = _amount_rows("c", [100.0] * 5, 600.0)
    assert set(_ha(spark, rows)) == {"c"}


def test_impossible_travel_gaps(spark):
    base = 10_000_000
    rows = [
        dict(card_id="fire", country="IL", event_time=base),
        dict(card_id="fire", country="US", event_time=base + 30 * 60_000 - 1),
        dict(card_id="edge", country="IL", event_time=base),
        dict(card_id="edge", country="US", event_time=base + 30 * 60_000),
        dict(card_id="same", country="IL", event_time=base),
        dict(card_id="same", country="IL", event_time=base + 1),
        dict(card_id="neg0", country="IL", event_time=base),
        dict(card_id="neg0", country="FR", event_time=base - 59_999),
        dict(card_id="neg1", country="IL", event_time=base),
        dict(card_id="neg1", country="FR", event_time=base - 60_001),
    ]
    out = {a.entity_id: a for a in rules.impossible_travel_alerts(make_tx(spark, rows)).collect()}
    assert set(out) == {"fire", "neg0", "neg1"}
    assert out["fire"].gap_minutes == 29
    assert out["neg0"].gap_minutes == 0
    assert out["neg1"].gap_minutes == -1
    assert out["neg1"].decision_values == (
        "Previous Country: IL, Current Country: FR, Time Gap Minutes: -1")
    assert out["fire"].prev_country == "IL"


def test_impossible_travel_late_row_becomes_reference(spark):
    base = 10_000_000
    rows = [
        dict(card_id="c", country="IL", event_time=base),
        dict(card_id="c", country="US", event_time=base - 3_600_000),  # backdated
        dict(card_id="c", country="US", event_time=base + 1),          # same as prev
    ]
    out = rules.impossible_travel_alerts(make_tx(spark, rows)).collect()
    assert [a.tx.event_time for a in out] == [base - 3_600_000]


def test_amounts_of_more_than_two_decimals(spark):
    """Amounts are not rounded before they are compared, averaged or summed."""
    cases = {"over": ([20.0] * 6, 500.004), "eq": ([20.0] * 6, 500.0),
             "under3x": ([200.004] * 5, 600.011), "eq3x": ([200.004] * 5, 600.012)}
    rows = [r for cust, (hist, last) in cases.items() for r in _amount_rows(cust, hist, last)]
    rows = [dict(r, arrival_seq=i) for i, r in enumerate(rows)]
    out = _ha(spark, rows)
    assert set(out) == {"over", "eq3x"}
    assert out["eq3x"].hist_avg == 200.004
    assert out["over"].decision_values == "Amount: 500.00, Historical Avg: 20.00"


def test_totals_of_amounts_below_a_cent(spark):
    from cardstream.operators import metrics
    tx = make_tx(spark, [dict(event_time=i, amount=0.004) for i in range(1000)]
                 + [dict(event_time=60_000 + i, amount=-0.004) for i in range(3)])
    first, second = metrics.minute_totals(tx).orderBy("window_end").collect()
    assert (first.n_tx, first.total_cents, first.total_amount) == (1000, 400, 4.0)
    assert (second.n_tx, second.total_cents, second.total_amount) == (3, -1, -0.012)
    avg = metrics.category_average(tx).collect()
    assert [round(r.avg_amount, 12) for r in avg] == [round(3.988 / 1003, 12)]
