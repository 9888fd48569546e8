"""Random arrival sequences: Spark operators == the row-by-row model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute_force as bf
from conftest import make_tx
from cardstream.operators import rules
from cardstream.operators.late import split_late

ROW = st.fixed_dictionaries({
    "card_id": st.sampled_from(["c1", "c2", "c3"]),
    "customer_id": st.sampled_from(["u1", "u2"]),
    "merchant_id": st.sampled_from(["m1", "m2"]),
    "country": st.sampled_from(["IL", "US", "FR"]),
    "event_time": st.integers(min_value=0, max_value=900_000),
    "amount": st.sampled_from([1.0, 10.5, 99.99, 250.0, 600.0, 1500.0, 5000.0]),
})
ROWS = st.lists(ROW, min_size=1, max_size=70)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _seq(rows):
    return [dict(r, arrival_seq=i, transaction_id=f"t{i}") for i, r in enumerate(rows)]


@SETTINGS
@given(rows=ROWS)
def test_window_rules(spark, rows):
    rows = _seq(rows)
    tx = make_tx(spark, rows)
    hf = sorted((a.entity_id, a.n_in_window, a.tx.transaction_id)
                for a in rules.high_frequency_alerts(tx, threshold=2).collect())
    assert hf == bf.window_rule(rows, "card_id", 2)
    mb = sorted((a.entity_id, a.n_in_window, a.tx.transaction_id)
                for a in rules.merchant_burst_alerts(tx, threshold=3).collect())
    assert mb == bf.window_rule(rows, "merchant_id", 3)


@SETTINGS
@given(rows=ROWS, hot=st.sampled_from([None, 2, 7]))
def test_ordered_rules_plain_and_split(spark, rows, hot):
    rows = _seq(rows)
    tx = make_tx(spark, rows)
    ha = sorted((a.entity_id, a.tx.transaction_id, a.hist_n,
                 round(a.hist_avg * 100 * a.hist_n))
                for a in rules.high_amount_alerts(tx, hot_rows=hot).collect())
    assert ha == bf.high_amount(rows)
    it = sorted((a.entity_id, a.tx.transaction_id, a.prev_country, a.gap_minutes)
                for a in rules.impossible_travel_alerts(tx, hot_rows=hot).collect())
    assert it == bf.impossible_travel(rows)


@SETTINGS
@given(rows=ROWS, width=st.sampled_from([1, 5, 1 << 20]),
       cfg=st.sampled_from([(60_000, 10_000), (120_000, 0), (300_000, 0)]))
def test_late_split(spark, rows, width, cfg):
    rows = _seq(rows)
    _, late = split_late(make_tx(spark, rows), cfg[0], cfg[1], bucket_width=width)
    assert sorted(r.transaction_id for r in late.collect()) == bf.late_rows(rows, *cfg)


@SETTINGS
@given(rows=ROWS, width=st.sampled_from([2, 1 << 20]))
def test_minute_emissions(spark, rows, width):
    from cardstream.operators.metrics import minute_total_emissions
    rows = _seq(rows)
    em = minute_total_emissions(make_tx(spark, rows), bucket_width=width)
    got = sorted((r.window_end, r.emission, r.fired_by, r.n_tx, r.total_cents)
                 for r in em.collect())
    assert got == bf.minute_emissions(rows)
