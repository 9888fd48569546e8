import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cardstream.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, app="cardstream-tests")
    yield s
    s.stop()


TX_DDL = ("arrival_seq bigint, transaction_id string, card_id string, customer_id string, "
          "merchant_id string, merchant_category string, country string, "
          "event_time bigint, amount double")


def make_tx(spark, rows):
    """Hand-made transactions: dicts with any subset of the fields."""
    from cardstream.functions.timecols import with_event_time
    defaults = dict(card_id="card-1", customer_id="cust-1", merchant_id="m-1",
                    merchant_category="fuel", country="IL", amount=10.0)
    full = []
    for i, r in enumerate(rows):
        d = dict(defaults, **r)
        d.setdefault("arrival_seq", i)
        d.setdefault("transaction_id", f"tx-{d['arrival_seq']}")
        full.append((d["arrival_seq"], d["transaction_id"], d["card_id"], d["customer_id"],
                     d["merchant_id"], d["merchant_category"], d["country"],
                     d["event_time"], float(d["amount"])))
    return with_event_time(spark.createDataFrame(full, TX_DDL))
