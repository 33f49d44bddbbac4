"""Open alerts come from the whole inventory history, without a first date."""

import datetime as dt

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from ovenbird.sources.star import REORDER_POINT

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def low_stock():
    """Low-stock changes as (location, ingredient, quantity), before the batch and in it."""
    rows = pq.read_table(f"{SF}/lineitem.parquet", columns=["l_suppkey", "l_partkey", "l_quantity", "l_shipdate"]).to_pylist()
    known = set(pq.read_table(f"{SF}/part.parquet", columns=["p_partkey"])["p_partkey"].to_pylist())
    low = [(r["l_suppkey"], r["l_partkey"], float(r["l_quantity"]) - 1, r["l_shipdate"]) for r in rows
           if r["l_quantity"] - 1 <= REORDER_POINT and r["l_partkey"] in known]
    start = dt.datetime(2001, 1, 1)
    day = lambda t: t if isinstance(t, dt.datetime) else dt.datetime.combine(t, dt.time())
    return [x[:3] for x in low if day(x[3]) < start], [x[:3] for x in low if day(x[3]) >= start]


def _alerts(spark, name):
    return sorted((r["location_id"], r["ingredient_id"], float(r["current_quantity"])) for r in E.queries()[name](spark, SF).collect())


def test_inventory_alerts_know_all_open_alerts(spark, low_stock):
    before, batch = low_stock
    opened = {x[:2] for x in before}
    assert _alerts(spark, "inventory_alerts") == sorted(x for x in batch if x[:2] not in opened)


def test_streamed_alerts_know_all_open_alerts(spark, low_stock):
    before, batch = low_stock
    opened = {x[:2] for x in before}
    assert _alerts(spark, "streamed_alerts") == sorted(before + [x for x in batch if x[:2] not in opened])
