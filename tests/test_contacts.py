"""The derived contacts: previous orders of ordinary and busy customers."""

import datetime

import pytest

from siltworks.sources.contacts import busy_customers, contacts_raw, with_previous_order

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_orderstatus string"


def day(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture
def orders(spark):
    rows = [(k, 1, day(f"2024-0{1 + k % 4}-{10 + k % 3}"), "FOP"[k % 3]) for k in range(1, 30)]
    rows += [(40, 1, None, "F"), (41, 1, None, "O"), (50, 2, day("2024-03-01"), "F"), (51, 2, day("2024-02-01"), "P"), (60, None, day("2024-02-01"), "F")]
    return spark.createDataFrame(rows, ORDERS)


def found(spark, orders, many):
    customer = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "o_custkey bigint, segment string")
    got = with_previous_order(orders, customer, busy_customers(orders, many)).collect()
    return sorted((r["o_orderkey"], r["segment"], r["prev_date"], r["prev_status"], r["n_prev"]) for r in got)


@pytest.mark.parametrize("many", [1, 5, 1000])
def test_previous_orders_do_not_depend_on_who_is_busy(spark, orders, many):
    expected = []
    rows = [r for r in orders.collect() if r["o_custkey"] is not None]
    for r in rows:
        at = (r["o_orderdate"] or datetime.date.min, r["o_orderkey"])
        own = sorted((o["o_orderdate"] or datetime.date.min, o["o_orderkey"], o["o_orderdate"], o["o_orderstatus"]) for o in rows if o["o_custkey"] == r["o_custkey"] and ((o["o_orderdate"] or datetime.date.min), o["o_orderkey"]) < at)
        last = own[-1][2:] if own else (None, None)
        expected.append((r["o_orderkey"], "?AB"[r["o_custkey"]], *last, len(own)))
    assert found(spark, orders, many) == sorted(expected)


def test_orders_are_shuffled_by_customer_once(spark, tmp_path):
    """Only the rows of the customers come to them; before, the orders met two more shuffles of their months."""
    spark.createDataFrame([(1, 1, datetime.datetime(2024, 1, 2), "F", "2-HIGH", 7.0)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderstatus string, o_orderpriority string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 5.0, "AUTO")], "c_custkey bigint, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1,), (1,)], "l_orderkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        contacts = contacts_raw(spark, str(tmp_path))
        text = contacts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    [row] = contacts.collect()
    assert (row["campaign"], row["pdays"], row["previous"], row["job"]) == ("2", "-1", "0", "AUTO")
    assert text.count("Exchange hashpartitioning(o_custkey") <= 4  # orders, customers and what is carried, twice at most
    assert text.count("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint") == 1
