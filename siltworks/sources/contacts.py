"""The bank-contact table, derived from the order tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from siltworks.session import stage

#: a customer with more orders is busy: its windows hold a month each
MANY_ORDERS = 1_000_000

PLACE = ("o_orderdate", "o_orderkey", "o_orderstatus")


def read_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]


class Busy(NamedTuple):
    """Customers of very many orders, and by customer and month what comes before the month; both written."""

    customers: DataFrame
    carried: DataFrame


def _no_month() -> Column:
    """Keeps orders without a date in the joins."""
    return F.lit("0001-01-01").cast("date")


def _slice(busy: Column) -> Column:
    """What one window holds of a customer: all orders, or those of a month if the customer is busy."""
    return F.when(busy, F.coalesce(F.trunc("o_orderdate", "month"), _no_month())).otherwise(_no_month())


def busy_customers(orders: DataFrame, many: int = MANY_ORDERS) -> Busy:
    """The customers with more than ``many`` orders; there are fewer of them than orders by ``many``."""
    counted = orders.filter(F.col("o_custkey").isNotNull()).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customers = stage(counted.filter(F.col("n") > many).select("o_custkey", F.lit(True).alias("busy")), "busy")
    months = (
        orders.join(F.broadcast(customers), "o_custkey")
        .groupBy("o_custkey", _slice(F.lit(True)).alias("slice"))
        .agg(F.max(F.struct(*PLACE)).alias("last_order"), F.count(F.lit(1)).alias("n_orders"))
    )
    earlier = W.partitionBy("o_custkey").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = months.select(
        "o_custkey",
        "slice",
        F.last("last_order").over(earlier).alias("carried"),
        F.sum("n_orders").over(earlier).alias("n_carried"),
    )
    return Busy(customers, stage(carried, "carried"))


def with_previous_order(orders: DataFrame, customer: DataFrame, busy: Busy) -> DataFrame:
    """Orders with the columns of their customer, date and status of the customer's previous order and how many came before.

    A window per customer would put a customer with a third of all orders into one
    task. The window of a busy customer covers one month, and what precedes a month is
    carried over from a table with one row per busy customer and month. It comes with the rows of the
    customers, so that the orders are shuffled once.
    """
    dated = (
        orders.filter(F.col("o_custkey").isNotNull())
        .join(F.broadcast(busy.customers), "o_custkey", "left")
        .withColumn("slice", _slice(F.col("busy")))
    )
    known = customer.join(busy.carried, "o_custkey", "left").withColumn("slice", F.coalesce("slice", _no_month()))
    in_slice = W.partitionBy("o_custkey", "slice").orderBy(*PLACE)
    seen = dated.withColumns(
        {
            "before": F.lag(F.struct(*PLACE)).over(in_slice),
            "n_before": F.row_number().over(in_slice) - 1,
        }
    ).join(known, ["o_custkey", "slice"])
    previous = F.coalesce("before", "carried")
    return seen.select(
        *orders.columns,
        *[c for c in customer.columns if c != "o_custkey"],
        previous["o_orderdate"].alias("prev_date"),
        previous["o_orderstatus"].alias("prev_status"),
        (F.col("n_before") + F.coalesce("n_carried", F.lit(0))).alias("n_prev"),
    )


def contacts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with 17 text columns as they might come from a delimited file."""
    orders, customer, lineitem = read_tables(spark, sf_dir, "orders", "customer", "lineitem")
    orders = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    items = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_items"))
    customer = customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    base = with_previous_order(orders.join(items, "o_orderkey", "left"), customer, busy_customers(orders))

    key, cust, previous = F.col("o_orderkey"), F.col("o_custkey"), F.col("prev_status")

    def text(c: Column) -> Column:
        return c.cast("string")

    def pick(number: Column, by: int, *options: str) -> Column:
        return F.element_at(F.array(*[F.lit(o) for o in options]), (number % by + 1).cast("int"))

    segment, priority = F.col("c_mktsegment"), F.col("o_orderpriority")
    return base.select(
        key.alias("contact_id"),
        F.when(key % 97 == 0, "abc").when(key % 101 == 0, "N/A").otherwise(text(18 + cust % 73)).alias("age"),
        F.when(key % 89 == 0, "").when(key % 211 == 0, "99999.5").otherwise(text(F.col("c_acctbal"))).alias("balance"),
        text(F.dayofmonth("o_orderdate")).alias("day"),
        text(F.floor(F.col("o_totalprice") / 1000)).alias("duration"),
        text(F.coalesce("n_items", F.lit(0))).alias("campaign"),
        text(F.coalesce(F.date_diff("o_orderdate", "prev_date"), F.lit(-1))).alias("pdays"),
        text(F.col("n_prev")).alias("previous"),
        F.when(key % 83 == 0, "NA").when(key % 5 == 0, F.concat(F.lit(" "), segment, F.lit(" "))).otherwise(segment).alias("job"),
        pick(cust, 3, "married", "Single", " divorced").alias("marital"),
        pick(cust, 4, "primary", "Secondary", "tertiary", "unknown").alias("education"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "cellular")
        .when(priority == "3-MEDIUM", "telephone")
        .otherwise("unknown")
        .alias("contact"),
        F.when(previous.isNull(), "unknown")
        .when(previous == "F", "success")
        .when(previous == "O", "failure")
        .otherwise("other")
        .alias("poutcome"),
        pick(
            F.month("o_orderdate") - 1, 12,
            "jan", "feb", "Mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", " dec ",
        ).alias("month"),
        F.when(F.col("c_acctbal") < 0, "Yes").otherwise("no").alias("default"),
        pick(key, 4, "y", " YES", "0", "false").alias("housing"),
        F.when(key % 79 == 0, "maybe").when(key % 6 == 0, "true").otherwise("N").alias("loan"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("deposit"),
    )
