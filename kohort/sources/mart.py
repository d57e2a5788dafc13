"""Derive the three business tables from the driver's order tables.

The analysis works on ``subscriptions``, ``invoices`` and ``customers``.
The test data ships TPC-H-like tables instead, so this module maps them:

* subscriptions: one row per (customer, order priority); priority = plan,
  market segment = contract length;
* invoices: one row per order;
* customers(cutoff): per-customer features from orders up to ``cutoff`` and
  the churn label from orders after it.

Every builder aggregates before it joins: each join below has at most one
row per key on both sides, so a hot customer (a third of all orders) is
folded by the map-side partial aggregate and never lands whole in one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import to_day
from .files import shared_table
from .tables import Tables

MONEY = "decimal(18,2)"


def subscription_id(custkey: Column, priority: Column) -> Column:
    """Plan key: customer key times ten plus the priority digit."""
    return (custkey * 10 + F.substring(priority, 1, 1).cast("int")).cast("bigint")


def _lit_date(d: _dt.date) -> Column:
    return F.lit(d).cast("date")


def subscriptions(t: Tables, cutoff: _dt.date = config.CUTOFF,
                  with_contract: bool = True) -> DataFrame:
    """subscription_id, customer_id, subscription_type, contract_length,
    start_date, end_date, is_active."""
    per_plan = (
        t.orders
        .select("o_custkey", "o_orderpriority", to_day("o_orderdate").alias("d"))
        .groupBy("o_custkey", "o_orderpriority")
        .agg(F.min("d").alias("start_date"), F.max("d").alias("last_date"))
    )
    cut = _lit_date(cutoff)
    subs = per_plan.select(
        subscription_id(F.col("o_custkey"), F.col("o_orderpriority")).alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("subscription_type"),
        "start_date",
        F.when(F.col("last_date") < cut, F.col("last_date")).alias("end_date"),
        (F.col("last_date") >= cut).alias("is_active"),
    )
    if not with_contract:
        return subs
    segments = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("contract_length"))
    # one row per key on both sides; sort-merge (AQE broadcasts if small)
    return subs.join(segments, "customer_id", "left").select(
        "subscription_id", "customer_id", "subscription_type", "contract_length",
        "start_date", "end_date", "is_active")


def ship_dates(t: Tables) -> DataFrame:
    """Latest ship date per order (partial aggregate before the shuffle)."""
    return (t.lineitem
            .groupBy(F.col("l_orderkey"))
            .agg(F.max(to_day("l_shipdate")).alias("ship_date")))


def _status(code: Column) -> Column:
    expr = None
    for key, name in config.STATUS_NAMES.items():
        expr = (F.when(code == key, name) if expr is None
                else expr.when(code == key, name))
    return expr


def invoices(t: Tables, with_late: bool = True) -> DataFrame:
    """invoice_id, subscription_id, invoice_date, amount, paid_late, status.

    ``with_late=False`` leaves out ``paid_late`` and so the join with the
    line items; queries that never read the column skip that work.
    """
    base = t.orders.select(
        F.col("o_orderkey").alias("invoice_id"),
        subscription_id(F.col("o_custkey"), F.col("o_orderpriority")).alias("subscription_id"),
        to_day("o_orderdate").alias("invoice_date"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        _status(F.col("o_orderstatus")).alias("status"),
    )
    if not with_late:
        return base
    ships = ship_dates(t).withColumnRenamed("l_orderkey", "invoice_id")
    late = F.coalesce(
        F.datediff(F.col("ship_date"), F.col("invoice_date")) > config.LATE_DAYS, F.lit(False))
    return base.join(ships, "invoice_id", "left").select(
        "invoice_id", "subscription_id", "invoice_date", "amount",
        late.alias("paid_late"), "status")


def _latest(d: Column, order: Column, priority: Column) -> Column:
    """(day, order, plan digit) as one fixed-width number, so that a maximum
    finds the latest order's plan inside a hash aggregate."""
    day = (F.unix_date(d) + 10_000_000).cast("decimal(16,0)")  # not negative
    shift = F.lit("1" + 20 * "0").cast("decimal(21,0)")
    rest = order.cast("decimal(20,0)") * 10 + F.substring(priority, 1, 1).cast("int")
    return (day * shift + rest).cast("decimal(38,0)")


def order_features(t: Tables, cutoffs: list[_dt.date]) -> DataFrame:
    """Per customer the order features as of each cutoff (columns end in its
    position), from one pass over the orders and one over the line items."""
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority", to_day("o_orderdate").alias("d"),
        F.col("o_totalprice").cast(MONEY).alias("amount"))
    ships = ship_dates(t).withColumnRenamed("l_orderkey", "o_orderkey")
    delay = F.greatest(F.datediff(F.col("ship_date"), F.col("d")), F.lit(0))
    latest = _latest(F.col("d"), F.col("o_orderkey"), F.col("o_orderpriority"))
    aggs = []
    for i, cutoff in enumerate(cutoffs):
        seen = F.col("d") <= _lit_date(cutoff)
        of = lambda c, seen=seen: F.when(seen, c)
        aggs += [F.min(of(F.col("d"))).alias(f"first_d_{i}"), F.max(of(F.col("d"))).alias(f"last_d_{i}"),
                 F.count_if(seen).alias(f"n_orders_{i}"), F.avg(of(delay)).alias(f"payment_delay_{i}"),
                 F.sum(of(F.col("amount"))).alias(f"spend_{i}"), F.max(of(latest)).alias(f"latest_{i}"),
                 # label: any order after the cutoff
                 F.max(F.when(F.col("d") > _lit_date(cutoff), 1).otherwise(0)).alias(f"later_{i}")]
    return orders.join(ships, "o_orderkey", "left").groupBy("o_custkey").agg(*aggs)


def _customers(t: Tables, features: DataFrame, i: int, cutoff: _dt.date) -> DataFrame:
    cut = _lit_date(cutoff)
    feats = features.where(F.col(f"n_orders_{i}") > 0).select(
        "o_custkey", *[F.col(f"{c}_{i}").alias(c) for c in
                       ("first_d", "last_d", "n_orders", "payment_delay", "spend", "later")],
        F.pmod(F.col(f"latest_{i}"), F.lit(10)).cast("int").alias("digit"))
    # one row per plan
    plans = t.orders.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("digit"),
                            F.col("o_orderpriority").alias("subscription_type")).distinct()
    calls = (t.events.groupBy(F.col("user_id").alias("o_custkey"))
             .agg(F.count_if(F.col("event_type") == "error").cast("double").alias("support_calls")))
    segments = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    month_no = lambda c: F.year(c) * 12 + F.month(c)
    key = F.col("o_custkey")
    return (
        feats.join(plans, "digit", "left")
        .join(calls, "o_custkey", "left")
        .join(segments, "o_custkey", "inner")
        .select(
            key.alias("customerid"),
            (F.lit(config.AGE_BASE) + key % config.AGE_SPAN).cast("int").alias("age"),
            F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
            (month_no(cut) - month_no(F.col("first_d"))).cast("int").alias("tenure"),
            F.col("n_orders").cast("double").alias("usage_frequency"),
            "support_calls",
            F.col("payment_delay").cast("double").alias("payment_delay"),
            F.col("spend").cast("double").alias("total_spend"),
            F.datediff(cut, F.col("last_d")).cast("double").alias("last_interaction"),
            "subscription_type",
            F.col("c_mktsegment").alias("contract_length"),
            (1 - F.col("later")).cast("int").alias("churn"),
        )
    )


def customers(t: Tables, cutoff: _dt.date = config.CUTOFF) -> DataFrame:
    """Wide customer table as of ``cutoff`` (features + churn label)."""
    return _customers(t, order_features(t, [cutoff]), 0, cutoff)


def customer_snapshots(t: Tables, cutoffs: list[_dt.date]) -> list[DataFrame]:
    """The customer table as of several cutoffs: the orders are read and
    folded once, and that result is written once."""
    features = shared_table(order_features(t, cutoffs), "order-features")
    return [_customers(t, features, i, c) for i, c in enumerate(cutoffs)]
