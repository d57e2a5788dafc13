"""Churn and subscription-base operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from .aggregates import attach_scalars, count_by_month
from .quantiles import median_table
from .revenue import customer_ltv

DEC_SUM = "decimal(28,2)"


# ------------------------------------------------------------------ A1, A26
def churn_distribution(customers: DataFrame) -> DataFrame:
    """A1: per (subscription_type, churn): customers, mean and median
    support calls (median = continuous 0.5 percentile, nulls ignored)."""
    keys = ["subscription_type", "churn"]
    x = F.col("support_calls").cast("double")
    base = customers.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_customers"),
                                        F.avg(x).alias("avg_support_calls"))
    med = median_table(customers, "support_calls", keys, name="median_support_calls")
    # null-safe key match: SQL groups a null plan too
    return (base.join(med, [base[k].eqNullSafe(med[k]) for k in keys], "left")
            .select(*[base[k] for k in keys], "total_customers", "avg_support_calls",
                    "median_support_calls"))


def churn_by_plan_series(customers: DataFrame, labels: list[int] | None = None) -> DataFrame:
    """A1 as bar-chart series: one row per plan, one column per
    (statistic, churn label), e.g. ``total_customers_1``.  The pivot runs
    on A1's small result; without ``labels`` every label in the data gets
    its columns."""
    dist = churn_distribution(customers)
    stats = ["total_customers", "avg_support_calls", "median_support_calls"]
    wide = (dist.groupBy("subscription_type").pivot("churn", labels)
            .agg(*[F.first(c).alias(c) for c in stats]))
    names = ["subscription_type"]
    for c in wide.columns[1:]:
        label, stat = c.split("_", 1)
        names.append(f"{stat}_{label}")
    return wide.toDF(*names)


# ------------------------------------------------------------------ A5, A6
def subscriptions_per_customer(subscriptions: DataFrame) -> DataFrame:
    """Number of subscriptions of each customer (null customer excluded)."""
    return (subscriptions.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id").agg(F.count(F.lit(1)).alias("subscriptions")))


def subscriptions_per_customer_summary(subscriptions: DataFrame) -> DataFrame:
    """A5: mean and median number of subscriptions per customer."""
    per = subscriptions_per_customer(subscriptions)
    mean = per.agg(F.avg("subscriptions").alias("avg_subscriptions"))
    med = median_table(per, "subscriptions", name="median_subscriptions")
    return attach_scalars(mean, med)


def count_of_counts(subscriptions: DataFrame) -> DataFrame:
    """Customers by number of subscriptions, sorted by that number
    (O1: ascending ``orderBy`` on the small result only)."""
    per = subscriptions_per_customer(subscriptions)
    return (per.groupBy("subscriptions").agg(F.count(F.lit(1)).alias("customers"))
            .orderBy("subscriptions"))


# ------------------------------------------------------------------ A7
def subscription_durations(subscriptions: DataFrame, as_of: _dt.date = config.AS_OF) -> DataFrame:
    """Per subscription: days from start to end (ended) or to ``as_of``
    (active).  -> subscription_id, ended_days, active_days."""
    as_of_d = F.lit(as_of).cast("date")
    return subscriptions.select(
        "subscription_id",
        F.datediff("end_date", "start_date").alias("ended_days"),
        F.when(F.col("is_active"), F.datediff(as_of_d, "start_date")).alias("active_days"))


def subscription_duration_summary(subscriptions: DataFrame,
                                  as_of: _dt.date = config.AS_OF) -> DataFrame:
    """Mean duration of ended and of active subscriptions, in days."""
    d = subscription_durations(subscriptions, as_of)
    return d.agg(
        F.avg("ended_days").alias("avg_ended_days"),
        F.count("ended_days").alias("ended_subscriptions"),
        F.avg("active_days").alias("avg_active_days"),
        F.count("active_days").alias("active_subscriptions"))


# ------------------------------------------------------------------ A17-A19
def ended_subscriptions(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions with an end date."""
    return subscriptions.where(F.col("end_date").isNotNull())


def churned_monthly(subscriptions: DataFrame) -> DataFrame:
    """Ended subscriptions per end month."""
    return count_by_month(subscriptions, "end_date", "churned_subscriptions")


def churned_by(subscriptions: DataFrame, dimension: str) -> DataFrame:
    """Ended subscriptions per plan or contract (null keys excluded)."""
    return (ended_subscriptions(subscriptions)
            .where(F.col(dimension).isNotNull())
            .groupBy(dimension).agg(F.count(F.lit(1)).alias("churned_subscriptions")))


def churn_rate_total(subscriptions: DataFrame) -> DataFrame:
    """Ended subscriptions over all subscriptions, in percent."""
    return subscriptions.agg(
        F.count_if(F.col("end_date").isNotNull()).alias("churned_subscriptions"),
        F.count(F.lit(1)).alias("total_subscriptions"),
    ).withColumn("churn_rate_pct", F.try_divide(F.col("churned_subscriptions") * 100,
                                                F.col("total_subscriptions")))


# ------------------------------------------------------------------ A22
def missing_and_range(subscriptions: DataFrame) -> DataFrame:
    """First and last start date; missing end dates, count and percent."""
    return subscriptions.agg(
        F.min("start_date").alias("first_start_date"),
        F.max("start_date").alias("last_start_date"),
        F.count_if(F.col("end_date").isNull()).alias("missing_end_dates"),
        F.count(F.lit(1)).alias("n"),
    ).select("first_start_date", "last_start_date", "missing_end_dates",
             F.try_divide(F.col("missing_end_dates") * 100, F.col("n")).alias("missing_end_pct"))


# ------------------------------------------------------------------ A20
# fixed values: the labels of the summary table
KPI_NAMES = [
    "Total Subscriptions", "Total Invoices", "Unique Customers",
    "Total Revenue", "Average Invoice Amount", "Active Subscriptions",
    "Churned Subscriptions", "Churn Rate (%)", "Late Payment Rate (%)",
    "Average Customer Lifetime Value", "Average Subscriptions per Customer",
]


def kpi_summary(subscriptions: DataFrame, invoices: DataFrame) -> DataFrame:
    """The eleven (metric, value) rows of the summary table.

    Three one-row aggregates (subscriptions, invoices, lifetime values) are
    unpivoted and unioned: no join between them.
    """
    s = subscriptions.agg(
        F.count(F.lit(1)).alias("subs"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(F.col("is_active")).alias("active"),
        F.count_if(F.col("end_date").isNotNull()).alias("ended"),
        F.count("customer_id").alias("subs_with_customer"))
    i = invoices.agg(
        F.count(F.lit(1)).alias("invoices"),
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("revenue"),
        F.count("amount").alias("amounts"),
        F.count_if(F.col("paid_late")).alias("late"))
    ltv = customer_ltv(invoices, subscriptions).agg(
        F.sum(F.col("lifetime_value").cast(DEC_SUM)).alias("ltv_sum"),
        F.count(F.lit(1)).alias("ltv_n"))
    # customers with at least one subscription (the per-customer groups)
    per_cust = (subscriptions.where(F.col("customer_id").isNotNull())
                .groupBy("customer_id").count()
                .agg(F.count(F.lit(1)).alias("groups"), F.sum("count").alias("members")))

    def rows(frame, pairs):
        body = ", ".join(f"'{k}', CAST({v} AS DOUBLE)" for k, v in pairs)
        return frame.select(F.expr(f"stack({len(pairs)}, {body}) AS (metric, value)"))

    n = KPI_NAMES
    return (rows(s, [(n[0], "subs"), (n[2], "customers"), (n[5], "active"), (n[6], "ended"),
                     (n[7], "try_divide(ended * 100, subs)")])
            .unionByName(rows(i, [(n[1], "invoices"), (n[3], "coalesce(revenue, 0)"),
                                  (n[4], "try_divide(CAST(revenue AS DOUBLE), amounts)"),
                                  (n[8], "try_divide(late * 100, invoices)")]))
            .unionByName(rows(ltv, [(n[9], "try_divide(CAST(ltv_sum AS DOUBLE), ltv_n)")]))
            .unionByName(rows(per_cust, [(n[10], "try_divide(members, groups)")])))
