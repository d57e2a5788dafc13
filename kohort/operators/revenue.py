"""Revenue, lifetime value and payment operators.

Money is summed as DECIMAL (exact, order-independent) and turned into
DOUBLE once at the end.  Every per-dimension revenue first sums invoices
per subscription (partial aggregation), so the join with subscriptions sees
one row per subscription, whatever the skew of the invoice table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start
from .aggregates import attach_scalars
from .quantiles import median_table, quantile_array

MONEY = "decimal(18,2)"
DEC_SUM = "decimal(28,2)"


def _exact_sum(col: str):
    return F.sum(F.col(col).cast(MONEY))


def _mean(sum_col, count_col):
    return F.try_divide(F.col(sum_col).cast("double"), F.col(count_col))


# ------------------------------------------------------------------ J5
def joined_invoices(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Every invoice with its subscription's attributes (left join)."""
    attrs = subscriptions.select("subscription_id", "customer_id", "subscription_type",
                                 "contract_length", "is_active")
    return invoices.join(attrs, "subscription_id", "left")


def revenue_per_subscription(invoices: DataFrame) -> DataFrame:
    """Invoice totals folded per subscription (exact decimal sum)."""
    return (invoices.groupBy("subscription_id")
            .agg(_exact_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("invoices")))


# ------------------------------------------------------------------ A8
def invoice_totals(invoices: DataFrame) -> DataFrame:
    """Total, mean and median invoice amount -> one row."""
    x = F.col("amount")
    agg = invoices.agg(_exact_sum("amount").alias("s"), F.count(x).alias("n"))
    med = median_table(invoices, "amount", name="median_amount")
    return attach_scalars(agg, med).select(
        F.col("s").cast("double").alias("total_revenue"),
        _mean("s", "n").alias("avg_amount"),
        F.round("median_amount", 6).alias("median_amount"))


# ------------------------------------------------------------------ A12, A13
def monthly_revenue(invoices: DataFrame) -> DataFrame:
    """Revenue, invoice count and mean amount per invoice month."""
    return (invoices.groupBy(month_start("invoice_date").alias("month"))
            .agg(_exact_sum("amount").alias("s"), F.count(F.lit(1)).alias("invoices"))
            .select("month", F.col("s").cast("double").alias("revenue"), "invoices",
                    _mean("s", "invoices").alias("avg_amount")))


def monthly_range(invoices: DataFrame) -> DataFrame:
    """Range and mean of monthly revenue and of monthly invoice counts."""
    per_month = (invoices.groupBy(month_start("invoice_date").alias("month"))
                 .agg(_exact_sum("amount").alias("s"), F.count(F.lit(1)).alias("n")))
    out = per_month.agg(
        F.min("s").alias("lo"), F.max("s").alias("hi"), F.sum("s").alias("tot"),
        F.count(F.lit(1)).alias("months"),
        F.min("n").alias("min_invoices"), F.max("n").alias("max_invoices"),
        F.sum("n").alias("all_invoices"))
    return out.select(
        F.col("lo").cast("double").alias("min_monthly_revenue"),
        F.col("hi").cast("double").alias("max_monthly_revenue"),
        _mean("tot", "months").alias("avg_monthly_revenue"),
        "min_invoices", "max_invoices",
        F.try_divide(F.col("all_invoices"), F.col("months")).alias("avg_monthly_invoices"))


# ------------------------------------------------------------------ A14
def revenue_by(invoices: DataFrame, subscriptions: DataFrame, dimension: str) -> DataFrame:
    """Revenue by a subscription attribute (plan, contract, active).

    Null dimension values form no group.  -> <dimension>, revenue.
    """
    per_sub = revenue_per_subscription(invoices)
    attrs = subscriptions.select("subscription_id", dimension)
    return (per_sub.join(attrs, "subscription_id", "left")
            .where(F.col(dimension).isNotNull())
            .groupBy(dimension)
            .agg(F.sum("revenue").cast("double").alias("revenue")))


# ------------------------------------------------------------------ A15, A16, O3
def customer_ltv(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Lifetime value (sum of invoice amounts) per customer."""
    per_sub = revenue_per_subscription(invoices)
    owners = subscriptions.select("subscription_id", "customer_id")
    return (per_sub.join(owners, "subscription_id", "left")
            .where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.sum("revenue").alias("ltv"))
            .select("customer_id", F.col("ltv").cast("double").alias("lifetime_value")))


def ltv_summary(ltv: DataFrame, quantile: float = 0.9) -> DataFrame:
    """Mean, median, ``quantile`` (linear interpolation) and maximum.

    Quantiles are exact without gathering all customers in one task (see
    :mod:`kohort.operators.quantiles`).
    """
    x = F.col("lifetime_value")
    agg = ltv.agg(F.sum(x.cast(DEC_SUM)).alias("s"), F.count(x).alias("n"), F.max(x).alias("max_ltv"))
    q = quantile_array(ltv, "lifetime_value", [0.5, quantile], name="q")
    return attach_scalars(agg, q).select(
        _mean("s", "n").alias("avg_ltv"),
        F.round(F.col("q")[0], 6).alias("median_ltv"),
        F.round(F.col("q")[1], 6).alias("p90_ltv"),
        "max_ltv")


def top_customers(ltv: DataFrame, k: int = 20) -> DataFrame:
    """O3: the ``k`` customers with the highest lifetime value (top-k; ties
    broken by customer id).  O2, the descending sort by value, is the same
    ordering without the limit."""
    return ltv.orderBy(F.desc("lifetime_value"), F.asc("customer_id")).limit(k)


# ------------------------------------------------------------------ A21
def payment_rates(invoices: DataFrame) -> DataFrame:
    """On-time, late and pending shares of invoices, in percent."""
    agg = invoices.agg(F.count(F.lit(1)).alias("n"),
                       F.count_if(~F.col("paid_late")).alias("on_time"),
                       F.count_if(F.col("paid_late")).alias("late"),
                       F.count_if(F.col("status") == "Pending").alias("pending"))
    return agg.select(*[F.try_divide(F.col(c) * 100, F.col("n")).alias(f"{c}_pct")
                        for c in ["on_time", "late", "pending"]])

