"""Cohort and retention operators.

Plan shape, chosen for very large invoice tables with hot keys:

* retention counts (C4-C6) join invoices to subscriptions once, then
  fold each customer's invoice months into bitmap words of 62 months, one
  row per word: a fixed-width hash aggregate that folds a hot customer
  map-side, whatever the dates.  Cohort month and indexes come from
  functions on the words, so there is no join back and no window over
  invoice rows;
* the first invoice month per customer (C2) is an aggregate over
  invoices folded per subscription, never a window over raw rows;
* the per-invoice index rows (C3) need every invoice: a sort-merge join
  on ``subscription_id`` (AQE splits a hot subscription) with a table of
  one row per subscription;
* cohort sizes come from the index-1 counts of the (small) count table
  through a window, not from a second pass over invoices: every cohort
  member has an invoice in its cohort month.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import cohort_index, month_number, month_start
from ..functions.numeric import ratio_rounded


# ---------------------------------------------------------------- C1, C2
def acquisition_cohorts(subscriptions: DataFrame) -> DataFrame:
    """First subscription start per customer, as a month.

    -> customer_id, acquisition_month, by month and
    customer.  Null customer ids form no cohort.
    """
    return (subscriptions
            .where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(month_start(F.min(F.col("start_date").cast("date"))).alias("acquisition_month"))
            .orderBy("acquisition_month", "customer_id"))


def _plan_customers(subscriptions: DataFrame, with_plan: bool = False) -> DataFrame:
    cols = ["subscription_id", "customer_id"] + (["subscription_type"] if with_plan else [])
    return subscriptions.select(*cols).where(F.col("customer_id").isNotNull())


def first_invoice_cohorts(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Month of the first invoice per customer -> customer_id, cohort_month.

    Invoices are folded to one row per subscription before the join, so the
    join and the per-customer minimum see at most (plans per customer) rows.
    """
    per_sub = (invoices.groupBy("subscription_id")
               .agg(F.min("invoice_date").alias("first_date")))
    return (per_sub.join(_plan_customers(subscriptions), "subscription_id")
            .groupBy("customer_id")
            .agg(month_start(F.min("first_date")).alias("cohort_month")))


def subscription_cohorts(invoices: DataFrame, subscriptions: DataFrame,
                         with_plan: bool = False) -> DataFrame:
    """Each subscription with its customer's cohort month (J2: join of the
    per-customer first-month aggregate on ``customer_id``; both sides have
    one row per subscription or customer).

    -> subscription_id, customer_id[, subscription_type], cohort_month.
    """
    subs = _plan_customers(subscriptions, with_plan)
    return subs.join(first_invoice_cohorts(invoices, subscriptions), "customer_id")


def _invoice_months(invoices: DataFrame, invoice_cohorts: DataFrame) -> DataFrame:
    # Invoices x subscriptions (inner, ``subscription_id``)
    return (invoices
            .select("subscription_id", month_start("invoice_date").alias("invoice_month"))
            .join(invoice_cohorts, "subscription_id"))


# ---------------------------------------------------------------- C3
def cohort_index_rows(invoices: DataFrame, subscriptions: DataFrame,
                      mode: str = "linear") -> DataFrame:
    """One row per invoice (no dedupe) with its cohort and index.

    -> customer_id, invoice_month, cohort_month, cohort_index.
    """
    rows = _invoice_months(invoices, subscription_cohorts(invoices, subscriptions))
    return rows.select(
        "customer_id", "invoice_month", "cohort_month",
        cohort_index("invoice_month", "cohort_month", mode).alias("cohort_index"))


# ---------------------------------------------------------------- C4, C5
MONTHS_PER_WORD = 62


def month_words(invoices: DataFrame, subscriptions: DataFrame, with_plan: bool = False) -> DataFrame:
    """Invoice months of each customer (per plan if asked) as bitmap words.

    -> customer_id, [subscription_type,] word, bits: bit ``b`` of word ``w``
    stands for linear month ``62 w + b`` (see :func:`month_number`).  Words
    are rows, so the plan is the same for any dates, and a stray date of year
    1 or 9999 costs one row.  One join on ``subscription_id`` (J1: Spark
    broadcasts a small subscription table, else sort-merge with AQE splitting
    a hot subscription) and one hash aggregate of fixed-width state, folded
    map-side.  Invoices without a date are in no month.
    """
    keys = ["customer_id"] + (["subscription_type"] if with_plan else [])
    inv = invoices.select("subscription_id", month_number("invoice_date").alias("m")).where(F.col("m").isNotNull())
    word = F.expr(f"cast((m - pmod(m, {MONTHS_PER_WORD})) div {MONTHS_PER_WORD} as int)")
    bit = F.expr(f"shiftleft(1L, pmod(m, {MONTHS_PER_WORD}))")
    return (inv.join(_plan_customers(subscriptions, with_plan), "subscription_id")
            .groupBy(*keys, word.alias("word")).agg(F.bit_or(bit).alias("bits")))


def merge_words(words: DataFrame) -> DataFrame:
    """One row per key and word: repeated or partial words are OR-ed together."""
    return words.groupBy(*[c for c in words.columns if c != "bits"]).agg(F.bit_or("bits").alias("bits"))


def _set_bits(bits: str, n: int) -> str:
    return f"filter(sequence(0, {n - 1}), b -> getbit({bits}, b) = 1)"


def word_counts(words: DataFrame, mode: str = "linear") -> DataFrame:
    """Distinct customers per (cohort, index) [and plan] from merged words.

    The cohort is the customer's first month over all plans.  In ``linear``
    mode every month is an index of its own; in ``age`` mode months twelve
    apart share one, so each customer's indexes are folded into twelve bits.
    -> [subscription_type,] cohort (linear month), cohort_index, num_customers.
    """
    if mode not in ("linear", "age"):
        raise ValueError(f"unknown cohort index mode {mode!r}")
    plan = [c for c in words.columns if c == "subscription_type"]
    first = F.expr(f"word * {MONTHS_PER_WORD} + bit_count((bits & -bits) - 1)")
    placed = words.withColumn("cohort", F.min(first).over(Window.partitionBy("customer_id")))
    since = f"word * {MONTHS_PER_WORD} + b - cohort"
    months = _set_bits("bits", MONTHS_PER_WORD)
    if mode == "linear":
        rows = placed.select(*plan, "cohort", F.explode(F.expr(f"transform({months}, b -> cast({since} + 1 as int))")).alias("cohort_index"))
    else:
        mask = F.expr(f"aggregate({months}, 0, (a, b) -> a | shiftleft(1, pmod({since}, 12)))")
        folded = placed.groupBy("customer_id", *plan, "cohort").agg(F.bit_or(mask).alias("ages"))
        rows = folded.select(*plan, "cohort", F.explode(F.expr(f"transform({_set_bits('ages', 12)}, b -> b + 1)")).alias("cohort_index"))
    return rows.groupBy(*plan, "cohort", "cohort_index").agg(F.count(F.lit(1)).alias("num_customers"))


def _month_date(number):
    """First day of a linear month number."""
    return F.expr(f"make_date(cast(({number} - 1) div 12 as int), cast(pmod({number} - 1, 12) + 1 as int), 1)")


def retention_counts(invoices: DataFrame, subscriptions: DataFrame,
                     mode: str = "linear") -> DataFrame:
    """C4: distinct customers per (cohort_month, cohort_index).

    The cohort is the customer's first invoice month; each customer counts
    once per index (in ``age`` mode months 0 and 12 are both index 1).
    -> cohort_month, cohort_index, num_customers, in that order (O1; a sort
    of the count table).
    """
    return counts_from_words(month_words(invoices, subscriptions), mode)


def counts_from_words(words: DataFrame, mode: str = "linear") -> DataFrame:
    """C4 from merged month words (see :mod:`.cohort_state`)."""
    return _counts(words, mode).orderBy("cohort_month", "cohort_index")


def _counts(words: DataFrame, mode: str) -> DataFrame:
    # J2 on the customer's own months: the first-month aggregate is never joined back
    if "subscription_type" in words.columns:
        words = merge_words(words.drop("subscription_type"))
    return word_counts(words, mode).select(_month_date("cohort").alias("cohort_month"), "cohort_index", "num_customers")


def _with_size(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the index-1 count of each cohort as its size; cohorts without
    an index-1 row are dropped (inner-join semantics).  The window runs
    over the count table (cohorts x indexes).  This replaces J3 (counts
    joined to sizes on ``cohort_month``) and J4 (the same on
    ``subscription_type, cohort_month``) without a second aggregate."""
    w = Window.partitionBy(*keys)
    size = F.max(F.when(F.col("cohort_index") == 1, F.col("num_customers"))).over(w)
    return (counts.withColumn("cohort_size", size)
            .where(F.col("cohort_size").isNotNull())
            .withColumn("retention_rate", ratio_rounded("num_customers", "cohort_size", 3)))


def retention_rates(invoices: DataFrame, subscriptions: DataFrame,
                    mode: str = "linear") -> DataFrame:
    """Counts with cohort size and ``round(count / size, 3)``.

    Every cohort member has an invoice in its cohort month, so the size is
    the index-1 count: no second pass over invoices.
    -> cohort_month, cohort_index, num_customers, cohort_size, retention_rate.
    """
    return rates_from_words(month_words(invoices, subscriptions), mode)


def rates_from_words(words: DataFrame, mode: str = "linear") -> DataFrame:
    """C5 from merged month words."""
    return _with_size(_counts(words, mode), ["cohort_month"]).select(
        "cohort_month", "cohort_index", "num_customers", "cohort_size", "retention_rate") \
        .orderBy("cohort_month", "cohort_index")


# ---------------------------------------------------------------- C6
def retention_rates_by_plan(invoices: DataFrame, subscriptions: DataFrame,
                            mode: str = "linear") -> DataFrame:
    """Retention per (subscription_type, cohort_month, cohort_index).

    The cohort month is the customer's first invoice over all plans; the
    size counts the plan's customers at index 1 only, so a rate can exceed
    1 and a plan/cohort pair without index-1 customers is dropped.
    """
    return plan_rates_from_words(month_words(invoices, subscriptions, with_plan=True), mode)


def plan_rates_from_words(words: DataFrame, mode: str = "linear") -> DataFrame:
    """C6 from merged month words by plan."""
    counts = word_counts(words, mode).withColumn("cohort_month", _month_date("cohort"))
    return _with_size(counts, ["subscription_type", "cohort_month"]).select(
        "subscription_type", "cohort_month", "cohort_index", "num_customers",
        "cohort_size", "retention_rate").orderBy("subscription_type", "cohort_month", "cohort_index")


# ---------------------------------------------------------------- C7-C10, C13
def matrix_column(index: int) -> str:
    return f"m{index}"


def retention_matrix(rates: DataFrame, indexes: list[int] | None = None,
                     keys: tuple[str, ...] = ("cohort_month",)) -> DataFrame:
    """Pivot rates to one row per cohort and one column per index.

    ``indexes`` fixes the columns (1..12 for age mode); an index outside
    them is an error, never left out.  Without it Spark first collects the
    distinct indexes (bounded by the number of months).  Duplicate cells are
    averaged; missing cells stay null.
    """
    if indexes is not None:
        known = F.col("cohort_index").isin(list(indexes))
        rates = rates.withColumn("cohort_index", F.when(known, F.col("cohort_index")).otherwise(
            F.raise_error(F.concat(F.lit("cohort index outside the matrix: "), F.col("cohort_index").cast("string"))).cast("int")))
    pivoted = (rates.groupBy(*keys)
               .pivot("cohort_index", indexes)
               .agg(F.avg("retention_rate")))
    return pivoted.toDF(*list(keys), *[matrix_column(int(c)) for c in pivoted.columns[len(keys):]])


def _mean_rate(rates: DataFrame, keys: list[str], name: str) -> DataFrame:
    # rates carry three decimals: sum them exactly as integers of 1/1000
    # and divide once, so the mean does not depend on summation order
    milli = F.round(F.col("retention_rate") * 1000).cast("bigint")
    return (rates.groupBy(*keys)
            .agg((F.sum(milli) / (F.count("retention_rate") * 1000)).alias(name)))


def average_retention_curve(rates: DataFrame) -> DataFrame:
    """Unweighted mean rate over cohorts per index -> cohort_index, avg_retention_rate."""
    return _mean_rate(rates, ["cohort_index"], "avg_retention_rate")


def average_retention_by_plan(rates_by_plan: DataFrame) -> DataFrame:
    """Mean rate per (subscription_type, cohort_index)."""
    return _mean_rate(rates_by_plan, ["subscription_type", "cohort_index"], "avg_retention_rate")


def cohort_curve(rates_by_plan: DataFrame, plan: str, cohort: str | _dt.date) -> DataFrame:
    """The curve of one cohort of one plan, ordered by index (P8
    equality filters on plan and cohort; O1 ascending order at the edge).

    ``cohort`` is a month (``'1995-01'``, a date string or a date).
    -> cohort_label, cohort_index, retention_rate.
    """
    if isinstance(cohort, str) and len(cohort) == 7:
        cohort = cohort + "-01"
    month = F.lit(cohort).cast("date")
    return (rates_by_plan
            .where((F.col("subscription_type") == plan) & (F.col("cohort_month") == month))
            .select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_label"),
                    "cohort_index", "retention_rate")
            .orderBy("cohort_index"))


def retention_drop(curve: DataFrame, value: str = "avg_retention_rate") -> DataFrame:
    """Change of the average curve from one index to the next.

    The input has one row per index (bounded by the number of months), so a
    single ordered window over it is cheap.  ``retention_drop`` is previous
    minus current: positive when retention falls.
    """
    w = Window.orderBy("cohort_index")
    return curve.select(
        "cohort_index", value,
        (F.lag(value).over(w) - F.col(value)).alias("retention_drop"))


# ---------------------------------------------------------------- C11, C12
def _running(subscriptions: DataFrame, as_of: _dt.date) -> DataFrame:
    """First and last running month of each subscription; one without a
    start, or whose last month lies before its first, runs in no month."""
    last = F.coalesce(F.col("end_date"), F.lit(as_of).cast("date"))
    return (subscriptions
            .select("customer_id", month_start("start_date").alias("first"), month_start(last).alias("last"),
                    month_start("end_date").alias("end_month"))
            .where(F.col("first") <= F.col("last")))


def activity_calendar(subscriptions: DataFrame, as_of: _dt.date = config.AS_OF) -> DataFrame:
    """C11: months in which each customer has a subscription running.

    A subscription runs from its start month to the month of its end date,
    or of ``as_of`` while open.  -> customer_id, activity_month (distinct).
    The output is one row per customer-month by definition; the dedupe is
    partial-aggregated map-side.
    """
    return (_running(subscriptions, as_of)
            .where(F.col("customer_id").isNotNull())
            .select("customer_id", F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("activity_month"))
            .distinct())


def monthly_churn_rate(subscriptions: DataFrame, as_of: _dt.date = config.AS_OF) -> DataFrame:
    """Share of running subscriptions that end in each month.

    ``active`` counts subscriptions running in the month (C11's rule),
    ``ended`` those whose end date falls in it.  Computed without expanding
    subscriptions to months: +1 at the start month, -1 after the last
    month, summed per month (partial aggregation), then a running sum over
    the month table, which holds one row per calendar month.
    -> month, active_subscriptions, ended_subscriptions, churn_rate.
    """
    as_of_month = month_start(F.lit(as_of).cast("date"))
    runs = _running(subscriptions, as_of)
    change = lambda month, delta, ended: F.struct(
        month.alias("month"), F.lit(delta).alias("delta"), F.lit(ended).alias("ended"))
    changes = F.array(change(F.col("first"), 1, 0), change(F.add_months("last", 1), -1, 0), change(F.col("end_month"), 0, 1))
    per_month = (runs.select(F.inline(changes)).where(F.col("month").isNotNull())
                 .groupBy("month").agg(F.sum("delta").alias("delta"), F.sum("ended").alias("ended")))
    # fill every month between the first start and as_of (months without
    # any change still have running subscriptions)
    span = (per_month.agg(F.min("month").alias("lo")).where(F.col("lo") <= as_of_month)
            .select(F.explode(F.sequence("lo", as_of_month, F.expr("INTERVAL 1 MONTH"))).alias("month")))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = span.join(per_month, "month", "left").fillna(0, ["delta", "ended"])
    return filled.select(
        "month",
        F.sum("delta").over(w).cast("bigint").alias("active_subscriptions"),
        F.col("ended").cast("bigint").alias("ended_subscriptions"),
    ).withColumn("churn_rate", F.try_divide(F.col("ended_subscriptions").cast("double"),
                                            F.col("active_subscriptions").cast("double")))
