"""Registered cohort and retention queries (C1-C13) with their SQL oracles."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from .. import config
from ..operators import cohort_state
from ..operators import cohorts as C
from ..session import checkpoint_dir
from ..sources import mart
from ..sources.tables import Tables
from .catalog import register
from .oracle_mart import invoices_cte, subscriptions_cte

SUBS = subscriptions_cte()
INV = invoices_cte()
STATE_SPLIT = _dt.date(1998, 6, 17)  # between the two batches of the stored state
AS_OF = f"DATE '{config.AS_OF.isoformat()}'"

# The definition, month by month: every customer's distinct months are
# numbered linearly, the smallest of them starts the cohort, and counts by
# (start, distance) give everything else.
_ACTIVE = f"""WITH {SUBS},
{INV},
active AS (
  SELECT DISTINCT s.customer_id, s.subscription_type AS plan,
         year(i.invoice_date) * 12 + month(i.invoice_date) - 1 AS m
  FROM subscriptions s, invoices i WHERE s.subscription_id = i.subscription_id AND s.customer_id IS NOT NULL
),
placed AS (
  SELECT customer_id, plan, m, min(m) OVER (PARTITION BY customer_id) AS start FROM active
)"""


def _month(number: str) -> str:
    return f"make_date(({number}) // 12, ({number}) % 12 + 1, 1)"


_DISTANCE = {"linear": "CAST(m - start + 1 AS INTEGER)", "age": "CAST((m - start) % 12 + 1 AS INTEGER)"}


def _counts_sql(mode: str, plan: str = "") -> str:
    """``counted``: [plan,] start, cohort_index, num_customers."""
    key = f"{plan}, " if plan else ""
    return f"""{_ACTIVE},
counted AS (
  SELECT {key}start, {_DISTANCE[mode]} AS cohort_index, count(DISTINCT customer_id) AS num_customers
  FROM placed GROUP BY ALL
)"""


def _rates_sql(mode: str, plan: str = "") -> str:
    """``rates``: the rate is rounded half up by integer arithmetic, in thousandths."""
    key = f"{plan} AS subscription_type, " if plan else ""
    return f"""{_counts_sql(mode, plan)},
sized AS (
  SELECT *, max(num_customers) FILTER (WHERE cohort_index = 1) OVER (PARTITION BY {plan + ", " if plan else ""}start) AS n
  FROM counted
),
rates AS (
  SELECT {key}{_month("start")} AS cohort_month, cohort_index, num_customers, n AS cohort_size,
         CAST((2000 * num_customers + n) // (2 * n) AS DOUBLE) / 1000 AS retention_rate
  FROM sized WHERE n IS NOT NULL
)"""


_PLAN_RATES_SQL = _rates_sql("linear", "plan")

_MEAN = "sum(CAST(round(retention_rate * 1000) AS BIGINT)) / (count(retention_rate) * 1000)"


def _inv(t: Tables):
    return mart.invoices(t, with_late=False)


def _subs(t: Tables):
    return mart.subscriptions(t, with_contract=False)


@register("cohort_acquisition", "C1", f"""WITH {SUBS}
SELECT customer_id, CAST(date_trunc('month', min(CAST(start_date AS DATE))) AS DATE) AS acquisition_month
FROM subscriptions WHERE customer_id IS NOT NULL GROUP BY customer_id""")
def cohort_acquisition(t: Tables):
    """Acquisition month per customer."""
    return C.acquisition_cohorts(_subs(t))


@register("cohort_first_invoice", "C2", f"{_ACTIVE}\nSELECT DISTINCT customer_id, {_month('start')} AS cohort_month FROM placed")
def cohort_first_invoice(t: Tables):
    """First invoice month per customer."""
    return C.first_invoice_cohorts(_inv(t), _subs(t))


@register("cohort_index_rows", "C3", f"""{_ACTIVE},
starts AS (SELECT DISTINCT customer_id, start FROM placed)
SELECT customer_id, {_month("m")} AS invoice_month, {_month("start")} AS cohort_month, {_DISTANCE["linear"]} AS cohort_index
FROM (SELECT s.customer_id, year(i.invoice_date) * 12 + month(i.invoice_date) - 1 AS m
      FROM subscriptions s, invoices i WHERE s.subscription_id = i.subscription_id) JOIN starts USING (customer_id)""")
def cohort_index_rows(t: Tables):
    """One row per invoice with its linear cohort index."""
    return C.cohort_index_rows(_inv(t), _subs(t), "linear")


@register("retention_counts_linear", "C4", f"{_counts_sql('linear')}\nSELECT {_month('start')} AS cohort_month, cohort_index, num_customers FROM counted")
def retention_counts_linear(t: Tables):
    """C4, linear index."""
    return C.retention_counts(_inv(t), _subs(t), "linear")


@register("retention_counts_age", "C4", f"{_counts_sql('age')}\nSELECT {_month('start')} AS cohort_month, cohort_index, num_customers FROM counted")
def retention_counts_age(t: Tables):
    """C4, index = months part of the age interval (wraps at 12)."""
    return C.retention_counts(_inv(t), _subs(t), "age")


@register("retention_rate_linear", "C5", f"{_rates_sql('linear')}\nSELECT * FROM rates")
def retention_rate_linear(t: Tables):
    """C5 (flagship), linear index."""
    return C.retention_rates(_inv(t), _subs(t), "linear")


@register("retention_rate_age", "C5", f"{_rates_sql('age')}\nSELECT * FROM rates")
def retention_rate_age(t: Tables):
    """C5 with the age-interval index, as the original rate query."""
    return C.retention_rates(_inv(t), _subs(t), "age")


@register("retention_rate_by_plan", "C6", f"{_PLAN_RATES_SQL}\nSELECT * FROM rates")
def retention_rate_by_plan(t: Tables):
    """Retention by subscription type."""
    return C.retention_rates_by_plan(_inv(t), _subs(t))


def _stored(t: Tables):
    """Month words from batches that come late, in any order and twice."""
    path = f"{checkpoint_dir(t.spark).rstrip('/')}/cohort-state-{uuid.uuid4().hex}"
    inv, subs = _inv(t), _subs(t)
    newer = F.col("invoice_date") >= F.lit(STATE_SPLIT)
    cohort_state.append(inv.where(newer), subs, path)
    cohort_state.append(inv.where(~newer), subs, path)
    cohort_state.compact(t.spark, path)
    cohort_state.append(inv.where(newer), subs, path)
    return cohort_state.words(t.spark, path)


@register("retention_counts_stored", "C4", f"{_counts_sql('linear')}\nSELECT {_month('start')} AS cohort_month, cohort_index, num_customers FROM counted")
def retention_counts_stored(t: Tables):
    """C4 from stored words: the full run's counts, though batches came out of order and one came twice."""
    return C.counts_from_words(_stored(t), "linear")


@register("retention_rate_by_plan_stored", "C6", f"{_PLAN_RATES_SQL}\nSELECT * FROM rates")
def retention_rate_by_plan_stored(t: Tables):
    """C6 from stored words."""
    return C.plan_rates_from_words(_stored(t))


_MATRIX_COLS = ",\n  ".join(
    f"avg(retention_rate) FILTER (WHERE cohort_index = {i}) AS m{i}" for i in range(1, 13))


@register("retention_matrix", "C7", f"""{_rates_sql('age')}
SELECT cohort_month,
  {_MATRIX_COLS}
FROM rates GROUP BY cohort_month""")
def retention_matrix(t: Tables):
    """Cohort x index matrix of the age-mode rates (indexes 1..12)."""
    rates = C.retention_rates(_inv(t), _subs(t), "age")
    return C.retention_matrix(rates, list(range(1, 13)))


# every index that the mart's calendar can hold: from its first order month
# (1995-01) to AS_OF; the operator fails on any other
MATRIX_INDEXES = list(range(1, (config.AS_OF.year - config.FIRST_YEAR) * 12 + config.AS_OF.month + 1))
_MATRIX_BY_PLAN = ",\n  ".join(
    f"avg(retention_rate) FILTER (WHERE cohort_index = {i}) AS m{i}" for i in MATRIX_INDEXES)


@register("retention_matrix_by_plan", "C7", f"""{_PLAN_RATES_SQL}
SELECT subscription_type, cohort_month,
  {_MATRIX_BY_PLAN}
FROM rates GROUP BY subscription_type, cohort_month""")
def retention_matrix_by_plan(t: Tables):
    """C7 per plan: (plan, cohort) x index matrix of the linear by-plan
    rates, one column per month of the mart's calendar."""
    rates = C.retention_rates_by_plan(_inv(t), _subs(t))
    return C.retention_matrix(rates, MATRIX_INDEXES, keys=("subscription_type", "cohort_month"))


@register("avg_retention_curve", "C8", f"""{_rates_sql('age')}
SELECT cohort_index, {_MEAN} AS avg_retention_rate FROM rates GROUP BY cohort_index""")
def avg_retention_curve(t: Tables):
    """Mean age-mode rate over cohorts per index."""
    return C.average_retention_curve(C.retention_rates(_inv(t), _subs(t), "age"))


@register("avg_retention_by_plan", "C9", f"""{_PLAN_RATES_SQL}
SELECT subscription_type, cohort_index, {_MEAN} AS avg_retention_rate
FROM rates GROUP BY subscription_type, cohort_index""")
def avg_retention_by_plan(t: Tables):
    """Mean plan rate per (plan, index)."""
    return C.average_retention_by_plan(C.retention_rates_by_plan(_inv(t), _subs(t)))


COHORT_CURVE_PLAN = "1-URGENT"
COHORT_CURVE_MONTH = "1995-01"


@register("cohort_curve", "C10", f"""{_PLAN_RATES_SQL}
SELECT strftime(cohort_month, '%Y-%m') AS cohort_label, cohort_index, retention_rate
FROM rates
WHERE subscription_type = '{COHORT_CURVE_PLAN}' AND cohort_month = DATE '{COHORT_CURVE_MONTH}-01'""")
def cohort_curve(t: Tables):
    """One plan's curve for one cohort month."""
    return C.cohort_curve(C.retention_rates_by_plan(_inv(t), _subs(t)),
                          COHORT_CURVE_PLAN, COHORT_CURVE_MONTH)


@register("retention_drop", "C13", f"""{_rates_sql('age')},
curve AS (SELECT cohort_index, {_MEAN} AS avg_retention_rate FROM rates GROUP BY cohort_index)
SELECT cohort_index, avg_retention_rate,
       lag(avg_retention_rate) OVER (ORDER BY cohort_index) - avg_retention_rate AS retention_drop
FROM curve""")
def retention_drop(t: Tables):
    """Drop of the average curve between consecutive indexes."""
    return C.retention_drop(C.average_retention_curve(C.retention_rates(_inv(t), _subs(t), "age")))


@register("activity_calendar", "C11", f"""WITH {SUBS}
SELECT DISTINCT customer_id, CAST(m AS DATE) AS activity_month
FROM subscriptions,
     unnest(generate_series(CAST(date_trunc('month', start_date) AS DATE),
                            CAST(date_trunc('month', coalesce(end_date, {AS_OF})) AS DATE),
                            INTERVAL 1 MONTH)) AS g(m)
WHERE customer_id IS NOT NULL""")
def activity_calendar(t: Tables):
    """C11: months in which each customer has a running subscription."""
    return C.activity_calendar(_subs(t))


@register("monthly_churn_rate", "C12", f"""WITH {SUBS},
months AS (
  SELECT CAST(m AS DATE) AS month
  FROM (SELECT min(CAST(date_trunc('month', start_date) AS DATE)) AS lo FROM subscriptions),
       unnest(generate_series(lo, CAST(date_trunc('month', {AS_OF}) AS DATE), INTERVAL 1 MONTH)) AS g(m)
)
SELECT m.month,
       CAST(count(s.subscription_id) AS BIGINT) AS active_subscriptions,
       CAST(count(s.subscription_id) FILTER (WHERE CAST(date_trunc('month', s.end_date) AS DATE) = m.month) AS BIGINT)
         AS ended_subscriptions,
       CAST(count(s.subscription_id) FILTER (WHERE CAST(date_trunc('month', s.end_date) AS DATE) = m.month) AS DOUBLE)
         / CAST(count(s.subscription_id) AS DOUBLE) AS churn_rate
FROM months m
LEFT JOIN subscriptions s
  ON CAST(date_trunc('month', s.start_date) AS DATE) <= m.month
 AND CAST(date_trunc('month', coalesce(s.end_date, {AS_OF})) AS DATE) >= m.month
GROUP BY m.month""")
def monthly_churn_rate(t: Tables):
    """Subscriptions ending in a month over those running in it."""
    return C.monthly_churn_rate(_subs(t))
