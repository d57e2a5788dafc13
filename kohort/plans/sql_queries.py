"""Queries written as SQL text over DataFrames.

The retention rate once more, as SQL: it exists for S2 and as the comparison
point for the aggregate-first flagship (same result, more shuffled data: see
``tools/plan_stats.py``).
"""

from __future__ import annotations

from ..sources import mart
from ..sources.tables import Tables, query_scan
from .catalog import ORACLE, register

RATE_SQL = """
SELECT add_months(DATE'1970-01-01', began) AS cohort_month, nth AS cohort_index, people AS num_customers,
       began_with AS cohort_size,
       CAST(round(CAST(people AS DECIMAL(20,0)) / began_with, :digits) AS DOUBLE) AS retention_rate
FROM (
  SELECT began, nth, count(*) AS people, max(if(nth = 1, count(*), NULL)) OVER (PARTITION BY began) AS began_with
  FROM (
    SELECT CAST(active - min(active) OVER (PARTITION BY customer_id) + 1 AS INT) AS nth,
           CAST(min(active) OVER (PARTITION BY customer_id) AS INT) AS began
    FROM (
      SELECT DISTINCT customer_id,
             (year(invoice_date) - 1970) * 12 + month(invoice_date) - 1 AS active
      FROM {invoices} JOIN {subscriptions} USING (subscription_id)
      WHERE customer_id IS NOT NULL
    )
  )
  GROUP BY began, nth
)
"""


@register("retention_rate_sql", "S2")
def retention_rate_sql(t: Tables):
    """The linear-index retention rate as SQL text."""
    frames = {"invoices": mart.invoices(t, with_late=False),
              "subscriptions": mart.subscriptions(t, with_contract=False)}
    return query_scan(t.spark, RATE_SQL, frames, args={"digits": 3})


def _share_oracle() -> None:
    # same result as the DataFrame flagship, so the same DuckDB twin
    from . import cohort_queries  # noqa: F401
    ORACLE["retention_rate_sql"] = ORACLE["retention_rate_linear"]


_share_oracle()
