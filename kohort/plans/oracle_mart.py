"""DuckDB text of the business tables, for the SQL oracle.

The same mapping as :mod:`kohort.sources.mart`, written independently in
SQL so the oracle re-derives every table from the base views.  Each oracle
query starts with ``WITH`` + the CTEs it needs.
"""

from __future__ import annotations

import datetime as _dt

from .. import config


def _d(d: _dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def subscriptions_cte(cutoff: _dt.date = config.CUTOFF) -> str:
    cut = _d(cutoff)
    return f"""subscriptions AS (
  SELECT CAST(p.o_custkey * 10 + CAST(substr(p.o_orderpriority, 1, 1) AS INTEGER) AS BIGINT) AS subscription_id,
         p.o_custkey AS customer_id,
         p.o_orderpriority AS subscription_type,
         c.c_mktsegment AS contract_length,
         p.start_date,
         CASE WHEN p.last_date < {cut} THEN p.last_date END AS end_date,
         p.last_date >= {cut} AS is_active
  FROM (SELECT o_custkey, o_orderpriority,
               min(CAST(o_orderdate AS DATE)) AS start_date,
               max(CAST(o_orderdate AS DATE)) AS last_date
        FROM orders GROUP BY o_custkey, o_orderpriority) p
  LEFT JOIN customer c ON c.c_custkey = p.o_custkey
)"""


def invoices_cte() -> str:
    return f"""ships AS (
  SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS ship_date FROM lineitem GROUP BY l_orderkey
),
invoices AS (
  SELECT o.o_orderkey AS invoice_id,
         CAST(o.o_custkey * 10 + CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS BIGINT) AS subscription_id,
         CAST(o.o_orderdate AS DATE) AS invoice_date,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount,
         coalesce(date_diff('day', CAST(o.o_orderdate AS DATE), s.ship_date) > {config.LATE_DAYS}, false) AS paid_late,
         CASE o.o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Partial' END AS status
  FROM orders o LEFT JOIN ships s ON s.l_orderkey = o.o_orderkey
)"""


def customers_cte(name: str = "customers", cutoff: _dt.date = config.CUTOFF,
                  with_ships: bool = False) -> str:
    cut = _d(cutoff)
    ships = ("ships AS (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS ship_date "
             "FROM lineitem GROUP BY l_orderkey),\n") if with_ships else ""
    return f"""{ships}{name} AS (
  SELECT f.o_custkey AS customerid,
         CAST({config.AGE_BASE} + f.o_custkey % {config.AGE_SPAN} AS INTEGER) AS age,
         CASE WHEN f.o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST((year({cut}) * 12 + month({cut})) - (year(f.first_d) * 12 + month(f.first_d)) AS INTEGER) AS tenure,
         CAST(f.n_orders AS DOUBLE) AS usage_frequency,
         e.support_calls,
         CAST(f.payment_delay AS DOUBLE) AS payment_delay,
         CAST(f.spend AS DOUBLE) AS total_spend,
         CAST(date_diff('day', f.last_d, {cut}) AS DOUBLE) AS last_interaction,
         f.subscription_type,
         c.c_mktsegment AS contract_length,
         CAST(CASE WHEN a.o_custkey IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churn
  FROM (SELECT o.o_custkey,
               min(CAST(o.o_orderdate AS DATE)) AS first_d,
               max(CAST(o.o_orderdate AS DATE)) AS last_d,
               count(*) AS n_orders,
               avg(greatest(date_diff('day', CAST(o.o_orderdate AS DATE), s.ship_date), 0)) AS payment_delay,
               sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS spend,
               arg_max(o.o_orderpriority, (CAST(o.o_orderdate AS DATE), o.o_orderkey)) AS subscription_type
        FROM orders o LEFT JOIN ships s ON s.l_orderkey = o.o_orderkey
        WHERE CAST(o.o_orderdate AS DATE) <= {cut}
        GROUP BY o.o_custkey) f
  LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) > {cut}) a
         ON a.o_custkey = f.o_custkey
  LEFT JOIN (SELECT user_id, CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS support_calls
             FROM events GROUP BY user_id) e ON e.user_id = f.o_custkey
  JOIN customer c ON c.c_custkey = f.o_custkey
)"""
