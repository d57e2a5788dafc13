"""Registered aggregation, revenue and churn queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions.dates import month_start
from ..operators import aggregates as A
from ..operators import churn as CH
from ..operators import revenue as R
from ..sources import mart
from ..sources.tables import Tables
from .catalog import register
from .oracle_mart import customers_cte, invoices_cte, subscriptions_cte

SUBS = subscriptions_cte()
INV = invoices_cte()
CUST = customers_cte(with_ships=True)
CUST_AFTER_INV = customers_cte(with_ships=False)
AS_OF = f"DATE '{config.AS_OF.isoformat()}'"
NUM = config.NUMERICAL_FEATURES
NUM_CHURN = NUM + [config.TARGET_COLUMN]

# Values of the test data, for the SQL twins only: the operators take their
# columns from the data, so another plan would show up as another column.
PLANS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CONTRACTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _subs(t: Tables, contract: bool = False):
    return mart.subscriptions(t, with_contract=contract)


def _inv(t: Tables, late: bool = False):
    return mart.invoices(t, with_late=late)


# ---------------------------------------------------------------- A1, A26
@register("churn_distribution", "A1", f"""WITH {CUST}
SELECT subscription_type, churn, count(*) AS total_customers,
       avg(support_calls) AS avg_support_calls,
       quantile_cont(support_calls, 0.5) AS median_support_calls
FROM customers GROUP BY subscription_type, churn""")
def churn_distribution(t: Tables):
    """A1: churn distribution with support-call mean and median."""
    return CH.churn_distribution(mart.customers(t))


_SERIES = ",\n  ".join(
    f"count(*) FILTER (WHERE churn = {k}) AS total_customers_{k},\n"
    f"  avg(support_calls) FILTER (WHERE churn = {k}) AS avg_support_calls_{k},\n"
    f"  quantile_cont(support_calls, 0.5) FILTER (WHERE churn = {k}) AS median_support_calls_{k}"
    for k in (0, 1))


@register("churn_by_plan_series", "A26", f"""WITH {CUST}
SELECT subscription_type,
  {_SERIES}
FROM customers GROUP BY subscription_type""")
def churn_by_plan_series(t: Tables):
    """A1 pivoted on the churn label (bar-chart series)."""
    return CH.churn_by_plan_series(mart.customers(t))


# ---------------------------------------------------------------- A2, P10
def _vc_sql(cte: str, table: str, col: str) -> str:
    return f"""WITH {cte}
SELECT {col} AS value, count(*) AS count, count(*) * 100 / sum(count(*)) OVER () AS share_pct
FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}"""


@register("value_counts_status", "A2", _vc_sql(INV, "invoices", "status"))
def value_counts_status(t: Tables):
    """A2: invoices per status with share."""
    return A.value_counts(_inv(t), "status")


@register("value_counts_plan", "A2", _vc_sql(SUBS, "subscriptions", "subscription_type"))
def value_counts_plan(t: Tables):
    """A2: subscriptions per plan with share."""
    return A.value_counts(_subs(t), "subscription_type")


@register("value_counts_contract", "A2", _vc_sql(SUBS, "subscriptions", "contract_length"))
def value_counts_contract(t: Tables):
    """A2: subscriptions per contract length with share."""
    return A.value_counts(_subs(t, contract=True), "contract_length")


@register("value_counts_active", "A2", _vc_sql(SUBS, "subscriptions", "is_active"))
def value_counts_active(t: Tables):
    """A2: active and inactive subscriptions with share."""
    return A.value_counts(_subs(t), "is_active")


@register("value_counts_late", "A2", _vc_sql(INV, "invoices", "paid_late"))
def value_counts_late(t: Tables):
    """A2: invoices paid late or on time, with share."""
    return A.value_counts(_inv(t, late=True), "paid_late")


@register("distinct_plans", "P10", f"""WITH {SUBS}
SELECT DISTINCT subscription_type FROM subscriptions WHERE subscription_type IS NOT NULL""")
def distinct_plans(t: Tables):
    """P10: the distinct plan names."""
    return A.distinct_values(_subs(t), "subscription_type")


# ---------------------------------------------------------------- A3, A4, A17
_MONTH = "CAST(date_trunc('month', {c}) AS DATE)"


@register("new_subs_monthly", "A3", f"""WITH {SUBS}
SELECT {_MONTH.format(c='start_date')} AS month, count(*) AS new_subscriptions
FROM subscriptions WHERE start_date IS NOT NULL GROUP BY 1""")
def new_subs_monthly(t: Tables):
    """A3: new subscriptions per start month."""
    return A.count_by_month(_subs(t), "start_date", "new_subscriptions")


def _pivot_sql(col: str, values: list[str]) -> str:
    cells = ",\n  ".join(
        f"nullif(count(*) FILTER (WHERE {col} = '{v}'), 0) AS \"{v}\"" for v in values)
    return f"""WITH {SUBS}
SELECT {_MONTH.format(c='start_date')} AS month,
  {cells}
FROM subscriptions WHERE {col} IS NOT NULL GROUP BY 1"""


@register("new_subs_by_plan", "A4", _pivot_sql("subscription_type", PLANS))
def new_subs_by_plan(t: Tables):
    """A4: new subscriptions per month and plan, plans as columns."""
    return A.pivot_counts(_subs(t), month_start("start_date").alias("month"),
                          "subscription_type")


@register("new_subs_by_contract", "A4", _pivot_sql("contract_length", CONTRACTS))
def new_subs_by_contract(t: Tables):
    """A4: new subscriptions per month and contract length."""
    return A.pivot_counts(_subs(t, contract=True), month_start("start_date").alias("month"),
                          "contract_length")


@register("churned_monthly", "A17", f"""WITH {SUBS}
SELECT {_MONTH.format(c='end_date')} AS month, count(*) AS churned_subscriptions
FROM subscriptions WHERE end_date IS NOT NULL GROUP BY 1""")
def churned_monthly(t: Tables):
    """Ended subscriptions per end month."""
    return CH.churned_monthly(_subs(t))


# ---------------------------------------------------------------- A5, A6, A7
_PER_CUST = "(SELECT customer_id, count(*) AS n FROM subscriptions WHERE customer_id IS NOT NULL GROUP BY 1)"


@register("subs_per_customer", "A5", f"""WITH {SUBS}
SELECT avg(n) AS avg_subscriptions, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_subscriptions
FROM {_PER_CUST} p""")
def subs_per_customer(t: Tables):
    """A5: mean and median subscriptions per customer."""
    return CH.subscriptions_per_customer_summary(_subs(t))


@register("subs_count_of_counts", "A6", f"""WITH {SUBS}
SELECT n AS subscriptions, count(*) AS customers FROM {_PER_CUST} p GROUP BY n""")
def subs_count_of_counts(t: Tables):
    """Customers by number of subscriptions."""
    return CH.count_of_counts(_subs(t))


@register("subscription_duration", "A7", f"""WITH {SUBS}
SELECT avg(date_diff('day', start_date, end_date)) AS avg_ended_days,
       count(end_date) AS ended_subscriptions,
       avg(CASE WHEN is_active THEN date_diff('day', start_date, {AS_OF}) END) AS avg_active_days,
       count(CASE WHEN is_active THEN 1 END) AS active_subscriptions
FROM subscriptions""")
def subscription_duration(t: Tables):
    """Mean duration of ended and active subscriptions."""
    return CH.subscription_duration_summary(_subs(t))


# ---------------------------------------------------------------- A8, A9, A10
@register("invoice_totals", "A8", f"""WITH {INV}
SELECT CAST(sum(amount) AS DOUBLE) AS total_revenue,
       CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount,
       round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 6) AS median_amount
FROM invoices""")
def invoice_totals(t: Tables):
    """Total, mean and median invoice amount."""
    return R.invoice_totals(_inv(t))


def _describe_sql(table: str, cols: list[str], by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT {key}'{c}' AS column_name, count({x}) AS count, round(avg({x}), 4) AS mean,
       round(stddev_samp({x}), 4) AS std, min({x}) AS min,
       round(quantile_cont({x}, 0.25), 4) AS p25, round(quantile_cont({x}, 0.5), 4) AS p50,
       round(quantile_cont({x}, 0.75), 4) AS p75, max({x}) AS max
FROM {table}{f' GROUP BY {by}' if by else ''}""")
    return "\nUNION ALL\n".join(parts)


@register("amount_by_status", "A9", f"WITH {INV}\n" + _describe_sql("invoices", ["amount"], "status"))
def amount_by_status(t: Tables):
    """Describe of invoice amount per status."""
    return A.describe(_inv(t), ["amount"], by="status")


@register("numeric_describe", "A10", f"WITH {CUST}\n" + _describe_sql("customers", NUM_CHURN))
def numeric_describe(t: Tables):
    """A10: describe of every numeric customer column."""
    return A.describe(mart.customers(t), NUM_CHURN)


# ---------------------------------------------------------------- A11, A21
@register("status_by_late", "A11", f"""WITH {INV}
SELECT status, count(*) FILTER (WHERE NOT paid_late) AS paid_late_false,
       count(*) FILTER (WHERE paid_late) AS paid_late_true
FROM invoices WHERE paid_late IS NOT NULL GROUP BY status""")
def status_by_late(t: Tables):
    """Invoice status x paid-late counts, zero-filled."""
    return A.crosstab(_inv(t, late=True), "status", "paid_late", [False, True])


@register("payment_rates", "A21", f"""WITH {INV}
SELECT count(*) FILTER (WHERE NOT paid_late) * 100 / count(*) AS on_time_pct,
       count(*) FILTER (WHERE paid_late) * 100 / count(*) AS late_pct,
       count(*) FILTER (WHERE status = 'Pending') * 100 / count(*) AS pending_pct
FROM invoices""")
def payment_rates(t: Tables):
    """On-time, late and pending shares."""
    return R.payment_rates(_inv(t, late=True))


# ---------------------------------------------------------------- A12, A13
_PER_MONTH = (f"(SELECT {_MONTH.format(c='invoice_date')} AS month, sum(amount) AS s, count(*) AS n "
              "FROM invoices GROUP BY 1)")


@register("monthly_revenue", "A12", f"""WITH {INV}
SELECT month, CAST(s AS DOUBLE) AS revenue, n AS invoices, CAST(s AS DOUBLE) / n AS avg_amount
FROM {_PER_MONTH} m""")
def monthly_revenue(t: Tables):
    """Revenue, count and mean amount per month."""
    return R.monthly_revenue(_inv(t))


@register("monthly_range", "A13", f"""WITH {INV}
SELECT CAST(min(s) AS DOUBLE) AS min_monthly_revenue, CAST(max(s) AS DOUBLE) AS max_monthly_revenue,
       CAST(sum(s) AS DOUBLE) / count(*) AS avg_monthly_revenue,
       min(n) AS min_invoices, max(n) AS max_invoices, sum(n) / count(*) AS avg_monthly_invoices
FROM {_PER_MONTH} m""")
def monthly_range(t: Tables):
    """Range of monthly revenue and counts."""
    return R.monthly_range(_inv(t))


# ---------------------------------------------------------------- A14-A16, O3, J5
def _rev_by_sql(dim: str) -> str:
    return f"""WITH {SUBS},
{INV}
SELECT s.{dim}, CAST(sum(i.amount) AS DOUBLE) AS revenue
FROM invoices i LEFT JOIN subscriptions s ON i.subscription_id = s.subscription_id
WHERE s.{dim} IS NOT NULL GROUP BY s.{dim}"""


@register("revenue_by_plan", "A14", _rev_by_sql("subscription_type"))
def revenue_by_plan(t: Tables):
    """Revenue per plan."""
    return R.revenue_by(_inv(t), _subs(t), "subscription_type").orderBy(F.desc("revenue"), "subscription_type")


@register("revenue_by_contract", "A14", _rev_by_sql("contract_length"))
def revenue_by_contract(t: Tables):
    """Revenue per contract length."""
    return R.revenue_by(_inv(t), _subs(t, contract=True), "contract_length").orderBy(F.desc("revenue"), "contract_length")


@register("revenue_by_active", "A14", _rev_by_sql("is_active"))
def revenue_by_active(t: Tables):
    """Revenue of active and inactive subscriptions."""
    return R.revenue_by(_inv(t), _subs(t), "is_active").orderBy(F.desc("revenue"), "is_active")


_LTV = f"""WITH {SUBS},
{INV},
ltv AS (
  SELECT s.customer_id, CAST(sum(i.amount) AS DOUBLE) AS lifetime_value
  FROM invoices i LEFT JOIN subscriptions s ON i.subscription_id = s.subscription_id
  WHERE s.customer_id IS NOT NULL GROUP BY s.customer_id
)"""


@register("customer_ltv", "A15", f"{_LTV}\nSELECT * FROM ltv")
def customer_ltv(t: Tables):
    """Lifetime value per customer, highest first (O2; ties by customer)."""
    return R.customer_ltv(_inv(t), _subs(t)).orderBy(F.desc("lifetime_value"), "customer_id")


@register("ltv_summary", "A16", f"""{_LTV}
SELECT CAST(sum(CAST(lifetime_value AS DECIMAL(28,2))) AS DOUBLE) / count(*) AS avg_ltv,
       round(quantile_cont(lifetime_value, 0.5), 6) AS median_ltv,
       round(quantile_cont(lifetime_value, 0.9), 6) AS p90_ltv,
       max(lifetime_value) AS max_ltv
FROM ltv""")
def ltv_summary(t: Tables):
    """Mean, median, 0.9 quantile and max of lifetime value."""
    return R.ltv_summary(R.customer_ltv(_inv(t), _subs(t)))


@register("top_customers", "O3", f"""{_LTV}
SELECT * FROM ltv ORDER BY lifetime_value DESC, customer_id LIMIT {config.TOP_CLV}""")
def top_customers(t: Tables):
    """O3: the 20 customers with the highest lifetime value."""
    return R.top_customers(R.customer_ltv(_inv(t), _subs(t)), config.TOP_CLV)


@register("joined_invoices", "J5", f"""WITH {SUBS},
{INV}
SELECT i.subscription_id, i.invoice_id, i.invoice_date, CAST(i.amount AS DOUBLE) AS amount, i.paid_late, i.status,
       s.customer_id, s.subscription_type, s.contract_length, s.is_active
FROM invoices i LEFT JOIN subscriptions s ON i.subscription_id = s.subscription_id""")
def joined_invoices(t: Tables):
    """Invoices with their subscription attributes."""
    out = R.joined_invoices(_inv(t, late=True), _subs(t, contract=True))
    return out.withColumn("amount", F.col("amount").cast("double"))


# ---------------------------------------------------------------- A18, A19, A22, P7
def _churned_by_sql(dim: str) -> str:
    return f"""WITH {SUBS}
SELECT {dim}, count(*) AS churned_subscriptions FROM subscriptions
WHERE end_date IS NOT NULL AND {dim} IS NOT NULL GROUP BY {dim}"""


@register("churned_by_plan", "A18", _churned_by_sql("subscription_type"))
def churned_by_plan(t: Tables):
    """Ended subscriptions per plan."""
    return CH.churned_by(_subs(t), "subscription_type")


@register("churned_by_contract", "A18", _churned_by_sql("contract_length"))
def churned_by_contract(t: Tables):
    """Ended subscriptions per contract length."""
    return CH.churned_by(_subs(t, contract=True), "contract_length")


@register("churn_rate_total", "A19", f"""WITH {SUBS}
SELECT count(end_date) AS churned_subscriptions, count(*) AS total_subscriptions,
       count(end_date) * 100 / count(*) AS churn_rate_pct
FROM subscriptions""")
def churn_rate_total(t: Tables):
    """Overall share of ended subscriptions."""
    return CH.churn_rate_total(_subs(t))


@register("missing_and_range", "A22", f"""WITH {SUBS}
SELECT min(start_date) AS first_start_date, max(start_date) AS last_start_date,
       count(*) FILTER (WHERE end_date IS NULL) AS missing_end_dates,
       count(*) FILTER (WHERE end_date IS NULL) * 100 / count(*) AS missing_end_pct
FROM subscriptions""")
def missing_and_range(t: Tables):
    """Start-date range and missing end dates."""
    return CH.missing_and_range(_subs(t))


@register("ended_subscriptions", "P7", f"""WITH {SUBS}
SELECT * FROM subscriptions WHERE end_date IS NOT NULL""")
def ended_subscriptions(t: Tables):
    """Subscriptions that have ended."""
    return CH.ended_subscriptions(_subs(t, contract=True))


# ---------------------------------------------------------------- A20
@register("kpi_summary", "A20", f"""{_LTV},
s AS (SELECT count(*) AS subs, count(DISTINCT customer_id) AS customers,
             count(*) FILTER (WHERE is_active) AS active, count(end_date) AS ended FROM subscriptions),
i AS (SELECT count(*) AS n, sum(amount) AS revenue, count(amount) AS amounts,
             count(*) FILTER (WHERE paid_late) AS late FROM invoices),
l AS (SELECT CAST(sum(CAST(lifetime_value AS DECIMAL(28,2))) AS DOUBLE) / count(*) AS avg_ltv FROM ltv),
p AS (SELECT avg(n) AS per_customer FROM {_PER_CUST} x)
SELECT 'Total Subscriptions' AS metric, CAST(subs AS DOUBLE) AS value FROM s
UNION ALL SELECT 'Total Invoices', CAST(n AS DOUBLE) FROM i
UNION ALL SELECT 'Unique Customers', CAST(customers AS DOUBLE) FROM s
UNION ALL SELECT 'Total Revenue', CAST(coalesce(revenue, 0) AS DOUBLE) FROM i
UNION ALL SELECT 'Average Invoice Amount', CAST(revenue AS DOUBLE) / amounts FROM i
UNION ALL SELECT 'Active Subscriptions', CAST(active AS DOUBLE) FROM s
UNION ALL SELECT 'Churned Subscriptions', CAST(ended AS DOUBLE) FROM s
UNION ALL SELECT 'Churn Rate (%)', ended * 100 / subs FROM s
UNION ALL SELECT 'Late Payment Rate (%)', late * 100 / n FROM i
UNION ALL SELECT 'Average Customer Lifetime Value', avg_ltv FROM l
UNION ALL SELECT 'Average Subscriptions per Customer', per_customer FROM p""")
def kpi_summary(t: Tables):
    """The summary KPI table."""
    return CH.kpi_summary(_subs(t), _inv(t, late=True))


# ---------------------------------------------------------------- A23-A25
def _corr_sql() -> str:
    cols = NUM_CHURN
    cells, selects = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            cells.append(f"round(corr({a}, {b}), 6) AS \"{a}__{b}\"")
            selects.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, \"{a}__{b}\" AS corr FROM c")
            if a != b:
                selects.append(f"SELECT '{b}', '{a}', \"{a}__{b}\" FROM c")
    return (f"WITH {CUST},\nc AS (SELECT {', '.join(cells)} FROM customers)\n"
            + "\nUNION ALL ".join(selects))


@register("correlation_matrix", "A23", _corr_sql())
def correlation_matrix(t: Tables):
    """Pairwise Pearson correlation of the numeric columns and churn."""
    return A.correlation_matrix(mart.customers(t), NUM_CHURN)


def _hist_sql() -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM)
    n = config.HIST_BINS
    return f"""WITH {CUST},
long AS (
  UNPIVOT (SELECT churn, {casts} FROM customers) ON {', '.join(NUM)}
  INTO NAME column_name VALUE value
),
ranges AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long GROUP BY 1),
b AS (
  SELECT l.column_name, l.churn,
         CAST(CASE WHEN r.hi - r.lo = 0 THEN 1
                   ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * {n}) + 1, {n}) END AS INTEGER) AS bin,
         count(*) AS count
  FROM long l JOIN ranges r ON l.column_name = r.column_name
  WHERE l.value IS NOT NULL GROUP BY ALL
),
grid AS (
  SELECT column_name, lo, hi, churn, CAST(bin AS INTEGER) AS bin
  FROM ranges, (SELECT DISTINCT churn FROM long), (SELECT unnest(range(1, {n} + 1)) AS bin)
)
SELECT g.column_name, g.churn, g.bin, round(g.lo + (g.hi - g.lo) * (g.bin - 1) / {n}, 6) AS bin_start,
       coalesce(b.count, 0) AS count
FROM grid g LEFT JOIN b ON g.column_name = b.column_name AND g.churn = b.churn AND g.bin = b.bin"""


@register("histogram_by_churn", "A24", _hist_sql())
def histogram_by_churn(t: Tables):
    """20-bin histograms of the numeric features split by churn."""
    return A.histogram(mart.customers(t), NUM, config.HIST_BINS, by=config.TARGET_COLUMN)


def _plain_hist_sql(prefix: str, select: str, columns: list[str], bins: int) -> str:
    """Equal-width histogram of each column of ``select`` over its own range."""
    return f"""{prefix},
src AS ({select}),
long AS (UNPIVOT src ON {', '.join(columns)} INTO NAME column_name VALUE value),
ranges AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long GROUP BY 1),
b AS (
  SELECT l.column_name,
         CAST(CASE WHEN r.hi - r.lo = 0 THEN 1
                   ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * {bins}) + 1, {bins}) END AS INTEGER) AS bin,
         count(*) AS count
  FROM long l JOIN ranges r ON l.column_name = r.column_name
  WHERE l.value IS NOT NULL GROUP BY ALL
),
grid AS (SELECT column_name, lo, hi, CAST(bin AS INTEGER) AS bin
         FROM ranges, (SELECT unnest(range(1, {bins} + 1)) AS bin))
SELECT g.column_name, g.bin, round(g.lo + (g.hi - g.lo) * (g.bin - 1) / {bins}, 6) AS bin_start,
       coalesce(b.count, 0) AS count
FROM grid g LEFT JOIN b ON g.column_name = b.column_name AND g.bin = b.bin"""


_FEATURE_CASTS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM)


@register("histogram_features", "A24", _plain_hist_sql(
    f"WITH {CUST}", f"SELECT {_FEATURE_CASTS} FROM customers", NUM, config.HIST_BINS_FEATURES))
def histogram_features(t: Tables):
    """30-bin distribution of every numeric customer feature."""
    return A.histogram(mart.customers(t), NUM, config.HIST_BINS_FEATURES)


@register("histogram_durations", "A24", _plain_hist_sql(
    f"WITH {SUBS}",
    f"""SELECT CAST(date_diff('day', start_date, end_date) AS DOUBLE) AS ended_days,
       CAST(CASE WHEN is_active THEN date_diff('day', start_date, {AS_OF}) END AS DOUBLE) AS active_days
FROM subscriptions""", ["ended_days", "active_days"], config.HIST_BINS_WIDE))
def histogram_durations(t: Tables):
    """50-bin distributions of ended and of active subscription
    durations (days)."""
    return A.histogram(CH.subscription_durations(_subs(t)), ["ended_days", "active_days"],
                       config.HIST_BINS_WIDE)


@register("histogram_amount", "A24", _plain_hist_sql(
    f"WITH {INV}", "SELECT CAST(amount AS DOUBLE) AS amount FROM invoices", ["amount"],
    config.HIST_BINS_WIDE))
def histogram_amount(t: Tables):
    """50-bin distribution of invoice amounts."""
    return A.histogram(_inv(t), ["amount"], config.HIST_BINS_WIDE)


@register("histogram_ltv", "A24", _plain_hist_sql(
    _LTV, "SELECT lifetime_value FROM ltv", ["lifetime_value"], config.HIST_BINS_WIDE))
def histogram_ltv(t: Tables):
    """50-bin distribution of customer lifetime value."""
    return A.histogram(R.customer_ltv(_inv(t), _subs(t)), ["lifetime_value"], config.HIST_BINS_WIDE)


def _box_sql(prefix: str, table: str, col: str) -> str:
    return f"""{prefix},
x AS (SELECT CAST({col} AS DOUBLE) AS x FROM {table} WHERE {col} IS NOT NULL),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM x)
SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)), 6) AS lower_whisker,
       round(max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
       count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
FROM x, q GROUP BY q1, median, q3"""


@register("boxplot_stats", "A25", _box_sql(f"WITH {INV}", "invoices", "amount"))
def boxplot_stats(t: Tables):
    """Box-plot statistics of invoice amounts."""
    return A.boxplot_stats(_inv(t), "amount")


@register("boxplot_ltv", "A25", _box_sql(_LTV, "ltv", "lifetime_value"))
def boxplot_ltv(t: Tables):
    """Box-plot statistics of customer lifetime value."""
    return A.boxplot_stats(R.customer_ltv(_inv(t), _subs(t)), "lifetime_value")


# ---------------------------------------------------------------- O4
PREVIEW_ROWS = 5


@register("invoice_preview", "O4", f"""WITH {INV}
SELECT invoice_id, subscription_id, invoice_date, CAST(amount AS DOUBLE) AS amount, status
FROM invoices ORDER BY invoice_id LIMIT {PREVIEW_ROWS}""")
def invoice_preview(t: Tables):
    """The first invoices by id (a preview: the limit is the feature)."""
    inv = _inv(t).withColumn("amount", F.col("amount").cast("double"))
    return inv.orderBy("invoice_id").limit(PREVIEW_ROWS)
