"""Registered data-quality, feature, model and drift queries
(Q3-Q5, M1-M3, M5, M7-M10, M13, D2-D6) and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..operators import categories as CAT_CODES
from ..operators import cleaning as CL
from ..operators import drift as D
from ..operators import drift_sketch as DS
from ..operators import features as FE
from ..operators import model as M
from ..operators import quality as Q
from ..sources import mart
from ..sources.files import shared_table
from ..sources.tables import Tables
from .catalog import register
from .oracle_mart import customers_cte

NUM = config.NUMERICAL_FEATURES
CAT = config.ORDINAL_FEATURES
CUST = customers_cte(with_ships=True)
# Spark type names of the customers table (metadata of the mart schema)
CUSTOMER_TYPES = {
    "customerid": "bigint", "age": "int", "gender": "string", "tenure": "int",
    "usage_frequency": "double", "support_calls": "double", "payment_delay": "double",
    "total_spend": "double", "last_interaction": "double", "subscription_type": "string",
    "contract_length": "string", "churn": "int",
}
COLS = list(CUSTOMER_TYPES)
RULE_DAYS = 180  # rule-based churn prediction: no order for 180 days
RULE_SPAN, RULE_ORDERS = 365, 8  # rule-based probability: days since the last order, number of orders


def _clean_sql(src: str, name: str) -> str:
    """Dedupe + median fill of every numeric column (+ 'Unknown' categories)."""
    meds = ", ".join(f"median({c}) AS {c}" for c in NUM)
    sel = []
    for c in COLS:
        if c in NUM:
            sel.append(f"coalesce(CAST(d.{c} AS DOUBLE), m.{c}) AS {c}")
        elif c in CAT:
            sel.append(f"coalesce(d.{c}, '{config.CATEGORY_FILL}') AS {c}")
        else:
            sel.append(f"d.{c}")
    return f"""{name}_d AS (SELECT DISTINCT * FROM {src}),
{name}_m AS (SELECT {meds} FROM {name}_d),
{name} AS (SELECT {', '.join(sel)} FROM {name}_d d, {name}_m m)"""


CLEAN = f"WITH {CUST},\n{_clean_sql('customers', 'clean')}"


# ---------------------------------------------------------------- Q3-Q5
@register("data_summary", "Q3", f"WITH {CUST}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, "
    f"count(*) - count({c}) AS nulls, count(*) AS rows FROM customers"
    for c, t in CUSTOMER_TYPES.items()))
def data_summary(t: Tables):
    """Q3: types, non-null and null counts of the customer table."""
    return Q.data_summary(mart.customers(t))


def _feature_summary_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, 'numerical' AS kind, round(avg({c}), 6) AS mean, "
             f"round(median({c}), 6) AS median, round(stddev_samp({c}), 6) AS std, "
             f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
             f"CAST(NULL AS BIGINT) AS unique_values, count(*) - count({c}) AS missing FROM customers"
             for c in NUM]
    parts += [f"SELECT '{c}', 'categorical', NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}), "
              f"count(*) - count({c}) FROM customers" for c in CAT]
    return f"WITH {CUST}\n" + "\nUNION ALL\n".join(parts)


@register("feature_summary", "Q4", _feature_summary_sql())
def feature_summary(t: Tables):
    """Q4: numeric and categorical feature profile."""
    return Q.feature_summary(mart.customers(t), NUM, CAT)


def _top_values_sql(k: int) -> str:
    return f"""WITH {CUST},
long AS (UNPIVOT (SELECT {', '.join(CAT)} FROM customers) ON {', '.join(CAT)} INTO NAME feature VALUE value),
counts AS (SELECT feature, value, count(*) AS count FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY feature ORDER BY count DESC, value) AS INTEGER) AS rank
           FROM counts)
SELECT * FROM ranked WHERE rank <= {k}"""


@register("feature_top_values", "Q4", _top_values_sql(config.TOP_VALUES))
def feature_top_values(t: Tables):
    """Q4: top five values of each categorical feature."""
    return Q.top_values(mart.customers(t), CAT, config.TOP_VALUES)


@register("feature_top10_values", "O3", _top_values_sql(config.TOP_VALUES_PLOT))
def feature_top10_values(t: Tables):
    """O3: top ten values of each categorical feature (distribution plots)."""
    return Q.top_values(mart.customers(t), CAT, config.TOP_VALUES_PLOT)


def _quality_sql() -> str:
    n = len(COLS)
    miss = " + ".join(f"(count(*) - count({c}))" for c in COLS)
    types: dict[str, int] = {}
    for v in CUSTOMER_TYPES.values():
        types[v] = types.get(v, 0) + 1
    parts = [
        "SELECT 'overview' AS section, 'rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM customers",
        f"SELECT 'overview', 'columns', CAST({n} AS DOUBLE)",
        "SELECT 'overview', 'duplicate_rows', CAST(r.n - d.n AS DOUBLE) FROM r, d",
        "SELECT 'overview', 'duplicate_pct', round(CAST(r.n - d.n AS DOUBLE) / CAST(r.n AS DOUBLE) * 100, 2) FROM r, d",
        f"SELECT 'missing', 'total_missing', CAST({miss} AS DOUBLE) FROM customers",
        f"SELECT 'missing', 'missing_pct', round(CAST({miss} AS DOUBLE) / CAST(count(*) * {n} AS DOUBLE) * 100, 2) FROM customers",
    ]
    parts += [f"SELECT 'missing_by_column', '{c}', CAST(count(*) - count({c}) AS DOUBLE) FROM customers "
              f"HAVING count(*) - count({c}) > 0" for c in COLS]
    parts += [f"SELECT 'unique_values', '{c}', CAST(count(DISTINCT {c}) AS DOUBLE) FROM customers" for c in COLS]
    parts += [f"SELECT 'data_types', '{k}', CAST({v} AS DOUBLE)" for k, v in sorted(types.items())]
    return (f"WITH {CUST},\nr AS (SELECT count(*) AS n FROM customers),\n"
            "d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM customers))\n"
            + "\nUNION ALL\n".join(parts))


@register("quality_report", "Q5", _quality_sql())
def quality_report(t: Tables):
    """Q5: duplicates, missing values, distinct values and type counts."""
    return Q.quality_report(mart.customers(t))


# ---------------------------------------------------------------- M1-M3, M8
@register("clean_customers", "M1", f"{CLEAN}\nSELECT * FROM clean")
def clean_customers(t: Tables):
    """M1: deduplicated customers with medians and 'Unknown' filled in."""
    return CL.clean(mart.customers(t))


@register("ordinal_encoded", "M2", f"""{CLEAN}
SELECT customerid,
       CAST(dense_rank() OVER (ORDER BY subscription_type) - 1 AS INTEGER) AS subscription_type_code,
       CAST(dense_rank() OVER (ORDER BY contract_length) - 1 AS INTEGER) AS contract_length_code
FROM clean""")
def ordinal_encoded(t: Tables):
    """M2: plan and contract codes in ascending category order."""
    cleaned = CL.clean(mart.customers(t))
    enc = FE.ordinal_encode(cleaned)
    return enc.select("customerid", *[f"{c}_code" for c in CAT])


@register("category_codes", "M2", f"""{CLEAN}
{" UNION ALL ".join(f"SELECT '{c}' AS column_name, v AS value, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {c} AS v FROM clean)" for c in CAT)}""")
def category_codes(t: Tables):
    """M2: the dictionary of the categorical columns, numbered on the cluster."""
    return CAT_CODES.category_codes(CL.clean(mart.customers(t)), CAT)


@register("standard_scaled", "M3", f"""{CLEAN}
SELECT customerid, {', '.join(
    f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) AS {c}"
    for c in NUM)}
FROM clean""")
def standard_scaled(t: Tables):
    """M3: z-scores (population deviation) of the numeric features."""
    cleaned = CL.clean(mart.customers(t))
    return FE.standard_scale(cleaned.select("customerid", *NUM), NUM)


@register("recall_f1", "M8", f"""WITH {CUST},
s AS (SELECT churn, CAST(last_interaction >= {RULE_DAYS} AS INTEGER) AS prediction FROM customers),
c AS (SELECT count(*) FILTER (WHERE churn = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE churn = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE churn = 1 AND prediction = 0) AS fn,
             count(*) FILTER (WHERE churn = 0 AND prediction = 0) AS tn FROM s)
SELECT tp, fp, fn, tn, tp / (tp + fn) AS recall, tp / (tp + fp) AS precision,
       2 * tp / (2 * tp + fp + fn) AS f1 FROM c""")
def recall_f1(t: Tables):
    """M8: recall / precision / F1 of a rule-based churn prediction
    (inactive for 180 days or more), deterministic so it has an oracle."""
    cust = mart.customers(t)
    scored = cust.withColumn("prediction", (F.col("last_interaction") >= RULE_DAYS).cast("int"))
    return M.recall_f1(scored)


# ---------------------------------------------------------------- model
def _model_frames(t: Tables):
    """(train, test, all customers): deduplicated, split by key; medians fitted on train only."""
    cust = shared_table(mart.customers(t).dropDuplicates(), "customers")
    meds = shared_table(CL.fit_medians(FE.train_test_split(cust)[0], NUM), "medians")
    full = shared_table(CL.apply_medians(cust, meds, NUM).fillna(config.CATEGORY_FILL, CAT), "model-input")
    train, test = FE.train_test_split(full)
    return train, test, full


_SPLIT_SQL = (f"CASE WHEN ('0x' || substr(md5('{config.SPLIT_SEED}:' || customerid), 1, 7))::BIGINT % 10000 "
              f"< {int(round(config.TEST_SIZE * 10000))} THEN 'test' ELSE 'train' END")


@register("train_test_split", "M5", f"WITH {CUST}\nSELECT *, {_SPLIT_SQL} AS split FROM customers")
def train_test_split(t: Tables):
    """M5: customers with a deterministic 'train'/'test' flag."""
    return FE.with_split(mart.customers(t))


@register("feature_importance", "M7")
def feature_importance(t: Tables):
    """M7: random-forest feature importances (100 trees, seed 123)."""
    train, _, _ = _model_frames(t)
    return M.feature_importance(M.fit(train), t.spark)


@register("churn_scores", "M9")
def churn_scores(t: Tables):
    """M9: churn probability and risk band of every customer, by the pipeline's
    forest (no depth limit), as in the batch job."""
    train, _, full = _model_frames(t)
    return M.score(M.fit(train), full)


# A rule with the shape of a model's scores, which SQL can repeat: the longer
# ago the last order and the fewer the orders, the likelier the churn.
def _rule_scores(t: Tables):
    cust = mart.customers(t)
    p = F.least(F.lit(1.0), F.col("last_interaction") / F.lit(RULE_SPAN)) * 0.8 \
        + F.when(F.col("usage_frequency") < RULE_ORDERS, 0.2).otherwise(0.0)
    return M.banded(cust.withColumn("churn_probability", F.round(p, 6)))


_RULE_SQL = f"""WITH {{cust}},
p AS (SELECT customerid, churn, round(least(1.0, last_interaction / {RULE_SPAN}.0) * 0.8
             + CASE WHEN usage_frequency < {RULE_ORDERS} THEN 0.2 ELSE 0.0 END, 6) AS churn_probability FROM customers),
s AS (SELECT customerid, churn_probability,
             CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_category,
             CAST(churn_probability >= 0.5 AS INTEGER) AS prediction, churn FROM p)"""


@register("risk_bands", "M9", _RULE_SQL.format(cust=CUST) + "\nSELECT * FROM s")
def risk_bands(t: Tables):
    """M9: probability, risk band and prediction of every customer, by a rule."""
    return _rule_scores(t)


@register("high_risk_customers", "M10", _RULE_SQL.format(cust=CUST) + f"""
SELECT * FROM s WHERE churn_probability >= {config.HIGH_RISK_THRESHOLD}
ORDER BY churn_probability DESC, customerid LIMIT {config.HIGH_RISK_TOP}""")
def high_risk_customers(t: Tables):
    """The ten customers most likely to churn (p >= 0.7), by the rule."""
    return M.high_risk(_rule_scores(t))


@register("confusion", "M13", _RULE_SQL.format(cust=CUST) + """
SELECT churn AS actual, prediction, count(*) AS count FROM s GROUP BY churn, prediction""")
def confusion(t: Tables):
    """Confusion counts of the rule over all customers."""
    return M.confusion(_rule_scores(t))


@register("model_confusion", "M13")
def model_confusion(t: Tables):
    """Confusion counts of the forest on the test split."""
    train, test, _ = _model_frames(t)
    return M.confusion(M.score(M.fit(train), test))


@register("model_recall_f1", "M8")
def model_recall_f1(t: Tables):
    """M8: recall and F1 of the forest on the test split."""
    train, test, _ = _model_frames(t)
    return M.recall_f1(M.score(M.fit(train), test))


# ---------------------------------------------------------------- drift D2-D6
REF_CUST = customers_cte(name="ref_raw", cutoff=config.REFERENCE_CUTOFF)
CUR_CUST = customers_cte(name="cur_raw", cutoff=config.CUTOFF)
DRIFT_BASE = (f"WITH ships AS (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS ship_date "
              f"FROM lineitem GROUP BY l_orderkey),\n{REF_CUST},\n{CUR_CUST},\n"
              f"{_clean_sql('ref_raw', 'ref')},\n{_clean_sql('cur_raw', 'cur')}")


def _raw_snapshots(t: Tables):
    return mart.customer_snapshots(t, [config.REFERENCE_CUTOFF, config.CUTOFF])


def _snapshots(t: Tables):
    return [D.snapshot(c) for c in _raw_snapshots(t)]


def _grid_sql() -> str:
    return "[" + ", ".join(f"CAST({p!r} AS DOUBLE)" for p in D.quantile_grid()) + "]"


def _numeric_drift_sql() -> str:
    g = _grid_sql()
    rq = ", ".join(f"quantile_cont({c}, {g}) AS {c}" for c in NUM)
    rs = ", ".join(f"stddev_pop({c}) AS {c}" for c in NUM)
    long = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, unnest(rq.{c}) AS r, unnest(cq.{c}) AS c, rs.{c} AS s FROM rq, cq, rs"
        for c in NUM)
    return f"""{DRIFT_BASE},
rq AS (SELECT {rq} FROM ref), cq AS (SELECT {rq} FROM cur), rs AS (SELECT {rs} FROM ref),
long AS (
  {long}
),
sc AS (SELECT column_name, round(avg(abs(r - c)) / any_value(s), 6) AS drift_score FROM long GROUP BY column_name)"""


NUMERIC_DRIFT_SQL = _numeric_drift_sql()
TH = config.DRIFT_THRESHOLD

_TARGET_DRIFT_SQL = f"""{DRIFT_BASE},
p AS (SELECT CAST(churn AS VARCHAR) AS value, count(*) / sum(count(*)) OVER () AS p FROM ref GROUP BY 1),
q AS (SELECT CAST(churn AS VARCHAR) AS value, count(*) / sum(count(*)) OVER () AS q FROM cur GROUP BY 1),
b AS (SELECT coalesce(p.p, 0) AS p, coalesce(q.q, 0) AS q FROM p FULL JOIN q ON p.value = q.value),
js AS (SELECT 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
            + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) AS js FROM b),
td AS (SELECT 'churn' AS column_name, 'jensenshannon' AS stat_test,
              round(sqrt(greatest(js, 0)), 6) AS drift_score FROM js)"""


@register("drift_scores", "D2", f"""{NUMERIC_DRIFT_SQL}
SELECT column_name, 'wasserstein_norm' AS stat_test, drift_score, drift_score >= {TH} AS drift_detected FROM sc""")
def drift_scores(t: Tables):
    """Normalised Wasserstein drift of each monitored column."""
    ref, cur = _snapshots(t)
    return D.numeric_drift(ref, cur)


@register("drift_sketch_scores", "D2")
def drift_sketch_scores(t: Tables):
    """D2 from merged quantile sketches, with the bound of each score."""
    ref, cur = _snapshots(t)
    half = F.pmod(F.xxhash64(*cur.columns), F.lit(2))
    return DS.sketch_drift(DS.sketch(ref), DS.merge(*(DS.sketch(cur.where(half == k)) for k in (0, 1))))


def _binned_sql() -> str:
    edges = "[" + ", ".join(f"CAST({i / 10!r} AS DOUBLE)" for i in range(1, 10)) + "]"
    e = ", ".join(f"quantile_cont({c}, {edges}) AS {c}" for c in NUM)
    sides = []
    for side, tbl in (("r", "ref"), ("c", "cur")):
        sides.append("\n  UNION ALL ".join(
            f"SELECT '{c}' AS column_name, len(list_filter(e.{c}, lambda x: x < t.{c})) AS bin, "
            f"'{side}' AS side FROM {tbl} t, e WHERE t.{c} IS NOT NULL" for c in NUM))
    return f"""{DRIFT_BASE},
e AS (SELECT {e} FROM ref),
vals AS (
  {sides[0]}
  UNION ALL {sides[1]}
),
cnt AS (SELECT column_name, bin, count(*) FILTER (WHERE side = 'r') AS r,
               count(*) FILTER (WHERE side = 'c') AS c FROM vals GROUP BY 1, 2),
grid AS (SELECT DISTINCT column_name, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM cnt),
tab AS (SELECT g.column_name, g.bin, coalesce(cnt.r, 0) AS r, coalesce(cnt.c, 0) AS c
        FROM grid g LEFT JOIN cnt ON g.column_name = cnt.column_name AND g.bin = cnt.bin),
sh AS (SELECT *, r / sum(r) OVER (PARTITION BY column_name) AS pr,
              c / sum(c) OVER (PARTITION BY column_name) AS pc FROM tab),
cu AS (SELECT *, abs(sum(pr) OVER w - sum(pc) OVER w) AS gap,
              greatest(pr, 0.0001) AS pr_, greatest(pc, 0.0001) AS pc_ FROM sh
       WINDOW w AS (PARTITION BY column_name ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT column_name, round(max(gap), 6) AS ks, round(sum((pc_ - pr_) * ln(pc_ / pr_)), 6) AS psi
FROM cu GROUP BY column_name"""


@register("drift_ks_psi", "D2", _binned_sql())
def drift_ks_psi(t: Tables):
    """D2 (also reported): KS and PSI over reference-decile bins."""
    ref, cur = _snapshots(t)
    return D.binned_drift(ref, cur)


@register("target_drift", "D3", f"{_TARGET_DRIFT_SQL}\nSELECT *, drift_score >= {TH} AS drift_detected FROM td")
def target_drift(t: Tables):
    """D3: Jensen-Shannon drift of the churn label (no other column is cleaned)."""
    ref, cur = (c.dropDuplicates().select(config.TARGET_COLUMN) for c in _raw_snapshots(t))
    return D.target_drift(ref, cur)


def _report_sql(select: str) -> str:
    target_ctes = _TARGET_DRIFT_SQL[len(DRIFT_BASE):]  # ",\np AS ... td AS (...)"
    return f"""{NUMERIC_DRIFT_SQL}{target_ctes},
report AS (
  SELECT column_name, 'wasserstein_norm' AS stat_test, drift_score, drift_score >= {TH} AS drift_detected FROM sc
  UNION ALL SELECT column_name, stat_test, drift_score, drift_score >= {TH} FROM td
)
{select}"""


@register("drift_report", "D4", _report_sql("SELECT * FROM report"))
def drift_report(t: Tables):
    """Numeric and target drift in one table."""
    ref, cur = _snapshots(t)
    return D.drift_report(ref, cur)


@register("drift_alerts", "D5", _report_sql(
    f"SELECT *, drift_detected AND drift_score > {TH} AS alert FROM report"))
def drift_alerts(t: Tables):
    """Drift table with threshold alerts."""
    ref, cur = _snapshots(t)
    return D.drift_alerts(D.drift_report(ref, cur))


@register("drift_counters", "D6", _report_sql(
    f"""SELECT (SELECT count(*) FILTER (WHERE drift_detected) FROM report) AS drifted_columns,
       (SELECT count(*) FROM report) AS monitored_columns,
       (SELECT count(*) FROM cur) AS rows,
       CAST({len(NUM) + 1} AS BIGINT) AS columns,
       (SELECT {' + '.join(f'(count(*) - count({c}))' for c in NUM + ['churn'])} FROM cur) AS missing_values"""))
def drift_counters(t: Tables):
    """Drifted columns and size of the current snapshot."""
    ref, cur = _snapshots(t)
    return D.dataset_counters(D.drift_report(ref, cur), cur)


# ---------------------------------------------------------------- P9, D1, M12
@register("dedup_customers", "P9", f"WITH {CUST}\nSELECT DISTINCT * FROM customers")
def dedup_customers(t: Tables):
    """Full-row distinct customers."""
    return CL.drop_duplicates(mart.customers(t))


@register("drift_snapshot", "D1", f"""WITH {CUST},
{_clean_sql('customers', 'clean')}
SELECT {', '.join(config.MONITORING_COLUMNS)}, churn FROM clean""")
def drift_snapshot(t: Tables):
    """Cleaned current snapshot restricted to the monitored columns."""
    return D.snapshot(mart.customers(t))


@register("logreg_recall_f1", "M12")
def logreg_recall_f1(t: Tables):
    """The declared logistic regression (C = 1) on the same split."""
    train, test, _ = _model_frames(t)
    return M.recall_f1(M.score(M.fit(train, M.build_estimator("logistic_regression", rows=train.count())), test))


@register("declared_forest_recall_f1", "M12")
def declared_forest_recall_f1(t: Tables):
    """The forest of the model configuration (depth 10, leaves of 2) on the same split."""
    train, test, _ = _model_frames(t)
    return M.recall_f1(M.score(M.fit(train, M.build_estimator("declared_forest")), test))
