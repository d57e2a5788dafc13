"""Fixed values and default parameters.

Everything under "Fixed values" must equal the values of the analysis this
library re-implements, because results depend on them.  The rest are our
own defaults and are exposed as parameters of the operators.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# Fixed values (must match the original analysis for equal results)
# ---------------------------------------------------------------------------
NUMERICAL_FEATURES = [
    "age", "tenure", "usage_frequency", "support_calls",
    "payment_delay", "total_spend", "last_interaction",
]
ORDINAL_FEATURES = ["subscription_type", "contract_length"]
TARGET_COLUMN = "churn"
CUSTOMER_ID_COLUMN = "customerid"
MONITORING_COLUMNS = [
    "age", "tenure", "usage_frequency", "support_calls",
    "payment_delay", "total_spend", "last_interaction",
]
DRIFT_THRESHOLD = 0.1
TEST_SIZE = 0.2
SPLIT_SEED = 123
FOREST_TREES = 100
FOREST_SEED = 123
SEARCH_DRAWS = 10
SEARCH_FOLDS = 5
SEARCH_SEED = 123
HIGH_RISK_THRESHOLD = 0.7
HIGH_RISK_TOP = 10
TOP_CLV = 20
TOP_VALUES = 5
TOP_VALUES_PLOT = 10     # top values per categorical column in the distribution plots
CATEGORY_FILL = "Unknown"
UNKNOWN_CODE = -1
# Random-search ranges: trees 100-999, depth 3-9, feature share sqrt/log2/all,
# class weight none/balanced, sample share log-uniform in [0.5, 1.0]
SEARCH_TREES = (100, 1000)
SEARCH_DEPTH = (3, 10)
SEARCH_FEATURES = ["sqrt", "log2", "all"]
SEARCH_CLASS_WEIGHT = [None, "balanced"]
SEARCH_SAMPLE_SHARE = (0.5, 1.0)
# Declared estimator settings (logistic regression, boosted trees, and the
# forest of the model configuration; the pipeline's own forest has no depth limit)
LOGREG_PARAMS = {"C": 1.0, "max_iter": 1000}
BOOSTED_PARAMS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1}
FOREST_PARAMS = {"n_estimators": 100, "max_depth": 10, "min_samples_split": 5, "min_samples_leaf": 2}

# ---------------------------------------------------------------------------
# Parameters of the test mart built from the driver tables (our choice)
# ---------------------------------------------------------------------------
FIRST_YEAR = 1995                     # of the orders
AS_OF = _dt.date(2001, 8, 1)          # last order date: "now" for durations
CUTOFF = _dt.date(2001, 2, 1)         # features before, label after
REFERENCE_CUTOFF = _dt.date(2000, 2, 1)  # earlier snapshot for drift
LATE_DAYS = 1000                      # ship later than this -> paid late
STATUS_NAMES = {"F": "Paid", "O": "Pending", "P": "Partial"}
AGE_BASE, AGE_SPAN = 18, 60
# Risk bands for scored customers: high from 0.7, medium from 0.4
RISK_BANDS = [(0.7, "High"), (0.4, "Medium"), (0.0, "Low")]
HIST_BINS = 20          # numeric features split by churn
HIST_BINS_FEATURES = 30  # distribution of each numeric feature
HIST_BINS_WIDE = 50      # durations, invoice amounts, lifetime values
QUANTILE_GRID = 100
