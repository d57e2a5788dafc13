"""Co-located (bucketed) storage: same results, no exchange below the
invoice-subscription join."""

from __future__ import annotations

import os
import re

from conftest import SF_SMALL

from kohort.operators import cohorts as C
from kohort.operators import revenue as R
from kohort.sources import layout, mart
from kohort.sources.tables import Tables


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bucketed_tables_join_without_exchange(spark, tmpdir_session):
    t = Tables(spark, SF_SMALL)
    inv, subs = mart.invoices(t), mart.subscriptions(t)
    layout.store_colocated(inv, subs, os.path.join(tmpdir_session, "colocated"), 4, prefix="lay_")
    b_inv, b_subs = layout.read_colocated(spark, prefix="lay_")
    rates = C.retention_rates(b_inv, b_subs)
    assert _rows(rates) == _rows(C.retention_rates(inv, subs))
    assert _rows(R.revenue_by(b_inv, b_subs, "subscription_type")) == \
        _rows(R.revenue_by(inv, subs, "subscription_type"))
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert not re.search(r"Exchange hashpartitioning\(subscription_id", plan)


def test_bucket_count():
    assert layout.bucket_count(0) == 8
    assert layout.bucket_count(100 * 1024 ** 4) == 409600
