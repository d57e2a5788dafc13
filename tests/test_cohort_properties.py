"""Randomised check: retention counts (C4) and by-plan rates (C6) equal a
plain-Python brute force on generated subscriptions and invoices, in both
index modes (null customers, plan switches and 12-month wraps included)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_skew import _brute_by_plan, _brute_counts

from kohort.operators import cohorts as C

_sub = st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["A", "B", "C"]))
_inv = st.tuples(st.integers(0, 11), st.integers(0, 40))  # (subscription index, month offset)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(subs=st.lists(_sub, min_size=1, max_size=12), invs=st.lists(_inv, max_size=40))
def test_retention_matches_brute_force(spark, make_subs, make_inv, subs, invs):
    sub_rows = [(i + 1, cust, plan, "M", dt.date(2020, 1, 1), None, True)
                for i, (cust, plan) in enumerate(subs)]
    inv_rows = []
    for n, (k, off) in enumerate(invs):
        sid = sub_rows[k % len(sub_rows)][0]
        day = dt.date(2020 + off // 12, off % 12 + 1, 1 + n % 28)
        inv_rows.append((n, sid, day, Decimal("1.00"), False, "Paid"))
    s_df, i_df = make_subs(sub_rows), make_inv(inv_rows)
    # the brute force ignores subscriptions without a customer, as the operators do
    known = [r for r in sub_rows if r[1] is not None]
    ids = {r[0] for r in known}
    kept = [r for r in inv_rows if r[1] in ids]
    for mode in ("linear", "age"):
        got = {(r.cohort_month, r.cohort_index): r.num_customers
               for r in C.retention_counts(i_df, s_df, mode).collect()}
        assert got == _brute_counts(known, kept, mode)
        got = {(r.subscription_type, r.cohort_month, r.cohort_index):
               (r.num_customers, r.cohort_size, r.retention_rate)
               for r in C.retention_rates_by_plan(i_df, s_df, mode).collect()}
        assert got == _brute_by_plan(known, kept, mode)
