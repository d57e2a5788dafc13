"""A hot customer holding a third of all invoices: results equal a brute
force computed in plain Python on the same fixture."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from kohort.operators import cohorts as C
from kohort.operators import revenue as R


def _fixture(make_subs, make_inv):
    rnd = random.Random(3)
    subs, invs = [], []
    for cust in range(60):
        for plan in ("A", "B"):
            subs.append((cust * 10 + (1 if plan == "A" else 2), cust, plan, "M",
                         dt.date(2020, 1, 1), None, True))
    iid = 0
    for _ in range(1200):
        # customer 0 (subscription 1) gets a third of all invoices
        sid = 1 if rnd.random() < 1 / 3 else rnd.choice(subs)[0]
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 700))
        invs.append((iid, sid, day, Decimal(rnd.randrange(100, 99999)) / 100, False, "Paid"))
        iid += 1
    return subs, invs, make_subs(subs), make_inv(invs)


def _brute_counts(subs, invs, mode):
    owner = {s[0]: s[1] for s in subs}
    months = defaultdict(set)
    for _, sid, day, *_ in invs:
        months[owner[sid]].add((day.year, day.month))
    out = defaultdict(int)
    for cust, ms in months.items():
        first = min(ms)
        idx = set()
        for y, m in ms:
            lin = (y * 12 + m) - (first[0] * 12 + first[1]) + 1
            idx.add(lin if mode == "linear" else (lin - 1) % 12 + 1)
        for i in idx:
            out[(dt.date(first[0], first[1], 1), i)] += 1
    return dict(out)


def test_hot_customer_retention_and_ltv(spark, make_subs, make_inv):
    subs, invs, s_df, i_df = _fixture(make_subs, make_inv)
    for mode in ("linear", "age"):
        got = {(r.cohort_month, r.cohort_index): r.num_customers
               for r in C.retention_counts(i_df, s_df, mode).collect()}
        assert got == _brute_counts(subs, invs, mode)
    owner = {s[0]: s[1] for s in subs}
    ltv = defaultdict(Decimal)
    for _, sid, _, amount, *_ in invs:
        ltv[owner[sid]] += amount
    got = {r.customer_id: r.lifetime_value for r in R.customer_ltv(i_df, s_df).collect()}
    assert got == {k: float(v) for k, v in ltv.items()}
    rows = C.cohort_index_rows(i_df, s_df).count()
    assert rows == len(invs)


def _brute_by_plan(subs, invs, mode):
    owner = {s[0]: (s[1], s[2]) for s in subs}
    months = defaultdict(set)  # customer -> {(plan, (y, m))}
    for _, sid, day, *_ in invs:
        cust, plan = owner[sid]
        months[cust].add((plan, (day.year, day.month)))
    counts = defaultdict(int)
    for cust, items in months.items():
        first = min(m for _, m in items)
        pairs = set()
        for plan, (y, m) in items:
            lin = (y * 12 + m) - (first[0] * 12 + first[1]) + 1
            pairs.add((plan, lin if mode == "linear" else (lin - 1) % 12 + 1))
        for plan, i in pairs:
            counts[(plan, dt.date(first[0], first[1], 1), i)] += 1
    out = {}
    for (plan, cohort, i), n in counts.items():
        size = counts.get((plan, cohort, 1))
        if size is None:
            continue  # no index-1 customers of that plan: the pair drops
        rate = (Decimal(n) / Decimal(size)).quantize(Decimal("0.001"), rounding="ROUND_HALF_UP")
        out[(plan, cohort, i)] = (n, size, float(rate))
    return out


def test_hot_subscription_rates_by_plan(spark, make_subs, make_inv):
    subs, invs, s_df, i_df = _fixture(make_subs, make_inv)
    for mode in ("linear", "age"):
        got = {(r.subscription_type, r.cohort_month, r.cohort_index):
               (r.num_customers, r.cohort_size, r.retention_rate)
               for r in C.retention_rates_by_plan(i_df, s_df, mode).collect()}
        assert got == _brute_by_plan(subs, invs, mode)
