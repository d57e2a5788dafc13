"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then up to ``$BENCH_RUNS`` (default 5)
timed runs written to the ``noop`` sink; reports the median per query and
prints ONE JSON line.  A run is stopped after ``$BENCH_QUERY_SECONDS`` (120;
its query is listed as stopped), and no further pass begins after
``$BENCH_SECONDS`` (1,200), so every query that ends has a figure.  ``BENCH_QUERIES=all`` runs every registered query, or give a
comma-separated list.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "retention_rate_linear",      # flagship
    "retention_rate_sql",         # same result in the original SQL shape (S2)
    "retention_rate_age",
    "retention_rate_by_plan",
    "retention_counts_linear",
    "cohort_index_rows",
    "activity_calendar",
    "monthly_churn_rate",
    "churn_distribution",
    "kpi_summary",
    "customer_ltv",
    "ltv_summary",
    "invoice_totals",
    "boxplot_stats",
    "monthly_revenue",
    "revenue_by_plan",
    "numeric_describe",
    "correlation_matrix",
    "histogram_by_churn",
    "quality_report",
    "clean_customers",
    "drift_report",
    "churn_scores",               # random forest fit (100 trees) + score
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    wanted = os.environ.get("BENCH_QUERIES", "")

    from kohort.plans import catalog
    from kohort.session import get_session

    catalog.load_all()
    if wanted == "all":
        names = list(catalog.QUERIES)
    elif wanted:
        names = [n.strip() for n in wanted.split(",") if n.strip()]
    else:
        names = HEADLINE

    spark = get_session(f"local[{cpus}]", app="kohort-bench",
                        shuffle_partitions=max(2 * cpus, 8),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})

    limit = float(os.environ.get("BENCH_QUERY_SECONDS", "120"))
    end = time.monotonic() + float(os.environ.get("BENCH_SECONDS", "1200"))
    times: dict[str, list[float]] = {name: [] for name in names}
    stopped: list[str] = []
    sc = spark.sparkContext

    def run(name: str) -> float | None:
        """Seconds of one run; none if it was stopped at the limit."""
        sc.setJobGroup(name, name, interruptOnCancel=True)
        timer = threading.Timer(limit, sc.cancelJobGroup, [name])
        timer.start()
        t0 = time.perf_counter()
        try:
            df = catalog.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        except Exception:
            if time.perf_counter() - t0 < limit:
                raise
            stopped.append(name)
            return None
        finally:
            timer.cancel()

    for k in range(runs + 1):  # the first pass warms up: JIT, file listing, imports
        for name in names:
            if name in stopped or (k > 1 and time.monotonic() > end):
                continue
            seconds = run(name)
            if k and seconds is not None:
                times[name].append(seconds)
    results = {name: round(statistics.median(t), 4) for name, t in times.items() if t}

    total = round(sum(results.values()), 4)
    out = {"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
           "queries": results, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
           "cpus": cpus, "runs": runs, "stopped": stopped}
    flag = results.get("retention_rate_linear")
    if flag:
        invoices = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
        out["flagship_invoice_rows_per_sec"] = round(invoices / flag, 1)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
