"""Benchmark of the headline steps. Prints one JSON line.

The billing sources are derived once from the order tables and stored; that is not timed. Then each step is run from
its stored inputs to a full result (all columns of all rows, thrown away), and the whole pipeline with all its tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import CLIENT_MONTH, queries, stages  # noqa: E402
from meterbook.functions.storage import stored  # noqa: E402
from meterbook.operators import allocation, invoice_rules, line_rules, match_exact, matching, rating, summaries  # noqa: E402
from meterbook.plans.pipeline import run_pipeline  # noqa: E402
from meterbook.session import local_session  # noqa: E402
from meterbook.sources.schemas import PROPERTIES  # noqa: E402
from checks.sample import AS_OF  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(step) -> float:
    """Median of a few runs after one warm-up."""
    consume(step())
    seconds = []
    for _ in range(RUNS):
        started = time.time()
        consume(step())
        seconds.append(time.time() - started)
    return round(statistics.median(seconds), 3)


def main(scratch: str) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setCheckpointDir(scratch)
    s = stages(spark, folder)
    s.sources
    exact = stored(match_exact.match_exact(s.exact_movements, s.exact_rules, CLIENT_MONTH, PROPERTIES, with_text=False))
    steps = {
        "invoice_rules": lambda: invoice_rules.invoice_rules(s.sources, AS_OF),
        "match_rules": lambda: matching.match_rules(s.movements, matching.compile_rules(s.lines)),
        "all_rules": lambda: line_rules.all_rules(s.rules, s.matches),
        "rated_transactions": lambda: rating.rate_transactions(s.all_rules),
        "revenue_allocated": lambda: allocation.allocate(s.rated, s.fee_totals, allocation.month_shares(s.rated)),
        "product_summary": lambda: summaries.product_summary(s.calculated),
        "reconciliation": lambda: queries()["reconciliation"](spark, folder),
        "match_exact": lambda: s.exact,
        "match_count_revenue": lambda: match_exact.revenue_by_match_count(exact, CLIENT_MONTH),
        "classify_payouts": lambda: queries()["classify_payouts"](spark, folder),
        "upsert_incremental": lambda: queries()["upsert_incremental"](spark, folder),
    }
    times = {name: timed(step) for name, step in steps.items()}
    for name in ("pipeline_first_run", "pipeline_second_run"):
        started = time.time()
        run_pipeline(s.sources, AS_OF, f"{scratch}/out")
        times[name] = round(time.time() - started, 3)
    rows = {"movements": s.movements.count(), "rule_rows": s.all_rules.count(), "rated_rows": s.rated.count()}
    print(json.dumps({
        "metric": "usage billing, sum of step medians and one pipeline run", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "rows": rows,
    }))


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="meterbook-bench-") as scratch:
        main(scratch)
