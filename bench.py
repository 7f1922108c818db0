"""Headline queries timed at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderloom.plans.queries import QUERIES  # noqa: E402
from orderloom.session import ONE_MACHINE, build_session  # noqa: E402

HEADLINE = [
    "kpi_monthly_tx",
    "kpi_daily_tx",
    "kpi_rfm_tx",
    "kpi_monthly_model",
    "kpi_daily_model",
    "kpi_rfm_model",
    "snapshot_dataset",
    "customer_orders",
    "upsert_orders",
    "upsert_items",
    "dq_duplicate_items",
    "churn_score_rfm",
    "daily_anomaly",
    "eval_dataset",
    "eval_metrics_baseline",
    "decile_diagnostics",
    "features_noise_reduced",
    "candidate_metrics",
]
RUNS = 3


def _seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        "orderloom-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **ONE_MACHINE,
        **{"spark.checkpoint.dir": f"{scratch}/checkpoint", "spark.sql.warehouse.dir": f"{scratch}/warehouse"},
    )
    # Rounds over all queries, so that each is timed with the JVM's compilers warm.
    rounds = [{name: _seconds(spark, name, sf_dir) for name in HEADLINE} for _ in range(RUNS)]
    best = {name: round(min(r[name] for r in rounds), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "runs": f"best of {RUNS}",
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
