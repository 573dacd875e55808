"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stayline.plans.catalog import catalog  # noqa: E402
from stayline.session import local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = [
    "dq_duplicate_keys",
    "dq_orphans",
    "dq_null_audit",
    "dq_churn_distribution",
    "clean_customers",
    "clean_summary",
    "eda_overview",
    "eda_by_contract",
    "eda_by_tenure",
    "eda_by_bill",
    "eda_revenue_at_risk",
    "feat_table",
    "feat_model_matrix",
    "split_stratified",
    "scale_train",
    "eval_metrics",
    "eval_roc_auc",
    "eval_class_report",
    "risk_tier",
    "reason_codes",
    "view_at_risk",
    "view_daily_summary",
    "report_call_list",
    "report_exec_summary",
    "report_weekly_trend",
    "report_top_drivers",
    "report_segments",
    "report_retention_roi",
    "report_model_tracking",
    "gbt_train",
    "score_customers",
    "shap_global",
]


def main() -> None:
    spark = local_session(CPUS, "stayline-bench", **{"spark__ui__showConsoleProgress": "false"})
    every = catalog()
    for name in ("dq_row_count", "report_exec_summary"):  # start the JVM's compilers
        every[name](spark, FOLDER).collect()
    times = {}
    for name in HEADLINE:
        # Training happens once per session, so it cannot be repeated.
        runs = 1 if name == "gbt_train" else REPEATS
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            every[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
