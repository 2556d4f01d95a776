"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace import registry  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "q1_executive", "q2_shipping_mode", "q3_segment", "q4_category", "q5_running_revenue",
    "q6_route_rank", "q7_customer_value", "q8_risk_radar", "src_extract", "dq_null_audit",
    "dq_orphan_customers", "dq_status_dist", "dq_summary", "clean_dedup", "clean_fill_median",
    "clean_clip_p99", "fe_calendar", "fe_revenue_per_unit", "fe_market_risk", "sink_clean",
    "sink_ml", "ml_split", "ml_encode", "ml_scale", "ml_assemble", "ml_oversample", "ev_auc",
    "ev_roc", "ev_report",
    "ts_failure_label", "ts_minmax", "ts_sequences", "ts_window_features", "ts_health_table",
    "br_daily",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    known = registry.queries()
    seconds: dict[str, float] = {}
    known["q2_shipping_mode"](spark, root).collect()  # start the session's machinery
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        known[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
