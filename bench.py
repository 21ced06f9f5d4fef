"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is executed in full through the ``noop`` sink (no rows collected).
Before timing, one small untimed query on sf0.001 warms up the JVM (class
loading, JIT), so that start-up cost is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_table",
    "training_frame",
    "carry_forward_rmsle",
    "adjustment_fold_scores",
    "adjusted_predictions",
    "geo_accounts",
    "ticket_set_cells",
    "composer_preferences",
    "missed_composer_preferences",
    "history_wide_full_outer",
    "resubmission_roundtrip",
    "gbt_fold_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]] or HEADLINE
    from encore.session import apply_conf, get_session, scale_conf
    from encore.plans.registry import queries

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="encore-bench")
    size = sum(os.path.getsize(os.path.join(sf_dir, f)) for f in os.listdir(sf_dir) if f.endswith(".parquet"))
    apply_conf(spark, scale_conf(size, cpus))
    qs = queries()
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        qs["feature_table"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
