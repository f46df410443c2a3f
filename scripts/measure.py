"""Median-of-3 wall times for the BASELINE 'own measurements' table (markdown to stdout)."""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tontine.plans import registry  # noqa: E402
from tontine.session import build_session  # noqa: E402

GROUPS = {
    "model-point row path (mart_portfolio)": ["mart_portfolio"],
    "validation gate (validation_summary)": ["validation_summary"],
    "seriatim factor path (segment_bel)": ["segment_bel"],
    "seriatim per-policy PVs (policy_bel)": ["policy_bel"],
    "check runner (5 dq_* queries, 87 rules)": ["dq_not_null", "dq_unique", "dq_unique_combo",
                                                "dq_accepted_values", "dq_accepted_range"],
}


def main() -> None:
    spark = build_session(master="local[8]", shuffle_partitions=16, driver_memory="16g")
    qs = registry.queries(shared=False, rounding=False)
    print("| sf | orders (policies) | measurement | output rows | median s (3 runs) |")
    print("|---|---|---|---|---|")
    for sf in sys.argv[1:]:
        n_orders = spark.read.parquet(f"{sf}/orders.parquet").count()
        qs["stg_policy"](spark, sf).write.format("noop").mode("overwrite").save()
        for label, names in GROUPS.items():
            runs, rows = [], 0
            for _ in range(3):
                t0 = time.perf_counter()
                for n in names:
                    qs[n](spark, sf).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            rows = sum(qs[n](spark, sf).count() for n in names)
            print(f"| {os.path.basename(sf)[2:]} | {n_orders:,} | {label} | {rows:,} | {statistics.median(runs):.1f} |",
                  flush=True)


if __name__ == "__main__":
    main()
