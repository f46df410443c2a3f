"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one
JSON line. Each query is executed in full through the ``noop`` sink (every row computed,
nothing collected to the driver, no oracle rounding); the reported time per query is the best of
$BENCH_REPEAT runs (default 2) after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tontine.plans import registry  # noqa: E402
from tontine.session import build_session  # noqa: E402

HEADLINE = [
    "mart_portfolio",        # model-point row path: projection -> roll-forward -> cash flows -> PV -> marts
    "validation_summary",    # validation gate over the whole chain
    "segment_bel",           # seriatim unit-factor path over every policy (one per order)
    "policy_bel",            # per-policy PVs for every scenario x curve x mortality basis
    "premium_table",         # equivalence-principle pricing of every policy
    "dq_not_null",           # declarative check runner over the 26 models
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, driver_memory="16g")
    # every run builds and computes its query from the parquet inputs; output columns are typed
    # as in the registry but not rounded (rounding only serves the oracle comparison)
    qs = registry.queries(shared=False, rounding=False)
    qs["stg_policy"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
