"""Summarize the physical plans of the headline queries (formatted explain) as markdown."""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tontine.plans import registry  # noqa: E402
from tontine.session import build_session  # noqa: E402

HEADLINE = ["mart_portfolio", "validation_summary", "segment_bel", "policy_bel", "premium_table", "dq_not_null"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    qs = registry.queries(shared=False, rounding=False)
    print(f"Physical plans at {os.path.basename(sf)} (`explain('formatted')`, before AQE re-planning). Stage")
    print("boundaries are read back as `Scan ExistingRDD` (checkpointed rows), so each plan below is the")
    print("work left after its boundaries were materialized.\n")
    print("| query | nodes | shuffle exchanges | broadcast exchanges | windows | parquet scans (ReadSchema) |")
    print("|---|---|---|---|---|---|")
    for name in HEADLINE:
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, sf).explain("formatted")
        text = buf.getvalue()
        nodes = re.findall(r"^\((\d+)\) (\w+)", text, re.M)
        kinds = [k for _, k in nodes]
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)))
        print(f"| {name} | {len(kinds)} | {kinds.count('Exchange')} | {kinds.count('BroadcastExchange')} | "
              f"{kinds.count('Window')} | {'<br>'.join('`' + s + '`' for s in schemas) or '–'} |")


if __name__ == "__main__":
    main()
