"""Command line: ``python -m tontine run|test``.

run   build the valuation from raw tables (``--raw-dir``) or from the driver tables
      (``--sf-dir``, fixture adapters), write the four marts (partitioned by curve and mortality
      basis) and the five CSV reports under ``--out``; exit 1 on an empty mart or a failing gate.
test  evaluate the declarative assertions, the validation gate and the assumption checks; exit 1
      on any failure or an empty gate.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def _valuation(spark, args):
    import datetime as dt

    from tontine.params import ValuationParams
    from tontine.plans.pipeline import Valuation
    from tontine.sources.fixtures import load_inputs
    from tontine.sources.tables import read_raw_tables
    raw = read_raw_tables(spark, location=args.raw_dir) if args.raw_dir else load_inputs(spark, args.sf_dir)
    params = ValuationParams(valuation_date=dt.date.fromisoformat(args.valuation_date),
                             mort_versions=tuple(args.mort_versions.split(",")),
                             pricing_mort_version=args.pricing_mort, pricing_curve_version=args.pricing_curve,
                             reference_mort_version=args.reference_mort, reference_curve_version=args.reference_curve,
                             va_pairs=tuple(tuple(x.split(":", 1)) for x in args.va_pairs.split(",") if x))
    return Valuation(raw, params, materialize=args.materialize)


def _gate(v) -> list[str]:
    """What keeps a valuation from being published, one line each; empty when it may be."""
    g = v.mart_validation.agg(F.count(F.lit(1)).alias("n"),
                              F.count(F.when(F.col("overall_validation_status") != "PASS", 1)).alias("bad")).first()
    out = [] if g.n else ["validation gate: no rows"]
    if g.bad:
        out.append(f"validation gate: {g.bad} of {g.n} rows fail")
    checks = v.assumption_checks.filter(F.col("failing") > 0).collect()  # one row per check
    return out + [f"assumption check {r.check}: {r.failing}" for r in checks]


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tontine")
    ap.add_argument("command", choices=["run", "test"])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-dir", help="folder holding the eight raw tables as <folder>/<table>")
    src.add_argument("--sf-dir", help="driver tables folder (orders, customer, ...)")
    ap.add_argument("--out", help="output folder (run)")
    ap.add_argument("--valuation-date", default="2026-01-01", help="first projection month (YYYY-MM-DD)")
    ap.add_argument("--mort-versions", default="M1,M2", help="mortality bases to value, comma separated")
    ap.add_argument("--pricing-mort", default="M1", help="mortality basis that prices a missing premium table")
    ap.add_argument("--pricing-curve", default="A", help="curve that prices a missing premium table")
    ap.add_argument("--reference-mort", default="M1", help="basis that mortality impacts are measured against")
    ap.add_argument("--reference-curve", default="A", help="curve that curve impacts are measured against")
    ap.add_argument("--va-pairs", default="A:B,C:D", help="curve pairs without:with volatility adjustment")
    ap.add_argument("--materialize", default="checkpoint", choices=["checkpoint", "table", "cache", "none"])
    args = ap.parse_args(argv)

    from tontine.operators import quality as DQ
    from tontine.plans.pipeline import report_queries, run_all
    from tontine.session import build_session
    from tontine.sources.sinks import export_csv
    spark = build_session()
    v = _valuation(spark, args)
    if args.command == "run":
        if not args.out:
            ap.error("run needs --out")
        paths = run_all(v, args.out)
        export_csv(report_queries(v), f"{args.out.rstrip('/')}/reports")
        for name, path in paths.items():
            print(f"{name}: {path}")
        bad = [f"{name}: no rows" for name, path in paths.items() if spark.read.parquet(path).isEmpty()] + _gate(v)
        for x in bad:
            print(f"FAIL {x}")
        return 1 if bad else 0
    rules = DQ.pipeline_rules(v.params.checks_by_mort_version)
    results = v.assertions(rules)
    bad_rules = results.filter(F.col("failing_rows") > 0).collect()            # one row per rule at most
    bad_gate = _gate(v)
    for r in bad_rules:
        print(f"FAIL {r.table_name} {r.rule}({r.columns}): {r.failing_rows}")
    for x in bad_gate:
        print(f"FAIL {x}")
    total = sum(len(x) for x in rules.values())
    print(f"{total - len(bad_rules)} of {total} assertions pass; validation gate failures: {len(bad_gate)}")
    return 1 if bad_rules or bad_gate else 0


if __name__ == "__main__":
    sys.exit(main())
