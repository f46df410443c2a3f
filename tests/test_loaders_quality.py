"""Assumption loaders (A2-A9), the data-quality runner (M1-M5) and sinks."""

import os

from pyspark.sql import functions as F

from tontine.operators import quality as DQ
from tontine.sources import assumptions as A
from tontine.sources import sinks


def test_lapse_rule_and_literals(spark):
    lp = {r.duration_year: r.lapse_rate_annual for r in A.lapse_curve(spark).collect()}
    assert len(lp) == 30
    assert [lp[d] for d in (1, 2, 3, 4, 5, 6, 10, 11, 20, 21, 30)] == \
        [0.15, 0.13, 0.11, 0.09, 0.08, 0.06, 0.06, 0.03, 0.03, 0.02, 0.02]
    assert A.scenario_table(spark).count() == 9
    assert A.expense_table(spark).first().expense_rate == 0.03


def test_wide_by_sex_loader(spark):
    wide = spark.createDataFrame([(2019, "35", 0.001, 0.002, 0.0015), (2019, "110+", 0.5, 0.6, 0.55)],
                                 "year long, age string, female double, male double, total double")
    long = {(r.age, r.sex): r.qx_annual for r in A.load_mortality_wide_sex(wide).collect()}
    assert long[(35, "F")] == 0.001 and long[(35, "M")] == 0.002 and long[(35, "T")] == 0.0015
    assert long[(110, "M")] == 0.6


def test_wide_by_age_loader_and_versioning(spark):
    wide = spark.createDataFrame([(2019, 500.0, 40.0, 30.0, 90000.0), (2018, 510.0, 41.0, 31.0, 91000.0)],
                                 "annee long, `0 an` double, `1 an` double, `2 ans` double, `110+` double")
    insee = A.load_mortality_wide_age(wide, "M")
    got = {(r.year, r.age): r.qx_annual for r in insee.collect()}
    assert got[(2019, 0)] == 0.005 and got[(2019, 2)] == 0.0003 and got[(2018, 110)] == 0.91
    hmd = A.load_mortality_wide_sex(spark.createDataFrame(
        [(2019, "1", 0.1, 0.2, 0.15)], "year long, age string, female double, male double, total double"))
    allv = A.mortality_versioning([hmd, insee], "DEFAULT", "OVERRIDE")
    tags = {(r.source, r.year): r.version_id for r in allv.collect()}
    assert tags[("INSEE", 2019)] == "OVERRIDE" and tags[("INSEE", 2018)] == "DEFAULT"
    assert tags[("HMD", 2019)] == "DEFAULT"
    dups = A.duplicate_keys(allv.unionByName(allv.limit(1)))
    assert dups.count() == 1


def test_curve_loader_and_profile(spark):
    sheet = spark.createDataFrame([("EUR", "1", 0.02), ("EUR", "2", 0.021), ("EUR", "LLP", None), ("EUR", "x1", 0.0)],
                                  "label string, tenor string, rate double")
    c = A.load_curves([(sheet, "V1"), (sheet, "V2")])
    assert sorted((r.version_id, r.tenor_month) for r in c.collect()) == [("V1", 12), ("V1", 24), ("V2", 12), ("V2", 24)]
    prof = {r.version_id: (r.n_rows, r.n_versions) for r in A.curve_profile(c).collect()}
    assert prof == {"V1": (2, 2), "V2": (2, 2)}


def test_quality_runner_counts_failures(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5), (1, "b", 1.5), (None, "a", -0.1), (3, "zz", None)], "k int, t string, x double")
    rules = {"t": [DQ.not_null("k"), DQ.unique("k"), DQ.unique_combo("k", "t"),
                   DQ.accepted_values("t", ["a", "b"]), DQ.accepted_range("x", 0, 1),
                   DQ.accepted_range("x", min_value=0, inclusive=False)]}
    out = DQ.run_rules({"t": df}, rules).collect()
    got = {(r.rule, r.columns): r.failing_rows for r in out}
    assert got[("not_null", "k")] == 1
    assert got[("unique", "k")] == 1                        # key 1 twice
    assert got[("unique_combination_of_columns", "k,t")] == 0
    assert got[("accepted_values", "t")] == 1
    assert sorted(r.failing_rows for r in out if r.rule == "accepted_range") == [1, 2]


def test_pipeline_rule_set_size():
    rules = DQ.pipeline_rules()
    kinds = [r.kind for rs in rules.values() for r in rs]
    assert len(kinds) == 87 and kinds.count("not_null") == 45


def test_sinks_write_partitioned_and_csv(spark, val_small, scratch):
    from tontine.plans.pipeline import report_queries, run_all
    paths = run_all(val_small, scratch)
    assert os.path.isdir(os.path.join(paths["mart_bel_components_core"], "version_id=A"))
    back = spark.read.parquet(paths["mart_bel_components_core"]).filter(F.col("version_id") == "B")
    assert back.count() == 10 * 9 * 2
    sinks.export_csv(report_queries(val_small), os.path.join(scratch, "reports"))
    assert spark.read.option("header", True).csv(os.path.join(scratch, "reports", "03_validation_summary")).count() == 1


def test_ensure_schema_lists_tables(spark):
    assert isinstance(sinks.ensure_schema(spark, "tontine_test_schema"), list)


def test_raw_tables_round_trip(spark, raw_small, val_small, scratch):
    from tontine.plans.pipeline import Valuation
    from tontine.sources.tables import read_raw_tables, write_raw_tables
    write_raw_tables(raw_small, scratch)
    back = read_raw_tables(spark, location=scratch)
    assert back.premium_input is None                      # not written -> priced from the others
    a = {(r.scenario_id, r.version_id, r.mort_version_id): r.total_bel for r in val_small.mart_portfolio.collect()}
    b = {(r.scenario_id, r.version_id, r.mort_version_id): r.total_bel
         for r in Valuation(back).mart_portfolio.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert b[k] == a[k]


def test_cli_test_command_passes_on_clean_inputs():
    from tontine.__main__ import main
    assert main(["test", "--sf-dir", "/root/testdata/sf0.001"]) == 0


def test_register_views_supports_report_sql(spark, val_small):
    from tontine.plans.pipeline import register_views
    names = register_views(val_small, prefix="t_")
    assert len(names) == 26
    n = spark.sql("SELECT overall_validation_status, COUNT(*) AS n FROM t_mart_validation_summary GROUP BY 1").collect()
    assert [(r.overall_validation_status, r.n) for r in n] == [("PASS", 720)]


def test_cli_run_writes_marts_and_reports(spark, scratch):
    from tontine.__main__ import main
    assert main(["run", "--sf-dir", "/root/testdata/sf0.001", "--out", scratch, "--mort-versions", "M1",
                 "--valuation-date", "2026-04-01"]) == 0
    port = spark.read.parquet(os.path.join(scratch, "mart_portfolio_overview"))
    assert port.count() == 9 * 4 and {r.mort_version_id for r in port.collect()} == {"M1"}
    assert os.path.isdir(os.path.join(scratch, "reports", "05_inforce_decay"))
