"""Loaders with a reject channel, staging of many versions, and the ordered export."""

import csv
import glob

import pytest
from pyspark.sql import functions as F

from tontine.operators import pricing as PR
from tontine.operators import reports as RP
from tontine.operators import staging as ST
from tontine.params import ValuationParams
from tontine.plans.pipeline import report_queries
from tontine.sources import assumptions as A
from tontine.sources import fixtures as FX
from tontine.sources import rejects as RJ
from tontine.sources import sinks
from tests.conftest import SF_SMALL


def test_mortality_by_sex_rejects(spark):
    rows = [("2019", "35", "0.001", "0.002", "0.0015"), ("2019", "110+", "0.5", "x", None), ("", "36", "0.1", "0.1", "0.1"), ("2019", "n/a", "0.1", "0.1", "0.1"),
            ("2019", " 37 ans", "1.0", "-0.1", "NaN"), (None, None, None, None, None)]
    sheet = spark.createDataFrame(rows, "year string, age string, female string, male string, total string")
    got = RJ.mortality_by_sex(sheet, "T")
    loaded, bad = got.loaded.collect(), got.rejected.collect()
    assert len(loaded) + len(bad) == 3 * len(rows)
    assert {(r.age, r.sex): r.qx_annual for r in loaded} == {(35, "F"): 0.001, (35, "M"): 0.002, (35, "T"): 0.0015, (110, "F"): 0.5, (37, "F"): 1.0}
    reasons = {}
    for r in bad:
        reasons[r.reason] = reasons.get(r.reason, 0) + 1
    assert reasons == {"year": 6, "age": 3, "rate": 4}
    assert ("2019|110+|M|x", "rate") in {(r.record, r.reason) for r in bad}


def test_clean_sheets_load_as_by_the_plain_loaders(spark):
    wide = spark.createDataFrame([(2019, "35", 0.001, 0.002, 0.0015), (2018, "110+", 0.5, 0.6, 0.55)], "year long, age string, female double, male double, total double")
    assert sorted(map(tuple, RJ.mortality_by_sex(wide, "S").loaded.collect())) == sorted(map(tuple, A.load_mortality_wide_sex(wide, "S").collect()))
    deaths = spark.createDataFrame([(2019, 500.0, 40.0, 90000.0), (2018, 510.0, 41.0, 91000.0)], "annee long, `0 an` double, `2 ans` double, `110+` double")
    got = RJ.mortality_by_age(deaths, "M", "I")
    assert sorted(map(tuple, got.loaded.collect())) == sorted(map(tuple, A.load_mortality_wide_age(deaths, "M", "I").collect()))
    assert got.rejected.isEmpty()


def test_mortality_by_age_and_curve_rejects(spark):
    deaths = spark.createDataFrame([("2019", "500", "12x", "100001"), ("x", "1", "2", "3")], "annee string, `0 an` string, `1 an` string, total string")
    got = RJ.mortality_by_age(deaths, "F", "I")
    assert [(r.year, r.age, r.qx_annual) for r in got.loaded.collect()] == [(2019, 0, 0.005)]
    assert sorted(r.reason for r in got.rejected.collect()) == ["age", "rate", "year", "year", "year"]
    curve = spark.createDataFrame([("1", "0.02", "A"), ("1Y", "0.02", "A"), ("0", "0.02", "A"), ("2", "-", "A"), ("3", "0.02", " "), ("4", "inf", "A"), (None, None, None)],
                                  "tenor string, rate string, version_id string")
    got = RJ.curve_points(curve)
    assert [tuple(r) for r in got.loaded.collect()] == [(12, 0.02, "A")]
    assert sorted(r.reason for r in got.rejected.collect()) == ["rate", "rate", "tenor", "tenor", "version", "version"]


def test_csv_lines_that_do_not_parse(spark, tmp_path):
    (tmp_path / "a.csv").write_text("tenor,rate,version_id\n1,0.02,A\n2,0.03\n3,0.04,A,more\n4,,A\n")
    rows, bad = RJ.read_csv(spark, str(tmp_path), ["tenor", "rate", "version_id"])
    assert sorted(map(tuple, bad.collect())) == [("2,0.03", "too few cells"), ("3,0.04,A,more", "too many cells")]
    got = RJ.curve_points(rows)
    assert got.loaded.count() == 1 and [(r.record, r.reason) for r in got.rejected.collect()] == [("4|A", "rate")]


def test_staging_of_every_portfolio(spark):
    a = FX.agency_assumptions(spark.createDataFrame([(i, c, "F") for i, c in enumerate([1, 1001, 2002, 2003])], "o_orderkey long, o_custkey long, o_orderstatus string"))
    bases = a.assumption_version.withColumn("is_base_version", F.col("version_id").isin("G0", "G2", "L0", "E1"))
    one = lambda kind: ST.base_versions(bases, kind)
    assert {r.mort_version_id for r in ST.stg_mortality(a.mortality_assumption, one("mortality")).collect()} == {"G0", "G2"}
    assert {r.version_id for r in ST.stg_lapse_versions(a.lapse_assumption, one("lapse")).collect()} == {"L0"}
    assert {r.version_id for r in ST.stg_expense_versions(a.expense_assumption, one("expense")).collect()} == {"E1"}
    assert ST.stg_mortality(a.mortality_assumption, one("nothing")).isEmpty()


def test_annual_discounts_of_every_curve(spark, raw_small):
    p = ValuationParams()
    every = PR.annual_discounts(raw_small.discount_curve)
    one = sorted(map(tuple, PR.pricing_discount(raw_small.discount_curve, p).collect()))
    assert sorted(map(tuple, every.filter("version_id = 'A'").drop("version_id").collect())) == one and every.select("version_id").distinct().count() == 4


def test_pricing_keys_from_orders_alone(spark):
    o, c = (FX.read_table(spark, SF_SMALL, n) for n in ("orders", "customer"))
    keys = {tuple(r) for r in FX.policies(o, c).select("sex", "issue_age", "term_years").distinct().collect()}
    assert keys <= {tuple(r) for r in FX.pricing_keys(o).collect()}


def test_factors_by_scenario_from_the_table(val_small):
    v = val_small
    a = RP.df_by_scenario(v.discounted_cashflows)
    b = RP.df_by_scenario_from_table(v.frame_wide, v.discount_factor_table, v.staged.mortality, v.staged.curve, v.params.broadcast_max_rows)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))


def read_back(path):
    out = []
    for name in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(name, newline="") as f:
            out += list(csv.reader(f))[1:]
    return out


@pytest.mark.parametrize("report", ["01_bel_base_results", "02_portfolio_overview", "04_sensitivity_by_cohort"])
def test_export_keeps_the_order_over_files(spark, val_small, scratch, report):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = report_queries(val_small)[report]
        sinks.export_ordered(df, f"{scratch}/{report}", max_records=7)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(f"{scratch}/{report}/part-*.csv")) > 1
    want = [["" if x is None else str(x) for x in r] for r in df.collect()]
    got = read_back(f"{scratch}/{report}")
    assert len(got) == len(want)
    order = {"01_bel_base_results": [-1], "02_portfolio_overview": [-2], "04_sensitivity_by_cohort": [2, 0, 1, 3, 4]}[report]
    assert [[r[i] for i in order] for r in got] == [[r[i] for i in order] for r in want]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
