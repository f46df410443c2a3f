"""Experience study against day-by-day counts, numpy least squares and the blend's own limits."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tontine.operators import experience as EX
from tontine.operators import staging as ST
from tontine.sources import fixtures as FX

START, END = dt.date(2000, 1, 1), dt.date(2004, 3, 1)
SCHEMA = "policy_id long, sex string, birth_date date, entry_date date, exit_date date, exit_cause string"
DAY = dt.timedelta(days=1)


def lives():
    r = random.Random(7)
    d = lambda a, b: a + DAY * r.randrange((b - a).days)
    rows = []
    for i in range(60):
        entry = d(dt.date(1997, 1, 1), dt.date(2004, 6, 1))
        leave = r.choice([None, entry + DAY * r.randrange(0, 1500)])
        rows.append((i, r.choice("FM"), d(dt.date(1940, 1, 1), dt.date(1980, 1, 1)), entry, leave, r.choice(["death", "lapse", None]) if leave else None))
    leap = dt.date(1960, 2, 29)
    return rows + [
        (100, "F", leap, dt.date(2000, 2, 29), dt.date(2003, 2, 28), "death"), (101, "M", leap, leap, None, None),
        (102, "M", dt.date(1970, 1, 1), START, START, "death"),  # dies on the first day: one day
        (103, "M", dt.date(1970, 1, 1), START, START, "lapse"),  # no day
        (104, "M", None, START, None, None), (105, "M", dt.date(1970, 1, 1), None, None, None), (106, None, dt.date(1970, 1, 1), START, None, None),
        (107, "M", dt.date(1970, 1, 1), dt.date(1999, 1, 1), END - DAY, "death"), (108, "M", dt.date(1970, 1, 1), dt.date(1999, 1, 1), END, "death"),
        (109, "M", dt.date(1970, 1, 1), dt.date(2010, 1, 1), None, None), (107, "M", dt.date(1970, 1, 1), dt.date(1999, 1, 1), END - DAY, "death")]


def whole_years(since, day):
    n = day.year - since.year
    try:
        turn = since.replace(year=day.year)
    except ValueError:
        turn = dt.date(day.year, 2, 28)
    return n - (turn > day)


def day_by_day(rows):
    days, deaths = Counter(), Counter()
    for _, sex, birth, entry, leave, cause in rows:
        if birth is None or entry is None:
            continue
        day = max(entry, START)
        while day < END and (leave is None or day < leave or (cause == "death" and day == leave)):
            cell = (sex, whole_years(birth, day), whole_years(entry, day) + 1)
            days[cell] += 1
            deaths[cell] += cause == "death" and day == leave
            day += DAY
    return {(*c, n, deaths[c]) for c, n in days.items()}


def test_exposure_day_by_day(spark):
    h = spark.createDataFrame(lives(), SCHEMA).withColumn("days", F.lit("clash"))
    got = {tuple(r) for r in EX.exposure_table(h, START, END).collect()}
    assert got == day_by_day(lives())
    whole = EX.under_observation(h, START, END).agg(F.sum(F.datediff("obs_to", "obs_from"))).first()[0]
    assert sum(r[3] for r in got) == whole  # nothing lost or counted twice
    assert EX.exposure_table(h.limit(0), START, END).count() == 0


def test_pieces_have_one_age_and_year(spark):
    h = spark.createDataFrame(lives(), SCHEMA)
    birth = {r[0]: r[2] for r in lives()}
    for p in EX.exposure_pieces(h, START, END).collect():
        first, last = p.piece_from, p.piece_to - DAY
        assert whole_years(birth[p.policy_id], first) == whole_years(birth[p.policy_id], last) == p.attained_age


def test_exposure_has_one_small_shuffle(spark):
    h = FX.policy_histories(FX.read_table(spark, SF_SMALL, "orders"))
    plan = EX.exposure_table(h, START, END)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_graduation_against_numpy(spark):
    r = np.random.default_rng(1)
    rows = [(s, a, 1000, 5, float(r.uniform(1, 50)), float(r.uniform(0.5, 1.6))) for s in ("F", "M") for a in range(30, 71)]
    rows += [("T", 40, 10, 1, 2.0, 0.5), (None, 41, 10, 1, 2.0, 0.7), (None, 42, 10, 1, 3.0, 0.9), ("U", 41, 10, 0, 0.0, None)]
    ae = spark.createDataFrame(rows, "sex string, attained_age long, days long, deaths long, expected double, ae_ratio double")
    got = {(g.sex, g.term): g.coefficient for g in EX.graduate(ae, 3).collect()}
    for s in ("F", "M"):
        mine = [x for x in rows if x[0] == s]
        t, y, w = ((np.array([x[1] for x in mine]) - 50) / 25), np.array([x[5] for x in mine]), np.array([x[4] for x in mine])
        want = np.linalg.lstsq(np.vander(t, 4, increasing=True) * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
        assert [got[s, k] for k in range(4)] == pytest.approx(list(want), abs=1e-8)
    assert got["T", 0] == 0.5 and got[None, 0] + got[None, 1] * (41 - 50) / 25 == pytest.approx(0.7)
    assert ("U", 0) not in got and len(got) == 11
    assert EX.graduate(ae.limit(0)).count() == 0


def test_credibility_limits(spark):
    base = FX.mortality_table(spark)
    ae = spark.createDataFrame([("F", 50, 9, 1082, 1.0, 2.0), ("F", 51, 9, 4000, 1.0, 2.0), ("F", 52, 9, 0, 1.0, 0.0), ("F", 53, 9, 541, 1.0, 2.0)],
                               "sex string, attained_age long, days long, deaths long, expected double, ae_ratio double")
    terms = spark.createDataFrame([("F", 0, 2.0, 50, 53)], "sex string, term int, coefficient double, age_from long, age_to long")
    blend = EX.experience_mortality(base, ae, terms, "M1", "MX")
    q = {(r.sex, r.age): r.qx_annual for r in base.where("version_id = 'M1'").collect()}
    got = {(r.sex, r.age): (r.qx_annual, r.credibility) for r in blend.collect()}
    assert len(got) == 222
    assert got["F", 50] == (min(1.0, 2 * q["F", 50]), 1.0) and got["F", 51][1] == 1.0  # full credibility, not more
    assert got["F", 52] == (q["F", 52], 0.0) == (got["F", 52][0], 0.0) and got["M", 50] == (q["M", 50], 0.0)
    assert got["F", 53][0] == pytest.approx(q["F", 53] * (1 + 0.5 ** 0.5), abs=1e-15)


def test_version_reaches_staging_and_valuation(spark):
    """The blended rates are a version like any other: staged, projected, valued."""
    from tontine.params import ValuationParams
    from tontine.plans.pipeline import Valuation
    raw = FX.load_inputs(spark, SF_SMALL)
    nobody = spark.createDataFrame([], SCHEMA)
    _, _, same = EX.study(nobody, raw.mortality_assumption, "M1", "MX", START, END)
    raw.mortality_assumption = EX.with_experience(raw.mortality_assumption, same)
    assert ST.stg_mortality(raw.mortality_assumption, ("M1", "MX")).count() == 444
    port = Valuation(raw, ValuationParams(mort_versions=("M1", "MX"))).mart_portfolio.collect()
    bel = {(r.mort_version_id, r.scenario_id, r.version_id): r.total_bel for r in port}
    assert len(bel) == 72
    for (basis, *key), x in bel.items():  # no experience: the base rates
        assert x == pytest.approx(bel["M1", *key], rel=1e-9)
