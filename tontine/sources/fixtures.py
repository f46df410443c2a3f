"""Adapters from the driver's tables (orders, customer) to insurance inputs.

* ``policies``      one seriatim policy per order (unit-factor path, pricing)
* ``model_points``  agency x segment x sex model points (reference row path); an agency is a block
  of 1,000 customer keys, so the book grows with the data
* ``policy_histories`` dated lives of the orders' policies (birth, entry, exit, cause) for the
  experience study
* ``mortality_table`` / ``curve_table``: invented assumption tables (not the reference's data)
* ``agency_assumptions`` / ``supplier_curves``: assumption tables with a version per agency or
  supplier, taken from orders and lineitem, so that the assumption operators work on tables that
  grow with the data

The scans read only the columns they need; Catalyst prunes the rest at the parquet reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.operators.joins import dealt_join
from tontine.sources import assumptions as A
from tontine.sources.schemas import POLICY_SCHEMA, RAW_SCHEMAS, conform, literal_table

# Fixed values of the test fixture: market segment -> (cohort, issue age, term, elapsed years)
SEGMENT_COHORTS = [
    ("AUTOMOBILE", "C1", 35, 30, 5),
    ("BUILDING", "C2", 50, 25, 10),
    ("FURNITURE", "C3", 60, 20, 5),
    ("MACHINERY", "C4", 65, 15, 3),
    ("HOUSEHOLD", "C5", 45, 20, 8),
]
# any other segment is its own cohort with these attributes: issue age, term, elapsed years
OTHER_SEGMENT = (40, 25, 4)
MODEL_POINT_SUM_ASSURED = 100000
# invented curves: version -> 1-year start rate, converging to 3.3 %
CURVE_START_RATES = [("A", 0.020), ("B", 0.0225), ("C", 0.0215), ("D", 0.024)]
MORTALITY_VERSIONS = [("M1", 1.0), ("M2", 1.15)]
CUSTOMERS_PER_AGENCY = 1000
SUPPLIER_CURVE_YEARS = 60


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sex(custkey: F.Column) -> F.Column:
    return F.when(custkey % 2 == 0, F.lit("F")).otherwise(F.lit("M"))


def _agency(custkey: F.Column) -> F.Column:
    return F.floor(custkey / F.lit(CUSTOMERS_PER_AGENCY)).cast("long")


def policies(orders: DataFrame, customer: DataFrame, pieces: dict[int, int] | None = None, parts: int | None = None) -> DataFrame:
    """One policy per order. Sort-merge (or AQE-broadcast) join on the customer key, nothing is
    collected; a hot customer is split into the ``pieces`` given or else by AQE's skew-join handling.
    With ``parts`` the orders are dealt to so many tasks by the shuffle that the join needs anyway,
    as narrow rows: the policies need no second one."""
    o = orders.select("o_orderkey", "o_custkey", F.floor("o_totalprice").alias("sum_assured"))
    j = dealt_join(o, customer.select("c_custkey", "c_mktsegment"), "o_custkey", "c_custkey", pieces, parts)
    return conform(j.select(
        F.col("o_orderkey").alias("policy_id"),
        F.col("c_mktsegment").alias("cohort_id"),
        _sex(F.col("c_custkey")).alias("sex"),
        (25 + 5 * (F.col("c_custkey") % 9)).alias("issue_age"),
        (10 + 5 * (F.col("o_orderkey") % 5)).alias("term_years"),
        (F.col("o_orderkey") % 8).alias("elapsed_duration_years"),
        "sum_assured",
        F.lit(1).alias("policy_count")), POLICY_SCHEMA)


def policy_histories(orders: DataFrame) -> DataFrame:
    """One dated policy per order: entry on the order's date, birth by customer, an invented exit
    (a death with 1.2 times the M1 rate at entry age over the time held, else a lapse or none)."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    o = orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("entry_date"))
    held = (key * 7919 % 3000 + 1).cast("int")
    o = o.select(key.alias("policy_id"), _sex(cust).alias("sex"), F.date_add(F.lit("1925-01-01").cast("date"), (cust * 37 % 18000).cast("int")).alias("birth_date"),
                 "entry_date", held.alias("held"), (key * 48271 % 99991 / F.lit(99991.0)).alias("draw"), (key % 3 == 0).alias("lapses"))
    o = o.withColumn("age", F.year("entry_date") - F.year("birth_date"))
    died = F.col("draw") < F.col("held") / F.lit(365.25) * _gompertz(F.lit(1.2))
    cause = F.when(died, F.lit("death")).when(F.col("lapses"), F.lit("lapse"))
    return o.withColumn("exit_cause", cause).select("policy_id", "sex", "birth_date", "entry_date",
                                                   F.when(F.col("exit_cause").isNotNull(), F.date_add("entry_date", F.col("held"))).alias("exit_date"), "exit_cause")


def pricing_keys(orders: DataFrame) -> DataFrame:
    """The pricing keys (sex, issue age, term) of ``policies``, from the orders alone."""
    cust = F.col("o_custkey")
    return orders.where(cust.isNotNull()).select(_sex(cust).alias("sex"), (25 + 5 * (cust % 9)).cast("int").alias("issue_age"),
                                                 (10 + 5 * (F.col("o_orderkey") % 5)).cast("int").alias("term_years")).distinct()


SEGMENT_SCHEMA = T.StructType([T.StructField("seg", T.StringType()), T.StructField("cohort_id", T.StringType()),
                               T.StructField("issue_age", T.IntegerType()), T.StructField("term_years", T.IntegerType()),
                               T.StructField("elapsed", T.IntegerType())])


def policy_exposure(orders: DataFrame, customer: DataFrame, pieces: dict[int, int] | None = None) -> DataFrame:
    """Exposure per (segment, sex, risk cell) without materializing policies: the four columns it
    needs are shuffled once, for the customer join, and summed map-side in the join's own tasks. (Sums per
    customer and cell before the join would be nearly as many rows as orders, shuffled twice.) A hot
    customer is split into the ``pieces`` given or else by AQE's skew-join handling.
    Sum of sum_assured and of policy_count, exactly as over the per-order policies."""
    o = orders.select("o_custkey", (10 + 5 * (F.col("o_orderkey") % 5)).cast("int").alias("term_years"),
                      (F.col("o_orderkey") % 8).cast("int").alias("elapsed_duration_years"),
                      F.floor("o_totalprice").cast("long").alias("sa"))
    j = dealt_join(o, customer.select("c_custkey", "c_mktsegment"), "o_custkey", "c_custkey", pieces)
    return (j.groupBy(F.col("c_mktsegment").alias("cohort_id"), _sex(F.col("c_custkey")).alias("sex"),
                      (25 + 5 * (F.col("c_custkey") % 9)).cast("int").alias("issue_age"),
                      "term_years", "elapsed_duration_years")
            .agg(F.sum("sa").alias("exposure"), F.count(F.lit(1)).alias("policy_count")))


def segment_cohorts(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SEGMENT_COHORTS, SEGMENT_SCHEMA)


def model_points(orders: DataFrame, customer: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Agency x segment x sex model points (policy_cohort_input schema).

    Orders are first counted per customer (map-side partial aggregation, so one customer
    holding a third of all orders costs nothing extra), then joined to customer on the key
    the aggregate is already partitioned by, then rolled up to the model points. Agency 0's
    cohorts carry the segment's cohort name alone, the others add their number (``C1-7``).
    """
    spark = spark or orders.sparkSession
    per_cust = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = customer.select("c_custkey", "c_mktsegment")
    j = per_cust.join(c, per_cust.o_custkey == c.c_custkey, "inner")
    seg = F.broadcast(segment_cohorts(spark))
    age, term, elapsed = (F.lit(x) for x in OTHER_SEGMENT)
    agency = _agency(F.col("c_custkey"))
    cohort = F.concat_ws("-", F.coalesce("cohort_id", "c_mktsegment", F.lit("NONE")), F.when(agency != 0, agency).cast("string"))
    mp = (j.join(seg, j.c_mktsegment == seg.seg, "left")
          .groupBy(cohort.alias("cohort_id"),
                   _sex(F.col("c_custkey")).alias("sex"), F.coalesce("issue_age", age).alias("issue_age"),
                   F.coalesce("term_years", term).alias("term_years"),
                   F.coalesce("elapsed", elapsed).alias("elapsed_duration_years"))
          .agg(F.sum("n").alias("policy_count")))
    return conform(mp.select(
        "cohort_id", "sex", "issue_age", "term_years",
        (F.col("issue_age") + F.col("term_years")).alias("maturity_age"),
        F.lit(MODEL_POINT_SUM_ASSURED).alias("sum_assured"), "policy_count", "elapsed_duration_years",
        F.lit("COHORT_FIXTURE").alias("version_id")), RAW_SCHEMAS["policy_cohort_input"])


def _gompertz(factor: F.Column) -> F.Column:
    sex_f = F.when(F.col("sex") == "F", F.lit(0.55)).otherwise(F.lit(1.0))
    return F.least(F.lit(1.0), sex_f * (F.lit(0.0003) + F.lit(0.00002) * F.pow(F.lit(1.11), F.col("age"))) * factor)


def mortality_table(spark: SparkSession, max_age: int = 110) -> DataFrame:
    """Invented Gompertz-like annual q by age 0..max_age, sex F/M, versions M1/M2 (444 rows)."""
    versions = F.array(*[F.struct(F.lit(v).alias("version_id"), F.lit(f).alias("factor"))
                         for v, f in MORTALITY_VERSIONS])
    grid = (spark.range(0, max_age + 1).select(F.col("id").alias("age"))
            .select("age", F.explode(F.array(F.lit("F"), F.lit("M"))).alias("sex"))
            .select("age", "sex", F.inline(versions)))
    q = F.round(_gompertz(F.col("factor")), 8)
    return conform(grid.select(
        F.lit(2019).alias("year"), "age", "sex", q.alias("qx_annual"), F.lit("SYNTH").alias("source"),
        "version_id"), RAW_SCHEMAS["mortality_assumption"])


def curve_table(spark: SparkSession, max_years: int = 150) -> DataFrame:
    """Invented annual zero curves, tenor 12..12*max_years months, 4 versions (600 rows)."""
    versions = F.array(*[F.struct(F.lit(v).alias("version_id"), F.lit(r).alias("start_rate"))
                         for v, r in CURVE_START_RATES])
    g = spark.range(1, max_years + 1).select(F.col("id").alias("t"), F.inline(versions))
    z = F.round(F.lit(0.033) - (F.lit(0.033) - F.col("start_rate")) / (F.lit(1.0) + F.col("t") / F.lit(8.0)), 8)
    return conform(g.select((F.col("t") * 12).alias("tenor_month"), z.alias("zero_rate_annual"), "version_id"),
                   RAW_SCHEMAS["discount_curve"])


def _zero_rate(start: F.Column) -> F.Column:
    return F.lit(0.033) - (F.lit(0.033) - start) / (F.lit(1.0) + F.col("t") / F.lit(8.0))


def supplier_curves(lineitem: DataFrame, max_years: int = SUPPLIER_CURVE_YEARS) -> DataFrame:
    """Two curves per supplier: ``S<key>`` starts at 1 % plus a term that grows with its mean
    discount, ``S<key>-VA`` lies above it at the start by one that grows with its mean tax. Means
    of whole percentages, so that the order of summation does not matter; square roots, so that
    rates are no short decimals, whose last digit rounding would leave to the platform."""
    per = lineitem.filter(F.col("l_suppkey").isNotNull()).groupBy("l_suppkey").agg(
        *[(F.sum(F.round(F.col(c) * 100).cast("long")) / F.count(c)).alias(c) for c in ("l_discount", "l_tax")])
    term = lambda c: F.sqrt(F.col(c) + F.lit(1 / 3)) / F.lit(500.0)
    start = F.lit(0.01) + term("l_discount")
    name = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    versions = F.array(F.struct(name.alias("version_id"), start.alias("start_rate")),
                       F.struct(F.concat(name, F.lit("-VA")).alias("version_id"),
                                (start + term("l_tax")).alias("start_rate")))
    g = (per.select(F.inline(versions))
         .select("version_id", "start_rate", F.explode(F.sequence(F.lit(1), F.lit(max_years))).alias("t")))
    return conform(g.select((F.col("t") * 12).alias("tenor_month"), _zero_rate(F.col("start_rate")).alias("zero_rate_annual"),
                            "version_id"), RAW_SCHEMAS["discount_curve"])


def supplier_pairs(lineitem: DataFrame) -> DataFrame:
    """(without, with) volatility adjustment: one pair of curve versions per supplier."""
    name = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    return (lineitem.select("l_suppkey").filter(F.col("l_suppkey").isNotNull()).distinct()
            .select(name.alias("first_version_id"), F.concat(name, F.lit("-VA")).alias("second_version_id")))


@dataclass
class AgencyAssumptions:
    """Raw assumption tables with one version per agency."""
    mortality_assumption: DataFrame
    lapse_assumption: DataFrame
    expense_assumption: DataFrame
    stress_scenario_definition: DataFrame
    assumption_version: DataFrame


def agency_assumptions(orders: DataFrame, max_age: int = 110) -> AgencyAssumptions:
    """Assumption tables per agency from its orders: mortality ``G<k>`` scaled by the share of
    finished orders, lapse ``L<k>`` per policy year the share of open ones, expense ``E<k>``, and
    the fixed scenarios with the agency's lapse scale, missing where neutral. Agency 0's versions
    are the base versions. Shares are quotients of counts."""
    o = orders.filter(F.col("o_custkey").isNotNull()).select(
        _agency(F.col("o_custkey")).alias("agency"), (F.col("o_orderkey") % 8 + 1).alias("duration_year"), "o_orderstatus")
    share = lambda status: F.count(F.when(F.col("o_orderstatus") == status, 1)) / F.count(F.lit(1))
    per = o.groupBy("agency").agg(share("F").alias("finished"))
    key = lambda letter: F.concat(F.lit(letter), F.col("agency").cast("string"))

    grid = (per.select("agency", "finished", F.explode(F.sequence(F.lit(0), F.lit(max_age))).alias("age"))
            .select("agency", "finished", "age", F.explode(F.array(F.lit("F"), F.lit("M"))).alias("sex")))
    mortality = grid.select(F.lit(2019).alias("year"), "age", "sex", _gompertz(F.lit(0.8) + F.col("finished")).alias("qx_annual"),
                            F.lit("AGENCY").alias("source"), key("G").alias("version_id"))

    lapse = (o.groupBy("agency", "duration_year").agg(share("O").alias("open"))
             .select("duration_year", (F.col("open") / F.lit(4.0)).alias("lapse_rate_annual"), key("L").alias("version_id")))

    expense = per.select(F.lit("maintenance").alias("expense_type"), F.lit("premium").alias("expense_basis"),
                         (F.lit(0.03) + F.col("finished") / F.lit(100.0)).alias("expense_rate"),
                         key("E").alias("version_id"), F.lit(None).cast("string").alias("comment"))

    names = RAW_SCHEMAS["stress_scenario_definition"].names
    fixed = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row)]) for row in A.SCENARIO_ROWS])
    s = per.select("agency", "finished", F.inline(fixed))
    scenario = s.select(
        F.concat_ws("@", "scenario_id", F.col("agency").cast("string")).alias("scenario_id"), "scenario_type",
        F.when(F.col("mortality_multiplier") != 1.0, F.col("mortality_multiplier")).alias("mortality_multiplier"),
        F.when(F.col("lapse_multiplier") != 1.0, F.col("lapse_multiplier") + F.col("finished") / F.lit(10.0)).alias("lapse_multiplier"),
        F.when(F.col("discount_shift_bps") != 0, F.col("discount_shift_bps")).alias("discount_shift_bps"),
        "scenario_group", "is_base_scenario", "scenario_description")

    kinds = F.array(*[F.struct(F.lit(kind).alias("assumption_type"), key(letter).alias("version_id"))
                      for kind, letter in (("mortality", "G"), ("lapse", "L"), ("expense", "E"))])
    version = per.select("agency", F.inline(kinds)).select(
        "assumption_type", "version_id", F.concat_ws(" ", F.lit("Agency"), F.col("agency").cast("string")).alias("version_name"),
        (F.col("agency") == 0).alias("is_base_version"))
    return AgencyAssumptions(*(conform(df, RAW_SCHEMAS[n]) for df, n in (
        (mortality, "mortality_assumption"), (lapse, "lapse_assumption"), (expense, "expense_assumption"),
        (scenario, "stress_scenario_definition"), (version, "assumption_version"))))


def mortality_sheet(orders: DataFrame, max_age: int = 110) -> DataFrame:
    """The agencies' mortality as a sheet of text cells, one row per agency and age: labels with
    units, and defects that grow with the book (agency plus age divisible by 17: no number in the label; by
    13: a word for the male rate; by 19: a female rate above one; by 23: no year)."""
    o = orders.filter(F.col("o_custkey").isNotNull()).select(_agency(F.col("o_custkey")).alias("agency"), "o_orderstatus")
    per = o.groupBy("agency").agg((F.count(F.when(F.col("o_orderstatus") == "F", 1)) / F.count(F.lit(1))).alias("finished"))
    grid = per.select("agency", "finished", F.explode(F.sequence(F.lit(0), F.lit(max_age))).alias("age"))
    n = F.col("agency") + F.col("age")
    # a quotient of integers with few digits, so that its text is the same everywhere
    rate = lambda base: (F.floor((F.lit(base) + F.col("age")) * (F.lit(0.8) + F.col("finished")) * 100) / F.lit(131072.0)).cast("string")
    label = F.when(n % 17 == 0, F.lit("n/a")).when(F.col("age") == max_age, F.concat(F.col("age").cast("string"), F.lit("+"))).otherwise(F.concat(F.lit(" "), F.col("age").cast("string"), F.lit(" ans")))
    return grid.select(F.when(n % 23 != 0, F.lit("2019")).alias("year"), label.alias("age"), F.when(n % 19 == 0, F.lit("1.5")).otherwise(rate(3)).alias("female"),
                       F.when(n % 13 == 0, F.lit("x")).otherwise(rate(5)).alias("male"), rate(4).alias("total"))


def curve_sheet(lineitem: DataFrame, years: int = 20) -> DataFrame:
    """The suppliers' curves as a sheet of text cells (tenor in years, rate, version), with defects:
    supplier plus tenor divisible by 11: a dash for the rate; by 7: a tenor in words."""
    per = lineitem.filter(F.col("l_suppkey").isNotNull()).groupBy("l_suppkey").agg(F.count("l_discount").alias("lines"))
    g = per.select("l_suppkey", "lines", F.explode(F.sequence(F.lit(1), F.lit(years))).alias("t"))
    n = F.col("l_suppkey") + F.col("t")
    return g.select(F.when(n % 7 == 0, F.concat(F.col("t").cast("string"), F.lit("Y"))).otherwise(F.col("t").cast("string")).alias("tenor"),
                    F.when(n % 11 == 0, F.lit("-")).otherwise(((F.col("lines") % 100 + F.col("t") + 10) / F.lit(8192.0)).cast("string")).alias("rate"),
                    F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("version_id"))


@dataclass
class RawInputs:
    """The eight raw tables of the reference (premium_input is priced from the others)."""
    policy_cohort_input: DataFrame
    mortality_assumption: DataFrame
    lapse_assumption: DataFrame
    discount_curve: DataFrame
    expense_assumption: DataFrame
    stress_scenario_definition: DataFrame
    assumption_version: DataFrame
    premium_input: DataFrame | None = None


def load_inputs(spark: SparkSession, sf_dir: str, seriatim: bool = False) -> RawInputs:
    """Driver tables -> raw inputs. ``seriatim`` uses one policy per order as model points."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    if seriatim:
        p = policies(orders, customer)
        mp = conform(p.select(
            F.col("policy_id").cast("string").alias("cohort_id"), "sex", "issue_age", "term_years",
            (F.col("issue_age") + F.col("term_years")).alias("maturity_age"), "sum_assured",
            "policy_count", "elapsed_duration_years", F.lit("SERIATIM").alias("version_id")),
            RAW_SCHEMAS["policy_cohort_input"])
    else:
        mp = model_points(orders, customer, spark)
    return RawInputs(
        policy_cohort_input=mp,
        mortality_assumption=mortality_table(spark),
        lapse_assumption=A.lapse_curve(spark),
        discount_curve=curve_table(spark),
        expense_assumption=A.expense_table(spark),
        stress_scenario_definition=A.scenario_table(spark),
        assumption_version=A.version_table(spark),
    )
