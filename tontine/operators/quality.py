"""Declarative data-quality runner (M1-M5): not_null, unique, unique_combination_of_columns,
accepted_values, accepted_range.

All row-level rules of one table are evaluated in a single aggregation pass (one conditional
sum per rule); each uniqueness rule is one grouped count whose map-side partial aggregation
absorbs hot keys. Output: (table_name, rule, columns, failing_rows), the number of failing
rows (row rules) or of duplicated key groups (uniqueness rules), as dbt reports them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_RULES = ("not_null", "accepted_values", "accepted_range")
UNIQUE_RULES = ("unique", "unique_combination_of_columns")


@dataclass(frozen=True)
class Rule:
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(col: str) -> Rule:
    return Rule("not_null", (col,))


def unique(col: str) -> Rule:
    return Rule("unique", (col,))


def unique_combo(*cols: str) -> Rule:
    return Rule("unique_combination_of_columns", tuple(cols))


def accepted_values(col: str, values: Sequence) -> Rule:
    return Rule("accepted_values", (col,), values=tuple(values))


def accepted_range(col: str, min_value=None, max_value=None, inclusive: bool = True) -> Rule:
    return Rule("accepted_range", (col,), min_value=min_value, max_value=max_value, inclusive=inclusive)


def failing_condition(rule: Rule) -> Column:
    """Row-level failure predicate (NULL counts only for not_null, as in dbt)."""
    c = F.col(rule.columns[0])
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(rule.values))
    if rule.kind == "accepted_range":
        ok = F.lit(True)
        if rule.min_value is not None:
            ok = ok & ((c >= rule.min_value) if rule.inclusive else (c > rule.min_value))
        if rule.max_value is not None:
            ok = ok & ((c <= rule.max_value) if rule.inclusive else (c < rule.max_value))
        return c.isNotNull() & ~ok
    raise ValueError(rule.kind)


def _out(table: str, rule: Rule, n: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(rule.kind).alias("rule"),
                    F.lit(rule.label).alias("columns"), F.coalesce(n, F.lit(0)).cast("long").alias("failing_rows"))


def run_table(table: str, df: DataFrame, rules: Iterable[Rule]) -> DataFrame | None:
    rules = list(rules)
    parts: list[DataFrame] = []
    row = [r for r in rules if r.kind in ROW_RULES]
    if row:
        sums = df.agg(*[F.sum(F.when(failing_condition(r), 1).otherwise(0)).alias(f"r{i}")
                        for i, r in enumerate(row)])
        parts.append(sums.select(F.inline(F.array(*[_out(table, r, F.col(f"r{i}")) for i, r in enumerate(row)]))))
    for r in rules:
        if r.kind not in UNIQUE_RULES:
            continue
        src = df.filter(F.col(r.columns[0]).isNotNull()) if r.kind == "unique" else df
        dups = src.groupBy(*r.columns).count().filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n"))
        parts.append(dups.select(F.inline(F.array(_out(table, r, F.col("n"))))))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def run_rules(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]],
              kinds: Sequence[str] | None = None) -> DataFrame:
    """Evaluate ``rules[table]`` on ``tables[table]``; optionally only some rule kinds."""
    out = None
    for name, rs in rules.items():
        rs = [r for r in rs if kinds is None or r.kind in kinds]
        if not rs:
            continue
        part = run_table(name, tables[name], rs)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    return out


RESULT_SCHEMA = "table_name string, rule string, columns string, failing_rows long"


_POLICY = ("stg_policy_cohort_input", ("cohort_id", "sex"))
_SCENARIO = ("stg_stress_scenario_definition", ("scenario_id",))
_MORTALITY = ("stg_mortality_assumption", ("age", "sex", "mort_version_id"))
_LAPSE = ("stg_lapse_assumption", ("duration_year",))
_PREMIUM = ("stg_premium_input", ("cohort_id", "sex"))
_CURVE = ("stg_discount_curve", ("tenor_month", "version_id"))
#: Whose keys make a model's key unique: each of these is built by joins on those keys and by
#: exploding distinct months, lines or versions.
PROVEN_BY: dict[str, tuple[tuple[str, tuple[str, ...]], ...]] = {
    "int_projection_frame": (_POLICY, _SCENARIO, _PREMIUM),
    "int_projection_mortality_rates": (_POLICY, _SCENARIO, _PREMIUM, _MORTALITY),
    "int_projection_lapse_rates": (_POLICY, _SCENARIO, _PREMIUM, _LAPSE),
    "int_inforce_rollforward": (_POLICY, _SCENARIO, _PREMIUM, _MORTALITY, _LAPSE),
    "int_cashflow_lines": (_POLICY, _SCENARIO, _PREMIUM, _MORTALITY, _LAPSE),
    "int_cashflows_discounted": (_POLICY, _SCENARIO, _PREMIUM, _MORTALITY, _LAPSE, _CURVE),
}


def _duplicated(df: DataFrame, columns: Sequence[str], skip_null: bool) -> DataFrame:
    src = df.filter(F.col(columns[0]).isNotNull()) if skip_null else df
    return src.groupBy(*columns).count().filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n"))


def unique_results(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> list[tuple]:
    """Duplicated keys per uniqueness rule. Keys of the inputs are counted in one job; a model whose
    inputs' keys are all unique has a unique key and is not grouped, any other one is."""
    wanted = [(t, r) for t, rs in rules.items() for r in rs if r.kind in UNIQUE_RULES]

    def count(pairs: list[tuple[str, tuple[str, ...], bool]]) -> dict[tuple, int]:
        parts = [_duplicated(tables[t], cols, skip).select(F.lit(i).alias("i"), "n") for i, (t, cols, skip) in enumerate(pairs)]
        one = None
        for p in parts:
            one = p if one is None else one.unionAll(p)
        return {} if one is None else {pairs[r.i][:2]: int(r.n) for r in one.collect()}  # one row a rule

    proving = {x for t, _ in wanted for x in PROVEN_BY.get(t, ())}
    first = [(t, r.columns, r.kind == "unique") for t, r in wanted if t not in PROVEN_BY]
    first += [(t, cols, False) for t, cols in sorted(proving) if (t, cols) not in {(a, b) for a, b, _ in first}]
    known = count(first)
    proven = {t for t, by in PROVEN_BY.items() if all(known.get(x) == 0 for x in by)}
    known |= count([(t, r.columns, r.kind == "unique") for t, r in wanted if t in PROVEN_BY and t not in proven])
    return [(t, r.kind, r.label, known.get((t, r.columns), 0)) for t, r in wanted]


def _val(col: str, keys: Sequence[str]) -> list[Rule]:
    return [not_null(col), accepted_values(col, ["PASS", "FAIL"]), unique_combo(*keys)]


def pipeline_rules(checks_by_mort_version: bool = True) -> dict[str, list[Rule]]:
    """The 87 column and key assertions of the reference, per table."""
    k3 = ("cohort_id", "sex", "scenario_id")
    k5 = k3 + ("version_id", "mort_version_id")
    kg = k3 + (("mort_version_id",) if checks_by_mort_version else ())
    nonneg = ["inforce_open", "inforce_close", "expected_deaths", "expected_lapses", "post_death_inforce"]
    return {
        "stg_policy_cohort_input": [unique_combo("cohort_id", "sex"), not_null("cohort_id"), not_null("sex")],
        "stg_mortality_assumption": [unique_combo("age", "sex", "mort_version_id"), not_null("age"),
                                     not_null("sex"), not_null("mort_version_id")],
        "stg_lapse_assumption": [not_null("duration_year"), unique("duration_year")],
        "stg_discount_curve": [not_null("tenor_month"), not_null("version_id")],
        "stg_expense_assumption": [not_null("expense_type")],
        "stg_premium_input": [unique_combo("cohort_id", "sex"), not_null("cohort_id"), not_null("sex")],
        "stg_stress_scenario_definition": [not_null("scenario_id"), unique("scenario_id")],
        "int_projection_frame": [not_null("cohort_id"), not_null("scenario_id"), not_null("projection_month"),
                                 unique_combo("cohort_id", "sex", "scenario_id", "projection_month")],
        "int_projection_mortality_rates": [
            not_null("base_qx_annual"), not_null("base_qx_monthly"), accepted_range("base_qx_monthly", 0, 1),
            not_null("scenario_qx_monthly"), accepted_range("scenario_qx_monthly", 0, 1),
            unique_combo("cohort_id", "sex", "scenario_id", "projection_month", "mort_version_id")],
        "int_projection_lapse_rates": [
            not_null("base_lapse_annual"), not_null("scenario_lapse_monthly"),
            accepted_range("scenario_lapse_monthly", 0, 1),
            unique_combo("cohort_id", "sex", "scenario_id", "projection_month")],
        "int_inforce_rollforward": [r for c in nonneg for r in (not_null(c), accepted_range(c, min_value=0))]
        + [unique_combo("cohort_id", "sex", "scenario_id", "projection_month", "mort_version_id")],
        "int_cashflow_lines": [
            not_null("cashflow_type"), accepted_values("cashflow_type", ["premium", "death_benefit", "expense"]),
            not_null("cashflow_timing"), accepted_values("cashflow_timing", ["month_start", "month_end"]),
            not_null("cashflow_amount"),
            unique_combo("cohort_id", "sex", "scenario_id", "projection_month", "cashflow_type", "mort_version_id")],
        "int_cashflows_discounted": [
            not_null("discount_factor"), accepted_range("discount_factor", min_value=0, inclusive=False),
            not_null("discounted_cashflow"),
            unique_combo("cohort_id", "sex", "scenario_id", "projection_month", "cashflow_type", "version_id",
                         "mort_version_id")],
        "int_bel_components": [not_null("bel_amount"), not_null("policy_count"), not_null("bel_per_policy"),
                               unique_combo(*k5)],
        "val_projection_continuity": _val("projection_ok", k3),
        "val_inforce_reconciliation": _val("inforce_ok", kg),
        "val_cashflow_sign_and_timing": _val("cashflow_ok", kg),
        "val_discounting_sanity": _val("discount_ok", k5),
        "val_bel_reconciliation": _val("bel_reconciled", k5),
        "val_sensitivity_direction": _val("sensitivity_ok", k5),
        "val_validation_summary": _val("overall_validation_status", k5),
        "mart_bel_components_core": [not_null("bel_amount"), unique_combo(*k5)],
        "mart_bel_sensitivity": [not_null("delta_bel"), unique_combo(*k5)],
        "mart_validation_summary": _val("overall_validation_status", k5),
        "mart_portfolio_overview": [not_null("scenario_id"), not_null("total_bel"),
                                    unique_combo("scenario_id", "version_id", "mort_version_id")],
    }
