"""The model-point row path: raw tables -> staging -> projection -> marts -> validation.

``Valuation`` exposes every layer as a lazily built DataFrame (nothing executes until an
action or a sink). Shuffles in the whole BEL chain: one for the roll-forward window, one
for the BEL aggregation; every assumption table is joined by a size-checked broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from tontine.operators import cashflow as CF
from tontine.operators import checks as CK
from tontine.operators import discounting as DS
from tontine.operators import pricing as PR
from tontine.operators import projection as PJ
from tontine.operators import quality as DQ
from tontine.operators import staging as ST
from tontine.operators import valuation as VL
from tontine.operators import vectors as VC
from tontine.operators.joins import forget_counts
from tontine.params import ValuationParams
from tontine.session import boundary_path, ensure_checkpoint_dir
from tontine.sources.fixtures import RawInputs
from tontine.sources.schemas import RAW_SCHEMAS, conform


class Valuation:
    """Stage boundaries (staged model points, premiums, the roll-forward, the BEL table) are
    materialized so that every branch of a plan (marts, validation, reports) reads them once
    instead of re-deriving the chain:

    * ``materialize="cache"``: lazy ``persist`` (memory, spilling to disk), filled
      by the first action and shared by all branches; lost blocks are recomputed from lineage.
    * ``materialize="checkpoint"`` (default): eager ``checkpoint`` into ``spark.checkpoint.dir``
      (the cluster's shared folder); lineage is cut, a lost executor replays nothing upstream.
    * ``materialize="table"``: each boundary written as a parquet table under
      ``spark.checkpoint.dir`` and read back (lineage cut; columnar, so readers prune columns,
      and the optimizer sees real file sizes). Prefer it when a boundary is large.
    * ``materialize="none"``: one plan, no reuse.
    """

    def __init__(self, raw: RawInputs, params: ValuationParams | None = None, materialize: str = "checkpoint"):
        self.raw = raw
        self.params = params or ValuationParams()
        self.materialize = materialize
        forget_counts(raw.policy_cohort_input.sparkSession)  # inputs may have been rewritten
        self._persisted: list[DataFrame] = []

    def _boundary(self, df: DataFrame) -> DataFrame:
        if self.materialize == "cache":
            self._persisted.append(df.persist())
            return df
        if self.materialize == "table":
            # a written parquet table in the shared checkpoint folder: lineage cut, columnar
            # (readers prune columns), and real file sizes for the optimizer's join choices
            path = boundary_path(df.sparkSession)
            df.write.mode("overwrite").parquet(path)
            return df.sparkSession.read.parquet(path)
        if self.materialize == "checkpoint":
            ensure_checkpoint_dir(df.sparkSession)
            df.persist()                       # the checkpoint write reads these blocks, no recompute
            out = df.checkpoint(eager=True)    # reliable copy in spark.checkpoint.dir; lineage cut here
            df.unpersist()
            return out
        return df

    def release(self) -> None:
        """Drop cached boundaries (checkpoint files are managed by spark.cleaner)."""
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()

    # ------------------------------------------------------------------ raw + staging
    @cached_property
    def premium_input(self) -> DataFrame:
        if self.raw.premium_input is not None:
            return self.raw.premium_input
        # priced inside the row: no table of rates, no boundary
        priced = VC.premium_vectors(self.staged_policy, self.raw.mortality_assumption, self.raw.discount_curve, self.params)
        return conform(PR.premium_columns(priced, self.params), RAW_SCHEMAS["premium_input"])

    @cached_property
    def staged_policy(self) -> DataFrame:
        return self._boundary(ST.stg_policy(self.raw.policy_cohort_input))

    @cached_property
    def staged(self) -> ST.Staged:
        r, p = self.raw, self.params
        return ST.Staged(
            policy=self.staged_policy,
            mortality=ST.stg_mortality(r.mortality_assumption, p.mort_versions),
            lapse=ST.stg_lapse(r.lapse_assumption, r.assumption_version),
            curve=ST.stg_curve(r.discount_curve),
            expense=ST.stg_expense(r.expense_assumption, r.assumption_version),
            scenario=ST.stg_scenario(r.stress_scenario_definition),
            premium=ST.stg_premium(self.premium_input, r.assumption_version),
            version=ST.stg_version(r.assumption_version))

    # ------------------------------------------------------------------ projection
    @cached_property
    def frame_wide(self) -> DataFrame:
        return PJ.projection_frame(self.priced, self.staged.scenario, self.params)

    @cached_property
    def projection_frame(self) -> DataFrame:
        return self.frame_wide.select(*PJ.FRAME_COLUMNS)

    @cached_property
    def mortality_rates(self) -> DataFrame:
        return PJ.mortality_rates(self.frame_wide, self.staged.mortality, self.params)

    @cached_property
    def lapse_rates(self) -> DataFrame:
        return PJ.lapse_rates(self.frame_wide, self.staged.lapse, self.params)

    @cached_property
    def priced(self) -> DataFrame:
        """Model points with their monthly premium."""
        return PJ.with_premium(self.staged.policy, self.staged.premium)

    @cached_property
    def inforce_plan(self) -> DataFrame:
        return PJ.inforce_wide_years(self.priced, self.staged.scenario, self.staged.mortality, self.staged.lapse, self.params)

    @cached_property
    def inforce_wide(self) -> DataFrame:
        return self._boundary(self.inforce_plan)

    @cached_property
    def chain_years(self) -> DataFrame:
        """The projection as year vectors, one row per model point, scenario and basis."""
        return VC.chain_years(self.priced, self.staged.scenario, self.staged.mortality, self.staged.lapse, self.params)

    @cached_property
    def inforce_rollforward(self) -> DataFrame:
        return self.inforce_wide.select(*PJ.INFORCE_COLUMNS)

    # ------------------------------------------------------------------ cash flows, PV
    @property
    def inforce_rows(self) -> DataFrame:
        """The roll-forward for a single reader: its boundary if there is one, else the plan, which
        costs less to run once than to write and read back."""
        return self.__dict__.get("inforce_wide", self.inforce_plan)

    @cached_property
    def cashflow_wide(self) -> DataFrame:
        return CF.cashflow_lines(self.inforce_rows, self.staged.expense, self.params,
                                 carry=("discount_shift_bps", *VL.BEL_CARRY))

    @cached_property
    def cashflow_lines(self) -> DataFrame:
        return self.cashflow_wide.select(*CF.CASHFLOW_COLUMNS)

    @cached_property
    def discount_factor_table(self) -> DataFrame:
        return DS.discount_factor_table(self.staged.curve, self.staged.scenario, self.params)

    @cached_property
    def discount_years(self) -> DataFrame:
        """The discount factors by year: a small table that the BEL and the gate read."""
        return self._boundary(VC.discount_years(self.staged.curve, self.staged.scenario))

    @cached_property
    def discounted_wide(self) -> DataFrame:
        return DS.discounted_cashflows(self.cashflow_wide, self.staged.curve, self.staged.scenario, self.params)

    @cached_property
    def discounted_cashflows(self) -> DataFrame:
        return self.discounted_wide.select(*DS.DISCOUNTED_COLUMNS)

    # ------------------------------------------------------------------ valuation
    @cached_property
    def bel_wide(self) -> DataFrame:
        st = self.staged
        return self._boundary(VC.bel_from_years(self.chain_years, self.discount_years, CF.expense_rate(st.expense, self.params), self.params))

    @cached_property
    def bel_by_rows(self) -> DataFrame:
        """The BEL summed from month rows: the same values by the other layout."""
        st = self.staged
        return VL.bel_from_inforce(self.inforce_wide, st.curve, st.scenario, CF.expense_rate(st.expense, self.params), self.params)

    @cached_property
    def bel_components(self) -> DataFrame:
        return VL.bel_components(self.bel_wide)

    @cached_property
    def mart_core(self) -> DataFrame:
        return VL.mart_core(self.bel_wide)

    @cached_property
    def mart_sensitivity(self) -> DataFrame:
        return VL.mart_sensitivity(self.mart_core, self.params)

    @cached_property
    def mart_portfolio(self) -> DataFrame:
        return VL.mart_portfolio(self.mart_core, self.mart_sensitivity, self.params)

    # ------------------------------------------------------------------ validation
    @cached_property
    def val_projection(self) -> DataFrame:
        return CK.val_projection(self.frame_wide, self.inforce_wide)

    @cached_property
    def val_inforce(self) -> DataFrame:
        return CK.val_inforce(self.inforce_wide, self.params)

    @cached_property
    def val_cashflow(self) -> DataFrame:
        return CK.val_cashflow(self.cashflow_wide, self.params)

    @cached_property
    def val_discount(self) -> DataFrame:
        return CK.val_discount(self.discounted_wide)

    @cached_property
    def val_bel(self) -> DataFrame:
        return CK.val_bel(self.bel_components, self.params, self.discounted_wide)

    @cached_property
    def val_direction(self) -> DataFrame:
        return CK.val_direction(self.bel_components, self.params)

    @cached_property
    def gate(self) -> dict[str, DataFrame] | None:
        """The check tables from one pass over the month rows; None when the curve versions are too
        many to be columns of it."""
        st = self.staged
        versions = DS.pivot_versions(st.curve, self.params)
        if versions is None:
            return None
        sums = self._boundary(CK.gate_sums(self.inforce_rows, self.discount_years, CF.expense_rate(st.expense, self.params), versions, self.params))
        return CK.gate_tables(self.frame_wide, sums, self.bel_components, self.params)

    @cached_property
    def validation_summary(self) -> DataFrame:
        return self.validation_by_checks if self.gate is None else self.gate["val_validation_summary"]

    @cached_property
    def validation_by_checks(self) -> DataFrame:
        """L7 from the single checks, each with a pass of its own."""
        return CK.validation_summary(self.val_projection, self.val_inforce, self.val_cashflow, self.val_discount,
                                     self.val_bel, self.val_direction, self.params)

    @cached_property
    def mart_validation(self) -> DataFrame:
        return CK.mart_validation(self.validation_summary)

    @cached_property
    def assumption_checks(self) -> DataFrame:
        rated = PJ.with_mortality(self.frame_wide, self.staged.mortality, self.params)
        return CK.assumption_checks(self.frame_wide, self.staged.mortality, self.staged.lapse, self.staged.curve,
                                    self.staged.expense, rated, self.params)

    # ------------------------------------------------------------------ assertions
    def row_assertions(self, rules: dict[str, list[DQ.Rule]], kinds: Sequence[str] = DQ.ROW_RULES) -> list[tuple]:
        """The row rules of ``kinds`` in one job: every model that has one is summed by itself, map-side,
        so a task reports the metrics of its own model alone; models without one are not built."""
        names = [n for n, rs in rules.items() if any(r.kind in kinds for r in rs)]
        found = DQ.run_rules({n: self.checked_table(n) for n in names}, {n: rules[n] for n in names}, kinds) if names else None
        return [] if found is None else [tuple(r) for r in found.collect()]  # one row a rule

    def checked_table(self, name: str) -> DataFrame:
        """A model by name, the check tables by the single pass where there is one."""
        if name in CK.GATE_TABLES and self.gate is not None:
            gate = self.gate["val_validation_summary" if name == "mart_validation_summary" else name]
            return CK.mart_validation(gate) if name == "mart_validation_summary" else gate
        return MODELS[name](self)

    def _checked_tables(self) -> dict[str, DataFrame]:
        return {name: self.checked_table(name) for name in MODELS}

    def key_assertions(self, rules: dict[str, list[DQ.Rule]]) -> list[tuple]:
        return DQ.unique_results(self._checked_tables(), rules)

    def assertions(self, rules: dict[str, list[DQ.Rule]]) -> DataFrame:
        """(table_name, rule, columns, failing_rows) of every rule: the row rules of one job,
        uniqueness from the keys of the inputs where these prove it."""
        found = self.row_assertions(rules) + self.key_assertions(rules)
        return self.raw.policy_cohort_input.sparkSession.createDataFrame(found, DQ.RESULT_SCHEMA)

    # ------------------------------------------------------------------ named tables
    def tables(self) -> dict[str, DataFrame]:
        """Every model of the reference DAG under its reference name."""
        return {name: model(self) for name, model in MODELS.items()}


#: Every model of the reference DAG by its reference name.
MODELS: dict[str, Callable[[Valuation], DataFrame]] = {
    "stg_policy_cohort_input": lambda v: v.staged.policy, "stg_mortality_assumption": lambda v: v.staged.mortality,
    "stg_lapse_assumption": lambda v: v.staged.lapse, "stg_discount_curve": lambda v: v.staged.curve,
    "stg_expense_assumption": lambda v: v.staged.expense, "stg_premium_input": lambda v: v.staged.premium,
    "stg_stress_scenario_definition": lambda v: v.staged.scenario, "stg_assumption_version": lambda v: v.staged.version,
    "int_projection_frame": lambda v: v.projection_frame, "int_projection_mortality_rates": lambda v: v.mortality_rates,
    "int_projection_lapse_rates": lambda v: v.lapse_rates, "int_inforce_rollforward": lambda v: v.inforce_rollforward,
    "int_cashflow_lines": lambda v: v.cashflow_lines, "int_cashflows_discounted": lambda v: v.discounted_cashflows,
    "int_bel_components": lambda v: v.bel_components,
    "val_projection_continuity": lambda v: v.val_projection, "val_inforce_reconciliation": lambda v: v.val_inforce,
    "val_cashflow_sign_and_timing": lambda v: v.val_cashflow, "val_discounting_sanity": lambda v: v.val_discount,
    "val_bel_reconciliation": lambda v: v.val_bel, "val_sensitivity_direction": lambda v: v.val_direction,
    "val_validation_summary": lambda v: v.validation_summary,
    "mart_bel_components_core": lambda v: v.mart_core, "mart_bel_sensitivity": lambda v: v.mart_sensitivity,
    "mart_portfolio_overview": lambda v: v.mart_portfolio, "mart_validation_summary": lambda v: v.mart_validation,
}


MART_PARTITIONS = {
    "mart_bel_components_core": ("version_id", "mort_version_id"),
    "mart_bel_sensitivity": ("version_id", "mort_version_id"),
    "mart_validation_summary": ("version_id", "mort_version_id"),
    "mart_portfolio_overview": (),
}


def run_all(valuation: Valuation, folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Materialize the four marts (partitioned by curve and mortality basis) under ``folder``
    and return their paths; intermediate models stay views over the checkpointed boundaries."""
    from tontine.sources.sinks import write_table
    tables = valuation.tables()
    out = {}
    for name, parts in MART_PARTITIONS.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_table(tables[name], name, path=path, fmt=fmt, partition_by=parts)
        out[name] = path
    return out


def report_queries(valuation: Valuation) -> dict[str, DataFrame]:
    """The five exported reports (A13) of the reference, over this valuation."""
    from tontine.operators import reports as RP
    v, p = valuation, valuation.params
    return {
        "01_bel_base_results": RP.report_base(v.mart_core, p),
        "02_portfolio_overview": RP.report_portfolio(v.mart_portfolio),
        "03_validation_summary": RP.report_validation(v.mart_validation),
        "04_sensitivity_by_cohort": RP.report_sensitivity(v.mart_sensitivity),
        "05_inforce_decay": RP.report_decay(v.inforce_rollforward, p),
    }


def register_views(valuation: Valuation, prefix: str = "") -> list[str]:
    """A12 (views): expose all 26 models as temporary views under their reference names, so
    report SQL can be run with ``spark.sql`` (views stay lazy; the boundaries are materialized)."""
    names = []
    for name, df in valuation.tables().items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
