"""Run parameters. Everything the reference hard-codes is an argument here."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ValuationParams:
    valuation_date: _dt.date = _dt.date(2026, 1, 1)
    # exact 1/12 as a double; the reference's Spark SQL literal 1.0/12 is DECIMAL 0.083333
    monthly_exponent: float = 1.0 / 12.0
    mort_versions: tuple[str, ...] = ("M1", "M2")
    base_scenario: str = "BASE"
    expense_type: str = "maintenance"
    inforce_tolerance: float = 0.001
    bel_tolerance: float = 0.01
    # pricing (J): which mortality basis and curve price the premium
    pricing_mort_version: str = "M1"
    pricing_curve_version: str = "A"
    # fixed values: expense 3 %, profit 2 %, contingency 2 % loadings on the net premium
    loadings: tuple[float, ...] = (0.03, 0.02, 0.02)
    pricing_version_id: str = "PRICING_V1"
    # curve analytics (K)
    reference_curve_version: str = "A"
    reference_mort_version: str = "M1"
    va_pairs: tuple[tuple[str, str], ...] = (("A", "B"), ("C", "D"))  # (without, with) volatility adjustment
    # summary gate: a missing check row counts as FAIL (reference: PASS)
    strict_missing_checks: bool = True
    # in-force / cash-flow checks grouped with mort_version_id (reference: without)
    checks_by_mort_version: bool = True
    # broadcast only below these row counts and this size (rows counted, times the schema's row size)
    broadcast_max_rows: int = 2_000_000
    broadcast_max_bytes: int = 256 << 20
    dimension_max_rows: int = 10_000
    # up to so many curve versions are columns of one aggregation; beyond, rows
    max_pivot_versions: int = 16
    extra: dict = field(default_factory=dict, compare=False, hash=False)
