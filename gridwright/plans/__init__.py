"""Composed jobs: the pay-grid mart (G1-G4) and the quality report."""

from gridwright.plans.pay_grid import (
    assemble,
    build_pay_grid,
    headcount,
    position_base,
    position_grid,
    salary_in_force,
    staffed_grid,
    territory_map,
)
from gridwright.plans.quality_report import branch_spot_check, firm_branch_sample, quality_report, report_summary
from gridwright.plans.refresh import refresh

__all__ = [
    "assemble",
    "branch_spot_check",
    "build_pay_grid",
    "firm_branch_sample",
    "headcount",
    "position_base",
    "position_grid",
    "quality_report",
    "refresh",
    "report_summary",
    "salary_in_force",
    "staffed_grid",
    "territory_map",
]
