"""All plans of the core with their SQL."""

from __future__ import annotations

from quernstone.plans import bank_plans, exam_plans, item_plans, link_plans, report_plans, source_plans, text_plans  # noqa: F401  they register themselves
from quernstone.plans.base import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
