"""Every query of the library by name, with SQL that gives the same rows."""

from __future__ import annotations

from loomspark.plans import exports, io, models, qc, relational, rows, speech, streams  # noqa: F401  they register their queries
from loomspark.plans.registry import ORACLE, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
