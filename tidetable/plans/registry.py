"""All core queries and their SQL oracles by name."""

from __future__ import annotations

from collections.abc import Callable

from tidetable.plans import base, delivery, exports, feeds, problems, problems_sql, relational, schedule, temporal  # noqa: F401


def queries() -> dict[str, Callable]:
    return problems.QUERIES | base.QUERIES


def oracles() -> dict[str, str]:
    return problems_sql.ORACLES | base.ORACLES
