"""All registered queries, by the inventory's ids."""

from __future__ import annotations

from quillstone.queries import evaluation, operators, relational, reports  # noqa: F401
from quillstone.queries.base import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
