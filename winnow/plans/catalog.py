"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from winnow.plans import q_dedup, q_io, q_params, q_text  # noqa: F401
from winnow.plans.registry import ORACLES, QUERIES

FLAGSHIP = "dedup_keep"


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
