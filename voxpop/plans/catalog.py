"""Query catalog: imports every query module and exposes the two driver maps."""

from __future__ import annotations

from voxpop.plans import text_queries, relational_queries, model_queries, io_queries, stream_queries  # noqa: F401,I001  (registers queries)
from voxpop.plans.registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
