"""Imports every operator module, which registers its query."""

from __future__ import annotations

from voxpop.llm import (  # noqa: F401
    collocations,
    exact_dedup,
    fingerprints,
    html_extract,
    language,
    line_dedup,
    mix_sources,
    packing,
    quality,
    sharding,
    simhash,
    token_alignment,
    vector_search,
)
from voxpop.llm.registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
