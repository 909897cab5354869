"""Demonstration bindings of every operator family on the driver's tables.

Each registered query is ``(spark, sf_dir) -> DataFrame`` over the whole
given tables; the matching DuckDB SQL (when expressible) is its oracle.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, oracle: str | None = None, headline: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def load_all() -> None:
    """Import every binding module so its queries register."""
    from harmoniq.plans import (adapters_q, articles_q, dims_q, exports_q, facts_q, incidents_q,  # noqa: F401
                                cleaning_q, quality_q, readers_q, second_tier_q, serving_q, streaming_q,
                                upsert_q, views_q)
