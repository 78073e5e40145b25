"""Query registry behind ``__spark_entry__``.

Each registered query is ``fn(spark, sf_dir) -> DataFrame`` plus an
optional DuckDB oracle SQL over the driver's views. Queries load the
catalog themselves (``catalog.load``) so they can run in any order.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all():
    """Import every query module (registration happens at import)."""
    from tokenmill.plans import (  # noqa: F401
        q_corpus, q_conversations, q_tasks, q_scoring, q_runs, q_tokenizer, q_packing, q_core,
        q_streaming, q_sources, q_synth,
    )
    return QUERIES, ORACLES
