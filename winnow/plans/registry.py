"""Query registry: name -> (spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


_MEMO: dict = {}


_FIXTURES: dict = {}


def memo(spark, key, build, fixture: bool = False):
    """Reuse an already checkpointed intermediate within one session.
    ``fixture`` entries (derived input files) survive ``clear_memo``."""
    store = _FIXTURES if fixture else _MEMO
    k = (spark.sparkContext.applicationId, key)
    if k not in store:
        store[k] = build()
    return store[k]


def clear_memo() -> None:
    _MEMO.clear()
