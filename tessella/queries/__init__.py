"""Registered queries over the supplied tables, each with its oracle SQL."""

from __future__ import annotations

from importlib import import_module

from tessella.fixtures import Views, oracle_text

_QUERIES: dict = {}
_ORACLES: dict[str, str] = {}
_MODULES = (
    "sources", "scalars", "filters", "joins", "aggregates", "windows", "sets", "raster", "streams",
    "plans",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` under a survey id."""

    def register(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            _ORACLES[name] = oracle_text(sql)
        return fn

    return register


def load():
    for module in _MODULES:
        import_module(f"tessella.queries.{module}")
    return dict(_QUERIES), dict(_ORACLES)
