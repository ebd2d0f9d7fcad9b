"""Registered queries of the subpackage, each over whole tables."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
_MODULES = (
    "quality", "pii", "token_files", "topk", "mixing", "simhash", "decontaminate", "urls", "secrets", "extract", "licenses", "phrases", "hard_negatives",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load():
    for module in _MODULES:
        import_module(f"tessella.llm.{module}")
    return dict(QUERIES), dict(ORACLES)
