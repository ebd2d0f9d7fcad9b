"""Structured Streaming forms of the tile and log operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.stats import fetch_counters
from tessella.sources.catalogs import parse_catalog_lines
from tessella.streaming.table import KeyIndex, TileTable, skip_known

__all__ = ["KeyIndex", "TileTable", "rolling_counters", "skip_known", "stream_catalog"]


def stream_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """New catalog files of a folder as parsed rows."""
    return parse_catalog_lines(spark.readStream.text(folder).withColumnRenamed("value", "line"))


def rolling_counters(log: DataFrame, every: str = "30 seconds", late: str = "10 minutes") -> DataFrame:
    """Fetch counters per tumbling window of event time; later rows are dropped."""
    return (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", every).alias("w"))
        .agg(*fetch_counters())
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "ok", "cached", "http_404", "blocked", "error", "bytes")
    )
