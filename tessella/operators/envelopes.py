"""Envelopes of footprints and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def footprint_envelope(footprints: DataFrame, by: list[str], aoi: tuple) -> DataFrame:
    """Envelope of the footprints of each group, cut to an area of interest.

    A group that does not meet the area has no row.
    """
    minx, miny, maxx, maxy = aoi
    cut = footprints.groupBy(*by).agg(
        F.greatest(F.lit(minx), F.min("minx")).alias("minx"),
        F.greatest(F.lit(miny), F.min("miny")).alias("miny"),
        F.least(F.lit(maxx), F.max("maxx")).alias("maxx"),
        F.least(F.lit(maxy), F.max("maxy")).alias("maxy"),
    )
    return cut.filter((F.col("minx") < F.col("maxx")) & (F.col("miny") < F.col("maxy")))


def edge_envelope(edges: DataFrame, by: list[str]) -> DataFrame:
    return edges.groupBy(*by).agg(
        F.least(F.min("x1"), F.min("x2")).alias("minx"),
        F.least(F.min("y1"), F.min("y2")).alias("miny"),
        F.greatest(F.max("x1"), F.max("x2")).alias("maxx"),
        F.greatest(F.max("y1"), F.max("y2")).alias("maxy"),
    )
