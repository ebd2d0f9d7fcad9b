"""Build plans: which tiles to make, in which season, for which shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import Box, box_center, is_land, shard_of_tile, shr, tile_bounds, tile_range
from tessella.functions.scalars import season_window
from tessella.operators.skew import unsized
from tessella.session import inline_table, pinned

COLLECTIONS = ("hls2-s30", "hls2-l30")
FALLBACK = ("landsat-c2-l2",)


def grid_tiles(spark: SparkSession, z: int, partitions: int | None = None) -> DataFrame:
    """Every tile of a zoom, generated in parallel."""
    count = 1 << (2 * z)
    ids = spark.range(0, count, 1, partitions) if partitions else spark.range(count)
    return ids.select(
        F.lit(z).alias("z"),
        shr("id", z).alias("x"),
        F.col("id").bitwiseAND(F.lit((1 << z) - 1).cast("bigint")).alias("y"),
    )


def box_tiles(boxes: DataFrame, z, mode: str = "corner") -> DataFrame:
    """Tiles of each box (minx, miny, maxx, maxy) at a zoom, without the whole grid."""
    span = tile_range("minx", "miny", "maxx", "maxy", z, mode)
    ranged = boxes.withColumns({"_x0": span.xmin, "_x1": span.xmax, "_y0": span.ymin, "_y1": span.ymax})
    ranged = ranged.filter((F.col("_x1") >= F.col("_x0")) & (F.col("_y1") >= F.col("_y0")))
    tiles = ranged.withColumn("x", F.explode(F.sequence("_x0", "_x1")))
    tiles = tiles.withColumn("y", F.explode(F.sequence("_y0", "_y1")))
    z = F.lit(z) if isinstance(z, int) else F.col(z)
    return tiles.withColumn("z", z).drop("_x0", "_x1", "_y0", "_y1")


def land_tiles(tiles: DataFrame, buffer_km: float = C.LAND_BUFFER_KM) -> DataFrame:
    boxed = pinned(tiles, **{f"_{n}": c for n, c in tile_bounds("z", "x", "y")._asdict().items()})
    return boxed.filter(is_land(Box("_minx", "_miny", "_maxx", "_maxy"), buffer_km)).select(*tiles.columns)


def plan_tiles(
    tiles: DataFrame,
    year: int,
    buffer_km: float = C.LAND_BUFFER_KM,
    collections=COLLECTIONS,
    fallback=FALLBACK,
    max_cloud: float = 40.0,
    fallback_max_cloud: float = 60.0,
    region: DataFrame | None = None,
    land: DataFrame | None = None,
) -> DataFrame:
    """Plan rows for candidate tiles: land, regions, season and shard in one pass.

    ``region`` and ``land`` are optional key sets (z, x, y) such as a polygon cover.
    The expressions never shuffle; only the key sets join.
    """
    boxed = pinned(tiles.select("z", "x", "y"), **tile_bounds("z", "x", "y")._asdict())
    boxed = boxed.filter(is_land(Box("minx", "miny", "maxx", "maxy"), buffer_km))
    for keys in (region, land):
        if keys is not None:
            boxed = boxed.join(unsized(keys.select("z", "x", "y")), ["z", "x", "y"], "left_semi")
    _, lat = box_center("minx", "miny", "maxx", "maxy")
    season, hemisphere, start, end = season_window(lat, year)
    return boxed.select(
        "z",
        "x",
        "y",
        "minx",
        "miny",
        "maxx",
        "maxy",
        start.alias("start_date"),
        end.alias("end_date"),
        season.alias("season"),
        hemisphere.alias("hemisphere"),
        F.array(*map(F.lit, collections)).alias("collections"),
        F.array(*map(F.lit, fallback)).alias("fallback_collections"),
        F.lit(max_cloud).alias("max_cloud"),
        F.lit(fallback_max_cloud).alias("fallback_max_cloud"),
        shard_of_tile("z", "x", "y").alias("shard"),
    )


def plan_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy(F.coalesce("season", F.lit("unknown")).alias("season")).agg(F.count("*").alias("tiles"))


def shard_table(spark: SparkSession) -> DataFrame:
    rows = [(f"{i:02d}", *box) for i, box in enumerate(C.SHARD_RECTANGLES)]
    table = inline_table(spark, rows, ["shard", "minx", "miny", "maxx", "maxy"])
    return table.select("shard", *[F.col(n).cast("bigint").alias(n) for n in table.columns[1:]])


def shard_boxes(spark: SparkSession) -> DataFrame:
    """Geographic box of each shard."""
    z = F.lit(C.SHARD_ZOOM)
    first = tile_bounds(z, "minx", "miny", clamp_lat=False)
    last = tile_bounds(z, "maxx", "maxy", clamp_lat=False)
    return shard_table(spark).select(
        "shard",
        first.minx.alias("minx"),
        last.miny.alias("miny"),
        last.maxx.alias("maxx"),
        first.maxy.alias("maxy"),
    )
