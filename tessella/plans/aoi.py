"""Areas of interest: one-of selectors resolved to boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.grid import box_buffer, tile_bounds
from tessella import constants as C
from tessella.operators.envelopes import edge_envelope
from tessella.plans.planning import box_tiles, shard_boxes
from tessella.operators.skew import unsized
from tessella.session import pinned

BOX = ["minx", "miny", "maxx", "maxy"]


def aoi_issues(aois: DataFrame) -> DataFrame:
    """Rows that do not name exactly one of box, shard and region."""
    given = sum(F.col(c).isNotNull().cast("int") for c in ("minx", "shard", "region_id"))
    return aois.filter(given != 1).select("aoi_id", F.lit("needs exactly one selector").alias("issue"))


def resolve_aois(aois: DataFrame, edges: DataFrame, land: DataFrame | None = None, land_zoom: int = 5) -> DataFrame:
    """Boxes of areas of interest (aoi_id, part, minx, miny, maxx, maxy).

    Rows name a box, a shard or a region of ``edges`` (region_id), a buffer in
    kilometres and ``land_only``. Boxes and shards grow as boxes; regions grow by
    the same number of degrees all around. A box over the antimeridian gives two
    parts. ``land`` holds tile keys of ``land_zoom``; an area without any land falls
    back to the whole land.
    """
    spark = aois.sparkSession
    rename = lambda df, key, p: df.select(key, *[F.col(c).alias(f"{p}_{c}") for c in BOX])
    given = sum(F.col(c).isNotNull().cast("int") for c in ("minx", "shard", "region_id"))
    joined = (
        aois.filter(given == 1)
        .join(rename(shard_boxes(spark), "shard", "s"), "shard", "left")
        .join(rename(edge_envelope(edges, ["region_id"]), "region_id", "r"), "region_id", "left")
    )
    first = joined.select("aoi_id", "land_only", "buffer_km", F.col("region_id").isNotNull().alias("polygon"),
                          *[F.coalesce(c, f"s_{c}", f"r_{c}").alias(c) for c in BOX])
    first = first.dropna(subset=BOX)
    split = F.when(
        F.col("minx") > F.col("maxx"),
        F.array(
            F.struct(F.col("minx").alias("lo"), F.lit(180.0).alias("hi")),
            F.struct(F.lit(-180.0).alias("lo"), F.col("maxx").alias("hi")),
        ),
    ).otherwise(F.array(F.struct(F.col("minx").alias("lo"), F.col("maxx").alias("hi"))))
    parts = first.select("*", F.posexplode(split).alias("part", "span")).withColumns(
        {"minx": F.col("span.lo"), "maxx": F.col("span.hi")}
    )
    boxed = box_buffer(*BOX, "buffer_km")
    degrees = F.greatest("buffer_km", F.lit(0.0)) / C.KM_PER_DEGREE
    sides = {"minx": -degrees, "miny": -degrees, "maxx": degrees, "maxy": degrees}
    grown = parts.select(
        "aoi_id", "part", "land_only",
        *[F.when(F.col("polygon"), F.col(c) + sides[c]).otherwise(b).alias(c) for c, b in boxed._asdict().items()],
    )
    out = ["aoi_id", "part", *BOX]
    if land is None:
        return grown.select(*out)
    return grown.filter(~F.col("land_only")).select(*out).unionByName(_on_land(grown.filter("land_only"), land, land_zoom))


def _on_land(boxes: DataFrame, land: DataFrame, z: int) -> DataFrame:
    key = ["aoi_id", "part"]
    tiles = box_tiles(boxes.select(*key, *BOX), z).join(unsized(land.select("x", "y")), ["x", "y"], "left_semi")
    located = pinned(tiles.select(*key, "z", "x", "y", *BOX), **{f"t_{c}": b for c, b in tile_bounds("z", "x", "y")._asdict().items()})
    hit = located.groupBy(*key).agg(
        F.min("t_minx").alias("a"), F.min("t_miny").alias("b"), F.max("t_maxx").alias("c"), F.max("t_maxy").alias("d"),
    )
    whole = pinned(land.select(F.lit(z).alias("z"), "x", "y"), **tile_bounds("z", "x", "y")._asdict()).agg(
        F.min("minx").alias("wa"), F.min("miny").alias("wb"), F.max("maxx").alias("wc"), F.max("maxy").alias("wd")
    )
    joined = boxes.join(hit, key, "left").withColumn("one", F.lit(1)).join(
        F.broadcast(whole.withColumn("one", F.lit(1))), "one"  # one row: the envelope of all land
    )
    pick = lambda own, cut, all_, fn: F.when(F.col(cut).isNotNull(), fn(own, cut)).otherwise(F.col(all_)).alias(own)
    return joined.select(
        *key,
        pick("minx", "a", "wa", F.greatest), pick("miny", "b", "wb", F.greatest),
        pick("maxx", "c", "wc", F.least), pick("maxy", "d", "wd", F.least),
    )
