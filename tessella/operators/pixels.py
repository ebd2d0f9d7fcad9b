"""Raster operators on pixel rows (keys, px, py, band, dn); 0 is nodata.

This is the form to use for sparse data and for stacks of any depth: every
reduction is an aggregate that combines before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import (
    Box, clamp, col, column_longitude, lat_to_row, lon_to_column, row_latitude, tile_range,
)
from tessella.session import cut_lineage, pinned


def visible_tiles(pixels: DataFrame, keys: list[str], alpha: str = "a") -> DataFrame:
    """Tiles with at least one pixel that is not fully transparent."""
    return pixels.groupBy(*keys).agg(F.max(alpha).alias("_a")).filter(F.col("_a") > 0).drop("_a")


def masked(dn, qa, mask: int) -> Column:
    """dn, or 0 where any masked quality bit is set; unmasked without quality data."""
    bits = col(qa).bitwiseAND(F.lit(mask).cast("int"))
    return F.when(F.coalesce(bits, F.lit(0)) != 0, 0).otherwise(col(dn)).cast("int")


def mask_pixels(pixels: DataFrame, qa: DataFrame, keys: list[str], mask: int) -> DataFrame:
    """Join each pixel with its scene's quality pixel and mask it."""
    at = [*keys, "px", "py"]
    joined = pixels.join(qa.select(*at, "qa"), at, "left")
    return joined.withColumn("dn", masked("dn", "qa", mask)).drop("qa")


def dilate_pixels(cloudy: DataFrame, keys: list[str], n: int, w: int, h: int) -> DataFrame:
    """Grow a set of masked pixels by ``n`` in the 4-neighbourhood, over tile borders.

    The growth of n steps is the diamond |dx| + |dy| <= n, so it is one explode.
    Nothing wraps around the edge of the world.
    """
    if n <= 0:
        return cloudy.select(*keys, "z", "x", "y", "px", "py").distinct()
    steps = [(dx, dy) for dx in range(-n, n + 1) for dy in range(-n, n + 1) if abs(dx) + abs(dy) <= n]
    diamond = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in steps])
    moved = cloudy.withColumn("d", F.explode(diamond)).select(
        *keys,
        "z",
        (F.col("x") * w + F.col("px") + F.col("d.dx")).alias("gx"),
        (F.col("y") * h + F.col("py") + F.col("d.dy")).alias("gy"),
    )
    across = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("z"))
    inside = moved.filter((F.col("gx") >= 0) & (F.col("gy") >= 0) & (F.col("gx") < across * w) & (F.col("gy") < across * h))
    return inside.select(
        *keys,
        "z",
        F.floor(F.col("gx") / w).alias("x"),
        F.floor(F.col("gy") / h).alias("y"),
        (F.col("gx") % w).cast("int").alias("px"),
        (F.col("gy") % h).cast("int").alias("py"),
    ).distinct()


def median_pixels(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Median of the clear observations, half to even; 0 where none is clear.

    The exact percentile keeps one counter per distinct value, so a pixel seen in
    any number of scenes needs no more memory than the value range.
    """
    clear = F.when(F.col("dn") != 0, F.col("dn"))
    value = F.coalesce(F.rint(F.median(clear)).cast("int"), F.lit(0))
    return pixels.groupBy(*keys).agg(value.alias("dn"))


def first_clear(pixels: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Clear observation of the least cloudy scene; on equal cloud the later ``order``.

    Unknown cloud is worst. Pixels without a clear observation get no row.
    """
    rank = F.struct((-F.coalesce("cloud", F.lit(float("inf")))).alias("c"), order.alias("o"))
    return pixels.filter(F.col("dn") != 0).groupBy(*keys).agg(F.max_by("dn", rank).alias("dn"))


def last_painted(pixels: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Last painted observation, even where it is 0."""
    return pixels.groupBy(*keys).agg(F.max_by("dn", order).alias("dn"))


def paint_order(pixels: DataFrame) -> Column:
    """Paint order of the band mosaic: list sorted by cloud, so the cloudiest is on top."""
    return F.struct(F.coalesce("cloud", F.lit(float("inf"))).alias("c"), F.col("scene"))


def stretched(value, low: float, high: float, gamma: float) -> Column:
    """Reflectance to byte: 255 * clamp((v - low) / (high - low)) ^ gamma, rounded."""
    share = clamp((col(value).cast("double") - low) / (high - low), F.lit(0.0), F.lit(1.0))
    curve = share if gamma == 1.0 else F.pow(share, F.lit(gamma))
    return F.rint(curve * 255.0).cast("int")


def over(base: dict, top: dict) -> dict[str, Column]:
    """Porter-Duff over of two RGBA pixels with 8-bit channels, rounded half up."""
    ta, ba = col(top["a"]), col(base["a"])
    alpha = ta * 255 + ba * (255 - ta)
    mixed = {}
    for n in "rgb":
        value = (col(top[n]) * ta * 255 + col(base[n]) * ba * (255 - ta)) / F.nullif(alpha, F.lit(0))
        mixed[n] = F.coalesce(F.floor(value + 0.5), F.lit(0)).cast("int")
    mixed["a"] = F.floor(alpha / 255.0 + 0.5).cast("int")
    return mixed


def composite_pixels(base: DataFrame, overlay: DataFrame, keys: list[str]) -> DataFrame:
    """Overlay over base where both exist, else whichever exists."""
    names = list("rgba")
    b = base.select(*keys, *[F.col(n).alias(f"b_{n}") for n in names])
    t = overlay.select(*keys, *[F.col(n).alias(f"t_{n}") for n in names])
    mixed = over({n: f"b_{n}" for n in names}, {n: f"t_{n}" for n in names})
    pick = lambda n: (
        F.when(F.col("t_a").isNull(), F.col(f"b_{n}"))
        .when(F.col("b_a").isNull(), F.col(f"t_{n}"))
        .otherwise(mixed[n])
    )
    return b.join(t, keys, "full").select(*keys, *[pick(n).alias(n) for n in names])


def pixel_lonlat(z, x, y, px, py, size: int) -> tuple[Column, Column]:
    """Centre of a pixel in degrees."""
    return (
        column_longitude(col(x) + (col(px) + 0.5) / size, z),
        row_latitude(col(y) + (col(py) + 0.5) / size, z),
    )


def crop_box(pixels: DataFrame, box: Box, z: int, size: int) -> DataFrame:
    """Pixels of one zoom whose centre is in a box; whole tiles are pruned first."""
    span = tile_range(*[F.lit(float(v)) for v in box], F.lit(z), "corner")
    near = pixels.filter(
        (F.col("z") == z) & F.col("x").between(span.xmin, span.xmax) & F.col("y").between(span.ymin, span.ymax)
    )
    lon, lat = pixel_lonlat("z", "x", "y", "px", "py", size)
    located = pinned(near, lon=lon, lat=lat)
    return located.filter(
        F.col("lon").between(box.minx, box.maxx) & F.col("lat").between(box.miny, box.maxy)
    ).drop("lon", "lat")


def color_relief(value, ramp) -> dict[str, Column]:
    """Elevation to RGBA by a ramp of (depth, r, g, b), linear between stops.

    Values outside the ramp take its end colours.
    """
    stops = sorted(tuple(s) for s in ramp)
    if not stops or any(len(s) < 4 for s in stops):
        raise ValueError("ramp stops need a depth and three colour parts")
    v = col(value).cast("double")

    def channel(i):
        chain = F.when(v <= stops[0][0], F.lit(float(stops[0][i])))
        for low, high in zip(stops, stops[1:]):
            t = (v - low[0]) / (high[0] - low[0])
            chain = chain.when(v <= high[0], F.lit(float(low[i])) + t * float(high[i] - low[i]))
        return F.floor(chain.otherwise(float(stops[-1][i])) + 0.5).cast("int")

    return {"r": channel(1), "g": channel(2), "b": channel(3), "a": F.when(v.isNotNull(), 255).otherwise(0)}


def stitch_pixels(pixels: DataFrame, size: int) -> DataFrame:
    """Pixels of four children on their parent of double size (missing ones stay absent)."""
    return pixels.filter(F.col("z") > 0).withColumns(
        {
            "px": (F.col("px") + (F.col("x") % 2) * size).cast("int"),
            "py": (F.col("py") + (F.col("y") % 2) * size).cast("int"),
            "x": F.floor(F.col("x") / 2),
            "y": F.floor(F.col("y") / 2),
            "z": F.col("z") - 1,
        }
    )


def overview_pixels(pixels: DataFrame, keys: list[str], size: int, method: str = "average") -> DataFrame:
    """Next coarser zoom by a 2x reduction of the clear pixels."""
    double = stitch_pixels(pixels, size)
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    at = [*keys, "z", "x", "y", half("px").alias("px"), half("py").alias("py")]
    clear = F.when(F.col("dn") != 0, F.col("dn"))
    if method == "nearest":
        corner = (F.col("px") % 2 == 0) & (F.col("py") % 2 == 0)
        return double.filter(corner).select(*at, "dn")
    if method == "average":
        value = F.rint(F.avg(clear)).cast("int")
    elif method == "mode":
        value = F.mode(clear, True)
    else:
        raise ValueError(f"no pixel form for {method!r}; use the chunk form")
    return double.groupBy(*at).agg(F.coalesce(value, F.lit(0)).alias("dn"))


def raster_to_tiles(raster: DataFrame, keys: list[str], cell: float, z: int, size: int, method="nearest") -> DataFrame:
    """Slice a geographic raster (lon, lat of the NW cell corner, dn) into tiles.

    ``nearest``: a cell fills every tile pixel whose centre it contains, so coarse and
    fine rasters both work and no pixel is written twice. ``average``: the mean of
    the cells whose centre falls in a pixel.
    """
    across = F.lit(float(size << z))
    gx = lambda lon: lon_to_column(lon, z) * size
    gy = lambda lat: lat_to_row(lat, z) * size
    if method == "average":
        fx = F.floor(gx(F.col("lon") + cell / 2)).cast("long")
        fy = F.floor(gy(F.col("lat") - cell / 2)).cast("long")
        spread = raster.select(*keys, fx.alias("gx"), fy.alias("gy"), "dn")
    elif method == "nearest":
        first = lambda v: F.ceil(v - 0.5).cast("long")
        edges = pinned(
            raster,
            c0=F.greatest(first(gx("lon")), F.lit(0).cast("long")),
            c1=F.least(first(gx(F.col("lon") + cell)), across.cast("long")) - 1,
            r0=F.greatest(first(gy("lat")), F.lit(0).cast("long")),
            r1=F.least(first(gy(F.col("lat") - cell)), across.cast("long")) - 1,
        ).filter((F.col("c1") >= F.col("c0")) & (F.col("r1") >= F.col("r0")))
        spread = edges.select(*keys, F.explode(F.sequence("c0", "c1")).alias("gx"), "r0", "r1", "dn").select(
            *keys, "gx", F.explode(F.sequence("r0", "r1")).alias("gy"), "dn"
        )
    else:
        raise ValueError(f"unknown resampling {method!r}")
    tiled = spread.select(
        *keys,
        F.lit(z).alias("z"),
        F.floor(F.col("gx") / size).alias("x"),
        F.floor(F.col("gy") / size).alias("y"),
        (F.col("gx") % size).cast("int").alias("px"),
        (F.col("gy") % size).cast("int").alias("py"),
        "dn",
    )
    if method == "nearest":
        return tiled
    at = [*keys, "z", "x", "y", "px", "py"]
    return tiled.groupBy(*at).agg(F.rint(F.avg("dn")).cast("int").alias("dn"))


def use_median(strategy: str) -> bool:
    """Whether a mosaic strategy means the temporal median, else cleanest on top."""
    return strategy.strip().lower() in ("best_pixel", "median")
