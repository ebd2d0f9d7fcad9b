"""Overlay builds: a base and ordered overlays merged into one tile set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella import constants as C
from tessella.functions.grid import tile_bounds
from tessella.operators import chunks as CH
from tessella.operators.tiles import KEY, overlay_wins
from tessella.plans.planning import box_tiles
from tessella.session import cut_lineage, inline_table


@dataclass(frozen=True)
class Overlay:
    """One overlay: ``src`` is its tile source, ``boxes`` its area, 0 an unset zoom."""

    name: str
    source: str
    src: int
    boxes: tuple
    max_zoom: int
    min_zoom: int = 0


def overlay_faults(base_source: str, base_max: int, overlays: list[Overlay]) -> list[str]:
    """Declared zooms above a source's ceiling, reversed ranges, repeated names."""
    faults = []
    ceiling = C.SOURCE_CEILINGS.get(base_source)
    if ceiling is not None and base_max > ceiling:
        faults.append(f"base {base_source} z{base_max} above its ceiling z{ceiling}")
    names = [o.name for o in overlays]
    for i, o in enumerate(overlays):
        if o.name in names[:i]:
            faults.append(f"name {o.name} used twice")
        ceiling = C.SOURCE_CEILINGS.get(o.source)
        if ceiling is not None and o.max_zoom > ceiling:
            faults.append(f"{o.name} z{o.max_zoom} above the ceiling z{ceiling} of {o.source}")
        if o.min_zoom > o.max_zoom:
            faults.append(f"{o.name} zooms reversed")
    return faults


def stack_requests(spark, overlay: Overlay, first_zoom: int) -> DataFrame:
    """Tiles an overlay composes: its area at every zoom from its first to its last."""
    boxes = inline_table(spark, [tuple(map(float, b)) for b in overlay.boxes], ["minx", "miny", "maxx", "maxy"])
    boxes = boxes.select(*[F.col(c).cast("double").alias(c) for c in boxes.columns])
    start = overlay.min_zoom or first_zoom
    levels = boxes.withColumn("zoom", F.explode(F.sequence(F.lit(start), F.lit(overlay.max_zoom))))
    return box_tiles(levels, "zoom").select(*KEY).distinct()


def build_planet(
    tiles: DataFrame, base_src: int, base_source: str, base_max: int, overlays: list[Overlay],
    size: int, method: str = "nearest", checkpoint: bool = True,
) -> DataFrame:
    """Fold ordered overlays over a base.

    Each overlay is composed over its area from every source so far, filling by
    overzoom, and replaces the planet's tiles there. ``checkpoint`` stores each composed
    overlay, which is read twice; the planet itself is never rewritten, only its keys are
    compared with the overlay's.
    """
    faults = overlay_faults(base_source, base_max, overlays)
    if faults:
        raise ValueError("; ".join(faults))
    names = [*KEY, "w", "h", "data"]
    planet = tiles.filter((F.col("src") == base_src) & (F.col("z") <= base_max)).select(*names)
    sources = [base_src]
    for overlay in overlays:
        sources.append(overlay.src)
        requests = stack_requests(tiles.sparkSession, overlay, base_max + 1)
        stack = CH.overzoom_stack(requests, tiles, list(sources), size, method)
        planet = overlay_wins(planet, (cut_lineage(stack) if checkpoint else stack).select(*names))
    return planet


def tileset_report(chunks: DataFrame, by: str = "z", planes: int | None = None) -> DataFrame:
    """Tiles, distinct contents and validity per zoom of a finished tile set."""
    from tessella.operators.stats import chunk_check

    checked = chunk_check(chunks, planes).withColumn("digest", F.sha2(F.array_join("data", ",").cast("binary"), 256))
    per = checked.groupBy(by, "digest").agg(F.count("*").alias("n"), F.bool_and("valid").alias("ok"))
    return per.groupBy(by).agg(
        F.sum("n").alias("tiles"), F.count("*").alias("contents"), F.bool_and("ok").alias("valid")
    )


def tileset_summary(chunks: DataFrame, planes: int | None = None) -> DataFrame:
    """The report of each zoom with the tile set's bounds, centre and zoom range.

    The bounds are the envelope of the finest zoom. The windows see one row per zoom.
    """
    spans = chunks.groupBy("z").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    whole = Window.orderBy(F.desc("z")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    finest = F.first(F.struct(F.col("z").alias("fz"), "x0", "x1", "y0", "y1")).over(whole)
    about = spans.select("z", F.min("z").over(whole).alias("minzoom"), F.max("z").over(whole).alias("maxzoom"), finest.alias("f")).select("z", "minzoom", "maxzoom", "f.*")
    first, last = tile_bounds("fz", "x0", "y0"), tile_bounds("fz", "x1", "y1")
    about = about.select("z", "minzoom", "maxzoom", first.minx.alias("minx"), last.miny.alias("miny"), last.maxx.alias("maxx"), first.maxy.alias("maxy"))
    middle = {"center_lon": (F.col("minx") + F.col("maxx")) / 2, "center_lat": (F.col("miny") + F.col("maxy")) / 2}
    return tileset_report(chunks, "z", planes).join(about.withColumns(middle), "z")
