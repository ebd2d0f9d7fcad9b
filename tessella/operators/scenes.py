"""Scene search, stacks, orderings and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.grid import Box, box_covers, boxes_intersect
from tessella.operators.gridjoin import BLOCKS_OF_A_SPAN, KEYS, block_level, box_level, boxes_of, levels_of, met_once, most_rows, spread_boxes, spread_days
from tessella.operators.ranking import ranked_in_group, top_in_group
from tessella.operators.skew import BROADCAST_ROWS, HOT_ROWS, salted
from tessella.session import cut_lineage

TILE = ["z", "x", "y"]
BOX = ("minx", "miny", "maxx", "maxy")


def search_scenes(scenes: DataFrame, collections, box: Box, start, end, max_cloud=None) -> DataFrame:
    """Scenes of some collections that meet a box in an (open-ended) date range.

    An unknown cloud cover does not pass a limit.
    """
    keep = F.col("collection_id").isin(*collections)
    keep = keep & boxes_intersect(Box("minx", "miny", "maxx", "maxy"), box)
    if start is not None:
        keep = keep & (F.col("acq_date") >= F.lit(start).cast("date"))
    if end is not None:
        keep = keep & (F.col("acq_date") <= F.lit(end).cast("date"))
    if max_cloud is not None:
        keep = keep & (F.col("cloud") <= max_cloud)
    return scenes.filter(keep)


def covering_scenes(scenes: DataFrame, box: Box) -> DataFrame:
    return scenes.filter(box_covers(Box("minx", "miny", "maxx", "maxy"), box))


def _searches(plan: DataFrame) -> DataFrame:
    """One row per spread tile, collection and role, with the role's cloud limit."""
    cols = [*TILE, *BOX, "start_date", "end_date", *KEYS, "_fx", "_fy", "_blocks", "_block"]

    def role(collections, limit, name):
        return plan.select(
            *cols,
            F.lit(name).alias("role"),
            F.explode(collections).alias("collection_id"),
            F.col(limit).alias("max_cloud"),
        )

    return role("collections", "max_cloud", "primary").unionByName(
        role("fallback_collections", "fallback_max_cloud", "fallback")
    )


def _whole_boxes(df: DataFrame, prefix: str) -> DataFrame:
    """Boxes over the antimeridian (minx > maxx) as two rows, one on each side."""
    west, east = F.col(f"{prefix}minx"), F.col(f"{prefix}maxx")
    side = lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"))
    parts = F.when(west > east, F.array(side(west, F.lit(180.0)), side(F.lit(-180.0), east))).otherwise(F.array(side(west, east)))
    split = df.withColumn("_part", F.explode(parts))
    return split.withColumns({f"{prefix}minx": F.col("_part.a"), f"{prefix}maxx": F.col("_part.b")}).drop("_part")


def match_plan_scenes(
    plan: DataFrame, scenes: DataFrame, hot_rows: int = HOT_ROWS, small_plan: int = BROADCAST_ROWS // 8
) -> DataFrame:
    """Candidate scenes of every plan tile: place, date, cloud and collection.

    Boxes meet in the cells of the larger one's size and days in blocks of the season's
    length (``gridjoin``), so neither a world-wide scene nor a long season multiplies rows.
    Every pair is checked exactly and comes out once. Hot cells are salted. A scene over the
    antimeridian is matched by either part; a tile that meets both gets it once, from the
    western part of the map.
    """
    box = {n: f"s_{n}" for n in BOX}
    known = scenes.filter(F.col("cloud").isNotNull() & F.col("acq_date").isNotNull()).withColumnsRenamed(box)
    known = known.withColumns({"_west": F.col("s_minx"), "_east": F.col("s_maxx")})
    known = _whole_boxes(known, "s_")
    *levels, blocks = levels_of((plan, box_level("")), (known, box_level("s_")), (plan, block_level("start_date", "end_date")))
    left, right = spread_boxes(plan, known, "", "s_", levels)
    left, right = spread_days(left, right, "start_date", "end_date", "acq_date", blocks)
    keys = ["collection_id", *KEYS, "_blocks", "_block"]
    if most_rows(*levels[:2]) * BLOCKS_OF_A_SPAN <= small_plan:
        # a counted plan of few tiles travels to the scenes, in any other case both are dealt
        pairs = right.join(F.broadcast(_searches(left)), keys)
    else:
        left, right = salted(_searches(left), right, keys, hot_rows, most_rows(*levels[::-1]) * len(blocks))
        pairs = left.join(right, [*keys, "salt"])
    exact = (
        boxes_intersect(Box(*BOX), Box(*box.values()))
        & F.col("acq_date").between(F.col("start_date"), F.col("end_date"))
        & (F.col("cloud") <= F.col("max_cloud"))
    )
    # the part that ends at 180 degrees stands back where the other one meets the tile
    first = (F.col("_west") <= F.col("_east")) | (F.col("s_minx") < F.col("_east")) | (F.col("minx") > F.col("_east"))
    extra = [c for c in scenes.columns if c not in ("collection_id", *box)]
    sides = [F.col("_west").alias("s_minx"), "s_miny", F.col("_east").alias("s_maxx"), "s_maxy"]
    return pairs.filter(met_once("", "s_") & exact & first).select(*TILE, "role", "collection_id", *extra, *sides)


def cap_search(candidates: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` candidates per tile, role and collection, clearest first."""
    order = [F.col("cloud"), F.col("acq_date"), F.col("item_id")]
    return top_in_group(candidates, [*TILE, "role", "collection_id"], order, limit)


def pick_role(candidates: DataFrame, capped: bool = True) -> DataFrame:
    """Fallback candidates only for tiles without a primary one.

    With ``capped`` candidates a tile is a small group and one window settles it. Else
    the tiles with a primary candidate are listed first and fallbacks are matched
    against that list, so that no tile has to fit a task.
    """
    if capped:
        has_primary = F.max(F.col("role") == "primary").over(Window.partitionBy(*TILE))
        chosen = candidates.withColumn("_primary", has_primary)
        return chosen.filter((F.col("role") == "primary") == F.col("_primary")).drop("_primary")
    primary = candidates.filter(F.col("role") == "primary")
    rest = candidates.filter(F.col("role") != "primary")
    return primary.unionByName(rest.join(primary.select(*TILE).distinct(), TILE, "left_anti"))


def scene_stack(scenes: DataFrame, keep: int, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``keep`` scenes per group, spread over dates, the clearest of each date bin.

    Scenes sorted by (date, cloud, collection, item) are cut into ``keep`` contiguous
    bins; the lowest cloud of a bin stays, the earliest on ties. Groups of at most
    ``keep`` scenes, or any group when ``keep`` <= 0, stay whole. Adds ``pos``.
    """
    cloud = F.coalesce("cloud", F.lit(float("inf")))
    order = [F.col("acq_date").asc_nulls_last(), cloud, F.col("collection_id"), F.col("item_id")]
    ranked = ranked_in_group(scenes, keys, order, "_r", "_n", hot_rows)
    r0 = F.col("_r") - 1
    if keep > 0:
        bins = F.floor(((r0 + 1) * keep - 1) / F.col("_n"))
        ranked = ranked.withColumn("_bin", F.when(F.col("_n") <= keep, r0).otherwise(bins))
    else:
        ranked = ranked.withColumn("_bin", r0)
    rest = [c for c in scenes.columns if c not in keys]
    best = ranked.groupBy(*keys, "_bin").agg(
        F.min_by(F.struct(*rest), F.struct(cloud, "_r")).alias("_s")
    )
    once = best.select(*keys, F.col("_bin").alias("pos"), "_s.*")
    return once


def unique_scenes(chosen: DataFrame, order: list[str]) -> DataFrame:
    """Each (collection, item) once, as first seen in plan order."""
    keys = ["collection_id", "item_id"]
    rest = [c for c in chosen.columns if c not in keys]
    first = chosen.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_s"))
    return first.select(*keys, "_s.*")


def manifest_summary(plan: DataFrame, candidates: DataFrame, chosen: DataFrame, depth: int) -> DataFrame:
    """Tiles evaluated, unique scenes, tiles without a primary scene, stack depth."""
    primary = candidates.filter(F.col("role") == "primary").select(*TILE).distinct()
    per_tile = plan.select(*TILE).join(primary.withColumn("p", F.lit(1)), TILE, "left")
    zero = F.lit(0).cast("bigint")
    tiles = per_tile.agg(
        F.count("*").alias("tiles_evaluated"),
        zero.alias("unique_scenes"),
        F.count_if(F.col("p").isNull()).alias("fallback_tiles"),
    )
    scenes = chosen.select("collection_id", "item_id").distinct().agg(
        zero.alias("tiles_evaluated"), F.count("*").alias("unique_scenes"), zero.alias("fallback_tiles")
    )
    return tiles.unionByName(scenes).agg(
        *[F.sum(c).alias(c) for c in tiles.columns], F.lit(depth).alias("max_scenes_per_tile")
    )


def order_primary(scenes: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Clearest first (unknown cloud counts as 100), then oldest."""
    order = [F.coalesce("cloud", F.lit(100.0)), F.col("acq_date"), F.col("item_id")]
    return top_in_group(scenes, keys, order, n)


def order_newest(scenes: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Clearest first (unknown cloud counts as 100), then newest."""
    order = [F.coalesce("cloud", F.lit(100.0)), F.col("acq_date").desc(), F.col("item_id")]
    return top_in_group(scenes, keys, order, n)


def mosaic_cap(scenes: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Lowest-cloud ``n`` scenes, unknown cloud last; ``n`` <= 0 keeps all."""
    return top_in_group(scenes, keys, [F.col("cloud").asc_nulls_last(), F.col("item_id")], n)


def finest_images(images: DataFrame, keys: list[str], n: int, max_gsd: float | None = None) -> DataFrame:
    """Finest ground resolution first, then newest (unknown date leads)."""
    if max_gsd is not None:
        images = images.filter(F.col("gsd") <= max_gsd)
    order = [F.col("gsd"), F.col("acquisition_start").desc_nulls_first(), F.col("url")]
    return top_in_group(images, keys, order, n)


def best_at_points(points: DataFrame, scenes: DataFrame, box: Box, start, end, max_cloud) -> DataFrame:
    """Single clearest scene that meets the box around each point.

    ``points`` has ``point_id``; ``box`` names its box columns. A point without a
    scene gets no row. Of scenes with one footprint only the clearest can win, so a
    footprint that is seen again and again meets the points once.
    """
    boxed = points.select("point_id", *[c.alias(n) for n, c in box._asdict().items()])
    s_box = {n: f"s_{n}" for n in BOX}
    usable = scenes.filter((F.col("cloud") <= max_cloud) & F.col("acq_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    usable = usable.select("cloud", "acq_date", "collection_id", "item_id", *BOX).withColumnsRenamed(s_box)
    clearest = F.min(F.struct("cloud", "acq_date", "collection_id", "item_id")).alias("b")
    footprints = cut_lineage(usable.groupBy(*s_box.values()).agg(clearest))
    left, right = boxes_of(boxed, _whole_boxes(footprints, "s_"), "", "s_")
    pairs = left.join(right, [*KEYS, "salt"]).filter(boxes_intersect(Box(*BOX), Box(*s_box.values())))
    best = pairs.groupBy("point_id").agg(F.min("b").alias("b"))
    return best.select("point_id", "b.*")
