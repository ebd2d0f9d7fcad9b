"""Scene manifests, prefetch lists and product work lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.grid import Box, box_covers
from tessella.functions.scalars import product_parts
from tessella.operators import scenes as SC
from tessella.operators.gridjoin import KEYS, boxes_of
from tessella.session import cut_lineage, pinned

BOX = ("minx", "miny", "maxx", "maxy")


def scene_manifest(
    plan: DataFrame, scenes: DataFrame, depth: int = 12, search_limit: int | None = None, checkpoint: bool = True
):
    """(scenes, summary) of a plan, in one job instead of one search per tile.

    Candidates by place, date and cloud; fallback where there is no primary candidate;
    a date-diverse stack per tile; each scene once, as first seen in plan order.
    ``search_limit`` caps the candidates of a tile and collection, as a page of a remote
    search would; by default all count. ``checkpoint`` keeps the candidates, which are
    read several times.
    """
    candidates = SC.match_plan_scenes(plan, scenes)
    if search_limit:
        candidates = SC.cap_search(candidates, search_limit)
    if checkpoint:
        candidates = cut_lineage(candidates)
    chosen = SC.scene_stack(SC.pick_role(candidates, capped=bool(search_limit)), depth, SC.TILE)
    unique = SC.unique_scenes(chosen, ["x", "y", "z", "pos"])
    return unique, SC.manifest_summary(plan, candidates, chosen, depth)


def covering_manifest(regions: DataFrame, scenes: DataFrame, region: str, n: int) -> DataFrame:
    """Scenes that fully cover each region box, clearest then newest, at most ``n``.

    A covering scene holds the region's south-west corner, so the corner alone meets the
    scenes, in cells of their own sizes.
    """
    corner = regions.select(
        region, *BOX, *[F.col(c).alias(f"_c_{n}") for n, c in zip(BOX, ("minx", "miny", "minx", "miny"))]
    )
    renamed = scenes.withColumnsRenamed({c: f"s_{c}" for c in BOX})
    left, right = boxes_of(corner, SC._whole_boxes(renamed, "s_"), "_c_", "s_")
    pairs = left.join(right, [*KEYS, "salt"]).filter(box_covers(Box(*(f"s_{c}" for c in BOX)), Box(*BOX)))
    return SC.order_newest(pairs.drop(*KEYS, "salt", *BOX, *[f"{p}{c}" for p in ("_c_", "s_") for c in ("_fx", "_fy")], *[f"_c_{c}" for c in BOX]), [region], n)


def prefetch_list(overlays: DataFrame, scenes: DataFrame, assets, cached: DataFrame, n: int) -> DataFrame:
    """Assets still to fetch for the overlays that use Sentinel-2, each once.

    The priority of an asset is the first overlay (``ord``) that needs it.
    """
    wanted = overlays.filter(F.col("source") == "sentinel2")
    picked = covering_manifest(wanted, scenes, "ord", n)
    rows = picked.select(
        "collection_id", "item_id", "ord", F.explode(F.array(*map(F.lit, assets))).alias("asset")
    )
    once = rows.groupBy("collection_id", "item_id", "asset").agg(F.min("ord").alias("priority"))
    return once.join(cached, ["collection_id", "item_id", "asset"], "left_anti")


def product_worklist(products: DataFrame, existing: DataFrame, prefix: str) -> DataFrame:
    """Grid tiles still to request per acquisition date, and how many are reused."""
    acquired, tile = product_parts("product_id", prefix)
    parsed = pinned(products.select("product_id"), acquired=acquired, tile=tile).dropna()
    have = existing.select("product_id").distinct().withColumn("have", F.lit(True))
    marked = parsed.join(have, "product_id", "left")
    todo = F.array_sort(F.collect_set(F.when(F.col("have").isNull(), F.col("tile"))))
    return marked.groupBy("acquired").agg(todo.alias("tiles"), F.count_if(F.col("have").isNotNull()).alias("reused"))
