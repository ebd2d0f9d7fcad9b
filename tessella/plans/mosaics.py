"""Clean mosaics from masked temporal stacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.scalars import qa_mask_literal
from tessella.functions.grid import Box
from tessella.operators import chunks as CH
from tessella.operators import pixels as PX
from tessella.operators import stacks as ST
from tessella.operators.planes import crop_box_chunks
from tessella.operators.tiles import KEY


def stretch_chunks(chunks: DataFrame, low: float, high: float, gamma: float) -> DataFrame:
    return chunks.withColumn("data", F.transform("data", lambda d: PX.stretched(d, low, high, gamma)))


def clean_mosaic(
    bands: DataFrame, qa: DataFrame, flags=C.QA_DEFAULT_FLAGS, dilation: int = 1,
    strategy: str = "best_pixel", stretch=C.STRETCHES["hls"],
) -> DataFrame:
    """Mask (and grow the mask), merge the stack of each tile and band, stretch to bytes.

    ``bands`` has scene, band, cloud and chunks; ``qa`` has scene and chunks. The
    median is taken for ``median`` and ``best_pixel``, else the clearest scene wins.
    """
    mask = qa_mask_literal(flags)
    if mask:
        cloud = CH.dilate_mask(qa, ["scene"], mask, dilation)
        bands = CH.mask_chunks(bands, cloud, ["scene", *KEY], 1)
    keys = [*KEY, "band"]
    if PX.use_median(strategy):
        merged = ST.median_chunks(bands.select("scene", *keys, "w", "h", "data"), keys)
    else:
        merged = ST.priority_chunks(bands.select("scene", "cloud", *keys, "w", "h", "data"), keys)
    return stretch_chunks(merged, *stretch)


def visual_mosaic(chunks: DataFrame, scenes_per_region: int, box: Box, z: int, stretch=C.STRETCHES["sentinel2"]) -> DataFrame:
    """Clearest scenes only, cleanest on top, cut to a box and stretched to bytes.

    ``chunks`` has scene, cloud, band. Scenes are capped by what they have in the box: clear
    values, or pixels of the footprint, nodata included, if ``chunks`` mark it in a second
    plane. The result's second plane is 255 where a scene is clear, else 0, since a clear
    value may be stretched to 0.
    """
    area = F.col("w") * F.col("h")
    inside = crop_box_chunks(chunks, ["scene", "cloud", "band", *KEY], box, z).filter(F.exists("data", lambda d: d != 0))
    if scenes_per_region > 0:
        scenes = inside.groupBy("scene", "cloud").agg(F.count("*").alias("n"))
        kept = scenes.orderBy(F.col("cloud").asc_nulls_last(), "scene").limit(scenes_per_region)
        inside = inside.join(F.broadcast(kept.select("scene")), "scene", "left_semi")  # at most the cap
    top = ST.priority_chunks(inside.withColumn("data", F.slice("data", F.lit(1), area)), [*KEY, "band"])
    alpha = F.transform("data", lambda d: F.when(d != 0, 255).otherwise(0)).alias("alpha")
    done = stretch_chunks(top.select("*", alpha), *stretch)
    return done.withColumn("data", F.concat("data", "alpha")).drop("alpha")


def band_mosaic(pixels: DataFrame, z_keys: list[str]) -> DataFrame:
    """Band mode: scenes painted in list order with no nodata, the last one on top."""
    return PX.last_painted(pixels, z_keys, PX.paint_order(pixels))
