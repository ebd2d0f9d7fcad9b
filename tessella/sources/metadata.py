"""Tile-set metadata, TileJSON and asset manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.operators.tiles import zoom_range


def read_meta(meta: DataFrame, tiles: DataFrame, by: list[str]) -> DataFrame:
    """Key/value metadata as one row per tile set.

    Missing zooms come from the tiles; ``bounds`` and ``center`` become numbers and
    keep their text aside, for when it is malformed.
    """
    value = lambda name: F.max(F.when(F.col("name") == name, F.col("value")))
    wide = meta.groupBy(*by).agg(*[
        value(n).alias(f"{n}_text")
        for n in ("name", "format", "attribution", "bounds", "center", "minzoom", "maxzoom")
    ])

    def numbers(text: str, n: int) -> Column:
        parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
        whole = (F.size(parts) == n) & F.forall(parts, lambda p: p.isNotNull())
        return F.when(whole, parts)

    spans = zoom_range(tiles, by)
    joined = spans.withColumnsRenamed({"minzoom": "z0", "maxzoom": "z1"}).join(wide, by, "left")
    return joined.select(
        *by,
        F.col("name_text").alias("name"),
        F.col("format_text").alias("format"),
        F.col("attribution_text").alias("attribution"),
        F.coalesce(F.col("minzoom_text").try_cast("int"), "z0").alias("minzoom"),
        F.coalesce(F.col("maxzoom_text").try_cast("int"), "z1").alias("maxzoom"),
        numbers("bounds_text", 4).alias("bounds"),
        numbers("center_text", 3).alias("center"),
        "bounds_text",
        "center_text",
    )


def meta_rows(table: DataFrame, by: list[str]) -> DataFrame:
    """One-row-per-set metadata back to key/value rows."""
    names = [c for c in table.columns if c not in by]
    pairs = F.map_filter(
        F.create_map(*[e for n in names for e in (F.lit(n), F.col(n).cast("string"))]),
        lambda _, value: value.isNotNull(),
    )
    return table.select(*by, F.explode(pairs).alias("name", "value"))


def credits(source: Column) -> tuple[Column, Column]:
    """Imagery label and attribution of a tile source."""
    def pick(i):
        chain = reduce(lambda c, kv: c.when(source == kv[0], kv[1][i]), C.SOURCE_CREDITS.items(), F.when(F.lit(False), ""))
        return chain.otherwise(C.DEFAULT_CREDIT[i])

    return pick(0), pick(1)


def tilejson(sets: DataFrame, by: list[str]) -> DataFrame:
    """TileJSON 3.0 document per tile set; absent bounds, centre or zooms get defaults."""
    have = set(sets.columns)
    value = lambda name, default: F.coalesce(F.col(name), default) if name in have else default
    doubles = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    doc = F.struct(
        F.lit("3.0.0").alias("tilejson"),
        "name",
        value("description", F.lit(None).cast("string")).alias("description"),
        value("version", F.lit(None).cast("string")).alias("version"),
        value("attribution", F.lit(None).cast("string")).alias("attribution"),
        value("bounds", doubles(*C.GLOBAL_BOUNDS)).alias("bounds"),
        value("center", doubles(0, 0, 2)).alias("center"),
        value("minzoom", F.lit(0)).alias("minzoom"),
        value("maxzoom", F.lit(0)).alias("maxzoom"),
        F.lower("format").alias("format"),
        F.lit("xyz").alias("scheme"),
        F.array(F.concat(F.lit("pmtiles://"), "name", F.lit(".pmtiles"))).alias("tiles"),
    )
    return sets.select(*by, F.to_json(doc).alias("tilejson"))


def asset_manifest(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest entry per fetched asset as JSON; null fields are left out."""
    bytes_ = F.col("content").cast("binary")
    digests = files.select(
        "asset_id", F.sha2(bytes_, 256).alias("sha256"), F.octet_length(bytes_).alias("file_size")
    )
    joined = catalog.join(digests, "asset_id")
    return joined.select(
        "asset_id", F.to_json(F.struct(*[c for c in joined.columns if c != "asset_id"])).alias("source")
    )
