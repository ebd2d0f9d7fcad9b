"""Tile catalogs, asset catalogs, layer listings and tile trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import col
from tessella.functions.scalars import slug, to_integer
from tessella.session import pinned


def parse_catalog_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """``z/x/y.ext,mtime,size[,md5]`` text to typed rows, malformed lines dropped."""
    fields = pinned(lines.select(F.col(line).alias("line")), parts=F.split(F.trim("line"), ","))
    fields = pinned(fields.filter(F.size("parts") >= 3), path=F.split(F.get("parts", F.lit(0)), "/"))
    leaf = F.get("path", F.lit(2))
    typed = pinned(
        fields.filter(F.size("path") == 3),
        z=to_integer(F.get("path", F.lit(0))).cast("int"),
        x=to_integer(F.get("path", F.lit(1))),
        y=to_integer(F.split_part(leaf, F.lit("."), F.lit(1))),
        ext=F.regexp_extract(leaf, r"\.(.*)$", 1),
        mtime=to_integer(F.get("parts", F.lit(1))),
        size=to_integer(F.get("parts", F.lit(2))),
        md5=F.coalesce(F.get("parts", F.lit(3)), F.lit("")),
    )
    whole = ["z", "x", "y", "mtime", "size"]
    return typed.dropna(subset=whole).select("z", "x", "y", "ext", "mtime", "size", "md5")


def read_catalog(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Catalog text files, plain or gzip; undecodable bytes are replaced.

    A gzip file is one split, so ``partitions`` spreads its lines before parsing.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return parse_catalog_lines(lines.repartition(partitions) if partitions else lines)


def tile_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """Files of a ``z/x/y.ext`` tree with their key; other entries are dropped.

    The extension is everything after the first dot of the file name.
    """
    pattern = r"(?:^|/)([0-9]+)/([0-9]+)/([0-9]+)\.([^/]+)$"
    key = lambda group: F.regexp_extract(F.col(path), pattern, group)
    found = files.filter(F.col(path).rlike(pattern))
    keyed = pinned(found, z=key(1).cast("int"), x=key(2).cast("bigint"), y=key(3).cast("bigint"), ext=key(4))
    return keyed.select("z", "x", "y", "ext", *files.columns)


def read_tile_tree(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Scan a tile tree; without payload only names and sizes leave the scan."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    )
    keep = ["path", "modificationTime", "length"] + (["content"] if payload else [])
    tiles = tile_paths(files.select(*keep))
    return tiles.withColumnRenamed("content", "payload") if payload else tiles


def cached_layer_tiles(files: DataFrame, min_zoom: int, max_zoom: int, path: str = "path") -> DataFrame:
    """Tiles of each layer at the wanted zoom, else at its highest stored zoom.

    ``files`` holds ``layer`` and a path; only image suffixes and integer names count.
    """
    tiles = tile_paths(files, path).filter(
        F.lower(F.element_at(F.split("ext", r"\."), -1)).isin(*C.TILE_SUFFIXES)
        & F.col("z").between(min_zoom, max_zoom)
    )
    best = tiles.groupBy("layer").agg(F.max("z").alias("z"))
    return tiles.join(best, ["layer", "z"], "left_semi")


ASSET_SCHEMA = (
    "map<string, struct<name: string, description: string, urls: array<string>, "
    "destination: string, license: string, attribution: string, media_type: string, checksum: string>>"
)


def parse_asset_catalog(docs: DataFrame, text: str = "value") -> DataFrame:
    """Asset map documents to one row per asset, defaults filled in."""
    assets = docs.select(F.explode(F.from_json(text, ASSET_SCHEMA)).alias("asset_id", "a"))
    blank = lambda name, default="": F.coalesce(F.col(f"a.{name}"), F.lit(default)).alias(name)
    return assets.filter(F.col("a.name").isNotNull() & F.col("a.destination").isNotNull()).select(
        "asset_id",
        F.col("a.name").alias("name"),
        blank("description"),
        F.coalesce(F.col("a.urls"), F.array().cast("array<string>")).alias("urls"),
        F.col("a.destination").alias("destination"),
        blank("license"),
        blank("attribution"),
        blank("media_type", "unknown"),
        F.col("a.checksum").alias("checksum"),
    )


def _layer_type(depth: int) -> str:
    inner = f", Layer: array<{_layer_type(depth - 1)}>" if depth > 1 else ""
    return f"struct<Name: string, Title: string{inner}>"


def _nesting(plain: Column) -> Column:
    """Deepest nesting of ``Layer`` elements in a document."""
    tags = F.regexp_extract_all(F.regexp_replace(plain, r"<Layer\b[^>]*/>", ""), F.lit(r"<(/?)Layer\b"), F.lit(1))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(a, tag):
        now = a["now"] + F.when(tag == "", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))

    return F.aggregate(tags, start, step)["most"]


def parse_layers_xml(docs: DataFrame, text: str = "xml", depth: int | None = None) -> DataFrame:
    """Name and title of all nested layers of service-capability documents.

    Without a ``depth`` the deepest nesting is measured first (one number for the whole
    table). The title falls back to the name and layers without a name are skipped (their
    children are still listed).
    """
    unprefixed = F.regexp_replace(F.col(text), r"<(/?)\w+:", "<$1")
    if depth is None:
        depth = max(1, docs.agg(F.max(_nesting(unprefixed))).first()[0] or 1)
    schema = f"struct<Capability: struct<Layer: array<{_layer_type(depth)}>>>"
    plain = F.regexp_replace(unprefixed, r"\sxmlns(:\w+)?=(\"[^\"]*\"|'[^']*')", "")
    nodes = pinned(docs, doc=F.from_xml(plain, schema)).withColumn("level", F.col("doc.Capability.Layer"))
    named = lambda n: F.struct(F.trim(n.Name).alias("name"), F.trim(n.Title).alias("title"))
    found = F.array()
    level = F.col("level")
    for at in range(depth):
        empty = F.array().cast(f"array<{_layer_type(depth - at)}>")
        level = F.coalesce(level, empty)
        found = F.concat(found, F.transform(level, named)) if at else F.transform(level, named)
        if at < depth - 1:
            below = F.filter(level, lambda n: n.Layer.isNotNull())
            level = F.flatten(F.transform(below, lambda n: n.Layer))
    keep = [c for c in docs.columns if c != text]
    rows = nodes.select(*keep, F.explode(found).alias("n")).filter(F.col("n.name") != "")
    title = F.coalesce(F.nullif(F.col("n.title"), F.lit("")), F.col("n.name"))
    return rows.select(*keep, F.col("n.name").alias("name"), title.alias("title"))


def band_files(files: DataFrame, expected: DataFrame, path: str = "path") -> DataFrame:
    """Match band rasters ``*<band>_doy<date>*.tif`` per tile folder.

    ``expected`` has (tile, band, date); a row without a file keeps a null path, so
    that ``missing_bands`` can report it.
    """
    pattern = r"/([^/]+)/([^/]+)_doy([0-9]{7})[^/]*\.tif$"
    part = lambda group: F.regexp_extract(path, pattern, group)
    named = pinned(files.filter(F.col(path).rlike(pattern)), f_tile=part(1), stem=part(2), f_date=part(3))
    found = named.select("f_tile", "stem", "f_date", F.col(path).alias("path"))
    joined = expected.join(
        found,
        (F.col("tile") == F.col("f_tile")) & (F.col("date") == F.col("f_date")) & F.col("stem").endswith(F.col("band")),
        "left",
    )
    return joined.groupBy("tile", "band", "date").agg(F.min("path").alias("path"))


def missing_bands(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("path").isNull()).select("tile", "band", "date")


def layer_folder(name) -> Column:
    return slug(col(name))
