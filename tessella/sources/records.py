"""Plans, scene items, manifests, aerial images and vector features as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.grid import shard_of_tile
from tessella.functions.scalars import sign_url, strip_query, to_instant, to_number
from tessella import constants as C
from tessella.session import pinned

PLAN_SCHEMA = (
    "z int, x bigint, y bigint, bbox array<double>, start_date string, end_date string, "
    "season string, hemisphere string, collections array<string>, "
    "fallback_collections array<string>, max_cloud double, fallback_max_cloud double, shard string"
)
ITEM_SCHEMA = (
    "id string, collection string, bbox array<double>, "
    "properties struct<datetime: string, `eo:cloud_cover`: string>, "
    "assets map<string, struct<href: string>>"
)
IMAGE_SCHEMA = (
    "results array<struct<uuid: string, gsd: double, bbox: array<double>, "
    "acquisition_start: string, properties: struct<license: string>>>"
)
MANIFEST_SCHEMA = "summary map<string, string>, scenes array<string>"
FEATURE_SCHEMA = (
    "features array<struct<properties: map<string, string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)


def parse_plan(lines: DataFrame, text: str = "value") -> DataFrame:
    """Plan NDJSON to typed rows: defaults filled, bad JSON and incomplete rows dropped."""
    raw = pinned(lines.select(F.col(text)), p=F.from_json(text, PLAN_SCHEMA)).select("p.*")
    max_cloud = F.coalesce("max_cloud", F.lit(100.0))
    none = F.array().cast("array<string>")
    return (
        pinned(raw, start_day=F.col("start_date").try_cast("date"), end_day=F.col("end_date").try_cast("date"))
        .select(
            "z",
            "x",
            "y",
            *[F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))],
            (F.size("bbox") == 4).alias("boxed"),
            F.col("start_day").alias("start_date"),
            F.col("end_day").alias("end_date"),
            F.coalesce("season", F.lit("unknown")).alias("season"),
            F.coalesce("hemisphere", F.lit("global")).alias("hemisphere"),
            F.coalesce("collections", none).alias("collections"),
            F.coalesce("fallback_collections", none).alias("fallback_collections"),
            max_cloud.alias("max_cloud"),
            F.coalesce("fallback_max_cloud", max_cloud).alias("fallback_max_cloud"),
            "shard",
        )
        .dropna(subset=["z", "x", "y", "start_date", "end_date"])
        .filter("boxed")
        .drop("boxed")
    )


def plan_json(plan: DataFrame) -> DataFrame:
    """Plan rows as JSON text; a null shard is left out."""
    row = F.struct(
        "z",
        "x",
        "y",
        F.array("minx", "miny", "maxx", "maxy").alias("bbox"),
        F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        F.date_format("end_date", "yyyy-MM-dd").alias("end_date"),
        "season",
        "hemisphere",
        "collections",
        "fallback_collections",
        "max_cloud",
        "fallback_max_cloud",
        "shard",
    )
    return plan.select(F.to_json(row).alias("value"))


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    return parse_plan(spark.read.text(path).filter(F.trim("value") != ""))


def write_plan(plan: DataFrame, path: str) -> None:
    plan_json(plan).write.mode("overwrite").text(path)


def with_plan_shard(plan: DataFrame) -> DataFrame:
    """Effective shard: the stored tag, else the tile's own, else ``unassigned``."""
    stored = F.nullif(F.col("shard"), F.lit(""))
    own = shard_of_tile("z", "x", "y")
    return plan.withColumn("shard", F.coalesce(stored, own, F.lit(C.UNASSIGNED_SHARD)))


def write_plan_by_shard(plan: DataFrame, path: str) -> None:
    """One dataset per shard, partitioned by folder."""
    with_plan_shard(plan).write.mode("overwrite").partitionBy("shard").json(path)


def parse_items(lines: DataFrame, text: str = "value") -> DataFrame:
    keep = [c for c in lines.columns if c != text]
    parsed = pinned(lines, i=F.from_json(text, ITEM_SCHEMA))
    hrefs = F.transform_values("i.assets", lambda _, a: a.href)
    rows = pinned(
        parsed,
        item_id=F.col("i.id"),
        collection_id=F.col("i.collection"),
        acquired=to_instant("i.properties.datetime"),
        acq_date=F.substring("i.properties.datetime", 1, 10).try_cast("date"),
        cloud=to_number(F.col("i.properties")["eo:cloud_cover"]),
        bbox=F.col("i.bbox"),
        hrefs=F.map_filter(hrefs, lambda _, href: href != ""),
    )
    return rows.select(*keep, "item_id", "collection_id", "acquired", "acq_date", "cloud", "bbox", "hrefs")


def _box(fallback=()):
    names = ("minx", "miny", "maxx", "maxy")
    whole = F.size("bbox") == 4
    for i, name in enumerate(names):
        own = F.when(whole, F.get("bbox", F.lit(i)))
        yield F.coalesce(own, F.col(fallback[i])).alias(name) if fallback else own.alias(name)


def scene_items(items: DataFrame, bands, qa_key: str, tile_box=()) -> DataFrame:
    """Items with at least one wanted band; the quality asset is optional.

    ``tile_box`` names four columns that stand in for a missing item box.
    """
    wanted = F.map_filter("hrefs", lambda k, _: k.isin(*bands))
    return pinned(items, bands=wanted).filter(F.size("bands") > 0).select(
        "collection_id",
        "item_id",
        F.when(F.col("acquired").isNotNull(), F.col("acq_date")).alias("acq_date"),
        "cloud",
        *_box(tile_box),
        "bands",
        F.try_element_at("hrefs", F.lit(qa_key)).alias("qa_href"),
    )


def scene_items_strict(items: DataFrame, assets) -> DataFrame:
    """Items that have an id, a box and every wanted asset."""
    names = F.array(*map(F.lit, assets))
    complete = F.forall(names, lambda n: F.map_contains_key(F.col("hrefs"), n))
    return items.filter(
        F.col("item_id").isNotNull() & (F.size("bbox") == 4) & F.coalesce(complete, F.lit(False))
    ).select(
        "collection_id",
        "item_id",
        "acquired",
        "cloud",
        *_box(),
        F.map_filter("hrefs", lambda k, _: k.isin(*assets)).alias("assets"),
    )


def parse_images(docs: DataFrame, text: str = "value") -> DataFrame:
    """Aerial-image search results; rows without url, gsd or a whole box are dropped."""
    found = pinned(docs.select(F.col(text)), doc=F.from_json(text, IMAGE_SCHEMA))
    rows = found.select(F.explode("doc.results").alias("r")).select("r.*")
    whole = (F.col("uuid") != "") & F.col("gsd").isNotNull() & (F.size("bbox") == 4)
    return rows.filter(whole).select(
        F.col("uuid").alias("url"),
        "gsd",
        *_box(),
        "acquisition_start",
        F.col("properties.license").alias("license"),
    )


def parse_manifest(docs: DataFrame, scene_schema: str, text: str = "value") -> DataFrame:
    """Scenes of manifest documents; entries that are not objects are dropped."""
    entries = docs.select(F.explode(F.from_json(text, MANIFEST_SCHEMA)["scenes"]).alias("e"))
    objects = entries.filter(F.col("e").startswith("{"))
    return objects.select(F.from_json("e", scene_schema).alias("s")).select("s.*")


def manifest_lines(summary: DataFrame, scenes: DataFrame, key: str) -> DataFrame:
    """(key, value): per manifest a ``{"summary": ...}`` line and a ``{"scene": ...}`` line a scene.

    The one layout for manifests of any size: nothing is gathered, and ``write_manifests``
    keeps the lines of a manifest in its folder.
    """
    line = lambda df, name: df.select(key, F.to_json(F.struct(F.struct(*[c for c in df.columns if c != key]).alias(name))).alias("value"))
    return line(summary, "summary").unionByName(line(scenes, "scene"))


def write_manifests(summary: DataFrame, scenes: DataFrame, key: str, path: str) -> None:
    manifest_lines(summary, scenes, key).write.mode("overwrite").partitionBy(key).text(path)


def parse_manifest_lines(lines: DataFrame, kind: str, schema: str, text: str = "value") -> DataFrame:
    """The ``summary`` or ``scene`` lines with the other columns; broken lines are dropped."""
    keep = [c for c in lines.columns if c != text]
    entry = F.get_json_object(text, f"$.{kind}")
    rows = lines.filter(entry.startswith("{")).select(*keep, F.from_json(entry, schema).alias("s"))
    return rows.select(*keep, "s.*")


def refresh_urls(scenes: DataFrame, tokens: DataFrame, default_collection: str | None = None) -> DataFrame:
    """Re-sign every href of a scene with its collection's token.

    ``tokens`` is one row per collection. Scenes without a collection are dropped
    unless a default is given.
    """
    if default_collection:
        scenes = scenes.withColumn(
            "collection_id", F.coalesce("collection_id", F.lit(default_collection))
        )
    named = scenes.filter(F.coalesce("collection_id", F.lit("")) != "")
    joined = named.join(tokens, "collection_id", "inner")
    signed = joined.withColumn(
        "bands", F.transform_values("bands", lambda _, href: sign_url(strip_query(href), F.col("token")))
    )
    if "qa_href" in scenes.columns:
        signed = signed.withColumn("qa_href", sign_url(strip_query("qa_href"), "token"))
    return signed.drop("token")


def parse_features(docs: DataFrame, text: str = "value", where=None) -> DataFrame:
    """Feature collections to an edge table, optionally filtered by attributes.

    Polygon and MultiPolygon rings become one row per edge:
    (feature_id, ring, seg, x1, y1, x2, y2). ``where`` is a predicate over
    ``properties`` and ``feature_id``.
    """
    features = docs.select(F.from_json(text, FEATURE_SCHEMA)["features"].alias("f")).select(
        F.explode("f").alias("f")
    )
    features = features.select(
        F.xxhash64("f.geometry.coordinates", F.to_json("f.properties")).alias("feature_id"),
        F.col("f.properties").alias("properties"),
        F.col("f.geometry.type").alias("kind"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )
    if where is not None:
        features = features.filter(where)
    # a repeated feature is the same area: its doubled edges would cancel each other
    features = features.dropDuplicates(["feature_id"])
    polygon = F.from_json("coordinates", "array<array<array<double>>>")
    multi = F.flatten(F.from_json("coordinates", "array<array<array<array<double>>>>"))
    rings = features.withColumn(
        "rings", F.when(F.col("kind") == "Polygon", polygon).when(F.col("kind") == "MultiPolygon", multi)
    ).select("feature_id", F.posexplode("rings").alias("ring", "points"))
    pairs = F.arrays_zip(
        F.slice("points", F.lit(1), F.size("points") - 1).alias("a"),
        F.slice("points", F.lit(2), F.size("points") - 1).alias("b"),
    )
    edges = rings.select("feature_id", "ring", F.posexplode(pairs).alias("seg", "e"))
    at = lambda end, i: F.get(F.col(f"e.{end}"), F.lit(i))
    return edges.select(
        "feature_id",
        "ring",
        "seg",
        at("a", 0).alias("x1"),
        at("a", 1).alias("y1"),
        at("b", 0).alias("x2"),
        at("b", 1).alias("y2"),
    )
