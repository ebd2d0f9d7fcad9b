"""Counters, checks and reports over catalogs, plans, logs and tile sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import gsd_to_zoom
from tessella.session import inline_table

BLOCKED = (403, 429, 503)


def catalog_by_zoom(catalog: DataFrame) -> DataFrame:
    """Tiles and bytes per zoom, with the total in the row of a null zoom."""
    return catalog.rollup("z").agg(F.count("*").alias("tiles"), F.sum("size").alias("bytes"))


def fetch_counters():
    """Aggregates of one row per attempt: status 0 is a cache hit, null a raised error."""
    status = F.col("status")
    other = ~status.isin(0, 200, 404, *BLOCKED)
    return [
        F.count_if(status == 200).alias("ok"),
        F.count_if(status == 0).alias("cached"),
        F.count_if(status == 404).alias("http_404"),
        F.count_if(status.isin(*BLOCKED)).alias("blocked"),
        F.count_if(status.isNull() | other).alias("error"),
        F.sum(F.when(status == 200, F.col("bytes")).otherwise(0)).alias("bytes"),
    ]


def fetch_stats(log: DataFrame, by: list[str]) -> DataFrame:
    return log.groupBy(*by).agg(*fetch_counters())


def failed_fetches(log: DataFrame, tile_keys: list[str], retries: int) -> DataFrame:
    """Tiles whose every attempt was blocked or raised, after all retries."""
    bad = F.col("status").isNull() | F.col("status").isin(*BLOCKED)
    per_tile = log.groupBy(*tile_keys).agg(F.count("*").alias("attempts"), F.count_if(bad).alias("bad"))
    return per_tile.filter((F.col("bad") == F.col("attempts")) & (F.col("attempts") >= retries))


def fetch_report(log: DataFrame, by: list[str], tile_keys: list[str], retries: int) -> DataFrame:
    """Fetch counters with the number of tiles given up, per group."""
    failed = failed_fetches(log, [*by, *tile_keys], retries).groupBy(*by).agg(F.count("*").alias("failed"))
    return fetch_stats(log, by).join(failed, by, "left").fillna(0, ["failed"])


def transfer_health(log: DataFrame, by: list[str]) -> DataFrame:
    """Throughput class and wait range per overlay from (bytes, seconds) rows."""
    sums = log.groupBy(*by).agg(F.sum("bytes").alias("bytes"), F.sum("seconds").alias("seconds"))
    speed = F.when(F.col("seconds") > 0, F.col("bytes") / 1024.0 / F.col("seconds")).otherwise(
        F.lit(float("inf"))
    )
    kind = (
        F.when(F.col("bytes") <= 0, "none")
        .when(speed < C.THROTTLE_FLOOR_KIBPS, "throttled")
        .otherwise("healthy")
    )
    bound = lambda i: (
        F.when(F.col("health") == "none", 0.0)
        .when(F.col("health") == "throttled", C.COOLDOWN_RANGE_S[i])
        .otherwise(C.JITTER_RANGE_S[i])
    )
    return sums.withColumn("kibps", speed).withColumn("health", kind).select(
        *by, "bytes", "seconds", "kibps", "health", bound(0).alias("wait_min_s"), bound(1).alias("wait_max_s")
    )


def cache_rates(log: DataFrame, by: list[str]) -> DataFrame:
    """Shares of cache hits, repeated downloads and failures (``outcome`` per fetch)."""
    share = lambda name: (F.count_if(F.col("outcome") == name) / F.count("*")).alias(f"{name}_rate")
    return log.groupBy(*by).agg(F.count("*").alias("fetches"), share("hit"), share("redownload"), share("failed"))


def weight_grid(tiles: DataFrame, cells: DataFrame, zoom: int, weight: str | None = None) -> DataFrame:
    """Tiles (or a weight) per cell of a coarse zoom, over a dense grid of cells."""
    shift = F.col("z") - zoom
    ax = F.call_function("shiftright", F.col("x"), shift.cast("int"))
    ay = F.call_function("shiftright", F.col("y"), shift.cast("int"))
    value = F.sum(weight) if weight else F.count("*")
    counted = tiles.filter(F.col("z") >= zoom).groupBy(ax.alias("x"), ay.alias("y")).agg(value.alias("w"))
    return cells.select("x", "y").join(counted, ["x", "y"], "left").select(
        "x", "y", F.coalesce("w", F.lit(0)).alias("w")
    )


def shard_balance(tiles: DataFrame, shard: str = "shard") -> DataFrame:
    """Tiles and share per shard, and the largest to smallest ratio."""
    counts = tiles.groupBy(shard).agg(F.count("*").alias("tiles"))
    every = Window.partitionBy()  # one row per shard from here on
    return counts.select(
        shard,
        "tiles",
        (F.col("tiles") / F.sum("tiles").over(every)).alias("share"),
        (F.max("tiles").over(every) / F.min("tiles").over(every)).alias("ratio"),
    )


def source_ceilings(spark: SparkSession) -> DataFrame:
    return inline_table(spark, C.SOURCE_CEILINGS.items(), ["source", "native_max_zoom"])


def with_ceiling(rows: DataFrame, gsd: str | None = None) -> DataFrame:
    """Attach the finest justified zoom: from the image's own gsd, else its source."""
    joined = rows.join(F.broadcast(source_ceilings(rows.sparkSession)), "source", "left")
    if gsd is None:
        return joined.withColumnRenamed("native_max_zoom", "ceiling")
    own = F.when(F.col(gsd).isNotNull(), gsd_to_zoom(gsd))
    return joined.withColumn("ceiling", F.coalesce(own, "native_max_zoom")).drop("native_max_zoom")


def oversampled(tiles: DataFrame) -> DataFrame:
    """Per layer: tiles stored above the ceiling of their source (``ceiling`` attached).

    An unknown ceiling is no fault.
    """
    above = F.coalesce(F.col("z") > F.col("ceiling"), F.lit(False))
    return tiles.groupBy("layer", "source").agg(
        F.max("z").alias("max_zoom"), F.max("ceiling").alias("ceiling"), F.count_if(above).alias("above")
    )


def overlay_issues(overlays: DataFrame) -> DataFrame:
    """Declared overlays that ask for too fine a zoom, a reversed range or a used name."""
    joined = with_ceiling(overlays)
    repeated = F.count("*").over(Window.partitionBy("name")) > 1
    issues = F.array_compact(
        F.array(
            F.when(F.col("max_zoom") > F.col("ceiling"), "above_ceiling"),
            F.when(F.col("min_zoom") > F.col("max_zoom"), "reversed_range"),
            F.when(F.col("repeated"), "duplicate_name"),
        )
    )
    return joined.withColumn("repeated", repeated).select("name", "source", F.explode(issues).alias("issue"))


def verify_assets(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Catalog against files (``content``): unknown, missing, mismatch or ok."""
    digests = files.select("asset_id", F.sha2(F.col("content").cast("binary"), 256).alias("digest"))
    both = catalog.select("asset_id", "checksum", F.lit(True).alias("listed")).join(digests, "asset_id", "full")
    status = (
        F.when(F.col("listed").isNull(), "unknown")
        .when(F.col("digest").isNull(), "missing")
        .when(F.col("checksum").isNotNull() & (F.lower("checksum") != F.col("digest")), "mismatch")
        .otherwise("ok")
    )
    return both.select("asset_id", status.alias("status"))


def manifest_check(scenes: DataFrame, by: list[str], required=None, assets: str = "assets") -> DataFrame:
    """Whether each manifest holds a scene with all required assets (any case)."""
    names = F.transform(F.map_keys(assets), lambda n: F.lower(n))
    wanted = F.array(*[F.lit(a.lower()) for a in (required or [])]).cast("array<string>")
    complete = F.forall(wanted, lambda w: F.array_contains(names, w))
    return scenes.groupBy(*by).agg(
        F.count("*").alias("scenes"), F.bool_or(F.coalesce(complete, F.lit(False))).alias("valid")
    )


def reuse_outputs(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Outputs whose source set and digests are unchanged: (output, reuse).

    Both sides hold (output, source, digest); a source that came, went or changed
    forces a rebuild.
    """
    a = recorded.select("output", "source", F.col("digest").alias("was"))
    b = current.select("output", "source", F.col("digest").alias("now"))
    same = F.coalesce(F.col("was") == F.col("now"), F.lit(False))
    return a.join(b, ["output", "source"], "full").groupBy("output").agg(F.bool_and(same).alias("reuse"))


def fresh_snapshots(snapshots: DataFrame, now, ttl_days: int) -> DataFrame:
    """Search snapshots young enough to be used again; ``now`` is an argument."""
    age = F.lit(now).cast("timestamp") - F.col("generated_at")
    return snapshots.withColumn("reuse", age <= F.expr(f"INTERVAL '{ttl_days}' DAY"))


def tileset_check(tiles: DataFrame, by: list[str]) -> DataFrame:
    return tiles.groupBy(*by).agg(F.count("*").alias("tiles"), (F.count("*") > 0).alias("valid"))


def tilejson_check(docs: DataFrame, text: str = "tilejson") -> DataFrame:
    """Whether TileJSON documents have the required keys."""
    keys = ("tilejson", "tiles", "minzoom", "maxzoom", "bounds")
    missing = F.filter(
        F.array(*[F.when(F.get_json_object(text, f"$.{k}").isNull(), k) for k in keys]),
        lambda k: k.isNotNull(),
    )
    return docs.withColumn("missing", F.array_join(missing, ",")).withColumn("valid", F.col("missing") == "")


def chunk_check(chunks: DataFrame, planes: int | None = None) -> DataFrame:
    """Chunks with ``valid``: data present, whole planes of w*h and the checksum, if any.

    ``planes`` is the number of planes to expect; without it any whole number will do.
    """
    area = F.col("w") * F.col("h")
    filled = (F.size("data") > 0) & (F.size("data") % F.nullif(area, F.lit(0)) == 0) if planes is None else F.size("data") == area * planes
    whole = (F.col("w") > 0) & (F.col("h") > 0) & filled
    if "checksum" in chunks.columns:
        digest = F.sha2(F.array_join("data", ",").cast("binary"), 256)
        whole = whole & (F.col("checksum").isNull() | (F.col("checksum") == digest))
    return chunks.withColumn("valid", F.coalesce(whole, F.lit(False)))


def quarantined(chunks: DataFrame, planes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(chunks to use, chunks to put aside)."""
    checked = chunk_check(chunks, planes)
    return checked.filter("valid").drop("valid"), checked.filter("NOT valid").drop("valid")
