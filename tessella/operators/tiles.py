"""Tile-set algebra: overwrite rules, merges, unions, gaps, metadata, ancestors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import ancestor, shl, tile_bounds
from tessella.operators.gridjoin import KEYS as GRID_KEYS
from tessella.operators.gridjoin import SPAN, boxes_of
from tessella.operators.skew import BROADCAST_ROWS, salted
from tessella.session import cut_lineage, inline_table

KEY = ["z", "x", "y"]


def _keep_one(tiles: DataFrame, keys: list[str], order: Column, pick) -> DataFrame:
    """One row per key by an aggregate, which combines before the shuffle."""
    rest = [c for c in tiles.columns if c not in keys]
    best = tiles.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_r"))
    return best.select(*keys, "_r.*").select(*tiles.columns)


def last_wins(tiles: DataFrame, order: list[str], keys=KEY) -> DataFrame:
    """Newest row per key. ``order`` must tell the rows of a key apart."""
    return _keep_one(tiles, keys, F.struct(*order), F.max_by)


def first_wins(tiles: DataFrame, order: list[str], keys=KEY) -> DataFrame:
    return _keep_one(tiles, keys, F.struct(*order), F.min_by)


def union_tiles(inputs: list[DataFrame], keys=KEY) -> DataFrame:
    """Union of archives; the first input that has a key wins."""
    if not inputs:
        raise ValueError("union needs at least one input")
    ranked = [t.withColumn("input_ord", F.lit(i)) for i, t in enumerate(inputs)]
    merged = reduce(lambda a, b: a.unionByName(b), ranked)
    return first_wins(merged, ["input_ord"], keys).drop("input_ord")


def union_meta(metas: list[DataFrame], zooms: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Metadata of a union: the first input's values, overrides, the new zoom range."""
    ranked = [m.withColumn("ord", F.lit(i)) for i, m in enumerate(metas)]
    merged = reduce(lambda a, b: a.unionByName(b), ranked)
    first = merged.groupBy("name").agg(F.min_by("value", "ord").alias("value"))
    stack = zooms.select(
        F.expr("stack(2, 'minzoom', string(minzoom), 'maxzoom', string(maxzoom)) AS (name, fresh)")
    )
    if overrides:
        given = inline_table(zooms.sparkSession, overrides.items(), ["name", "fresh"])
        stack = stack.unionByName(given)
    return first.join(stack, "name", "full").select("name", F.coalesce("fresh", "value").alias("value"))


def overlay_wins(base: DataFrame, overlay: DataFrame, keys=KEY) -> DataFrame:
    """All overlay tiles and the base tiles they do not replace.

    Only the overlay's keys meet the base, so the base's payload is not moved when the
    planner finds them small. The overlay is read twice: pass a stored (or checkpointed)
    table. Keys are unique on either side.
    """
    kept = base.select(*overlay.columns).join(overlay.select(*keys), keys, "left_anti")
    return overlay.unionByName(kept)


def upsert(stored: DataFrame, fresh: DataFrame, order: list[str], keys=KEY) -> DataFrame:
    """Stored rows updated with fresh ones; running it again changes nothing."""
    return last_wins(stored.unionByName(fresh), order, keys)


def missing_tiles(expected: DataFrame, present: DataFrame, keys=KEY) -> DataFrame:
    """Expected keys that are not stored (also: work left after a restart)."""
    return expected.join(present.select(*keys), keys, "left_anti")


def cover_runs(shards: DataFrame, extent: tuple[int, int, int, int]) -> DataFrame:
    """How often rectangles cover an extent, as boxes (minx, miny, maxx, maxy, n).

    ``shards`` has (minx, miny, maxx, maxy), inclusive. The extent is cut into slabs at the
    rectangles' y borders; in a slab every rectangle adds 1 where it begins and takes it
    back behind its end, and the running sum between two such places is the cover. No cell
    is enumerated: the rows grow with the rectangles, not with the zoom.
    """
    x0, y0, x1, y1 = extent
    clipped = shards.select(
        F.greatest("minx", F.lit(x0)).cast("bigint").alias("a"), (F.least("maxx", F.lit(x1)) + 1).cast("bigint").alias("b"),
        F.greatest("miny", F.lit(y0)).cast("bigint").alias("c"), (F.least("maxy", F.lit(y1)) + 1).cast("bigint").alias("d"), F.lit(1).alias("step"),
    ).filter("a < b AND c < d")
    # the extent itself opens and closes each slab without covering it
    frame = inline_table(shards.sparkSession, [(x0, x1 + 1, y0, y1 + 1, 0)], clipped.columns)
    boxes = clipped.unionByName(frame)
    borders = boxes.select(F.explode(F.array("c", "d")).alias("y")).distinct()
    ordered = Window.orderBy("y")  # two borders for each rectangle
    slabs = borders.select("y", F.row_number().over(ordered).alias("slab"), F.lead("y").over(ordered).alias("next"))
    low, high = (slabs.select(F.col("y").alias(c), F.col("slab").alias(f"slab_{c}")) for c in "cd")
    placed = boxes.join(low, "c").join(high, "d").withColumn("slab", F.explode(F.sequence(F.col("slab_c"), F.col("slab_d") - 1)))
    point = lambda x, step: F.struct(x.alias("x"), step.alias("step"))
    events = placed.select("slab", F.inline(F.array(point(F.col("a"), F.col("step")), point(F.col("b"), -F.col("step")))))
    sums = events.groupBy("slab", "x").agg(F.sum("step").alias("step"))
    along = Window.partitionBy("slab").orderBy("x")
    runs = sums.select("slab", F.col("x").alias("minx"), F.sum("step").over(along).alias("n"), F.lead("x").over(along).alias("after"))
    runs = runs.filter(F.col("after").isNotNull()).join(slabs, "slab")
    return runs.select("minx", F.col("y").alias("miny"), (F.col("after") - 1).alias("maxx"), (F.col("next") - 1).alias("maxy"), "n")


def exact_cover(cells: DataFrame, shards: DataFrame) -> DataFrame:
    """Cells covered by no shard or by several.

    ``cells`` has (x, y), ``shards`` has (shard, minx, miny, maxx, maxy) on the same grid.
    Cells meet only the boxes of ``cover_runs`` that are faults, over a quadtree.
    """
    limits = cells.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    if limits[0] is None:
        return cells.select("x", "y", F.lit(0).cast("bigint").alias("n")).limit(0)
    faults = cut_lineage(cover_runs(shards, tuple(limits)).filter(F.col("n") != 1))
    scale = SPAN / (1 + max(abs(v) for v in limits))
    scaled = lambda df, prefix, *names: df.withColumns({f"{prefix}{t}": F.col(n) * scale for t, n in zip(("minx", "miny", "maxx", "maxy"), names)})
    left, right = boxes_of(scaled(cells.select("x", "y"), "c_", "x", "y", "x", "y"), scaled(faults, "f_", "minx", "miny", "maxx", "maxy"), "c_", "f_")
    met = left.join(right, [*GRID_KEYS, "salt"])
    inside = F.col("x").between(F.col("minx"), F.col("maxx")) & F.col("y").between(F.col("miny"), F.col("maxy"))
    return met.filter(inside).select("x", "y", "n")


def content_store(tiles: DataFrame, keys=KEY, payload: str = "payload"):
    """Identical payloads once: (contents by digest, references by key).

    References are a projection; only contents shuffle, combined per digest first.
    """
    digest = F.sha2(F.col(payload).cast("binary"), 256).alias("digest")
    refs = tiles.select(*keys, digest)
    contents = tiles.select(digest, payload).groupBy("digest").agg(
        F.first(payload).alias(payload), F.count("*").alias("uses")
    )
    return contents, refs


def dedup_ratio(tiles: DataFrame, payload: str = "payload") -> DataFrame:
    size = F.octet_length(F.col(payload))
    per_digest = tiles.groupBy(F.sha2(F.col(payload).cast("binary"), 256).alias("digest")).agg(
        F.count("*").alias("uses"), F.max(size).alias("bytes")
    )
    return per_digest.agg(
        F.sum("uses").alias("tiles"),
        F.count("*").alias("contents"),
        F.sum(F.col("uses") * F.col("bytes")).alias("bytes_before"),
        F.sum("bytes").cast("bigint").alias("bytes_after"),
    )


def zoom_range(tiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    return tiles.groupBy(*(by or [])).agg(F.min("z").alias("minzoom"), F.max("z").alias("maxzoom"))


def tileset_bounds(tiles: DataFrame, by: list[str], mode: str = "auto") -> DataFrame:
    """Bounds per tile set: ``global`` literal or ``auto`` envelope of the finest zoom."""
    names = ("minx", "miny", "maxx", "maxy")
    if mode.lower() == "global":
        fixed = [F.lit(v).alias(n) for n, v in zip(names, C.GLOBAL_BOUNDS)]
        return tiles.select(*by).distinct().select(*by, *fixed)
    if mode.lower() != "auto":
        raise ValueError(f"unsupported bounds mode {mode!r}")
    spans = tiles.groupBy(*by, "z").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )
    finest = spans.groupBy(*by).agg(F.max_by(F.struct("z", "x0", "x1", "y0", "y1"), "z").alias("s")).select(*by, "s.*")
    first = tile_bounds("z", "x0", "y0")
    last = tile_bounds("z", "x1", "y1")
    return finest.select(
        *by,
        first.minx.alias("minx"),
        last.miny.alias("miny"),
        last.maxx.alias("maxx"),
        first.maxy.alias("maxy"),
    )


def rows_per_zoom(tiles: DataFrame) -> dict[int, int]:
    """Stored rows by zoom: at most a few dozen numbers, from the key columns alone."""
    return {row["z"]: row["count"] for row in tiles.groupBy("z").count().collect()}


def nearest_ancestor(requests: DataFrame, tiles: DataFrame, by: list[str], carry: str | None = None) -> DataFrame:
    """Deepest stored ancestor-or-self of each requested tile, per ``by`` (a source).

    Both sides carry the ``by`` columns; see ``for_sources``. The tiles are read more
    than once, so pass a stored (or checkpointed) table.

    Keys only, so attach payloads afterwards. Requests are spread over their
    ancestors at stored zooms. A counted, small set of stored keys is broadcast; else
    both sides shuffle, and coarse ancestors that many requests share are salted.
    Requests without an ancestor get no row. ``carry`` names a column of the tiles to
    keep (of equal keys the least value).
    """
    held = [carry] if carry else []
    keys = tiles.groupBy(*by, "z", "x", "y").agg(F.min(carry).alias(carry)) if carry else tiles.select(*by, "z", "x", "y").distinct()
    stored_rows = rows_per_zoom(tiles)
    levels = F.array(*[F.lit(int(at)) for at in sorted(stored_rows)])
    steps = F.filter(levels.cast("array<int>"), lambda anc: anc <= F.col("z"))
    spread = requests.select(*by, *KEY, F.explode(steps).alias("anc_z"))
    ax, ay = ancestor("z", "x", "y", "anc_z")
    spread = spread.select(*by, *KEY, "anc_z", ax.alias("anc_x"), ay.alias("anc_y"))
    stored = keys.select(
        *by, F.col("z").alias("anc_z"), F.col("x").alias("anc_x"), F.col("y").alias("anc_y"), *held
    )
    on = [*by, "anc_z", "anc_x", "anc_y"]
    if sum(stored_rows.values()) <= BROADCAST_ROWS:
        hits = spread.join(F.broadcast(stored), on)
    else:
        stored, spread = salted(stored, spread, on)
        hits = spread.join(stored, [*on, "salt"])
    best = hits.groupBy(*by, *KEY).agg(F.max(F.struct(F.col("anc_z").cast("int").alias("anc_z"), *held)).alias("best"))
    best = best.select(*by, *KEY, "best.*")
    ax, ay = ancestor("z", "x", "y", "anc_z")
    depth = F.col("z") - F.col("anc_z")
    return best.select(
        *by,
        *KEY,
        "anc_z",
        ax.alias("anc_x"),
        ay.alias("anc_y"),
        (F.col("x") - shl(ax, depth)).alias("off_x"),
        (F.col("y") - shl(ay, depth)).alias("off_y"),
        *held,
    )


def for_sources(requests: DataFrame, sources: list, name: str = "src") -> DataFrame:
    """Repeat each request for every source of an ordered stack."""
    return requests.withColumn(name, F.explode(F.array(*[F.lit(s) for s in sources])))


def children_of(tiles: DataFrame, value: str) -> DataFrame:
    """Four children per parent as columns nw, ne, sw, se (null where missing)."""
    quadrant = lambda dx, dy: F.max(
        F.when((F.col("x") % 2 == dx) & (F.col("y") % 2 == dy), F.col(value))
    )
    return (
        tiles.filter(F.col("z") > 0)
        .groupBy((F.col("z") - 1).alias("z"), F.floor(F.col("x") / 2).alias("x"), F.floor(F.col("y") / 2).alias("y"))
        .agg(
            quadrant(0, 0).alias("nw"),
            quadrant(1, 0).alias("ne"),
            quadrant(0, 1).alias("sw"),
            quadrant(1, 1).alias("se"),
        )
    )


def cluster_key(z, x, y) -> Column:
    """Z-order position of a tile at its zoom, for range-read layouts."""
    from tessella.functions.grid import col

    def spread(value):
        value = col(value).cast("bigint")
        for shift, mask in (
            (16, 0x0000FFFF0000FFFF),
            (8, 0x00FF00FF00FF00FF),
            (4, 0x0F0F0F0F0F0F0F0F),
            (2, 0x3333333333333333),
            (1, 0x5555555555555555),
        ):
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return value

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def clustered(tiles: DataFrame, partitions: int) -> DataFrame:
    """Tiles laid out so that neighbours share files: zoom, then z-order."""
    keyed = tiles.withColumn("cluster", cluster_key("z", "x", "y"))
    return keyed.repartitionByRange(partitions, "z", "cluster").sortWithinPartitions("z", "cluster")
