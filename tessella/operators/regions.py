"""Polygon regions as edge tables: covers, scene selection, clips.

A region is a set of edges (id, x1, y1, x2, y2). Work spreads by tile rows, so the
cost follows the length of the outline and no task holds a whole region.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import clamp, column_longitude, lat_to_row, lon_to_column, row_latitude
from tessella.operators.chunks import Grouped, Ragged, _emit, _runs, _same, _types
from tessella.operators.skew import unsized
from tessella.session import cut_lineage, pinned


def _index(value, z: int):
    return clamp(F.floor(value).cast("long"), F.lit(0).cast("long"), F.lit((1 << z) - 1).cast("long"))


def _edge_cells(edges: DataFrame, region: str, z: int) -> DataFrame:
    """Each edge in every cell it runs through (touching counts), row by row."""
    top, bottom = F.greatest("y1", "y2"), F.least("y1", "y2")
    ends = ["x1", "y1", "x2", "y2"]
    rows = edges.select(
        region,
        *ends,
        F.explode(F.sequence(_index(lat_to_row(top, z), z), _index(lat_to_row(bottom, z), z))).alias("y"),
    )
    banded = pinned(rows, north=row_latitude("y", z), south=row_latitude(F.col("y") + 1, z))
    # longitudes of the part of the edge inside the row
    at = lambda lat: F.col("x1") + (lat - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(
        F.col("y2") - F.col("y1"), F.lit(0.0)
    )
    high = F.least(F.greatest("y1", "y2"), F.col("north"))
    low = F.greatest(F.least("y1", "y2"), F.col("south"))
    flat = F.col("y1") == F.col("y2")
    a = F.when(flat, F.col("x1")).otherwise(at(high))
    b = F.when(flat, F.col("x2")).otherwise(at(low))
    spans = pinned(
        banded.select(region, *ends, "y", a.alias("a"), b.alias("b")),
        c0=_index(lon_to_column(F.least("a", "b"), z), z),
        c1=_index(lon_to_column(F.greatest("a", "b"), z), z),
    )
    return spans.select(region, *ends, F.explode(F.sequence("c0", "c1")).alias("x"), "y")


def boundary_tiles(edges: DataFrame, region: str, z: int) -> DataFrame:
    """Tiles an outline runs through."""
    return _edge_cells(edges, region, z).select(region, F.lit(z).alias("z"), "x", "y").distinct()


def inside_spans(edges: DataFrame, region: str, z: int) -> DataFrame:
    """Runs of cells of zoom ``z`` whose centre is inside, one row per run.

    Scanline at the centre latitude of each row: crossings sorted by longitude pair
    up to intervals (even-odd). Columns: region, y, x0, x1 (inclusive).
    """
    top, bottom = F.greatest("y1", "y2"), F.least("y1", "y2")
    rows = edges.filter(F.col("y1") != F.col("y2")).select(
        region,
        "x1",
        "y1",
        "x2",
        "y2",
        F.explode(F.sequence(_index(lat_to_row(top, z), z), _index(lat_to_row(bottom, z), z))).alias("y"),
    )
    lined = pinned(rows, lat=row_latitude(F.col("y") + 0.5, z))
    hit = (F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))
    cut = F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossings = lined.filter(hit).select(region, "y", cut.alias("lon"))
    order = Window.partitionBy(region, "y").orderBy("lon")
    paired = crossings.withColumn("n", F.row_number().over(order)).withColumn("east", F.lead("lon").over(order))
    runs = paired.filter((F.col("n") % 2 == 1) & F.col("east").isNotNull())
    # a centre (i + 0.5) is inside when west <= centre < east
    first = F.ceil(lon_to_column("lon", z) - 0.5).cast("long")
    last = (F.ceil(lon_to_column("east", z) - 0.5) - 1).cast("long")
    limit = F.lit((1 << z) - 1).cast("long")
    return runs.select(
        region, "y", F.greatest(first, F.lit(0).cast("long")).alias("x0"), F.least(last, limit).alias("x1")
    ).filter(F.col("x1") >= F.col("x0"))


def polygon_cover(edges: DataFrame, region: str, z: int) -> DataFrame:
    """Tiles that meet any region: outline tiles and the runs between them."""
    inner = inside_spans(edges, region, z).select(
        region, F.lit(z).alias("z"), F.explode(F.sequence("x0", "x1")).alias("x"), "y"
    )
    return unsized(boundary_tiles(edges, region, z).unionByName(inner).select("z", "x", "y").distinct())


def region_cover(edges: DataFrame, region: str, z: int) -> DataFrame:
    """Tiles per region, with ``partial`` where the outline runs through."""
    inner = inside_spans(edges, region, z).select(
        region, F.lit(z).alias("z"), F.explode(F.sequence("x0", "x1")).alias("x"), "y", F.lit(False).alias("partial")
    )
    edge = boundary_tiles(edges, region, z).withColumn("partial", F.lit(True))
    return unsized(edge.unionByName(inner).groupBy(region, "z", "x", "y").agg(F.bool_or("partial").alias("partial")))


def clip_pixels(pixels: DataFrame, edges: DataFrame, region: str, z: int, bits: int) -> DataFrame:
    """Pixels of zoom-``z`` tiles of 2^bits pixels whose centre is in a region.

    The pixel grid is the tile grid ``bits`` zooms deeper. Runs of inside pixels are
    cut at tile borders, so the join key is (tile, pixel row) and a tile that lies
    wholly inside costs one run per pixel row.
    """
    size = 1 << bits
    runs = inside_spans(edges, region, z + bits)
    shift = lambda c, n: F.shiftright(F.col(c), n)
    cut = runs.select(
        shift("y", bits).alias("y"),
        F.col("y").bitwiseAND(F.lit(size - 1).cast("long")).cast("int").alias("py"),
        "x0",
        "x1",
        F.explode(F.sequence(shift("x0", bits), shift("x1", bits))).alias("x"),
    )
    spans = cut.select(
        F.lit(z).alias("z"),
        "x",
        "y",
        "py",
        F.greatest(F.col("x0") - F.col("x") * size, F.lit(0).cast("long")).cast("int").alias("lo"),
        F.least(F.col("x1") - F.col("x") * size, F.lit(size - 1).cast("long")).cast("int").alias("hi"),
    ).distinct()
    on = [pixels[c] == spans[c] for c in ("z", "x", "y", "py")]
    on.append(pixels["px"].between(spans["lo"], spans["hi"]))
    return pixels.join(unsized(spans), on, "left_semi")


def region_masks(edges: DataFrame, region: str, z: int, bits: int) -> DataFrame:
    """Masks (z, x, y, whole, runs) of the tiles of 2^bits pixels that regions reach.

    A tile between outlines is ``whole``. An outline tile has the runs (py, lo, hi) of pixels
    whose centre is inside: the scanlines of its own tile row, cut to the tile.
    """
    size = 1 << bits
    outline = boundary_tiles(edges, region, z)
    lines = inside_spans(edges, region, z + bits).select(
        region, F.shiftright("y", bits).alias("y"), F.col("y").bitwiseAND(F.lit(size - 1).cast("long")).cast("int").alias("py"), "x0", "x1"
    )
    west = F.col("x") * size
    cut = unsized(outline).join(lines, [region, "y"]).filter((F.col("x1") >= west) & (F.col("x0") < west + size))
    lo = F.greatest(F.col("x0") - west, F.lit(0).cast("long")).cast("int")
    hi = F.least(F.col("x1") - west, F.lit(size - 1).cast("long")).cast("int")
    partial = cut.groupBy("z", "x", "y").agg(F.collect_set(F.struct("py", lo.alias("lo"), hi.alias("hi"))).alias("runs"))
    inner = inside_spans(edges, region, z).select(region, F.explode(F.sequence("x0", "x1")).alias("x"), "y")
    inner = unsized(inner).join(outline, [region, "x", "y"], "left_anti").select(F.lit(z).alias("z"), "x", "y", F.lit(True).alias("whole"))
    both = partial.withColumn("whole", F.lit(False)).unionByName(inner, allowMissingColumns=True)
    return both.groupBy("z", "x", "y").agg(F.bool_or("whole").alias("whole"), F.first("runs", True).alias("runs"))


def clip_chunks(chunks: DataFrame, keys: list[str], edges: DataFrame, region: str, z: int, bits: int, nodata: int = 0) -> DataFrame:
    """Chunks of zoom ``z`` and 2^bits pixels that regions reach, nodata outside of them.

    ``keys`` name z, x and y among others. Whole tiles pass as they are.
    """
    size, names = 1 << bits, list(keys)

    def cut(batches):
        for batch in batches:
            data, group = Ragged(batch.column("data")), Grouped(batch.column("runs"))
            whole = batch.column("whole").to_numpy(zero_copy_only=False)
            edge = np.zeros((batch.num_rows, size, size + 1), np.int32)
            np.add.at(edge, (group.owner, group.ints("py"), group.ints("lo")), 1)
            np.add.at(edge, (group.owner, group.ints("py"), group.ints("hi") + 1), -1)
            inside = (edge.cumsum(axis=2)[:, :, :size] > 0) | whole[:, None, None]
            for (length,), index in _same(data.sizes):
                for part in _runs(index, int(length)):
                    images = data.rows(part).reshape(len(part), -1, size, size)
                    yield _emit(batch, names, part, size, size, np.where(inside[part][:, None], images, nodata))

    here = chunks.filter((F.col("z") == z) & (F.col("w") == size) & (F.col("h") == size))
    masked = here.join(unsized(region_masks(edges, region, z, bits)), ["z", "x", "y"])
    runs = F.coalesce("runs", F.array().cast("array<struct<py:int,lo:int,hi:int>>")).alias("runs")
    return masked.select(*names, "whole", runs, "data").mapInArrow(cut, _types(chunks, names) + "w int, h int, data array<int>")


def boxes_in_regions(boxes: DataFrame, edges: DataFrame, region: str, key: str, z: int = 7) -> DataFrame:
    """Boxes (minx, miny, maxx, maxy) that meet a region: pairs of key and region.

    Everything meets in cells of zoom ``z``, never a box with a whole outline. A box
    an edge touches is in. Otherwise it is inside or outside as its centre is: the
    centre has the side of its cell's centre, flipped once for every edge of the
    cell between the two. Malformed boxes are dropped.
    """
    from tessella.plans.planning import box_tiles

    good = boxes.filter((F.col("maxx") >= F.col("minx")) & (F.col("maxy") >= F.col("miny")))
    good = good.select(key, "minx", "miny", "maxx", "maxy")
    edge_cells = _edge_cells(edges, region, z)
    touched = (
        box_tiles(good, z)
        .join(unsized(edge_cells), ["x", "y"])
        .filter(edge_meets_box("minx", "miny", "maxx", "maxy"))
        .select(key, region)
        .distinct()
    )
    px, py = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    centred = pinned(good.select(key, px.alias("px"), py.alias("py")),
                     x=_index(lon_to_column("px", z), z), y=_index(lat_to_row("py", z), z))
    inner = inside_spans(edges, region, z).select(region, F.explode(F.sequence("x0", "x1")).alias("x"), "y")
    facts = inner.withColumns({n: F.lit(None).cast("double") for n in ("x1", "y1", "x2", "y2")}).unionByName(edge_cells)
    met = pinned(centred.join(unsized(facts), ["x", "y"]),
                 qx=column_longitude(F.col("x") + 0.5, z), qy=row_latitude(F.col("y") + 0.5, z))
    between = _between(*[F.col(n) for n in ("x1", "y1", "x2", "y2")])
    flips = F.count_if(F.col("x1").isNull() | between)
    inside = met.groupBy(key, region).agg((flips % 2 == 1).alias("inside")).filter("inside").select(key, region)
    return touched.unionByName(inside).distinct()


def boxes_in_any_region(boxes: DataFrame, edges: DataFrame, region: str, key: str, z: int = 7) -> DataFrame:
    """Keys of the boxes (minx, miny, maxx, maxy) that meet some region, each once.

    The result of ``boxes_in_regions`` without its pairs, whose number is that of boxes times
    regions. A box over a cell that lies wholly inside a region is in, which settles most
    boxes where regions are dense. The others look for one edge that touches them, then for
    one region around their centre, by semi joins that stop at the first hit. A region's
    edges inside one cell travel together.
    """
    from tessella.plans.planning import box_tiles

    good = boxes.filter((F.col("maxx") >= F.col("minx")) & (F.col("maxy") >= F.col("miny")))
    good = good.select(key, "minx", "miny", "maxx", "maxy")
    edge_cells = _edge_cells(edges, region, z)
    outline = unsized(edge_cells.select(region, "x", "y").distinct())
    inner = inside_spans(edges, region, z).select(region, F.explode(F.sequence("x0", "x1")).alias("x"), "y")
    whole = unsized(inner).join(outline, [region, "x", "y"], "left_anti").select("x", "y").distinct()
    # at most all cells of the zoom
    certain = cut_lineage(box_tiles(good, z).join(F.broadcast(whole), ["x", "y"], "left_semi").select(key).distinct())
    rest = cut_lineage(good.join(unsized(certain), key, "left_anti"))
    ends = ["x1", "y1", "x2", "y2"]
    facing = edge_cells.select(*ends, F.col("x").alias("_x"), F.col("y").alias("_y")).distinct()
    here = (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y"))
    touched = box_tiles(rest, z).join(unsized(facing), here & edge_meets_box("minx", "miny", "maxx", "maxy"), "left_semi")
    touched = cut_lineage(touched.select(key).distinct())
    px, py = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    centred = pinned(rest.join(unsized(touched), key, "left_anti").select(key, px.alias("px"), py.alias("py")),
                     x=_index(lon_to_column("px", z), z), y=_index(lat_to_row("py", z), z))
    centred = pinned(centred, qx=column_longitude(F.col("x") + 0.5, z), qy=row_latitude(F.col("y") + 0.5, z))
    # whole cells are settled: a region around a centre that is left has edges in the cell
    parts = edge_cells.groupBy(region, "x", "y").agg(F.collect_list(F.struct(*ends)).alias("edges"))
    sides = unsized(parts).join(unsized(inner.withColumn("inside", F.lit(1))), [region, "x", "y"], "left")
    sides = sides.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.coalesce("inside", F.lit(0)).alias("inside"), "edges")
    flips = F.col("inside") + F.size(F.filter("edges", lambda e: _between(*[e[n] for n in ends])))
    inside = unsized(centred).join(unsized(sides), here & (flips % 2 == 1), "left_semi").select(key)
    return certain.unionByName(touched).unionByName(inside).distinct()


def _between(x1, y1, x2, y2):
    """An edge crosses the way from the centre of a box (px, py) to that of its cell (qx, qy)."""
    c = F.col
    side = lambda ax, ay, bx, by, cx, cy: (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    apart = (side(x1, y1, x2, y2, c("px"), c("py")) > 0) != (side(x1, y1, x2, y2, c("qx"), c("qy")) > 0)
    return apart & ((side(c("px"), c("py"), c("qx"), c("qy"), x1, y1) > 0) != (side(c("px"), c("py"), c("qx"), c("qy"), x2, y2) > 0))


def edge_meets_box(minx, miny, maxx, maxy):
    """Segment (x1, y1)-(x2, y2) touches the box: overlapping extents, corners not on one side."""
    c = F.col
    side = lambda x, y: (c("x2") - c("x1")) * (c(y) - c("y1")) - (c("y2") - c("y1")) * (c(x) - c("x1"))
    corners = [side(x, y) for x in (minx, maxx) for y in (miny, maxy)]
    extent = (
        (F.greatest("x1", "x2") >= c(minx))
        & (F.least("x1", "x2") <= c(maxx))
        & (F.greatest("y1", "y2") >= c(miny))
        & (F.least("y1", "y2") <= c(maxy))
    )
    return extent & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def land_in_region(land: DataFrame, region: DataFrame) -> DataFrame:
    """Land tiles inside a region; all land tiles when nothing is left.

    The fallback is a left join on the number of kept rows, not a driver branch.
    """
    keys = ["z", "x", "y"]
    marked = land.join(region.select(*keys).distinct().withColumn("_in", F.lit(True)), keys, "left")
    kept = marked.agg(F.bool_or(F.coalesce("_in", F.lit(False))).alias("_any"))
    # one row: whether the intersection holds anything
    joined = marked.withColumn("_one", F.lit(1)).join(F.broadcast(kept.withColumn("_one", F.lit(1))), "_one")
    return joined.filter(F.col("_in").isNotNull() | ~F.col("_any")).select(*land.columns)


def grow_cover(edges: DataFrame, region: str, z: int, km: float) -> DataFrame:
    """Cover of regions grown by kilometres (degrees of latitude), at tile level.

    A tile joins when its box is within the distance of the outline or inside.
    """
    degrees = km / C.KM_PER_DEGREE
    if degrees <= 0:
        return polygon_cover(edges, region, z)
    near = edges.select(
        region,
        "x1", "y1", "x2", "y2",
        F.explode(
            F.sequence(
                _index(lat_to_row(F.greatest("y1", "y2") + degrees, z), z),
                _index(lat_to_row(F.least("y1", "y2") - degrees, z), z),
            )
        ).alias("y"),
    )
    banded = pinned(near, north=row_latitude("y", z) + degrees, south=row_latitude(F.col("y") + 1, z) - degrees)
    slope = (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    high = F.least(F.greatest("y1", "y2"), F.col("north"))
    low = F.greatest(F.least("y1", "y2"), F.col("south"))
    flat = F.col("y1") == F.col("y2")
    a = F.when(flat, F.col("x1")).otherwise(F.col("x1") + (high - F.col("y1")) * slope)
    b = F.when(flat, F.col("x2")).otherwise(F.col("x1") + (low - F.col("y1")) * slope)
    spans = pinned(
        banded.select("y", "x1", "y1", "x2", "y2", a.alias("a"), b.alias("b")),
        c0=_index(lon_to_column(F.least("a", "b") - degrees, z), z),
        c1=_index(lon_to_column(F.greatest("a", "b") + degrees, z), z),
    )
    tiles = spans.withColumn("x", F.explode(F.sequence("c0", "c1")))
    tiles = pinned(
        tiles,
        w=column_longitude("x", z), e=column_longitude(F.col("x") + 1, z),
        s=row_latitude(F.col("y") + 1, z), n=row_latitude("y", z),
    )
    close = tiles.filter(_distance("w", "s", "e", "n") <= degrees).select(F.lit(z).alias("z"), "x", "y")
    return unsized(close.unionByName(polygon_cover(edges, region, z)).distinct())


def _distance(w, s, e, n):
    """Distance in degrees between a segment and a box that need not touch."""
    c = F.col
    dx, dy = c("x2") - c("x1"), c("y2") - c("y1")
    norm = F.greatest(dx * dx + dy * dy, F.lit(1e-18))

    def corner(x, y):
        t = F.least(F.greatest(((c(x) - c("x1")) * dx + (c(y) - c("y1")) * dy) / norm, F.lit(0.0)), F.lit(1.0))
        return F.hypot(c(x) - c("x1") - t * dx, c(y) - c("y1") - t * dy)

    def end(x, y):
        out = lambda v, lo, hi: F.greatest(c(lo) - c(v), c(v) - c(hi), F.lit(0.0))
        return F.hypot(out(x, w, e), out(y, s, n))

    apart = F.least(corner(w, s), corner(e, s), corner(w, n), corner(e, n), end("x1", "y1"), end("x2", "y2"))
    return F.when(edge_meets_box(w, s, e, n), 0.0).otherwise(apart)
