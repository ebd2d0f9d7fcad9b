"""Raster operators; chunk forms are compared pixel by pixel."""

from pyspark.sql import functions as F

from tessella.functions.grid import Box
from tessella.operators import chunks as CH
from tessella.operators import pixels as PX
from tessella.operators import stacks as ST
from tessella.operators import planes as PL
from tessella.operators.regions import clip_chunks, land_in_region, polygon_cover
from tessella.plans.planning import land_tiles
from tessella.queries import query
from tessella.session import cut_lineage
from tessella.queries.filters import BOUNDS, INSIDE, LAND, POINT_TILES, point_tiles, region_tiles

TILE = ["z", "x", "y"]


def rgba_chunks(pixels, keys, size):
    return CH.assemble_chunks(pixels, keys, size, size, ["r", "g", "b", "a"])


def visible_pixels(chunks, keys):
    """RGBA chunks to one row per pixel that shows anything."""
    area = F.col("w") * F.col("h")
    plane = lambda i: F.slice("data", F.lit(i) * area + 1, area).alias("rgba"[i])
    zipped = chunks.select(*keys, "w", *[plane(i) for i in range(4)])
    rows = zipped.select(*keys, "w", F.posexplode(F.arrays_zip("r", "g", "b", "a")).alias("pos", "c"))
    return rows.filter(F.col("c.a") > 0).select(
        *keys,
        (F.col("pos") % F.col("w")).cast("int").alias("px"),
        F.floor(F.col("pos") / F.col("w")).cast("int").alias("py"),
        "c.*",
    )


def plane_columns(chunks, keys, names):
    """Chunks of several planes to one row per pixel, a column per plane."""
    area = F.col("w") * F.col("h")
    planes = [F.slice("data", F.lit(i) * area + 1, area).alias(n) for i, n in enumerate(names)]
    rows = chunks.select(*keys, "w", *planes).select(*keys, "w", F.posexplode(F.arrays_zip(*names)).alias("pos", "c"))
    px, py = (F.col("pos") % F.col("w")).cast("int"), F.floor(F.col("pos") / F.col("w")).cast("int")
    return rows.select(*keys, px.alias("px"), py.alias("py"), "c.*")


def stack_chunks(v):
    return CH.assemble_chunks(v.fx_stack, ["scene", "band", *TILE], 16, 16)


def marked_chunks(v, keys):
    """The stack's chunks with a second plane: 1 where the stack has a pixel, nodata included."""
    return CH.assemble_chunks(v.fx_stack.withColumn("there", F.lit(1)), keys, 16, 16, ["dn", "there"])


def qa_chunks(v):
    return CH.assemble_chunks(v.fx_qa.withColumnRenamed("qa", "dn"), ["scene", *TILE], 16, 16)


def clear_rows(chunks, keys):
    rows = CH.explode_chunks(chunks, keys)
    return rows.filter(F.col("dn") != 0).select(*keys, "px", "py", "dn")


@query("ras_explode", "SELECT scene, x, y, band, px, py, dn FROM {fx_stack} WHERE dn <> 0")
def _(v):
    return clear_rows(stack_chunks(v), ["scene", "x", "y", "band"])


@query("ras_assemble", """
    SELECT scene, x, y, band, 256 AS n, CAST(sum(dn) AS BIGINT) AS total, CAST(sum(dn * (py * 16 + px + 1)) AS BIGINT) AS placed FROM {fx_stack} GROUP BY scene, x, y, band""")
def _(v):
    total = F.aggregate("data", F.lit(0).cast("bigint"), lambda a, d: a + d)
    at = F.transform("data", lambda d, i: (d * (i + 1)).cast("bigint"))
    placed = F.aggregate(at, F.lit(0).cast("bigint"), lambda a, d: a + d)
    return stack_chunks(v).select(
        "scene", "x", "y", "band", F.size("data").alias("n"), total.alias("total"), placed.alias("placed")
    )


MASKED = """(SELECT s.scene, s.z, s.x, s.y, s.band, s.px, s.py, cloud, CASE WHEN qa & 15 <> 0 THEN 0 ELSE dn END AS dn
    FROM {fx_stack} AS s LEFT JOIN {fx_qa} AS q USING (scene, z, x, y, px, py))"""


@query("ras_qa_mask", f"SELECT scene, x, y, band, px, py, dn FROM {MASKED} AS m WHERE dn <> 0")
def _(v):
    masked = CH.mask_chunks(stack_chunks(v), qa_chunks(v), ["scene", *TILE], 15)
    return clear_rows(masked, ["scene", "x", "y", "band"])


GROWN = """(SELECT DISTINCT scene, z, gx // 16 AS x, gy // 16 AS y, CAST(gx % 16 AS INT) AS px, CAST(gy % 16 AS INT) AS py FROM (
    SELECT scene, z, x * 16 + px + dx AS gx, y * 16 + py + dy AS gy FROM {fx_qa}, (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) AS d(dx, dy) WHERE qa & 15 <> 0) AS m
    WHERE gx >= 0 AND gy >= 0)"""


@query("ras_dilate", f"SELECT g.scene, g.x, g.y, g.px, g.py FROM {GROWN} AS g SEMI JOIN {{fx_qa}} AS k USING (scene, x, y)")
def _(v):
    grown = CH.dilate_mask(qa_chunks(v), ["scene"], 15, 1)
    return clear_rows(grown, ["scene", "x", "y"]).drop("dn")


MEDIANS = f"""(SELECT z, x, y, band, px, py, CAST(round_even(median(CASE WHEN dn <> 0 THEN dn END), 0) AS INT) AS dn FROM {MASKED} AS m GROUP BY z, x, y, band, px, py)"""
RGB = """(SELECT x, y, px, py, coalesce(max(CASE WHEN band = 2 THEN dn END), 0) AS r, coalesce(max(CASE WHEN band = 1 THEN dn END), 0) AS g, coalesce(max(CASE WHEN band = 0 THEN dn END), 0) AS b
    FROM {m} AS m SEMI JOIN (SELECT x, y FROM {{fx_stack}} GROUP BY x, y HAVING count(DISTINCT band) = 3) AS k USING (x, y) GROUP BY x, y, px, py)"""


@query("ras_median_rgb", f"SELECT x, y, px, py, r, g, b FROM {RGB.replace('{m}', MEDIANS).replace('{{', '{').replace('}}', '}')} AS t WHERE r + g + b > 0")
def _(v):
    masked = CH.mask_chunks(stack_chunks(v), qa_chunks(v), ["scene", *TILE], 15)
    medians = ST.median_chunks(masked, [*TILE, "band"])
    picks = [F.max(F.when(F.col("band") == b, F.col("data"))).alias(n) for n, b in zip("rgb", (2, 1, 0))]
    rgb = medians.groupBy("x", "y", "w").agg(*picks).dropna()
    rows = rgb.select("x", "y", "w", F.posexplode(F.arrays_zip("r", "g", "b")).alias("pos", "c"))
    at = rows.select(
        "x", "y", (F.col("pos") % F.col("w")).cast("int").alias("px"), F.floor(F.col("pos") / F.col("w")).cast("int").alias("py"), "c.*"
    )
    return at.filter(F.col("r") + F.col("g") + F.col("b") > 0)


@query("ras_priority_mosaic", f"""
    SELECT x, y, band, px, py, dn FROM (SELECT *, row_number() OVER (PARTITION BY x, y, band, px, py ORDER BY coalesce(cloud, 1e9), scene DESC) AS r FROM {MASKED} AS m WHERE dn <> 0) AS t WHERE r = 1""")
def _(v):
    clouds = v.fx_stack.select("scene", "cloud").distinct()
    masked = CH.mask_chunks(stack_chunks(v), qa_chunks(v), ["scene", *TILE], 15).join(clouds, "scene")
    return clear_rows(ST.priority_chunks(masked, [*TILE, "band"]), ["x", "y", "band"])


@query("ras_paint_mosaic", """
    SELECT x, y, band, px, py, dn FROM (SELECT *, row_number() OVER (PARTITION BY x, y, band, px, py ORDER BY coalesce(cloud, 1e9) DESC, scene DESC) AS r FROM {fx_stack}) AS t WHERE r = 1""")
def _(v):
    return PX.last_painted(v.fx_stack, ["x", "y", "band", "px", "py"], PX.paint_order(v.fx_stack))


@query("ras_panel_mosaic", """
    SELECT band, scene, x * 16 + px AS px, y * 16 + py AS py, dn FROM {fx_stack}""")
def _(v):
    panels = marked_chunks(v, ["scene", "band", *TILE]).withColumnsRenamed({"x": "col", "y": "row"})
    canvas = CH.panels_to_chunks(panels, ["band", "scene"])
    canvas = plane_columns(canvas, ["band", "scene", "x", "y"], ["dn", "there"]).filter("there = 1")
    return canvas.select("band", "scene", (F.col("x") * 16 + F.col("px")).alias("px"), (F.col("y") * 16 + F.col("py")).alias("py"), "dn")


@query("ras_band_stack", """
    SELECT scene, x, y, px, py, max(CASE WHEN band = 2 THEN dn END) AS r, max(CASE WHEN band = 1 THEN dn END) AS g, max(CASE WHEN band = 0 THEN dn END) AS b
    FROM {fx_stack} GROUP BY scene, x, y, px, py HAVING count(DISTINCT band) = 3""")
def _(v):
    keys = ["scene", *TILE]
    stacked = PL.band_stack_chunks(stack_chunks(v), keys, (2, 1, 0))
    # pixels that all three bands hold: chunks have no absent pixels
    whole = v.fx_stack.groupBy("scene", "x", "y", "px", "py").agg(F.countDistinct("band").alias("n")).filter("n = 3")
    return plane_columns(stacked, ["scene", "x", "y"], "rgb").join(whole.drop("n"), ["scene", "x", "y", "px", "py"], "left_semi")


@query("ras_stretch", """
    SELECT scene, x, y, band, px, py, CAST(round_even(255 * pow(least(1.0, dn / 3000.0), 0.8), 0) AS INT) AS hls,
           CAST(round_even(255 * least(1.0, dn / 4000.0), 0) AS INT) AS modis FROM {fx_stack}""")
def _(v):
    from tessella.constants import STRETCHES

    return v.fx_stack.select(
        "scene", "x", "y", "band", "px", "py",
        PX.stretched("dn", *STRETCHES["hls"]).alias("hls"),
        PX.stretched("dn", *STRETCHES["modis"]).alias("modis"),
    )


LON = "(x + (px + 0.5) / 16) / power(2, z) * 360.0 - 180.0"
PLAT = "degrees(atan(sinh(pi() * (1.0 - 2.0 * (y + (py + 0.5) / 16) / power(2, z)))))"


@query("ras_crop_bbox", f"SELECT scene, x, y, band, px, py, dn FROM {{fx_stack}} WHERE dn <> 0 AND {LON} BETWEEN -179.93 AND -179.51 AND {PLAT} BETWEEN 85.0441 AND 85.0503")
def _(v):
    keys = ["scene", "band", *TILE]
    cropped = PL.crop_box_chunks(stack_chunks(v), keys, Box(-179.93, 85.0441, -179.51, 85.0503), 14)
    return clear_rows(cropped, ["scene", "x", "y", "band"])


@query("ras_crop_polygon", f"""
    SELECT x, y, px, py, count(*) AS n FROM {{fx_obs}} SEMI JOIN (
      SELECT DISTINCT x, y, px, py FROM (SELECT x, y, px, py, region_id, count(*) FILTER (WHERE {INSIDE}) AS n_right FROM (
        SELECT DISTINCT x, y, px, py, {LON} AS cx, {PLAT} AS cy FROM {{fx_obs}}) AS c, {{fx_edges}} AS g GROUP BY x, y, px, py, region_id) AS r WHERE n_right % 2 = 1) AS k USING (x, y, px, py)
    GROUP BY x, y, px, py""")
def _(v):
    counts = v.fx_obs.groupBy(*TILE, "px", "py").agg(F.count("*").alias("dn"))
    clipped = clip_chunks(CH.assemble_chunks(counts, TILE, 16, 16), TILE, v.fx_edges, "region_id", 3, 4)
    return clear_rows(clipped, ["x", "y"]).withColumn("n", F.col("dn").cast("bigint")).drop("dn")


@query("ras_clip_region", f"""
    WITH covered AS ({region_tiles(POINT_TILES + " AS p")}), land AS (SELECT z, x, y FROM (SELECT z, x, y, {BOUNDS} FROM {POINT_TILES} AS q) AS t WHERE {LAND})
    SELECT 'cut' AS part, z, x, y FROM land SEMI JOIN covered USING (z, x, y) UNION ALL SELECT 'all' AS part, z, x, y FROM land""")
def _(v):
    land = land_tiles(point_tiles(v))
    cover = polygon_cover(v.fx_edges, "region_id", 7)
    cut = land_in_region(land, cover).select(F.lit("cut").alias("part"), *TILE)
    # a region beside all land leaves the land as it is
    away = land_in_region(land, cover.withColumn("x", F.col("x") - 1000)).select(F.lit("all").alias("part"), *TILE)
    return cut.unionByName(away)


@query("ras_nodata_alpha", """
    SELECT ord, x, y, px, py, CASE WHEN r = 0 AND g = 0 AND b = 0 THEN 0 ELSE 255 END AS alpha FROM (SELECT ord, x, y, px, py, r % 3 AS r, g % 3 AS g, b % 3 AS b FROM {fx_rgba}) AS t""")
def _(v):
    at = ["ord", "x", "y", "px", "py"]
    low = v.fx_rgba.select("z", *at, *[(F.col(n) % 3).alias(n) for n in "rgb"])
    chunks = CH.assemble_chunks(low, ["ord", *TILE], 8, 8, ["r", "g", "b"])
    done = plane_columns(PL.nodata_alpha_chunks(chunks, ["ord", *TILE]), ["ord", "x", "y"], ["r", "g", "b", "alpha"])
    return done.select(*at, "alpha").join(low, at, "left_semi")


RAMP = ((-2000, 8, 24, 58), (-500, 20, 70, 140), (0, 120, 180, 220), (800, 90, 140, 60), (2000, 240, 240, 235))


def _ramp_sql(i):
    steps = " ".join(
        f"WHEN elev <= {b[0]} THEN {a[i]} + (elev - {a[0]}) / {b[0] - a[0]}.0 * {b[i] - a[i]}" for a, b in zip(RAMP, RAMP[1:])
    )
    return f"CAST(floor(CASE WHEN elev <= {RAMP[0][0]} THEN {RAMP[0][i]} {steps} ELSE {RAMP[-1][i]} END + 0.5) AS INT)"


@query("ras_color_relief", f"SELECT x, y, px, py, {_ramp_sql(1)} AS r, {_ramp_sql(2)} AS g, {_ramp_sql(3)} AS b, 255 AS a FROM {{fx_elev}}")
def _(v):
    elev = CH.assemble_chunks(v.fx_elev.withColumnRenamed("elev", "dn"), TILE, 16, 16)
    done = plane_columns(PL.color_relief_chunks(elev, TILE, RAMP), ["x", "y"], "rgba")
    return done.join(v.fx_elev, ["x", "y", "px", "py"], "left_semi")


# every tile of the zoom holds data, so the raster is one 128 by 128 grid whose outer
# border is repeated; a neighbour's weight is 2 on the axis and 1 on the diagonal
@query("ras_hillshade", """
    WITH grid AS (SELECT a.i AS gx, b.i AS gy, coalesce(elev, 0) AS v FROM range(128) AS a(i) CROSS JOIN range(128) AS b(i) LEFT JOIN {fx_elev} AS e ON e.x * 16 + e.px = a.i AND e.y * 16 + e.py = b.i),
    slopes AS (SELECT c.gx, c.gy, sum(n.v * ox * (2 - abs(oy))) / (8.0E0 * 250.0E0) AS dx, sum(n.v * oy * (2 - abs(ox))) / (8.0E0 * 250.0E0) AS dy
      FROM grid AS c CROSS JOIN (VALUES (-1, -1), (0, -1), (1, -1), (-1, 0), (1, 0), (-1, 1), (0, 1), (1, 1)) AS d(ox, oy)
      JOIN grid AS n ON n.gx = greatest(0, least(127, c.gx + ox)) AND n.gy = greatest(0, least(127, c.gy + oy)) GROUP BY c.gx, c.gy)
    SELECT 3 AS z, gx // 16 AS x, gy // 16 AS y, CAST(gx % 16 AS INT) AS px, CAST(gy % 16 AS INT) AS py,
           CAST(greatest(1, least(255, floor(1 + 254 * greatest(0.0, cos(radians(45.0)) * cos(s) + sin(radians(45.0)) * sin(s) * cos(radians(135.0) - a)) + 0.5))) AS INT) AS shade
    FROM (SELECT *, atan(sqrt(dx * dx + dy * dy)) AS s, atan2(dy, -dx) AS a FROM slopes) AS t""")
def _(v):
    elev = CH.assemble_chunks(v.fx_elev.withColumnRenamed("elev", "dn"), TILE, 16, 16)
    shaded = CH.hillshade_chunks(elev, [], 250.0, 250.0)
    return CH.explode_chunks(shaded, TILE, "shade").drop("plane")


@query("ras_blend", """
    SELECT b.x, b.y, b.px, b.py, round(b.r * 0.65E0 + t.r * 0.35E0, 9) AS r FROM (SELECT * FROM {fx_rgba} WHERE ord = 0) AS b JOIN (SELECT * FROM {fx_rgba} WHERE ord = 1) AS t USING (x, y, px, py)""")
def _(v):
    at = ["x", "y", "px", "py"]
    layer = lambda i: v.fx_rgba.filter(F.col("ord") == i)
    chunk = lambda i: CH.assemble_chunks(layer(i).select(*TILE, "px", "py", F.col("r").alias("dn")), TILE, 8, 8)
    done = CH.explode_chunks(PL.blend_chunks(chunk(0), chunk(1), TILE, 0.35), ["x", "y"], "r")
    both = layer(0).join(layer(1), at, "left_semi")
    return done.select(*at, F.round("r", 9).alias("r")).join(both, at, "left_semi")


@query("ras_over", """
    SELECT x, y, px, py, CASE WHEN ta = 0 THEN br ELSE CAST(floor((tr * ta * 255 + br * 255 * (255 - ta)) / (255.0E0 * 255) + 0.5) AS INT) END AS r,
           CASE WHEN ta = 0 THEN bg ELSE CAST(floor((tg * ta * 255 + bg * 255 * (255 - ta)) / (255.0E0 * 255) + 0.5) AS INT) END AS g,
           CASE WHEN ta = 0 THEN bb ELSE CAST(floor((tb * ta * 255 + bb * 255 * (255 - ta)) / (255.0E0 * 255) + 0.5) AS INT) END AS b, 255 AS a
    FROM (SELECT x, y, px, py, b.r AS br, b.g AS bg, b.b AS bb, t.r AS tr, t.g AS tg, t.b AS tb, (t.r + t.g) % 256 AS ta
          FROM (SELECT * FROM {fx_rgba} WHERE ord = 0) AS b JOIN (SELECT * FROM {fx_rgba} WHERE ord = 1) AS t USING (x, y, px, py)) AS j""")
def _(v):
    at = ["x", "y", "px", "py"]
    base = v.fx_rgba.filter(F.col("ord") == 0).select(*at, "r", "g", "b", F.lit(255).alias("a"))
    top = v.fx_rgba.filter(F.col("ord") == 1).select(*at, "r", "g", "b", ((F.col("r") + F.col("g")) % 256).alias("a"))
    both = base.select(*at).join(top.select(*at), at, "left_semi")
    return PX.composite_pixels(base, top, at).join(both, at, "left_semi")


@query("ras_resize", """
    SELECT 'half' AS kind, scene, x, y, band, px // 2 AS px, py // 2 AS py, dn FROM {fx_stack} WHERE px % 2 = 0 AND py % 2 = 0 AND dn <> 0
    UNION ALL SELECT 'double' AS kind, scene, x, y, band, px * 2 + dx AS px, py * 2 + dy AS py, dn FROM {fx_stack}, (VALUES (0), (1)) AS a(dx), (VALUES (0), (1)) AS b(dy) WHERE dn <> 0""")
def _(v):
    chunks, keys = stack_chunks(v), ["scene", "x", "y", "band"]
    part = lambda kind, n: clear_rows(CH.resize_chunks(chunks, n, n), keys).select(F.lit(kind).alias("kind"), *keys, "px", "py", "dn")
    return part("half", 8).unionByName(part("double", 32))


def overzoom_sql(requests):
    """Each request pixel from the nearest ancestor of both sources, the upper one on top."""
    return f"""
    SELECT z, x, y, px, py, CASE WHEN t.a = 255 THEN t.r ELSE o.r END AS r, CASE WHEN t.a = 255 THEN t.g ELSE o.g END AS g, CASE WHEN t.a = 255 THEN t.b ELSE o.b END AS b
    FROM (SELECT q.*, l.r, l.g, l.b, l.a FROM qpix AS q JOIN {{fx_layers}} AS l ON l.src = 0 AND q.src = 0 AND l.z = q.az AND l.x = q.x >> (q.z - q.az) AND l.y = q.y >> (q.z - q.az)
            AND l.px = (q.x * 8 + q.px) // (1 << (q.z - q.az)) % 8 AND l.py = (q.y * 8 + q.py) // (1 << (q.z - q.az)) % 8 WHERE a = 255) AS o
    FULL JOIN (SELECT q.*, l.r, l.g, l.b, l.a FROM qpix AS q JOIN {{fx_layers}} AS l ON l.src = 1 AND q.src = 1 AND l.z = q.az AND l.x = q.x >> (q.z - q.az) AND l.y = q.y >> (q.z - q.az)
            AND l.px = (q.x * 8 + q.px) // (1 << (q.z - q.az)) % 8 AND l.py = (q.y * 8 + q.py) // (1 << (q.z - q.az)) % 8 WHERE a = 255) AS t USING (z, x, y, px, py)"""


def overzoom_ctes(requests):
    return f"""req AS ({requests}),
    near AS (SELECT r.z, r.x, r.y, k.src, max(k.z) AS az FROM req AS r JOIN (SELECT DISTINCT src, z, x, y FROM {{fx_layers}}) AS k
             ON k.z <= r.z AND k.x = r.x >> (r.z - k.z) AND k.y = r.y >> (r.z - k.z) GROUP BY r.z, r.x, r.y, k.src),
    qpix AS (SELECT n.*, CAST(a.i AS INT) AS px, CAST(b.i AS INT) AS py FROM near AS n, range(8) AS a(i), range(8) AS b(i))"""


REQUESTS = f"""SELECT 6 AS z, x >> 1 AS x, y >> 1 AS y FROM {POINT_TILES} AS p GROUP BY 1, 2, 3 UNION ALL SELECT 9 AS z, x * 4 + 1 AS x, y * 4 + 2 AS y FROM {POINT_TILES} AS p"""


def layer_chunks(v):
    """The stack's tiles as a stored table, since the operators read it several times."""
    return cut_lineage(rgba_chunks(v.fx_layers, ["src", *TILE], 8))


@query("ras_overzoom_stack", f"WITH {overzoom_ctes(REQUESTS)} {overzoom_sql(REQUESTS)}")
def _(v):
    tiles = point_tiles(v)
    six = tiles.select(F.lit(6).alias("z"), F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y")).distinct()
    nine = tiles.select(F.lit(9).alias("z"), (F.col("x") * 4 + 1).alias("x"), (F.col("y") * 4 + 2).alias("y"))
    done = CH.overzoom_stack(six.unionByName(nine), layer_chunks(v), [0, 1], 8)
    return visible_pixels(done, TILE).drop("a")


@query("ras_stitch", """
    SELECT ord, z - 1 AS z, x >> 1 AS x, y >> 1 AS y, CAST(px + (x % 2) * 8 AS INT) AS px, CAST(py + (y % 2) * 8 AS INT) AS py, r, g, b FROM {fx_rgba} WHERE a > 0""")
def _(v):
    parents = CH.stitch(rgba_chunks(v.fx_rgba, ["ord", *TILE], 8), ["ord"])
    return visible_pixels(parents, ["ord", *TILE]).drop("a")


CELLS = """SELECT CAST(o_custkey % 360 - 180 AS DOUBLE) AS lon, CAST(o_orderkey % 168 - 83 AS DOUBLE) AS lat, CAST(max(o_orderkey % 3999) AS INT) + 1 AS dn FROM {orders} GROUP BY 1, 2"""


@query("ras_tile_pyramid", f"""
    SELECT 5 AS z, gx // 16 AS x, gy // 16 AS y, CAST(gx % 16 AS INT) AS px, CAST(gy % 16 AS INT) AS py, dn FROM (
      SELECT a.i AS gx, b.i AS gy, floor((a.i + 0.5) / 512 * 360.0 - 180.0) AS lon, ceil(degrees(atan(sinh(pi() * (1.0 - 2.0 * (b.i + 0.5) / 512))))) AS lat
      FROM range(512) AS a(i), range(512) AS b(i)) AS g JOIN ({CELLS}) AS c USING (lon, lat)""")
def _(v):
    return PX.raster_to_tiles(v.sql(CELLS), [], 1.0, 5, 16)


def _half(value, extra=""):
    return f"""SELECT scene, band, 13 AS z, x >> 1 AS x, y >> 1 AS y, CAST((x % 2 * 16 + px) // 2 AS INT) AS px, CAST((y % 2 * 16 + py) // 2 AS INT) AS py, {value} AS dn
      FROM {{fx_stack}} WHERE dn <> 0 {extra} GROUP BY 1, 2, 3, 4, 5, 6, 7"""


@query("ras_overviews", f"""
    SELECT 'average' AS method, * FROM ({_half('CAST(round_even(avg(dn), 0) AS INT)')}) AS a
    UNION ALL SELECT 'nearest' AS method, * FROM ({_half('max(dn)', 'AND px % 2 = 0 AND py % 2 = 0')}) AS b
    UNION ALL SELECT 'mode' AS method, scene, band, z, x, y, px, py, dn FROM (
      SELECT *, row_number() OVER (PARTITION BY scene, band, x, y, px, py ORDER BY n DESC, dn) AS r FROM (
        SELECT scene, band, 13 AS z, x >> 1 AS x, y >> 1 AS y, CAST((x % 2 * 16 + px) // 2 AS INT) AS px, CAST((y % 2 * 16 + py) // 2 AS INT) AS py, dn, count(*) AS n
        FROM {{fx_stack}} WHERE dn <> 0 GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) AS m) AS c WHERE r = 1""")
def _(v):
    chunks, keys = stack_chunks(v), ["scene", "band", *TILE]
    part = lambda m: clear_rows(CH.overview(chunks, ["scene", "band"], m, nodata=0), keys).select(F.lit(m).alias("method"), *keys, "px", "py", "dn")
    return part("average").unionByName(part("nearest")).unionByName(part("mode"))
