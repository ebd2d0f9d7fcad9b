import math

import pytest
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions import grid as G
from tessella.functions import scalars as S
from tessella.operators.tiles import cover_runs, exact_cover
from tessella.plans.planning import grid_tiles, land_tiles, plan_summary, plan_tiles, shard_boxes, shard_table

def around_thresholds(z):
    """Points half a tile or more to either side of each limit of the four regions, at zoom z."""
    gap = 360.0 / 2**z
    north, east, south = 62 / 1.5, 138.0, 133.0
    return [
        (south - 3 * gap, north + gap, "north"), (east + 9 * gap, north + gap, "north"), (south + gap, north - gap, "west"),
        (east + gap, north - gap, "east"), (east + 40 * gap, 0.0, "east"), (east - gap, north - gap, "west"),
        (south - gap, north - 2 * gap, "south"), (south - 50 * gap, -10.0, "south"), (south + gap, 5.0, "west"),
    ]


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("z,tiles,north", [(0, 1, 1), (3, 64, 32), (4, 237, 123), (5, 920, 492), (6, 3544, 1903), (8, 55169, 29954)])
def test_land_plan_counts(spark, z, tiles, north):
    plan = plan_tiles(grid_tiles(spark, z), 2024)
    counts = {r.season: r.tiles for r in plan_summary(plan).collect()}
    assert sum(counts.values()) == tiles
    assert counts["northern_growing_season"] == north


def test_z6_shards(spark):
    want = [318, 180, 231, 238, 414, 108, 229, 190, 90, 260, 260, 120, 156, 196, 274, 90, 80, 110]
    rows = plan_tiles(grid_tiles(spark, 6), 2024).groupBy("shard").count().collect()
    assert [r["count"] for r in sorted(rows, key=lambda r: r.shard)] == want


def test_shards_cover_the_grid_once(spark):
    cells = grid_tiles(spark, 6)
    assert exact_cover(cells, shard_table(spark)).count() == 0
    gap = shard_table(spark).filter("shard <> '07'")
    assert {r.n for r in exact_cover(cells, gap).collect()} == {0}


def test_faults_of_a_deep_cover_are_boxes(spark):
    """Two gaps and an overlap among a million million cells, in a few rows."""
    top = (1 << 20) - 1
    rows = [("a", 0, 0, 99_999, top), ("b", 100_000, 0, 599_999, 400_000), ("c", 100_000, 400_001, 599_999, top), ("d", 600_000, 7, top - 1, top), ("e", 50_000, 50, 100_004, 60)]
    shards = spark.createDataFrame(rows, "shard string, minx bigint, miny bigint, maxx bigint, maxy bigint")
    runs = cover_runs(shards, (0, 0, top, top)).collect()
    assert len(runs) < 40 and sum((r.maxx - r.minx + 1) * (r.maxy - r.miny + 1) for r in runs) == 1 << 40
    covered = lambda x, y: sum(a <= x <= c and b <= y <= d for _, a, b, c, d in rows)
    for r in runs:
        assert {covered(x, y) for x in (r.minx, r.maxx) for y in (r.miny, r.maxy)} == {r.n}
    area = {n: sum((r.maxx - r.minx + 1) * (r.maxy - r.miny + 1) for r in runs if r.n == n) for n in (0, 2)}
    assert area == {0: 7 * (top - 600_000 + 1) + (top + 1 - 7), 2: (100_004 - 50_000 + 1) * 11}


def test_cells_of_faults(spark):
    shards = spark.createDataFrame([("a", 0, 0, 3, 7), ("b", 3, 0, 6, 7)], "shard string, minx int, miny int, maxx int, maxy int")
    cells = spark.range(8).select(F.col("id").alias("x")).crossJoin(spark.range(8).select(F.col("id").alias("y")))
    got = {(r.x, r.y): r.n for r in exact_cover(cells, shards).collect()}
    assert got == {**{(3, y): 2 for y in range(8)}, **{(7, y): 0 for y in range(8)}}
    assert exact_cover(cells.limit(0), shards).collect() == []


def test_shard_needs_its_zoom(spark):
    row = one(spark, low=G.shard_of_tile(5, 3, 3), same=G.shard_of_tile(6, 0, 0), deep=G.shard_of_tile(10, 909, 403))
    assert row.low is None and row.same == "00" and row.deep == "12"


def test_shard_boxes_reach_the_edges(spark):
    ends = shard_boxes(spark).agg(F.min("minx"), F.max("maxx"), F.round(F.max("maxy"), 6)).first()
    assert tuple(ends) == (-180.0, 180.0, 85.051129)


@pytest.mark.parametrize("z", [12, 16, 18])
def test_quadrants(spark, z):
    rows = spark.createDataFrame(around_thresholds(z), "lon double, lat double, want string")
    x, y = G.lonlat_to_tile("lon", "lat", z)
    got = rows.withColumns({"x": x, "y": y}).withColumn("got", G.quadrant_of_tile(F.lit(z), "x", "y"))
    assert got.filter("got <> want").count() == 0


def test_gsd_to_zoom(spark):
    """Both sides of the borders of zooms 10 and 15 (152.874 and 4.7773 m a pixel)."""
    row = one(spark, a=G.gsd_to_zoom(152.8), b=G.gsd_to_zoom(152.9), c=G.gsd_to_zoom(4.777), d=G.gsd_to_zoom(4.778), e=G.gsd_to_zoom(0.0), f=G.gsd_to_zoom(F.lit(None).cast("double")))
    assert tuple(row) == (10, 9, 15, 14, 24, 24)


def test_box_buffer(spark):
    box = G.box_buffer(139.0, 35.0, 139.0, 35.0, 11.132)
    row = one(spark, **box._asdict())
    assert row.maxy == pytest.approx(35.1) and row.minx == pytest.approx(139 - 0.1 / math.cos(math.radians(35)))
    world = one(spark, **G.box_buffer(-180.0, -90.0, 180.0, 90.0, 50.0)._asdict())
    assert tuple(world) == (-180.0, -90.0, 180.0, 90.0)


def test_tile_ranges(spark):
    args = (G.col(10.0), G.col(20.0), G.col(-10.0), G.col(-20.0), F.lit(4))
    inset = one(spark, **G.tile_range(*args, "inset")._asdict())
    assert (inset.xmin, inset.xmax) == (7, 8)
    plain = one(spark, **G.tile_range(*args, "plain")._asdict())
    assert plain.xmax == -1
    edge = one(spark, **G.tile_range(F.lit(170.0), F.lit(0.0), F.lit(180.0), F.lit(10.0), F.lit(3), "plain")._asdict())
    assert edge.xmax == 7


def test_flip_twice_is_identity(spark):
    tiles = grid_tiles(spark, 4)
    assert tiles.withColumn("t", G.tms_flip("z", "y")).filter(G.tms_flip("z", "t") != F.col("y")).count() == 0


def test_season_wraps_over_new_year(spark):
    row = one(spark, **dict(zip("nhse", S.season_window(-10.0, 2024))))
    assert (row.n, str(row.s), str(row.e)) == ("southern_growing_season", "2023-10-01", "2024-04-30")
    shared = (("all_year", "global", 1, 1, 12, 31),)
    assert one(spark, n=S.season_window(5.0, 2024, shared)[0]).n == "all_year"
    with pytest.raises(ValueError):
        S.season_window(5.0, 2024, (("s", "south", 1, 1, 2, 2),))


def test_text_helpers(spark):
    row = one(
        spark,
        slug=S.slug(F.lit("True Color (v2)!")),
        none=S.slug(F.lit("!!")),
        shard=S.shard_id(F.lit(0)),
        long=S.shard_id(F.lit("007")),
        blank=S.shard_id(F.lit(" ")),
        fmt=S.tile_format(F.lit("JPEG")),
        data=S.vector_dataset(F.lit(" Admin0 ")),
        other=S.vector_dataset(F.lit("roads")),
        mask=S.qa_mask(F.array(F.lit("Cloud"), F.lit(" snow "), F.lit("fog"))),
        signed=S.sign_url(F.lit("http://a/b?x=1#f"), F.lit("?t=2")),
        bare=S.strip_query(F.lit("http://a/b?x=1#f")),
    )
    assert tuple(row) == ("true_color_v2", "layer", "00", "007", None, "jpg", "countries", None, 18, "http://a/b?x=1&t=2#f", "http://a/b")


def test_product_parts(spark):
    ids = ["modis_mcd43a4_2024060_h10v05", "modis_mcd43a4_2023366_h10v05", "modis_mcd43a4_20240_h10v05", "modis_mcd43a4_2024060", "viirs_vnp09ga_2024060_h10v05"]
    rows = spark.createDataFrame([(i,) for i in ids], "p string")
    day, tile = S.product_parts("p", "modis_mcd43a4_")
    got = [(str(r.d), r.t) for r in rows.select(day.alias("d"), tile.alias("t")).collect() if r.t]
    assert got == [("2024-02-29", "h10v05")]


def test_sinusoidal_ring(spark):
    ring = one(spark, r=S.sinusoidal_ring(F.lit("h18v09")), bad=S.sinusoidal_ring(F.lit("h36v00")))
    assert ring.bad is None and len(ring.r) == 5 and ring.r[0] == ring.r[4]
    assert ring.r[0].lon == pytest.approx(0, abs=1e-6) and ring.r[2].lat == pytest.approx(-10, abs=1e-6)


def test_land_is_monotone(spark):
    deep = land_tiles(grid_tiles(spark, 5)).select(F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y")).distinct()
    assert deep.join(land_tiles(grid_tiles(spark, 4)), ["x", "y"], "left_anti").count() == 0
    assert len(C.SHARD_RECTANGLES) == 18
