import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions.grid import Box
from tessella.operators import chunks as CH
from tessella.operators import kernels as K
from tessella.operators import pixels as PX
from tessella.operators import stacks as ST
from tessella.operators import planes as PL
from tessella.operators import regions as R
from tessella.operators import stats
from tessella.plans import mosaics, planet
from tessella.plans.planning import grid_tiles

CHUNK = "src int, z int, x bigint, y bigint, w int, h int, data array<int>"


def chunks(spark, rows, schema=CHUNK):
    return spark.createDataFrame(rows, schema)


def rgba(color, size, alpha=255):
    return [int(v) for c in (*color, alpha) for v in [c] * (size * size)]


def image(row):
    return np.array(row.data).reshape(-1, row.h, row.w)


def merged(spark, stack, merge=ST.median_chunks, clouds=None):
    h, w = len(stack[0]), len(stack[0][0])
    clouds = clouds or [None] * len(stack)
    rows = [(i, c, 3, 1, 1, w, h, [v for r in s for v in r]) for i, (s, c) in enumerate(zip(stack, clouds))]
    table = spark.createDataFrame(rows, "scene int, cloud double, z int, x bigint, y bigint, w int, h int, data array<int>")
    return image(merge(table, ["z", "x", "y"]).first())[0].tolist()


def test_median(spark):
    assert merged(spark, [[[41, 7]], [[-6, 0]], [[12, 9]]]) == [[12, 8]]
    assert merged(spark, [[[0, -5]], [[0, -8]]]) == [[0, -6]]  # halves go to even
    assert merged(spark, [[[-50]], [[-30]], [[500]]]) == [[-30]]
    assert merged(spark, [[[8, 0, -2]]]) == [[8, 0, -2]]
    assert merged(spark, [[[17, 0], [6, 1]], [[4, 90], [3, 0]]]) == [[10, 90], [4, 1]]


def test_a_stack_of_twenty_thousand_scenes(spark):
    """Deep stacks beside shallow ones, against one sort; no task holds a stack."""
    rows = spark.range(20_000).select(
        F.col("id").cast("int").alias("scene"), F.lit(3).alias("z"), F.lit(1).cast("bigint").alias("x"), F.lit(1).cast("bigint").alias("y"), F.lit(2).alias("w"), F.lit(3).alias("h"),
        F.expr("transform(sequence(0, 5), i -> CAST(IF((id + i) % 4 = 0 OR i = 5, 0, (id * 7919 + i * 104729) % (CASE i WHEN 0 THEN 3 WHEN 1 THEN 60000 ELSE 2000000000 END) - 5) AS INT))").alias("data"),
    )
    shallow = rows.filter("scene < 3").withColumn("y", F.lit(2).cast("bigint"))
    got = {r.y: list(r.data) for r in ST.median_chunks(rows.unionByName(shallow), ["z", "x", "y"]).collect()}
    for y, source in ((1, rows), (2, shallow)):
        stack = np.array([r.data for r in source.collect()], float)
        stack[stack == 0] = np.nan
        want = [0 if np.isnan(c).all() else int(np.rint(np.nanmedian(c))) for c in stack.T]
        assert got[y] == want


def test_groups_of_a_stream_come_whole_or_in_pieces():
    import pyarrow as pa

    sizes = [1, 200, 3, ST.HELD, ST.HELD + 1, 2, 70]
    keys = [k for k, n in enumerate(sizes) for _ in range(n)]
    for step in (1, 7, 64, 500):
        batches = [pa.record_batch({"k": pa.array([None if v == 2 else v for v in keys[i:i + step]], pa.int64())}) for i in range(0, len(keys), step)]
        seen, going = [], 0
        for batch, starts, whole in ST._groups(iter(batches), ["k"]):
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                assert len(batch.slice(a, b - a).column("k").unique()) == 1
                going += b - a
                if whole:
                    seen.append(going)
                    going = 0
            assert whole or len(starts) == 1
        assert seen == sizes


def test_deep_and_wide_stacks(spark):
    """Stacks deeper than any batch and chunks of several strips, against one sort."""
    rng = np.random.default_rng(4)
    stack = rng.integers(-9, 10, (300, 41, 53))
    work = np.where(stack == 0, np.nan, stack.astype(float))
    assert merged(spark, stack.tolist()) == np.rint(np.nanmedian(work, axis=0)).astype(int).tolist()
    clouds = [float(c) if c < 95 else None for c in rng.integers(0, 100, 300)]
    order = sorted(range(300), key=lambda i: (clouds[i] is None, clouds[i] or 0, -i))
    want = np.zeros((41, 53), int)
    for i in reversed(order):
        want = np.where(stack[i] != 0, stack[i], want)
    assert merged(spark, stack.tolist(), ST.priority_chunks, clouds) == want.tolist()


@pytest.mark.parametrize("n", [0, 1, 4])
def test_dilation_kernel_is_the_diamond(n):
    mask = np.zeros((3, 9, 11), bool)
    mask[0, 4, 5] = mask[1, 0, 0] = mask[1, 8, 9] = True
    ys, xs = np.mgrid[:9, :11]
    for m, grown in zip(mask, K.dilate(mask, n)):
        near = [abs(ys - y) + abs(xs - x) <= n for y, x in np.argwhere(m)]
        assert (grown == (np.any(near, axis=0) if near else False)).all()


def test_overviews_weigh_by_alpha():
    pixels = np.array([[[200, 0], [10, 0]], [[0, 200], [20, 0]], [[0, 0], [30, 0]], [[255, 255], [85, 0]]])
    got = K.halve(pixels, "average", rgba=True)[:, 0, 0]
    share = np.array([255, 255, 85])
    colours = np.array([[200, 0, 0], [0, 200, 0], [10, 20, 30]])
    assert got.tolist() == [*np.rint((colours * share[:, None]).sum(axis=0) / share.sum()).astype(int), round(share.sum() / 4)]
    assert K.halve(pixels, "mode", rgba=True)[:, 0, 0].tolist() == [0, 200, 0, 255]  # the lowest of three
    depths = np.array([[[-300, -300], [-100, 0]]])
    assert K.halve(depths, "average")[0, 0, 0] == -175 and K.halve(depths, "average", nodata=0)[0, 0, 0] == -233
    assert K.halve(depths, "mode", nodata=0)[0, 0, 0] == -300 and (K.halve(np.full((1, 8, 8), -300), "cubic") == -300).all()
    assert K.resize(np.array([[[0, 255], [0, 255]]]), 8, 8, "cubic", limits=(0, 255)).min() == 0


def test_checks_count_planes(spark):
    rows = [(0, 1, 0, 0, 2, 2, rgba((1, 2, 3), 2)), (1, 1, 0, 0, 2, 2, [1] * 15), (2, 1, 0, 0, 2, 2, []), (3, 1, 0, 0, 0, 2, [1]), (4, 1, 0, 0, 2, 2, [1] * 4)]
    valid = lambda **a: [r.src for r in stats.chunk_check(chunks(spark, rows), **a).filter("valid").orderBy("src").collect()]
    assert valid() == [0, 4] and valid(planes=4) == [0]
    good, bad = stats.quarantined(chunks(spark, rows), 4)
    assert good.count() == 1 and bad.count() == 4 and bad.columns == good.columns


def test_median_kernel_against_numpy():
    rng = np.random.default_rng(1)
    stack = rng.integers(0, 4, (6, 7, 50)) * rng.integers(-900, 900, (6, 7, 50))
    work = np.where(stack == 0, np.nan, stack.astype(float))
    with np.testing.suppress_warnings() as mute:
        mute.filter(RuntimeWarning)
        want = np.nan_to_num(np.rint(np.nanmedian(work, axis=1)))
    assert (K.stack_median(stack) == want).all()


def whole_raster(spark, bits, size, fn):
    """One raster of 2^bits x 2^bits chunks."""
    n = 1 << bits
    full = np.array([[fn(px, py) for px in range(n * size)] for py in range(n * size)], np.int32)
    rows = [(0, bits, x, y, size, size, full[y * size : (y + 1) * size, x * size : (x + 1) * size].ravel().tolist()) for x in range(n) for y in range(n)]
    return full, chunks(spark, rows)


def put_together(rows, size, n):
    out = np.zeros((n * size, n * size), np.int64)
    for r in rows:
        out[r.y * size : (r.y + 1) * size, r.x * size : (r.x + 1) * size] = image(r)[0]
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_dilation_crosses_chunk_borders(spark, n):
    full, table = whole_raster(spark, 2, 4, lambda px, py: 2 if (px * 13 + py * 7) % 41 == 0 else 1)
    got = put_together(CH.dilate_mask(table, ["src"], 2, n).collect(), 4, 4)
    assert (got == K.dilate(full == 2, n)).all()
    points = CH.explode_chunks(table, ["src", "z", "x", "y"]).filter("dn = 2")
    pixel = PX.dilate_pixels(points, ["src"], n, 4, 4)
    sparse = np.zeros_like(got)
    for r in pixel.collect():
        sparse[r.y * 4 + r.py, r.x * 4 + r.px] = 1
    assert (sparse == got).all()


def test_dilation_keeps_chunks_beyond_the_last_column(spark):
    """Keys are not bound to the zoom's 2^z columns: such chunks grow their mask as others do."""
    table = chunks(spark, [(0, 1, 1, 0, 2, 1, [0, 2]), (0, 1, 2, 0, 2, 1, [0, 0]), (0, 1, 3, 5, 2, 1, [2, 0])])
    got = {(r.x, r.y): list(r.data) for r in CH.dilate_mask(table, ["src"], 2, 1).collect()}
    assert got == {(1, 0): [1, 1], (2, 0): [1, 0], (3, 5): [1, 1]}


def test_mosaic_is_masked_beyond_the_last_column(spark):
    """A mask grows over chunks whose keys lie outside the zoom's columns, too."""
    at = "scene int, cloud double, band int, z int, x bigint, y bigint, w int, h int, data array<int>"
    bands = spark.createDataFrame([(0, 1.0, 0, 1, x, 0, 2, 1, [100, 200]) for x in (1, 2, 3)], at)
    qa = spark.createDataFrame([(0, 1, 1, 0, 2, 1, [0, 2]), (0, 1, 2, 0, 2, 1, [0, 0]), (0, 1, 3, 0, 2, 1, [2, 0])], "scene int, z int, x bigint, y bigint, w int, h int, data array<int>")
    for strategy in ("median", "clearest"):
        done = mosaics.clean_mosaic(bands, qa, ("cloud",), 1, strategy, (0, 255, 1.0))
        assert {r.x: list(r.data) for r in done.collect()} == {1: [0, 0], 2: [0, 0], 3: [0, 0]}


def test_visual_mosaic_keeps_dark_values_and_counts_footprints(spark):
    """Values that stretch to 0 are clear; a scene with nodata alone in the box takes its place in the cap."""
    at = "scene int, cloud double, band int, z int, x bigint, y bigint, w int, h int, data array<int>"
    marked = spark.createDataFrame([
        (1, 0.0, 0, 1, 0, 0, 2, 1, [0, 0, 1, 0]),
        (2, 5.0, 0, 1, 0, 0, 2, 1, [7, 0, 1, 1]),
        (3, 9.0, 0, 1, 0, 0, 2, 1, [900, 900, 1, 1]),
    ], at)
    world = Box(-180.0, -85.0, 180.0, 85.0)
    mosaic = lambda cap: list(mosaics.visual_mosaic(marked, cap, world, 1).first().data)
    assert mosaic(1) == [0, 0, 0, 0]
    assert mosaic(2) == [0, 0, 255, 0]
    assert mosaic(3) == mosaic(0) == [0, 23, 255, 255]


def test_panel_mosaic_keeps_nodata_pixels(spark, views):
    from tessella.queries import load

    rows = views.fx_stack.filter("scene < 2")
    got = load()[0]["ras_panel_mosaic"](spark, views.sf_dir).filter("scene < 2")
    assert got.count() == rows.count() and got.filter("dn = 0").count() == rows.filter("dn = 0").count() > 0


def test_parts_of_a_batch_are_small():
    """A worker resizes a full Arrow batch in parts of 4 MB, whatever the batch holds."""
    for width in (1, 256, 1024, 4 * 256 * 256):
        parts = list(CH._runs(np.arange(10_000), width))
        assert np.concatenate(parts).tolist() == list(range(10_000))
        assert max(len(p) for p in parts) * width * 4 <= 4 << 20


def test_hillshade_is_seamless(spark):
    full, table = whole_raster(spark, 2, 4, lambda px, py: (px * px * 3 + py * 11) % 97)
    got = put_together(CH.hillshade_chunks(table, ["src"], 30.0, 30.0).collect(), 4, 4)
    want = K.hillshade(np.pad(full.astype(float), 1, mode="edge"), 30.0, 30.0)
    assert (got == want).all()
    flat = K.hillshade(np.zeros((5, 5)), 1.0, 1.0)
    assert (flat == round(1 + 254 * np.cos(np.radians(45)))).all()
    slope = np.tile(np.arange(5.0), (5, 1))  # rises to the east, so it faces the light in the west
    assert K.hillshade(slope, 1.0, 1.0)[1, 1] > flat[1, 1] > K.hillshade(slope[:, ::-1], 1.0, 1.0)[1, 1]


def test_mask_without_quality_passes(spark):
    bands = chunks(spark, [(1, 1, 0, 0, 2, 1, [5, 6]), (2, 1, 0, 0, 2, 1, [7, 8])])
    qa = chunks(spark, [(1, 1, 0, 0, 2, 1, [2, 32])])
    got = {r.src: r.data for r in CH.mask_chunks(bands, qa, ["src", "z", "x", "y"], 31).collect()}
    assert got == {1: [0, 6], 2: [7, 8]}


def test_priority_and_paint(spark):
    rows = [(1, 10.0, 5), (2, 10.0, 6), (3, None, 7), (4, 1.0, 0)]
    px = spark.createDataFrame([(0, s, c, d) for s, c, d in rows], "k int, scene int, cloud double, dn int")
    assert PX.first_clear(px, ["k"], F.struct("scene")).first().dn == 6  # later wins on equal cloud, 0 is transparent
    assert PX.last_painted(px, ["k"], PX.paint_order(px)).first().dn == 7  # cloudiest (unknown) painted last
    only = px.filter("scene = 4")
    assert PX.first_clear(only, ["k"], F.struct("scene")).count() == 0
    assert PX.last_painted(only, ["k"], PX.paint_order(only)).first().dn == 0


def test_stitch_places_children(spark):
    kids = [(0, 1, 0, 0, (10, 0, 0)), (0, 1, 1, 0, (0, 20, 0)), (0, 1, 0, 1, (0, 0, 30)), (0, 1, 1, 1, (40, 40, 40)), (0, 0, 0, 0, (9, 9, 9))]
    table = chunks(spark, [(s, z, x, y, 2, 2, rgba(c, 2)[:12]) for s, z, x, y, c in kids])
    row = CH.stitch(table, ["src"]).collect()
    assert len(row) == 1
    out = image(row[0])
    assert out.shape == (3, 4, 4) and out[:, 0, 0].tolist() == [10, 0, 0] and out[:, 0, 3].tolist() == [0, 20, 0]
    assert out[:, 3, 0].tolist() == [0, 0, 30] and out[:, 3, 3].tolist() == [40, 40, 40]
    gap = image(CH.stitch(table.filter("x = 0 and y = 0 and z = 1"), ["src"], background=(1, 2, 3)).first())
    assert gap[:, 3, 3].tolist() == [1, 2, 3]
    mixed = chunks(spark, [(0, 1, 0, 0, 2, 2, rgba((7, 7, 7), 2)[:12]), (0, 1, 1, 0, 4, 4, rgba((8, 8, 8), 4)[:48])])
    assert image(CH.stitch(mixed, ["src"]).first()).shape == (3, 8, 8)


def test_composite_shows_the_base_through(spark):
    red, blue = rgba((255, 0, 0), 4), np.array(rgba((0, 0, 255), 4)).reshape(4, 4, 4)
    blue[3, :, 2:] = 0
    base = chunks(spark, [(0, 2, 1, 1, 4, 4, red)])
    over = chunks(spark, [(1, 2, 1, 1, 4, 4, blue.ravel().tolist()), (1, 3, 5, 5, 2, 2, rgba((1, 2, 3), 2))])
    got = {(r.z, r.x): image(r) for r in CH.composite_tiles(base, over, 4).collect()}
    assert got[2, 1][:, 0, 0].tolist() == [0, 0, 255, 255] and got[2, 1][:, 0, 3].tolist() == [255, 0, 0, 255]
    assert got[3, 5].shape == (4, 4, 4) and got[3, 5][:, 0, 0].tolist() == [1, 2, 3, 255]
    smooth = CH.composite_tiles(base, over, 4, "lanczos").filter("z = 3").first()
    assert image(smooth)[:, 1, 1].tolist() == [1, 2, 3, 255]


def test_overzoom_prefers_the_finest(spark):
    coarse, fine = rgba((100, 0, 0), 4), rgba((0, 200, 0), 4)
    table = chunks(spark, [(0, 1, 1, 1, 4, 4, coarse), (1, 3, 5, 5, 4, 4, fine)])
    requests = spark.createDataFrame([(3, 5, 5), (3, 4, 5), (3, 0, 0), (5, 20, 21), (9, 330, 340)], "z int, x bigint, y bigint")
    got = {(r.z, r.x, r.y): image(r)[:3, 0, 0].tolist() for r in CH.overzoom_stack(requests, table, [0, 1], 4).collect()}
    assert got == {(3, 5, 5): [0, 200, 0], (3, 4, 5): [100, 0, 0], (5, 20, 21): [0, 200, 0], (9, 330, 340): [0, 200, 0]}


def test_overzoom_cuts_equal_direct_windows(spark):
    """All depths of one varied tile, across the piece sizes, against direct sampling."""
    size = 16
    data = np.stack([np.arange(256).reshape(16, 16) % 251, np.arange(256).reshape(16, 16) // 3, np.zeros((16, 16), int), np.full((16, 16), 255)])
    table = chunks(spark, [(0, 1, 1, 0, size, size, data.astype(int).ravel().tolist())])
    asked = [(z, (1 << (z - 1)) + (5 * z) % (1 << (z - 1)), (3 * z + 1) % (1 << (z - 1))) for z in range(1, 12)]
    requests = spark.createDataFrame(asked, "z int, x bigint, y bigint")
    got = {r.z: image(r) for r in CH.overzoom_stack(requests, table, [0], size).collect()}
    for z, x, y in asked:
        d = z - 1
        at = lambda v, i, first: ((v - (first << d)) * size + i) >> d
        cols, rows = [at(x, i, 1) for i in range(size)], [at(y, i, 0) for i in range(size)]
        assert (got[z] == data[:, rows][:, :, cols]).all(), z


@pytest.mark.parametrize("method", ["nearest", "average", "mode", "gauss", "cubic", "cubicspline", "lanczos", "other"])
def test_overviews_keep_flat_areas(spark, method):
    table = chunks(spark, [(0, 2, x, y, 4, 4, [77] * 16) for x in range(4) for y in range(4)])
    rows = CH.pyramid(table, ["src"], 2, 0, method).collect()
    assert sorted(r.z for r in rows) == [0] + [1] * 4 + [2] * 16
    assert all(set(r.data) == {77} for r in rows)


def test_pixel_and_chunk_overviews_agree(spark, views):
    keys = ["scene", "band"]
    table = CH.assemble_chunks(views.fx_stack, ["scene", "band", "z", "x", "y"], 16, 16)
    for method in ("average", "nearest", "mode"):
        chunk = CH.explode_chunks(CH.overview(table, keys, method, nodata=0), [*keys, "z", "x", "y"]).filter("dn <> 0").drop("plane")
        pixel = PX.overview_pixels(views.fx_stack, keys, 16, method).filter("dn <> 0")
        cols = [*keys, "x", "y", "px", "py", "dn"]
        assert chunk.select(cols).exceptAll(pixel.select(cols)).count() == 0
        assert pixel.select(cols).exceptAll(chunk.select(cols)).count() == 0


def test_clip_and_cover(spark):
    ring = [(-40.0, -30.0), (50.0, -20.0), (30.0, 60.0), (-60.0, 40.0)]
    edges = spark.createDataFrame([(1, *a, *b) for a, b in zip(ring, ring[1:] + ring[:1])], "region int, x1 double, y1 double, x2 double, y2 double")
    cover = {(r.x, r.y) for r in R.polygon_cover(edges, "region", 4).collect()}
    parts = R.region_cover(edges, "region", 4)
    assert {(r.x, r.y) for r in parts.collect()} == cover and 0 < parts.filter("partial").count() < len(cover)
    grown = {(r.x, r.y) for r in R.grow_cover(edges, "region", 4, 600.0).collect()}
    assert cover < grown and {(r.x, r.y) for r in R.grow_cover(edges, "region", 4, 0.0).collect()} == cover
    # pixels of inner tiles stay, pixels of tiles beside the region go
    px = grid_tiles(spark, 4).withColumn("px", F.lit(3)).withColumn("py", F.lit(4))
    kept = {(r.x, r.y) for r in R.clip_pixels(px, edges, "region", 4, 3).collect()}
    inner = {(r.x, r.y) for r in parts.filter("NOT partial").collect()}
    assert inner <= kept <= cover


def test_color_ramp(spark):
    ramp = [(-100, 0, 0, 0), (100, 200, 100, 50)]
    c = PX.color_relief(F.col("v"), ramp)
    got = spark.createDataFrame([(-500.0,), (0.0,), (500.0,)], "v double").select(*[e.alias(n) for n, e in c.items()]).collect()
    assert [tuple(r) for r in got] == [(0, 0, 0, 255), (100, 50, 25, 255), (200, 100, 50, 255)]
    with pytest.raises(ValueError):
        PX.color_relief(F.col("v"), [(0, 1, 2)])


def test_strategies(spark, views):
    bands = CH.assemble_chunks(views.fx_stack, ["scene", "band", "z", "x", "y"], 16, 16)
    cloud = F.when(F.col("scene") == 4, None).otherwise(F.col("scene") * 37 % 50).cast("double")
    bands = bands.withColumn("cloud", cloud)
    qa = CH.assemble_chunks(views.fx_qa.withColumnRenamed("qa", "dn"), ["scene", "z", "x", "y"], 16, 16)
    best = mosaics.clean_mosaic(bands, qa, strategy="best_pixel")
    assert best.exceptAll(mosaics.clean_mosaic(bands, qa, strategy=" Median ")).count() == 0
    top = mosaics.clean_mosaic(bands, qa, flags=(), strategy="priority", stretch=(0.0, 255.0, 1.0))
    want = PX.first_clear(views.fx_stack, ["x", "y", "band", "px", "py"], F.struct("scene")).withColumn("dn", F.least("dn", F.lit(255)))
    got = CH.explode_chunks(top, ["x", "y", "band"]).filter("dn <> 0").select("x", "y", "band", "px", "py", "dn")
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_planet_folds_in_order(spark):
    area = (1.0, 1.0, 40.0, 40.0)
    layers = [planet.Overlay("ctx", "hls", 1, (area,), 4), planet.Overlay("city", "sentinel2", 2, ((5.0, 5.0, 6.0, 6.0),), 5)]
    table = chunks(spark, [(0, 2, 2, 1, 2, 2, rgba((9, 9, 9), 2)), (1, 4, 8, 7, 2, 2, rgba((1, 1, 1), 2)), (2, 5, 16, 15, 2, 2, rgba((2, 2, 2), 2))])
    done = planet.build_planet(table, 0, "bmng", 2, layers, 2, checkpoint=True)
    got = {(r.z, r.x, r.y): image(r)[0, 0, 0] for r in done.collect()}
    assert got[2, 2, 1] == 9 and got[3, 4, 3] == 9 and got[4, 8, 7] == 1 and got[5, 16, 15] == 2
    assert max(k[0] for k in got) == 5
    base = planet.build_planet(table, 0, "bmng", 2, [], 2)
    assert base.count() == 1
    with pytest.raises(ValueError, match="ceiling"):
        planet.build_planet(table, 0, "bmng", 9, [], 2)
    assert len(planet.overlay_faults("bmng", 8, [planet.Overlay("a", "hls", 1, (), 13, 14), planet.Overlay("a", "hls", 1, (), 12)])) == 3


def test_chunk_crop_keeps_the_pixels_of_the_box(spark, views):
    keys = ["scene", "band", "z", "x", "y"]
    pixels = views.fx_stack.filter("dn <> 0")
    lon = pixels.agg(F.min("x"), F.max("x")).first()
    box = Box(-180.0, 84.9, (lon[0] + lon[1]) / 2 / 2**14 * 360.0 - 180.0, 85.05)
    chunks_ = CH.assemble_chunks(pixels, keys, 16, 16)
    cropped = CH.explode_chunks(PL.crop_box_chunks(chunks_, keys, box, 14), keys).filter("dn <> 0").drop("plane")
    want = PX.crop_box(pixels, box, 14, 16).select(*keys, "px", "py", "dn")
    cols = [*keys, "px", "py", "dn"]
    assert 0 < want.count() < pixels.count()
    assert cropped.select(cols).exceptAll(want.select(cols)).count() == 0 and cropped.count() == want.count()


def test_relief_and_alpha_of_odd_chunks(spark):
    rows = [(0, 1, 0, 0, 2, 1, [-500, 0]), (1, 1, 1, 0, 1, 1, [7]), (2, 1, 1, 1, 2, 2, [])]
    table = chunks(spark, rows)
    ramp = [(100, 200, 100, 50), (-100, 0, 0, 0)]
    got = {r.src: r.data for r in PL.color_relief_chunks(table, ["src"], ramp).collect()}
    assert got[0] == [0, 100, 0, 50, 0, 25, 255, 255] and 2 not in got
    alpha = {r.src: r.data for r in PL.nodata_alpha_chunks(table, ["src"]).collect()}
    assert alpha[0] == [-500, 0, 255, 0]
    with pytest.raises(ValueError):
        PL.color_relief_chunks(table, ["src"], [(0, 1, 2)])
    mixed = PL.blend_chunks(table, table.withColumn("data", F.transform("data", lambda d: d + 10)), ["src"], 2.0)
    assert {r.src: r.data for r in mixed.collect()}[0] == [-490.0, 10.0]


@pytest.mark.parametrize("z,bits", [(3, 4), (7, 1)])
def test_region_masks_of_chunks_equal_pixels(spark, views, z, bits):
    """Every pixel of the world: the chunk form keeps what the pixel form keeps; inner tiles are whole."""
    size, at = 1 << bits, ["z", "x", "y"]
    data = F.transform(F.sequence(F.lit(1), F.lit(size * size)), lambda i: i.cast("int"))
    world = grid_tiles(spark, z).select(*at, F.lit(size).alias("w"), F.lit(size).alias("h"), data.alias("data"))
    clipped = R.clip_chunks(world, at, views.fx_edges, "region_id", z, bits)
    got = CH.explode_chunks(clipped, at).filter("dn <> 0").select(*at, "px", "py")
    want = R.clip_pixels(CH.explode_chunks(world, at).drop("plane"), views.fx_edges, "region_id", z, bits).select(*at, "px", "py")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    masks = R.region_masks(views.fx_edges, "region_id", z, bits)
    assert masks.groupBy(*at).count().filter("count > 1").isEmpty() and masks.filter("NOT whole AND runs IS NULL").isEmpty()
    assert z == 3 or masks.filter("whole AND runs IS NULL").count() > 0
