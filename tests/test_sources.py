import gzip
import sqlite3

from pyspark.sql import functions as F

from tessella.operators.tiles import zoom_range
from tessella.plans.planning import grid_tiles, plan_tiles
from tessella.sources import archives, catalogs, metadata, records


def lines(spark, rows, name="line"):
    return spark.createDataFrame([(r,) for r in rows], f"{name} string")


def test_catalog_lines(spark):
    whole = ["13/7021/3300.png,1700000123,998,0f3a", "7/64/9.webp,1700000999,77", "6/3/4,11,12", "6/3/5.csv.gz, 13 ,14"]
    faults = ["1x/1/2.png,21,22", "13/7021/3301.png 23 24", "5/1/2/3.png,25,26", "  ", "6/3/six.png,27,28", "6/3/7.png,29", "6/3/8.png,30,3.1"]
    rows = lines(spark, whole + faults)
    got = {(r.z, r.x, r.y, r.ext, r.mtime, r.size, r.md5) for r in catalogs.parse_catalog_lines(rows).collect()}
    assert got == {
        (13, 7021, 3300, "png", 1700000123, 998, "0f3a"),
        (7, 64, 9, "webp", 1700000999, 77, ""),
        (6, 3, 4, "", 11, 12, ""),
        (6, 3, 5, "csv.gz", 13, 14, ""),
    }


def test_gzip_catalog_with_bad_bytes(spark, tmp_path):
    with gzip.open(tmp_path / "c.csv.gz", "wb") as f:
        f.write(b"8/1/2.jpg,1,2,ab\n8/1/3.j\xffpg,1,2\n")
    rows = catalogs.read_catalog(spark, str(tmp_path), 4).collect()
    assert {r.y for r in rows} == {2, 3}


def test_tile_tree(spark, tmp_path):
    for name in ("3/1/2.png", "3/1/x.png", "t/1/2.png", "3/4/5.tar.gz"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"abc")
    tiles = catalogs.read_tile_tree(spark, str(tmp_path))
    assert {(r.z, r.x, r.y, r.ext, bytes(r.payload)) for r in tiles.collect()} == {(3, 1, 2, "png", b"abc"), (3, 4, 5, "tar.gz", b"abc")}


def test_plan_round_trip(spark, tmp_path):
    plan = plan_tiles(grid_tiles(spark, 4), 2024)
    records.write_plan(plan, str(tmp_path / "plan"))
    back = records.read_plan(spark, str(tmp_path / "plan"))
    cols = ["z", "x", "y", "minx", "maxy", "start_date", "end_date", "season", "collections", "max_cloud", "shard"]
    assert back.select(*cols).exceptAll(plan.select(*cols)).count() == 0
    assert back.count() == plan.count() == 237
    text = spark.read.text(str(tmp_path / "plan")).first().value
    assert '"shard"' not in text  # z4 has no shard


def test_plan_split_loses_nothing(spark, tmp_path):
    plan = grid_tiles(spark, 6).select("z", "x", "y").withColumn("shard", F.when(F.col("x") == 7, "own").when(F.col("x") == 8, ""))
    plan = plan.unionByName(spark.createDataFrame([(3, 2, 5, None)], plan.schema))
    folder = str(tmp_path / "split")
    records.write_plan_by_shard(plan, folder)
    back = spark.read.schema(plan.schema).json(folder).groupBy("shard").count().collect()
    counts = {r["shard"]: r["count"] for r in back}
    assert sum(counts.values()) == 4**6 + 1 and counts["own"] == 64 and counts["unassigned"] == 1
    tagged = records.with_plan_shard(plan).groupBy("shard").count().collect()
    assert counts == {r["shard"]: r["count"] for r in tagged}


def test_plan_defaults_and_rejects(spark):
    ok = '{"z":1,"x":0,"y":0,"bbox":[0,0,1,1],"start_date":"2024-01-01","end_date":"2024-02-01","max_cloud":30}'
    rows = lines(spark, [ok, ok.replace('"x":0,', ""), ok.replace("[0,0,1,1]", "[0,1]"), ok.replace("2024-02-01", "x"), "{bad"], "value")
    got = records.parse_plan(rows).collect()
    assert len(got) == 1
    assert (got[0].season, got[0].hemisphere, got[0].fallback_max_cloud, got[0].collections) == ("unknown", "global", 30.0, [])


def test_archives_round_trip(spark, tmp_path):
    tiles = grid_tiles(spark, 4).withColumn("payload", F.concat("x", F.lit("/"), "y")).withColumn("shard", F.when(F.col("x") < 12, "a").otherwise("b"))
    archives.write_archives(tiles, str(tmp_path), meta={"name": "n"}, rows_per_file=100)
    names = sorted(p.name for p in tmp_path.glob("*.mbtiles"))
    assert names == ["a_0.mbtiles", "a_1.mbtiles", "b_0.mbtiles"]
    back = archives.read_archives(spark, str(tmp_path), rows_per_partition=40)
    assert back.rdd.getNumPartitions() > 3
    rows = back.select("z", "x", "y", F.col("payload").cast("string").alias("payload"))
    assert rows.exceptAll(tiles.select("z", "x", "y", "payload")).count() == 0 and rows.count() == 256
    with sqlite3.connect(tmp_path / "b_0.mbtiles") as conn:  # rows are TMS on disk
        assert conn.execute("SELECT tile_data FROM tiles WHERE tile_column = 12 AND tile_row = 0").fetchone()[0] == b"12/15"
    meta = {(r.archive, r.name): r.value for r in archives.read_archive_meta(spark, str(tmp_path)).collect()}
    assert meta["b_0.mbtiles", "maxzoom"] == "4" and meta["a_0.mbtiles", "name"] == "n"


def test_meta_fills_zooms_and_keeps_bad_text(spark):
    tiles = spark.createDataFrame([(1, 3, 0, 0), (1, 5, 0, 0), (2, 2, 0, 0)], "s int, z int, x int, y int")
    meta = spark.createDataFrame([(1, "center", "1, 2,3"), (2, "bounds", "a,b,c,d"), (2, "minzoom", "1")], "s int, name string, value string")
    got = {r.s: r for r in metadata.read_meta(meta, tiles, ["s"]).collect()}
    assert (got[1].minzoom, got[1].maxzoom, got[1].center) == (3, 5, [1.0, 2.0, 3.0])
    assert (got[2].minzoom, got[2].bounds, got[2].bounds_text) == (1, None, "a,b,c,d")
    assert zoom_range(tiles).first().maxzoom == 5


def test_band_files_report_gaps(spark):
    files = lines(spark, ["file:/in/h01v01/M_Band1_doy2024001_aid.tif", "file:/in/h01v01/M_Band4_doy2024001.tif", "file:/in/h01v01/readme.txt"], "path")
    expected = spark.createDataFrame([("h01v01", b, "2024001") for b in ("Band1", "Band3", "Band4")], "tile string, band string, date string")
    matched = catalogs.band_files(files, expected)
    assert [r.band for r in catalogs.missing_bands(matched).collect()] == ["Band3"]


def test_multipolygon_features(spark):
    doc = '{"features":[{"properties":{"name":"a"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}},{"properties":{"name":"b"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,0]]]}}]}'
    edges = records.parse_features(lines(spark, [doc], "value"))
    assert edges.count() == 9
    assert records.parse_features(lines(spark, [doc], "value"), where=F.col("properties.name") == "b").count() == 3


def test_archives_are_replaced_whole(spark, tmp_path):
    many = grid_tiles(spark, 3).withColumn("payload", F.lit("a")).withColumn("shard", F.when(F.col("x") < 4, "s"))
    archives.write_archives(many, str(tmp_path), rows_per_file=10)
    few = many.filter("x = 0")
    archives.write_archives(few, str(tmp_path))
    assert [p.name for p in tmp_path.glob("*.mbtiles")] == ["s_0.mbtiles"]
    assert archives.read_archives(spark, str(tmp_path)).count() == few.count()
    archives.write_archives(many.filter("x = 7"), str(tmp_path))
    assert [p.name for p in tmp_path.glob("*.mbtiles")] == ["unassigned_0.mbtiles"]


def test_layers_of_any_depth(spark):
    nested = "".join(f"<Layer><Name>n{i}</Name>" for i in range(7)) + "<Layer/>" + "</Layer>" * 7
    doc = f"<WMS><Capability><Layer><Title>root</Title>{nested}</Layer></Capability></WMS>"
    got = catalogs.parse_layers_xml(lines(spark, [doc], "xml")).collect()
    assert {r["name"] for r in got} == {f"n{i}" for i in range(7)}


def test_repeated_features_count_once(spark):
    ring = "[[0,0],[4,0],[4,4],[0,4],[0,0]]"
    one = '{"type":"Feature","properties":{"name":"a"},"geometry":{"type":"Polygon","coordinates":[%s]}}' % ring
    doc = '{"type":"FeatureCollection","features":[%s]}'
    single, double = (records.parse_features(lines(spark, [doc % t], "value")) for t in (one, f"{one},{one}"))
    assert single.count() == 4 and double.exceptAll(single).count() == 0 and double.count() == 4
    again = records.parse_features(lines(spark, [doc % one, doc % one], "value"))
    assert again.count() == 4


def test_manifest_lines(spark, tmp_path):
    scenes = spark.createDataFrame([("d1", f"s{i}", 1.5) for i in range(50)] + [("d2", 'q"uote', None)], "day string, item_id string, cloud double")
    summary = scenes.groupBy("day").agg(F.count("*").alias("n"))
    records.write_manifests(summary, scenes, "day", str(tmp_path / "m"))
    back = spark.read.schema("value string, day string").text(str(tmp_path / "m"))
    got = records.parse_manifest_lines(back, "scene", "item_id string, cloud double")
    assert got.exceptAll(scenes).count() == 0 and got.count() == scenes.count()
    assert records.parse_manifest_lines(back, "summary", "n bigint").exceptAll(summary).count() == 0
    assert records.parse_manifest_lines(lines(spark, ["{broken", "7", '{"scene":1}'], "value"), "scene", "item_id string").count() == 0
