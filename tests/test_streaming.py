import random

import pytest
from pyspark.sql import functions as F

from tessella.streaming import KeyIndex, TileTable, rolling_counters, skip_known, stream_catalog


def write_lines(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(rows) + "\n")


def test_catalog_files_are_read_once(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", ["8/1/2.jpg,1,2,aa", "bad"])

    def run():
        rows = stream_catalog(spark, str(tmp_path / "in"))
        query = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert run() == 1 and run() == 1
    write_lines(tmp_path / "in", "b.csv", ["8/1/3.jpg,1,2"])
    assert run() == 2


TILES = "z int, x bigint, y bigint, seq bigint, payload string"


def read(table, spark, version=None):
    return {(r.z, r.x, r.y): (r.seq, r.payload) for r in table.read(spark, version).collect()}


def test_tile_table_over_many_batches(spark, tmp_path):
    """Random batches with late rows and replays against a plain dict; versions stay readable."""
    rng = random.Random(3)
    table, want, past = TileTable(str(tmp_path / "table"), ["seq"]), {}, []
    for batch in range(9):
        rows = {}
        for _ in range(60):
            z = rng.choice((0, 3, 9, 12))
            key = (z, rng.randrange(1 << z), rng.randrange(min(1 << z, 40)))
            rows[key] = (rng.randrange(1000), f"p{batch}")
        frame = spark.createDataFrame([(*k, *v) for k, v in rows.items()], TILES)
        for _ in range(1 + batch % 2):  # every second batch comes twice
            table.append(frame, batch, "one")
        for key, value in rows.items():
            if value[0] > want.get(key, (-1,))[0]:
                want[key] = value
        got = read(table, spark)
        assert got == {k: got[k] for k in want} and all(got[k][0] == want[k][0] for k in want)
        past.append((table.ranges.state()["version"], got))
    table.append(spark.createDataFrame([(3, 1, 1, -5, "late")], TILES), 4, "one")  # an old batch of the stream
    table.append(spark.createDataFrame([(3, 1, 1, -5, "late")], TILES), 0, "other")  # an older row of another one
    assert read(table, spark) == past[-1][1] | ({} if (3, 1, 1) in want else {(3, 1, 1): (-5, "late")})
    assert all(read(table, spark, version) == rows for version, rows in past)
    last = read(table, spark)
    table.compact(spark)
    assert all(len(f) == 1 for f in table.ranges.folders(table.ranges.state()).values())
    assert read(table, spark) == last and table.ranges.vacuum(keep=1) > 0 and read(table, spark) == last


def test_a_batch_touches_only_its_ranges(spark, tmp_path):
    table = TileTable(str(tmp_path / "table"), ["seq"])
    table.append(spark.range(64).selectExpr("12 AS z", "id * 64 AS x", "id * 64 AS y", "1L AS seq", "'a' AS payload"), 0)
    was = table.ranges.folders(table.ranges.state())
    assert len(was) == 32
    table.append(spark.createDataFrame([(12, 0, 0, 2, "b"), (12, 1, 1, 1, "c")], TILES), 1)
    now = table.ranges.folders(table.ranges.state())
    assert {n for n in now if now[n] != was[n]} == {"z12_0_0"} and now["z12_0_0"][0] == was["z12_0_0"][0]
    for i in range(2, 9):  # a range with many folders is merged, others stay
        table.append(spark.createDataFrame([(12, 0, 0, i + 1, "b")], TILES), i)
    now = table.ranges.folders(table.ranges.state())
    assert len(now["z12_0_0"]) <= 6 and {n for n in now if now[n] != was[n]} == {"z12_0_0"}
    assert read(table, spark)[12, 0, 0] == (9, "b")


def test_a_commit_that_does_not_end_is_not_seen(spark, tmp_path, monkeypatch):
    table = TileTable(str(tmp_path / "table"), ["seq"])
    table.append(spark.createDataFrame([(1, 0, 0, 1, "a")], TILES), 0)
    with monkeypatch.context() as m:
        m.setattr(table.ranges, "_save", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.append(spark.createDataFrame([(1, 0, 0, 2, "b")], TILES), 1)
    assert read(table, spark) == {(1, 0, 0): (1, "a")}
    table.append(spark.createDataFrame([(1, 0, 0, 2, "b")], TILES), 1)
    assert read(table, spark) == {(1, 0, 0): (2, "b")}


def test_key_index_holds_what_was_added(spark, tmp_path):
    """Bits of many zooms against a set; a batch reads its shards only; replays see the state before."""
    rng = random.Random(6)
    index, stored = KeyIndex(str(tmp_path / "index")), set()
    draw = lambda n: {(z, rng.randrange(1 << z), rng.randrange(1 << z)) for z in (0, 2, 7, 8, 15) for _ in range(n)}
    schema = "z int, x bigint, y bigint"
    assert index.missing(spark.createDataFrame([(1, 0, 0)], schema)).count() == 1
    for batch in range(5):
        keys = draw(40) | set(rng.sample(sorted(stored), min(len(stored), 20)))
        frame = spark.createDataFrame(sorted(keys), schema)
        want = keys - stored
        assert {tuple(r) for r in index.missing(frame).collect()} == want
        for _ in range(2):
            index.add(frame, batch, "s")
        assert {tuple(r) for r in index.missing(frame, index.ranges.before("s", batch)).collect()} == want
        stored |= keys
        assert index.count(spark) == len(stored) and index.missing(frame).count() == 0
    assert max(int(n[1:].split("_")[0]) for n in index.ranges.folders(index.ranges.state(), ["z2_0_0"])) == 2


def test_known_tiles_are_skipped_and_remembered(spark, tmp_path):
    source = tmp_path / "in"
    schema = "z int, x bigint, y bigint"
    index = KeyIndex(str(tmp_path / "index"))
    index.add(spark.createDataFrame([(3, 1, 1)], schema), 0)
    seen = []
    for rows in ([(3, 1, 1), (3, 2, 2)], [(3, 2, 2), (3, 4, 4)], [(3, 4, 4)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        skip_known(stream, index, lambda f, b: seen.append(sorted(r.x for r in f.collect())), str(tmp_path / "check")).awaitTermination()
    assert seen == [[2], [4], []]


def test_late_rows_are_dropped(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    schema = "ts timestamp, status int, bytes bigint"

    def feed(rows):
        frame = spark.createDataFrame(rows, "t string, status int, bytes bigint").select(F.col("t").cast("timestamp").alias("ts"), "status", "bytes")
        frame.coalesce(1).write.mode("append").parquet(str(source))
        stream = rolling_counters(spark.readStream.schema(schema).parquet(str(source)), "30 seconds", "1 minute")
        query = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(out))
        query.awaitTermination()

    feed([("2024-01-01 00:00:05", 200, 10), ("2024-01-01 00:00:20", 503, 0), ("2024-01-01 00:05:00", 0, 0)])
    feed([("2024-01-01 00:00:10", 200, 99), ("2024-01-01 00:10:00", 404, 0)])
    got = {str(r.start)[11:]: (r.ok, r.blocked, r.bytes) for r in spark.read.parquet(str(out)).collect()}
    assert got["00:00:00"] == (1, 1, 10)


def test_streams_of_other_checkpoints_add(spark, tmp_path):
    table = TileTable(str(tmp_path / "table"), ["seq"])

    def feed(source, checkpoint, rows):
        spark.createDataFrame(rows, TILES).coalesce(1).write.mode("append").parquet(str(tmp_path / source))
        stream = spark.readStream.schema(TILES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / source))
        table.start(stream, str(tmp_path / checkpoint)).awaitTermination()
        return {(r.x, r.payload) for r in table.read(spark).collect()}

    assert feed("a", "first", [(1, 0, 0, 1, "a")]) == {(0, "a")}
    assert feed("b", "second", [(1, 1, 0, 1, "b")]) == {(0, "a"), (1, "b")}
    assert feed("b", "second", [(1, 0, 0, 0, "older")]) == {(0, "a"), (1, "b")}
    # the newest row counts, whichever stream brings it and however late
    assert feed("a", "first", [(1, 0, 0, 9, "newer"), (1, 1, 0, 9, "c")]) == {(0, "newer"), (1, "c")}
    assert feed("a", "third", []) == {(0, "newer"), (1, "c")}
