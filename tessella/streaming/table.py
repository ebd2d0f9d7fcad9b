"""Tile tables and key indexes that take micro-batches by key ranges.

Keys are ordered by zoom and z-order. A range is one square of ``DEPTH`` zoom levels under a
tile, so it holds 4 ** ``DEPTH`` keys at most. A table is a folder of immutable files and of
manifests: a root names the state of each group of ranges, a group names the live folders of
each range. A commit writes new files, new manifests of the groups it touches, and last the
root of the next version by one move, so readers see one version whole. Roots also record the
last batch of each stream and the version before it, so a replayed batch changes nothing.
A table has one writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessella.functions.grid import shl, shr
from tessella.operators.skew import unsized
from tessella.operators.tiles import KEY, last_wins

DEPTH = 7
GROUPS = 256
DELTAS = 6  # folders of a range before it is merged into one
SHARD = 5  # levels of ranges that lie in one folder of a key index


def stream_name(checkpoint: str) -> str:
    """A stream is known by its checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def range_of(depth: int = DEPTH) -> Column:
    """Name of a key's range: its zoom and the tile ``depth`` levels above it."""
    up = F.least("z", F.lit(depth)).cast("int")
    return F.concat(F.lit("z"), F.concat_ws("_", "z", shr(F.col("x"), up), shr(F.col("y"), up)))


def place_in_range() -> Column:
    """Position of a key in its range, in z-order: the low bits of x and y in turn."""
    bit = lambda value, i: F.shiftright(F.col(value).cast("bigint"), i).bitwiseAND(F.lit(1))
    place = F.lit(0).cast("bigint")
    for i in range(DEPTH):
        place = place + F.shiftleft(bit("x", i), 2 * i) + F.shiftleft(bit("y", i), 2 * i + 1)
    low = F.least("z", F.lit(DEPTH)).cast("int")
    return place.bitwiseAND(shl(F.lit(1).cast("bigint"), 2 * low) - 1)


class Ranges:
    """Folders per range under versioned manifests."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.fs, self.root = arrow_fs.FileSystem.from_uri(self.path)

    def _load(self, name: str) -> dict:
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return json.loads(f.read())

    def _save(self, name: str, value: dict) -> None:
        """Whole or not at all: written aside, then moved."""
        place = f"{self.root}/{name}"
        self.fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
        aside = f"{place}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(aside) as f:
            f.write(json.dumps(value).encode())
        self.fs.move(aside, place)

    def versions(self) -> list[int]:
        found = self.fs.get_file_info(arrow_fs.FileSelector(f"{self.root}/roots", allow_not_found=True))
        names = [f.base_name for f in found]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def state(self, version: int | None = None) -> dict:
        """The root of a version, by default the newest."""
        known = self.versions()
        if version == -1 or (version is None and not known):
            return {"version": -1, "groups": {}, "batches": {}}
        return self._load(f"roots/{known[-1] if version is None else version:012d}.json")

    def before(self, stream: str, batch: int) -> dict:
        """The state a batch has to see: that before its own commit, if it was committed."""
        now = self.state()
        done = now["batches"].get(stream)
        return self.state(done["before"]) if done and done["batch"] == batch else now

    @staticmethod
    def _group(name: str) -> str:
        return f"{int(hashlib.sha256(name.encode()).hexdigest()[:8], 16) % GROUPS:03d}"

    def folders(self, state: dict, names: list[str] | None = None) -> dict[str, list[str]]:
        """Live folders per range, oldest first, of some ranges or of all."""
        groups = state["groups"] if names is None else {g: state["groups"][g] for g in {self._group(n) for n in names} if g in state["groups"]}
        found = {}
        for manifest in groups.values():
            found |= self._load(manifest)
        return found if names is None else {n: found[n] for n in names if n in found}

    def read(self, spark: SparkSession, folders: dict[str, list[str]]) -> DataFrame | None:
        paths = [f"{self.path}/{folder}" for listed in folders.values() for folder in listed]
        return spark.read.option("basePath", f"{self.path}/data").parquet(*paths) if paths else None

    def write(self, rows: DataFrame) -> dict[str, str]:
        """New folders of the rows, by their column ``range``."""
        name = f"data/commit={uuid.uuid4().hex}"
        rows.repartition("range").write.partitionBy("range").parquet(f"{self.path}/{name}")
        made = self.fs.get_file_info(arrow_fs.FileSelector(f"{self.root}/{name}", allow_not_found=True))
        return {f.base_name.removeprefix("range="): f"{name}/{f.base_name}" for f in made if f.base_name.startswith("range=")}

    def commit(self, state: dict, changed: dict[str, list[str]], stream: str | None = None, batch: int = 0) -> dict:
        """The next version, with other folders for some ranges."""
        version, groups = state["version"] + 1, dict(state["groups"])
        by_group: dict[str, dict] = {}
        for name, listed in changed.items():
            by_group.setdefault(self._group(name), {})[name] = listed
        for group, fresh in by_group.items():
            whole = (self._load(groups[group]) if group in groups else {}) | fresh
            groups[group] = f"groups/{group}-{version:012d}-{uuid.uuid4().hex}.json"
            self._save(groups[group], whole)
        batches = dict(state["batches"])
        if stream is not None:
            batches[stream] = {"batch": batch, "before": state["version"]}
        root = {"version": version, "groups": groups, "batches": batches}
        self._save(f"roots/{version:012d}.json", root)
        return root

    def done(self, state: dict, stream: str, batch: int) -> bool:
        return state["batches"].get(stream, {"batch": -1})["batch"] >= batch

    def vacuum(self, keep: int = 10) -> int:
        """Drop versions but the last ``keep`` and what no remaining one names."""
        known = self.versions()
        for version in known[:-keep]:
            self.fs.delete_file(f"{self.root}/roots/{version:012d}.json")
        states = [self.state(v) for v in known[-keep:]]
        manifests = {m for s in states for m in s["groups"].values()}
        live = {folder for m in manifests for listed in self._load(m).values() for folder in listed}
        dropped = 0
        for info in self.fs.get_file_info(arrow_fs.FileSelector(f"{self.root}/groups", allow_not_found=True)):
            if f"groups/{info.base_name}" not in manifests:
                self.fs.delete_file(info.path)
        for commit in self.fs.get_file_info(arrow_fs.FileSelector(f"{self.root}/data", allow_not_found=True)):
            for info in self.fs.get_file_info(arrow_fs.FileSelector(commit.path)):
                if info.base_name.startswith("range=") and f"data/{commit.base_name}/{info.base_name}" not in live:
                    self.fs.delete_dir(info.path)
                    dropped += 1
        return dropped


class TileTable:
    """Tiles by key, the newest row of each by ``order``, fed by micro-batches.

    A batch adds one folder to each range it touches and leaves all others alone. A range
    with more than ``DELTAS`` folders is merged into one. Rows older than the stored ones,
    replayed batches and streams that start again change nothing that is read.
    """

    def __init__(self, path: str, order: list[str], keys: tuple[str, ...] = tuple(KEY)):
        self.ranges, self.order, self.keys = Ranges(path), list(order), list(keys)

    def append(self, batch: DataFrame, batch_id: int, stream: str = "direct") -> None:
        state = self.ranges.state()
        if self.ranges.done(state, stream, batch_id):
            return
        fresh = self.ranges.write(last_wins(batch, self.order, self.keys).withColumn("range", range_of()))
        listed = self.ranges.folders(state, list(fresh))
        changed = {name: [*listed.get(name, []), folder] for name, folder in fresh.items()}
        state = self.ranges.commit(state, changed, stream, batch_id)
        long = {n: f for n, f in changed.items() if len(f) > DELTAS}
        if long:
            self._merge(batch.sparkSession, state, long)

    def _merge(self, spark: SparkSession, state: dict, folders: dict[str, list[str]]) -> None:
        rows = self.ranges.read(spark, folders).drop("commit", "range")
        merged = self.ranges.write(last_wins(rows, self.order, self.keys).withColumn("range", range_of()))
        self.ranges.commit(state, {n: [f] for n, f in merged.items()})

    def compact(self, spark: SparkSession) -> None:
        """Every range with several folders into one."""
        state = self.ranges.state()
        several = {n: f for n, f in self.ranges.folders(state).items() if len(f) > 1}
        if several:
            self._merge(spark, state, several)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The newest row of each key, in one version."""
        rows = self.ranges.read(spark, self.ranges.folders(self.ranges.state(version)))
        return None if rows is None else last_wins(rows.drop("commit", "range"), self.order, self.keys)

    def start(self, tiles: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        stream = stream_name(checkpoint)
        return (
            tiles.writeStream.foreachBatch(lambda batch, batch_id: self.append(batch, batch_id, stream))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


class KeyIndex:
    """Which keys are stored: a bitmap over the z-order places of each range.

    Bitmaps of neighbouring ranges share a folder (a shard). A batch reads and rewrites the
    shards it touches; whether a key is stored is one bit of its range's bitmap, so the
    stored tiles themselves are never read.
    """

    def __init__(self, path: str):
        self.ranges = Ranges(path)

    @staticmethod
    def _placed(tiles: DataFrame) -> DataFrame:
        return tiles.withColumns({"_shard": range_of(DEPTH + SHARD), "_range": range_of(), "_place": place_in_range()})

    def _bitmaps(self, spark: SparkSession, state: dict, shards: list[str]) -> DataFrame | None:
        rows = self.ranges.read(spark, self.ranges.folders(state, shards))
        return None if rows is None else rows.select(F.col("name").alias("_range"), "bits")

    @staticmethod
    def _shards(placed: DataFrame) -> list[str]:
        return [r[0] for r in placed.select("_shard").distinct().collect()]

    def add(self, tiles: DataFrame, batch_id: int, stream: str = "direct") -> None:
        state = self.ranges.state()
        if self.ranges.done(state, stream, batch_id):
            return
        placed = self._placed(tiles.select(*KEY))
        fresh = placed.groupBy("_range", "_shard").agg(F.bitmap_construct_agg("_place").alias("bits"))
        known = self.ranges.read(tiles.sparkSession, self.ranges.folders(state, self._shards(placed)))
        both = fresh.select(F.col("_range").alias("name"), F.col("_shard").alias("range"), "bits")
        if known is not None:
            both = both.unionByName(known.select("name", F.col("range").cast("string").alias("range"), "bits"))
        written = self.ranges.write(both.groupBy("range", "name").agg(F.bitmap_or_agg("bits").alias("bits")))
        self.ranges.commit(state, {n: [f] for n, f in written.items()}, stream, batch_id)

    def missing(self, tiles: DataFrame, state: dict | None = None) -> DataFrame:
        """The rows whose keys are not stored."""
        placed = self._placed(tiles)
        bitmaps = self._bitmaps(tiles.sparkSession, state or self.ranges.state(), self._shards(placed))
        if bitmaps is None:
            return tiles
        byte = F.substring("bits", (F.col("_place") / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        stored = value.bitwiseAND(shl(F.lit(1), (F.col("_place") % 8).cast("int"))) != 0
        joined = unsized(placed).join(bitmaps, "_range", "left")
        return joined.filter(~F.coalesce(stored, F.lit(False))).select(*tiles.columns)

    def count(self, spark: SparkSession) -> int:
        rows = self.ranges.read(spark, self.ranges.folders(self.ranges.state()))
        return 0 if rows is None else rows.agg(F.sum(F.bitmap_count("bits"))).first()[0]


def skip_known(tiles: DataFrame, index: KeyIndex, sink, checkpoint: str, remember: bool = True, **trigger) -> StreamingQuery:
    """Pass on tiles that are not stored yet, and remember them.

    ``sink(frame, batch_id)`` takes the rows of a batch that the index did not hold before
    it, also when the batch is replayed; it must accept replays.
    """
    stream = stream_name(checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        fresh = index.missing(batch, index.ranges.before(stream, batch_id))
        sink(fresh, batch_id)
        if remember:
            index.add(fresh, batch_id, stream)
        batch.unpersist()

    return (
        tiles.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
