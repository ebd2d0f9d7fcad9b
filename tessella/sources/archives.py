"""Tile archives (SQLite files with TMS rows) as a Spark data source.

Reading splits every archive into (file, zoom, column range) partitions. Writing
makes one archive per Spark partition, so repartition by shard first: no file ever
holds the whole world and no task writes more than its shard. Files must lie in a
folder all executors see.
"""

from __future__ import annotations

import glob
import json
import os
import sqlite3
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage,
)

from tessella.constants import UNASSIGNED_SHARD
from tessella.functions.grid import tms_flip

FORMAT = "tile_archive"
BATCH_ROWS = 1024


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


@dataclass
class Ranges(InputPartition):
    """Column ranges (path, zoom, first, last) one task reads."""

    ranges: tuple


def _archives(path: str) -> list[str]:
    path = path.removeprefix("file:")
    if os.path.isfile(path):
        return [path]
    return sorted(glob.glob(os.path.join(path, "**", "*.mbtiles"), recursive=True))


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.rows = int(options.get("rowsperpartition", 50_000))

    def partitions(self):
        """Column ranges packed to about equal row counts, from the archives' indexes."""
        parts, current, filled = [], [], 0
        for name in _archives(self.path):
            with _open(name) as conn:
                spans = conn.execute(
                    "SELECT zoom_level, MIN(tile_column), MAX(tile_column), COUNT(*) FROM tiles GROUP BY zoom_level"
                ).fetchall()
            for z, low, high, count in spans:
                pieces = max(1, min(high - low + 1, -(-count // self.rows)))
                step = -(-(high - low + 1) // pieces)
                for first in range(low, high + 1, step):
                    current.append((name, z, first, min(first + step - 1, high)))
                    filled += count / pieces
                    if filled >= self.rows:
                        parts.append(Ranges(tuple(current)))
                        current, filled = [], 0
        if current:
            parts.append(Ranges(tuple(current)))
        return parts

    def read(self, partition):
        for path, z, low, high in partition.ranges:
            yield from self._range(path, z, low, high)

    def _range(self, path, z, low, high):
        with _open(path) as conn:
            cursor = conn.execute(
                "SELECT tile_column, tile_row, tile_data FROM tiles WHERE zoom_level = ? AND tile_column BETWEEN ? AND ?",
                (z, low, high),
            )
            top = (1 << z) - 1
            while rows := cursor.fetchmany(BATCH_ROWS):
                x, row, data = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([os.path.basename(path)] * len(rows), pa.string()),
                        pa.array([z] * len(rows), pa.int32()),
                        pa.array(x, pa.int64()),
                        pa.array([top - r for r in row], pa.int64()),
                        pa.array(data, pa.binary()),
                    ],
                    names=["archive", "z", "x", "y", "payload"],
                )


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


class ArchiveWriter(DataSourceWriter):
    """Each task fills a temporary file; the commit renames them into place."""

    def __init__(self, options, overwrite):
        self.folder = options["path"].removeprefix("file:")
        self.overwrite = overwrite
        self.meta = json.loads(options.get("meta", "{}"))

    def write(self, iterator):
        path, shard, conn, zooms = None, None, None, []
        for row in iterator:
            if conn is None:
                shard = row.shard
                os.makedirs(self.folder, exist_ok=True)
                path = os.path.join(self.folder, f".{shard}-{uuid.uuid4().hex}.tmp")
                conn = sqlite3.connect(path)
                conn.execute("CREATE TABLE metadata (name text, value text)")
                conn.execute("CREATE TABLE tiles (zoom_level integer, tile_column integer, tile_row integer, tile_data blob)")
                conn.execute("CREATE UNIQUE INDEX tile_index ON tiles (zoom_level, tile_column, tile_row)")
            if row.shard != shard:
                raise ValueError("a partition must hold one shard; use write_archives")
            conn.execute("INSERT OR REPLACE INTO tiles VALUES (?, ?, ?, ?)", (row.z, row.x, row.tms_row, bytes(row.payload)))
            zooms = [min(zooms[0], row.z), max(zooms[1], row.z)] if zooms else [row.z, row.z]
        if conn is None:
            return Written("", "")
        pairs = {**self.meta, "minzoom": zooms[0], "maxzoom": zooms[1]}
        conn.executemany("INSERT INTO metadata VALUES (?, ?)", [(k, str(v)) for k, v in pairs.items()])
        conn.commit()
        conn.close()
        return Written(path, os.path.join(self.folder, f"{shard}.mbtiles"))

    def commit(self, messages):
        for message in messages:
            if message and message.temporary:
                if not self.overwrite and os.path.exists(message.final):
                    raise FileExistsError(message.final)
                os.replace(message.temporary, message.final)
        if self.overwrite and os.path.isdir(self.folder):
            fresh = {m.final for m in messages if m and m.final}
            for name in os.listdir(self.folder):
                if name.endswith(".mbtiles") and os.path.join(self.folder, name) not in fresh:
                    os.remove(os.path.join(self.folder, name))

    def abort(self, messages):
        for message in messages:
            if message and message.temporary and os.path.exists(message.temporary):
                os.remove(message.temporary)


class TileArchive(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "archive string, z int, x bigint, y bigint, payload binary"

    def reader(self, schema):
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite):
        return ArchiveWriter(self.options, overwrite)


def read_archives(spark: SparkSession, path: str, rows_per_partition: int = 50_000) -> DataFrame:
    """Tiles of one archive or of all archives in a folder, in XYZ rows."""
    spark.dataSource.register(TileArchive)
    return spark.read.format(FORMAT).option("rowsPerPartition", rows_per_partition).load(path)


def write_archives(tiles: DataFrame, path: str, shard: str = "shard", meta: dict | None = None, rows_per_file: int = 500_000) -> None:
    """Archives ``<shard>_<part>`` of about ``rows_per_file`` tiles; older archives there go.

    Big shards are split by key, so that a hot shard is no single task. Tiles without a
    shard (those above the shard zoom) are kept as ``unassigned``.
    """
    spark = tiles.sparkSession
    tiles = tiles.withColumn(shard, F.coalesce(F.col(shard), F.lit(UNASSIGNED_SHARD)))
    spark.dataSource.register(TileArchive)
    files = F.ceil(F.count("*") / rows_per_file).cast("int")
    plan = tiles.groupBy(shard).agg(files.alias("n")).collect()  # one row per shard
    first, total = {}, 0
    for row in sorted(plan, key=lambda r: str(r[0])):
        first[row[0]] = (total, row.n)
        total += row.n
    start = F.create_map(*[F.lit(v) for k, (at, _) in first.items() for v in (k, at)])[F.col(shard)]
    parts = F.create_map(*[F.lit(v) for k, (_, n) in first.items() for v in (k, n)])[F.col(shard)]
    piece = F.pmod(F.xxhash64("z", "x", "y"), parts).cast("int")
    name = F.concat_ws("_", F.col(shard), piece)
    placed = tiles.select(
        name.alias("shard"), "z", "x", tms_flip("z", "y").alias("tms_row"),
        F.col("payload").cast("binary").alias("payload"), (start + piece).alias("_p"),
    ).repartitionById(total, "_p").drop("_p")
    placed.write.format(FORMAT).mode("overwrite").option("meta", json.dumps(meta or {})).save(path)


def read_archive_meta(spark: SparkSession, path: str) -> DataFrame:
    """Metadata rows (archive, name, value), one task per archive."""
    names = _archives(path)

    def rows(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with _open(name) as conn:
                    pairs = conn.execute("SELECT name, value FROM metadata").fetchall()
                out = [(os.path.basename(name), str(k), None if v is None else str(v)) for k, v in pairs]
                columns = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["archive", "name", "value"])

    listed = spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, len(names)))
    return listed.mapInArrow(rows, "archive string, name string, value string")
