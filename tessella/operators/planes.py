"""Chunk forms of the operators that work pixel by pixel: one row in, one row out.

Only the box crop and the blend look beyond a single chunk: the crop at its place on the
map, the blend at the chunk of the other layer with the same key.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.grid import Box, tile_range
from tessella.operators.chunks import Ragged, _emit, _runs, _same, _types


def map_planes(chunks: DataFrame, keys: list[str], kernel, place: bool = False) -> DataFrame:
    """Apply ``kernel(images)`` to batches (k, planes, h, w) of chunks of one size.

    With ``place`` the kernel also gets z, x and y of the batch's chunks.
    """
    names = list(keys)

    def run(batches):
        for batch in batches:
            data = Ragged(batch.column("data"))
            w, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("w", "h"))
            at = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("z", "x", "y")] if place else []
            for (wide, high, length), index in _same(w, h, data.sizes):
                if not length or not wide * high:
                    continue
                for part in _runs(index, 4 * int(length)):
                    done = kernel(data.rows(part).reshape(len(part), -1, high, wide), *(c[part] for c in at))
                    yield _emit(batch, names, part, wide, high, np.asarray(done, np.int32))

    return chunks.select(*names, "w", "h", "data").mapInArrow(run, _types(chunks, names) + "w int, h int, data array<int>")


def nodata_alpha_chunks(chunks: DataFrame, keys: list[str], nodata: int = 0) -> DataFrame:
    """Chunks with one more plane: 0 where all planes are nodata, else 255."""

    def with_alpha(images):
        alpha = np.where((images == nodata).all(axis=1, keepdims=True), 0, 255)
        return np.concatenate([images, alpha], axis=1)

    return map_planes(chunks, keys, with_alpha)


def color_relief_chunks(chunks: DataFrame, keys: list[str], ramp) -> DataFrame:
    """Elevation chunks to RGBA by a ramp of (depth, r, g, b), linear between stops."""
    stops = np.array(sorted(tuple(map(float, s[:4])) for s in ramp if len(s) >= 4))
    if not len(stops) or len(stops) < len(list(ramp)):
        raise ValueError("ramp stops need a depth and three colour parts")

    def colours(images):
        parts = [np.floor(np.interp(images[:, 0], stops[:, 0], stops[:, i]) + 0.5) for i in (1, 2, 3)]
        return np.stack([*parts, np.full(images[:, 0].shape, 255)], axis=1)

    return map_planes(chunks, keys, colours)


def band_stack_chunks(chunks: DataFrame, keys: list[str], bands, band: str = "band") -> DataFrame:
    """One chunk of a plane per band, where all the bands are there.

    Each band is one side of a join by key, so no payload goes through an aggregate.
    """
    on = [*keys, "w", "h"]
    sides = [chunks.filter(F.col(band) == b).select(*on, F.col("data").alias(f"p{i}")) for i, b in enumerate(bands)]
    joined = reduce(lambda a, b: a.join(b, on), sides)
    return joined.select(*on, F.concat(*[f"p{i}" for i in range(len(sides))]).alias("data"))


def crop_box_chunks(chunks: DataFrame, keys: list[str], box: Box, z: int, nodata: int = 0) -> DataFrame:
    """Chunks of one zoom that meet a box; pixels whose centre lies outside are nodata."""
    span = tile_range(*[F.lit(float(v)) for v in box], F.lit(z), "corner")
    near = chunks.filter((F.col("z") == z) & F.col("x").between(span.xmin, span.xmax) & F.col("y").between(span.ymin, span.ymax))

    def cut(images, zoom, x, y):
        _, _, high, wide = images.shape
        across = 2.0 ** zoom[:, None]
        lon = (x[:, None] + (np.arange(wide) + 0.5) / wide) / across * 360.0 - 180.0
        lat = np.degrees(np.arctan(np.sinh(np.pi * (1.0 - 2.0 * (y[:, None] + (np.arange(high) + 0.5) / high) / across))))
        inside = ((lat >= box.miny) & (lat <= box.maxy))[:, :, None] & ((lon >= box.minx) & (lon <= box.maxx))[:, None, :]
        return np.where(inside[:, None], images, nodata)

    return map_planes(near, keys, cut, place=True)


def blend_chunks(base: DataFrame, overlay: DataFrame, keys: list[str], opacity: float) -> DataFrame:
    """A * (1 - o) + B * o of chunks with one key and size, as doubles; the opacity is clamped."""
    o = max(0.0, min(1.0, opacity))
    on = [*keys, "w", "h"]
    joined = base.select(*on, F.col("data").alias("a")).join(overlay.select(*on, F.col("data").alias("b")), on)

    def mix(batches):
        for batch in batches:
            a, b = Ragged(batch.column("a")), Ragged(batch.column("b"))
            mixed = np.zeros(0) if not len(a.values) else a.values * (1.0 - o) + b.values * o
            offsets = np.concatenate([[0], np.cumsum(a.sizes)]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(mixed))
            yield pa.RecordBatch.from_arrays([*batch.select(on).columns, column], names=[*on, "data"])

    same = joined.filter(F.size("a") == F.size("b"))
    return same.mapInArrow(mix, _types(joined, on) + "data array<double>")
