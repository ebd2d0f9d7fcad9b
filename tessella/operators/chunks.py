"""Raster operators on chunk rows: keys, z, x, y, w, h, data ARRAY<INT>.

Spark partitions, joins and groups. Groups are bounded by construction (four
children, nine halo pieces, one row per source). The grouped rows reach numpy in Arrow
batches of many tiles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.grid import shl, shr
from tessella.operators import kernels
from tessella.operators.skew import unsized
from tessella.operators.tiles import KEY, for_sources, nearest_ancestor
from tessella.session import cut_lineage

OUT_VALUES = 1_000_000  # values of one output batch; a worker holds a few arrays of this size
CUT_BITS = 4
BYTE = (0, 255)


def _types(df: DataFrame, names) -> str:
    kinds = dict(df.dtypes)
    return "".join(f"`{n}` {kinds[n]}, " for n in names)


class Ragged:
    """A list column as flat values with offsets."""

    def __init__(self, column: pa.ListArray):
        self.values = column.flatten().to_numpy(zero_copy_only=False)
        offsets = column.offsets.to_numpy()
        self.starts = offsets[:-1] - offsets[0]
        self.sizes = np.diff(offsets)

    def rows(self, index: np.ndarray) -> np.ndarray:
        """Rows of one common size as a matrix."""
        size = int(self.sizes[index[0]])
        return self.values[self.starts[index][:, None] + np.arange(size)[None, :]]


class Grouped:
    """A column of collected structs: one entry per item, with the row that owns it."""

    def __init__(self, column: pa.ListArray):
        items = column.flatten()
        counts = np.diff(column.offsets.to_numpy())
        self.n = len(column)
        self.owner = np.repeat(np.arange(self.n), counts)
        self.counts = counts
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self._items = items

    def ints(self, name: str) -> np.ndarray:
        return self._items.field(name).to_numpy(zero_copy_only=False)

    def lists(self, name: str = "data") -> Ragged:
        return Ragged(self._items.field(name))


def _list_column(matrix: np.ndarray) -> pa.ListArray:
    flat = np.ascontiguousarray(matrix, dtype=np.int32)
    offsets = np.arange(len(flat) + 1, dtype=np.int64) * flat.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.ravel()))


def _emit(batch: pa.RecordBatch, names, index: np.ndarray, w: int, h: int, matrix: np.ndarray):
    """Output batch: key columns of the given rows, a common size, the data."""
    keys = batch.select(list(names)).take(pa.array(index, pa.int64()))
    columns = list(keys.columns) + [
        pa.array(np.full(len(index), w, np.int32)),
        pa.array(np.full(len(index), h, np.int32)),
        _list_column(matrix.reshape(len(index), -1)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[*names, "w", "h", "data"])


def _runs(index: np.ndarray, width: int):
    """Cut an index so that each part stays within the output size."""
    step = max(1, OUT_VALUES // max(width, 1))
    for start in range(0, len(index), step):
        yield index[start : start + step]


def _same(*columns: np.ndarray):
    """Row indices per distinct combination of integer columns."""
    if not len(columns[0]):
        return
    table, inverse = np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)
    inverse = inverse.ravel()
    for i, values in enumerate(table):
        yield tuple(int(v) for v in values), np.flatnonzero(inverse == i)


def _gather(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.collect_list(F.struct(*fields)).alias("g"))


def explode_chunks(chunks: DataFrame, keys: list[str], value: str = "dn") -> DataFrame:
    """Chunk rows to pixel rows with the ``plane`` number of multi-plane data."""
    area = F.col("w") * F.col("h")
    return chunks.select(*keys, "w", "h", F.posexplode("data").alias("pos", value)).select(
        *keys,
        F.floor(F.col("pos") / area).cast("int").alias("plane"),
        (F.col("pos") % F.col("w")).cast("int").alias("px"),
        F.floor((F.col("pos") % area) / F.col("w")).cast("int").alias("py"),
        value,
    )


def assemble_chunks(pixels: DataFrame, keys: list[str], w: int, h: int, planes: list[str] = ("dn",)) -> DataFrame:
    """Pixel rows to dense chunks, absent pixels 0. A group is at most w*h rows."""
    planes, names = list(planes), list(keys)
    size = w * h * len(planes)

    def build(batches):
        for batch in batches:
            for part in _runs(np.arange(batch.num_rows), size):
                rows = batch.slice(int(part[0]), len(part))
                group = Grouped(rows.column("g"))
                data = np.zeros((group.n, size), np.int32)
                at = group.ints("pos")
                for i, name in enumerate(planes):
                    data[group.owner, at + i * w * h] = group.ints(name)
                yield _emit(rows, names, np.arange(group.n), w, h, data)

    placed = pixels.withColumn("pos", (F.col("py") * w + F.col("px")).cast("int"))
    fields = ["pos", *[F.col(n).cast("int").alias(n) for n in planes]]
    return _gather(placed, names, fields).mapInArrow(build, _types(pixels, names) + "w int, h int, data array<int>")


def mask_chunks(bands: DataFrame, qa: DataFrame, keys: list[str], mask: int) -> DataFrame:
    """Zero where a masked quality bit is set; a chunk without quality data passes."""
    joined = bands.join(qa.select(*keys, F.col("data").alias("qa")), keys, "left")
    bits = F.lit(mask).cast("int")
    clear = F.zip_with("data", "qa", lambda d, q: F.when(q.bitwiseAND(bits) != 0, 0).otherwise(d))
    return joined.withColumn("data", F.coalesce(clear, F.col("data"))).drop("qa")


def _halo(chunks: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Each chunk, and the border strips its eight neighbours need.

    Rows carry the target's key and (dx, dy), the sender's place as seen from the
    target. Strips are ``n`` wide, so little more than the chunks themselves moves. Chunks
    count wherever they lie: a strip to a place without a chunk is dropped by the reader.
    """
    slices = lambda step, length: {-1: slice(length - n, None), 0: slice(None), 1: slice(0, n)}[step]

    def strips(batches):
        for batch in batches:
            data = Ragged(batch.column("data"))
            x, y, w, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "w", "h"))
            for (wide, high), index in _same(w, h):
                if n > min(wide, high):
                    raise ValueError("halo wider than a chunk")
                for part in _runs(index, wide * high):
                    images = data.rows(part).reshape(-1, high, wide)
                    for dx in (-1, 0, 1):
                        for dy in (-1, 0, 1):
                            nx, ny = x[part] - dx, y[part] - dy
                            inside = (nx >= 0) & (ny >= 0)
                            cut = images[inside][:, slices(dy, high), slices(dx, wide)]
                            if not len(cut):
                                continue
                            kept = part[inside]
                            head = batch.select([*keys, "z"]).take(pa.array(kept, pa.int64()))
                            full = lambda v: pa.array(np.full(len(kept), v, np.int32))
                            yield pa.RecordBatch.from_arrays(
                                [*head.columns, pa.array(nx[inside]), pa.array(ny[inside]), full(wide), full(high),
                                 full(dx), full(dy), _list_column(cut.reshape(len(kept), -1))],
                                names=[*keys, "z", "x", "y", "w", "h", "dx", "dy", "data"],
                            )

    source = chunks.select(
        *keys, F.col("z").cast("int").alias("z"), F.col("x").cast("bigint").alias("x"),
        F.col("y").cast("bigint").alias("y"), "w", "h", "data",
    )
    return source.mapInArrow(
        strips, _types(chunks, keys) + "z int, x bigint, y bigint, w int, h int, dx int, dy int, data array<int>"
    )


EIGHT = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (dx, dy) != (0, 0)]


def _outer_corners(padded: np.ndarray, have: dict, n: int, w: int, h: int) -> None:
    """Missing corners repeat the border of the one side neighbour that is there."""
    for sx in (-1, 1):
        for sy in (-1, 1):
            cols, rows = (slice(0, n) if sx < 0 else slice(n + w, None)), (slice(0, n) if sy < 0 else slice(n + h, None))
            row, column = (n if sy < 0 else n + h - 1), (n if sx < 0 else n + w - 1)
            missing = ~have[sx, sy]
            beside = np.flatnonzero(missing & have[sx, 0])
            padded[beside, rows, cols] = padded[beside, row, cols][:, None, :]
            above = np.flatnonzero(missing & ~have[sx, 0] & have[0, sy])
            padded[above, rows, cols] = padded[above, rows, column][:, :, None]


def with_neighbours(chunks: DataFrame, keys: list[str], n: int, kernel, edge: str = "zero") -> DataFrame:
    """Apply ``kernel(padded, n)`` to chunks padded by ``n`` pixels of their neighbours.

    The kernel gets a batch (k, h + 2n, w + 2n) and returns (k, h, w). Pixels no
    neighbour provides are 0 (``zero``) or repeat the border (``nearest``). The chunks
    of a layer have one size.
    """
    names = [*keys, *KEY]
    slices = lambda step, length: {-1: slice(0, n), 0: slice(n, n + length), 1: slice(n + length, None)}[step]

    def apply(batches):
        for batch in batches:
            group = Grouped(batch.column("g"))
            data, dx, dy = group.lists(), group.ints("dx"), group.ints("dy")
            w, h = group.ints("w"), group.ints("h")
            centres = np.flatnonzero((dx == 0) & (dy == 0))
            for (wide, high), chosen in _same(w[centres], h[centres]):
                for part in _runs(centres[chosen], 4 * wide * high):
                    images = data.rows(part).reshape(-1, high, wide)
                    padded = np.pad(images, ((0, 0), (n, n), (n, n)), mode="edge" if edge == "nearest" else "constant")
                    place = np.full(group.n, -1)
                    place[group.owner[part]] = np.arange(len(part))
                    at = place[group.owner]
                    have = {}
                    for step_x, step_y in EIGHT:
                        items = np.flatnonzero((at >= 0) & (dx == step_x) & (dy == step_y))
                        have[step_x, step_y] = np.zeros(len(part), bool)
                        have[step_x, step_y][at[items]] = True
                        if len(items):
                            rows, cols = slices(step_y, high), slices(step_x, wide)
                            shape = padded[0, rows, cols].shape
                            padded[at[items], rows, cols] = data.rows(items).reshape(-1, *shape)
                    if edge == "nearest":
                        _outer_corners(padded, have, n, wide, high)
                    yield _emit(batch, names, group.owner[part], wide, high, kernel(padded, n))

    pieces = _halo(chunks, keys, n)
    grouped = _gather(pieces, names, ["dx", "dy", "w", "h", "data"])
    return grouped.mapInArrow(apply, _types(pieces, names) + "w int, h int, data array<int>")


def dilate_mask(qa: DataFrame, keys: list[str], mask: int, n: int) -> DataFrame:
    """Quality chunks to 0/1 cloud masks grown by ``n`` pixels across chunk borders."""
    bits = F.lit(mask).cast("int")
    flags = qa.withColumn("data", F.transform("data", lambda q: F.when(q.bitwiseAND(bits) != 0, 1).otherwise(0)))
    if n <= 0:
        return flags.select(*keys, *KEY, "w", "h", "data")
    grow = lambda padded, m: kernels.dilate(padded != 0, m)[:, m:-m, m:-m]
    return with_neighbours(flags, keys, n, grow)


def hillshade_chunks(elev: DataFrame, keys: list[str], cell_x, cell_y, azimuth=315.0, altitude=45.0) -> DataFrame:
    """Shaded relief with neighbours; the outer border is repeated."""
    shade = lambda padded, _: kernels.hillshade(padded.astype(np.float64), cell_x, cell_y, azimuth, altitude)
    return with_neighbours(elev, keys, 1, shade, edge="nearest")


def _compose(size: int, method: str, keep_hidden: bool):
    """Fold of each tile's layers, bottom to top."""

    def layer_images(data, items, w, h, depth, sx, sy):
        out = np.zeros((len(items), 4, size, size), np.int32)
        for (wide, high, deep), index in _same(w[items], h[items], depth[items]):
            at = items[index]
            images = data.rows(at).reshape(-1, 4, high, wide)
            if method == "nearest":
                out[index] = kernels.windows(images, deep, sx[at], sy[at], size)
            else:
                for i, item in zip(index, range(len(at))):
                    cut = kernels.window(images[item], deep, int(sx[at[item]]), int(sy[at[item]]))
                    out[i] = kernels.resize(cut, size, size, method, rgba=True, limits=BYTE)
        return out

    def fold(batches):
        for batch in batches:
            group = Grouped(batch.column("g"))
            data, order = group.lists(), group.ints("ord")
            fields = [group.ints(c) for c in ("w", "h", "depth", "sub_x", "sub_y")]
            for part in _runs(np.arange(group.n), 8 * size * size):
                place = np.full(group.n, -1)
                place[part] = np.arange(len(part))
                at = place[group.owner]
                result = np.zeros((len(part), 4, size, size), np.int32)
                empty = np.ones(len(part), bool)
                for level in np.unique(order):
                    items = np.flatnonzero((order == level) & (at >= 0))
                    if not len(items):
                        continue
                    images = layer_images(data, items, *fields)
                    rows = at[items]
                    bare = empty[rows]
                    result[rows[bare]] = images[bare]
                    if not bare.all():
                        result[rows[~bare]] = kernels.alpha_over(result[rows[~bare]], images[~bare])
                    empty[rows] = False
                shown = np.arange(len(part)) if keep_hidden else np.flatnonzero(result[:, 3].reshape(len(part), -1).max(axis=1) > 0)
                if len(shown):
                    yield _emit(batch, KEY, part[shown], size, size, result[shown])

    return fold


LAYER = ["ord", "depth", "sub_x", "sub_y", "w", "h", "data"]
TILE_SCHEMA = "z int, x bigint, y bigint, w int, h int, data array<int>"


def _folded(layers: DataFrame, size: int, method: str, keep_hidden: bool) -> DataFrame:
    typed = layers.select(
        F.col("z").cast("int").alias("z"), F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"),
        *[F.col(c).cast("bigint").alias(c) for c in ("ord", "depth", "sub_x", "sub_y", "w", "h")], "data",
    )
    return _gather(typed, KEY, LAYER).mapInArrow(_compose(size, method, keep_hidden), TILE_SCHEMA)


def _pieces(tiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """Source tiles cut into 2^k by 2^k pieces, for the k that requests need.

    A coarse tile that stands in for very many requests is thus split: each piece
    only meets the requests inside it.
    """
    on = ["src", "anc_z", "anc_x", "anc_y"]
    named = tiles.select(
        "src", F.col("z").alias("anc_z"), F.col("x").alias("anc_x"), F.col("y").alias("anc_y"), "w", "h", "data"
    )
    needed = named.join(unsized(wanted), on).select(*on, "bits", "w", "h", "data")
    names = [*on, "bits"]

    def cut(batches):
        for batch in batches:
            data = Ragged(batch.column("data"))
            w, h, bits = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("w", "h", "bits"))
            for (wide, high, k), index in _same(w, h, bits):
                n = 1 << k
                for part in _runs(index, 4 * wide * high):
                    images = data.rows(part).reshape(len(part), -1, n, high // n, n, wide // n)
                    parts = images.transpose(0, 2, 4, 1, 3, 5).reshape(len(part) * n * n, -1)
                    rows = np.repeat(part, n * n)
                    out = _emit(batch, names, rows, wide // n, high // n, parts)
                    by, bx = np.divmod(np.tile(np.arange(n * n), len(part)), n)
                    yield pa.RecordBatch.from_arrays(
                        [*out.columns, pa.array(bx.astype(np.int64)), pa.array(by.astype(np.int64))],
                        names=[*out.schema.names, "bx", "by"],
                    )

    return needed.mapInArrow(cut, _types(needed, names) + "w int, h int, data array<int>, bx bigint, by bigint")


def overzoom_stack(requests: DataFrame, tiles: DataFrame, sources: list[int], size: int, method="nearest") -> DataFrame:
    """Compose requested tiles from an ordered stack of sources, filling by overzoom.

    ``tiles`` are RGBA chunks with ``src``; ``sources`` lists them bottom to top. Each
    source gives its tile or the matching window of its nearest ancestor; layers are
    put over one another in order. Requests without any visible data get no tile.
    A tile is cut at most as often as its width and height can be halved.
    """
    both = F.col("w").bitwiseOR(F.col("h"))
    tiles = tiles.filter(F.col("src").isin(*sources)).withColumn("halvings", F.round(F.log2(both.bitwiseAND(-both))).cast("int"))
    hits = nearest_ancestor(for_sources(requests.select(*KEY), sources), tiles, ["src"], "halvings")
    depth = (F.col("z") - F.col("anc_z")).cast("int")
    # pieces matter to neighbouring kernels, so only nearest cuts below whole tiles
    bits = F.least(F.floor(depth / CUT_BITS) * CUT_BITS, F.col("halvings")) if method == "nearest" else F.lit(0)
    hits = hits.withColumn("bits", bits.cast("int")).withColumn("depth", depth - F.col("bits"))
    hits = hits.withColumns({"bx": shr("off_x", "depth"), "by": shr("off_y", "depth")})
    hits = hits.withColumns(
        {"sub_x": F.col("off_x") - shl("bx", "depth"), "sub_y": F.col("off_y") - shl("by", "depth")}
    )
    on = ["src", "anc_z", "anc_x", "anc_y", "bits"]
    pieces = _pieces(tiles, hits.select(*on).distinct())
    ord_of = F.element_at(F.create_map(*[F.lit(v) for i, s in enumerate(sources) for v in (s, i)]), F.col("src"))
    layers = unsized(hits).join(pieces, [*on, "bx", "by"]).withColumn("ord", ord_of)
    return _folded(layers, size, method, keep_hidden=False)


def composite_tiles(base: DataFrame, overlay: DataFrame, size: int, method="nearest") -> DataFrame:
    """Alpha-composite an overlay tile set over a base, all at one tile size.

    Unlike a merge by key, transparent overlay pixels let the base show through.
    Tiles of only one side are kept, resized to the common size.
    """
    side = lambda df, i: df.select(
        *KEY, "w", "h", "data", F.lit(i).alias("ord"), *[F.lit(0).alias(c) for c in ("depth", "sub_x", "sub_y")]
    )
    return _folded(side(base, 0).unionByName(side(overlay, 1)), size, method, keep_hidden=True)


def _parents(chunks: DataFrame, keys: list[str], finish, background, size) -> DataFrame:
    """Group four children by parent and finish their 2x2 canvases (k, planes, 2h, 2w)."""
    names = [*keys, *KEY]
    children = chunks.filter(F.col("z") > 0).select(
        *keys,
        (F.col("z") - 1).cast("int").alias("z"),
        F.floor(F.col("x") / 2).alias("x"),
        F.floor(F.col("y") / 2).alias("y"),
        (F.col("x") % 2).cast("int").alias("qx"),
        (F.col("y") % 2).cast("int").alias("qy"),
        "w",
        "h",
        "data",
    )

    def build(batches):
        for batch in batches:
            group = Grouped(batch.column("g"))
            data, qx, qy, w, h = group.lists(), *(group.ints(c) for c in ("qx", "qy", "w", "h"))
            planes = data.sizes // (w * h)
            # children of several sizes take the largest, unless a size is given
            gw, gh = np.zeros(group.n, np.int64), np.zeros(group.n, np.int64)
            gp = np.zeros(group.n, np.int64)
            for target, values in ((gw, w), (gh, h), (gp, planes)):
                np.maximum.at(target, group.owner, values)
            if size:
                gw[:], gh[:] = size
            for (wide, high, p), index in _same(gw, gh, gp):
                fill = np.zeros(p, np.int32) if background is None else np.broadcast_to(np.asarray(background, np.int32), (p,))
                for part in _runs(index, 4 * p * wide * high):
                    canvas = np.empty((len(part), p, 2 * high, 2 * wide), np.int32)
                    canvas[:] = fill[None, :, None, None]
                    place = np.full(group.n, -1)
                    place[part] = np.arange(len(part))
                    at = place[group.owner]
                    for (cx, cy, cw, ch), chosen in _same(qx, qy, w, h):
                        items = chosen[at[chosen] >= 0]
                        if not len(items):
                            continue
                        images = data.rows(items).reshape(-1, p, ch, cw)
                        if (ch, cw) != (high, wide):
                            images = np.stack([kernels.resize(i, high, wide) for i in images])
                        canvas[at[items], :, cy * high : (cy + 1) * high, cx * wide : (cx + 1) * wide] = images
                    done = finish(canvas)
                    yield _emit(batch, names, part, done.shape[3], done.shape[2], done)

    grouped = _gather(children, names, ["qx", "qy", "w", "h", "data"])
    return grouped.mapInArrow(build, _types(children, names) + "w int, h int, data array<int>")


def stitch(chunks: DataFrame, keys: list[str], background=None, size: tuple[int, int] | None = None) -> DataFrame:
    """Double-size tiles one zoom coarser: the 2x2 mosaic of the children.

    West and north children have even x and y; a missing child leaves the background
    (one value per plane). Zoom 0 has no parent.
    """
    return _parents(chunks, keys, lambda canvas: canvas, background, size)


def overview(
    chunks: DataFrame, keys: list[str], method: str = "average", rgba: bool = False, nodata: int | None = None,
    limits: tuple[int, int] | None = None,
) -> DataFrame:
    """Next coarser zoom at the same tile size.

    ``rgba`` weights colours by alpha; ``nodata`` is left out of averages and modes, and
    fills the place of a missing child; ``limits`` bound what smooth kernels overshoot.
    """
    finish = lambda canvas: kernels.halve(canvas, method, rgba, nodata, limits)
    return _parents(chunks, keys, finish, nodata, None)


def pyramid(
    chunks: DataFrame, keys: list[str], zmax: int, zmin: int, method: str = "average", checkpoint: bool = True,
    rgba: bool = False, nodata: int | None = None, limits: tuple[int, int] | None = None,
) -> DataFrame:
    """All zooms from ``zmax`` to ``zmin``.

    Every level is both output and input of the next, so it is checkpointed: work is
    done once per level, each a quarter of the one before, and a lost executor
    costs one level.
    """
    kept = cut_lineage if checkpoint and zmax > zmin else lambda df: df
    level = kept(chunks.filter(F.col("z") == zmax).select(*keys, F.col("z").cast("int").alias("z"), "x", "y", "w", "h", "data"))
    out = level
    for _ in range(zmax - zmin):
        level = kept(overview(level, keys, method, rgba, nodata, limits))
        out = out.unionByName(level)
    return out


def resize_chunks(
    chunks: DataFrame, w: int, h: int, method: str = "nearest", rgba: bool = False, limits: tuple[int, int] | None = None,
) -> DataFrame:
    """Every chunk to one size; planes are kept. See ``kernels.resize`` for the last two."""
    names = [c for c in chunks.columns if c not in ("w", "h", "data")]

    def run(batches):
        for batch in batches:
            data = Ragged(batch.column("data"))
            ws, hs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("w", "h"))
            for (wide, high, length), index in _same(ws, hs, data.sizes):
                p = length // (wide * high)
                for part in _runs(index, p * max(w * h, wide * high)):
                    images = data.rows(part).reshape(-1, p, high, wide)
                    if method == "nearest":
                        rows, cols = np.arange(h) * high // h, np.arange(w) * wide // w
                        done = images[:, :, rows][:, :, :, cols]
                    else:
                        done = np.stack([kernels.resize(i, h, w, method, rgba, limits) for i in images])
                    yield _emit(batch, names, part, w, h, done)

    return chunks.select(*names, "w", "h", "data").mapInArrow(run, _types(chunks, names) + "w int, h int, data array<int>")


def panels_to_chunks(panels: DataFrame, keys: list[str]) -> DataFrame:
    """Panels laid out on one canvas: (col, row) of a panel become its chunk position.

    A single panel passes through; nothing is copied, since a canvas of chunks is the
    union of its panels.
    """
    return panels.select(
        *keys, F.col("col").cast("bigint").alias("x"), F.col("row").cast("bigint").alias("y"), "w", "h", "data"
    )
