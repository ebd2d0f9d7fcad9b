"""Splitting a weighted grid into rectangles of similar weight."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.chunks import Grouped
from tessella.operators.skew import BROADCAST_ROWS, unsized
from tessella.session import cut_lineage, inline_table

GROUP_VALUES = 4_000_000  # values of one group of the second scan


def best_cut(lines: DataFrame, by: list[str], line: str, weight: str, *,
             share_num=None, share_den=None, low: str | None = None, high: str | None = None) -> DataFrame:
    """Line whose running weight comes closest to a share of the total, per group.

    The lowest line wins ties. ``low`` and ``high`` bound the lines allowed. A group
    holds one row per grid line, however many cells there are.
    """
    order = Window.partitionBy(*by).orderBy(line)
    every = Window.partitionBy(*by)
    running = F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(weight).over(every)
    num = F.lit(share_num) if isinstance(share_num, float) else F.col(share_num)
    den = F.lit(share_den) if isinstance(share_den, float) else F.col(share_den)
    gaps = lines.withColumn("gap", F.abs(running - total * num / den))
    if low:
        gaps = gaps.filter(F.col(line).between(F.col(low), F.col(high)))
    picked = gaps.groupBy(*by).agg(F.min(F.struct("gap", line)).alias("b"))
    return picked.select(*by, F.col(f"b.{line}").alias("cut"), F.col("b.gap").alias("gap"))


Extent = tuple[int, int, int, int]


class PrefixSums:
    """Summed-area table of a weighted grid: per line x, strips of the sums over all cells
    up to (x, y).

    Two scans build it: along y inside each grid line, then along x inside each strip of
    columns. A group is one line, or one strip of ``GROUP_VALUES`` values. The table is
    stored, so the cells are read once however often sums are looked up.
    """

    def __init__(self, grid: DataFrame, extent: Extent):
        self.extent = x0, y0, x1, y1 = extent
        lines, height = x1 - x0 + 1, y1 - y0 + 1
        self.strip = strip = max(1, min(256, GROUP_VALUES // lines))
        whole = dict(grid.dtypes)["w"] in ("tinyint", "smallint", "int", "bigint")
        self.kind = "bigint" if whole else "double"
        number = np.int64 if whole else np.float64
        target = pa.int64() if whole else pa.float64()
        schema = f"x bigint, strip bigint, sums array<{self.kind}>"

        def rows(xs, strips, parts):
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(p) for p in parts]), pa.int32()), pa.array(np.concatenate(parts), target))
            return pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(strips, pa.int64()), lists], names=["x", "strip", "sums"])

        def along_y(batches):
            for batch in batches:
                group = Grouped(batch.column("g"))
                ys, ws = group.ints("y"), group.ints("w")
                for x, first, n in zip(batch.column("x").to_pylist(), group.first.tolist(), group.counts.tolist()):
                    line = np.zeros(height, number)
                    np.add.at(line, ys[first:first + n] - y0, ws[first:first + n])
                    line = line.cumsum()
                    cuts = range(0, height, strip)
                    yield rows([x] * len(cuts), [c // strip for c in cuts], [line[c:c + strip] for c in cuts])

        def along_x(batches):
            for batch in batches:
                for row in range(batch.num_rows):
                    number_of = batch.column("strip")[row].as_py()
                    width = min(strip, height - number_of * strip)
                    table = np.zeros((lines, width), number)
                    group = Grouped(batch.column("g").slice(row, 1))
                    at, parts = group.ints("x") - x0, group.lists("sums")
                    table[at] = parts.rows(np.arange(len(at)))
                    table = table.cumsum(axis=0)
                    for start in range(0, lines, 4096):
                        part = table[start:start + 4096]
                        yield rows(np.arange(start, start + len(part)) + x0, [number_of] * len(part), list(part))

        inside = F.col("x").between(x0, x1) & F.col("y").between(y0, y1)
        cells = grid.filter(inside).select(F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"), F.col("w").cast(self.kind).alias("w"))
        by_line = cells.groupBy("x").agg(F.collect_list(F.struct("y", "w")).alias("g")).mapInArrow(along_y, schema)
        by_strip = by_line.groupBy("strip").agg(F.collect_list(F.struct("x", "sums")).alias("g"))
        self.table = cut_lineage(by_strip.mapInArrow(along_x, schema))

    def at(self, points: DataFrame, keys: list[str], count: int | None = None) -> DataFrame:
        """Signed sums of points (px, py, sign) per key; points before the grid count 0.

        ``count`` is the number of points where it is known; few of them go to the table.
        """
        x0, y0, _, _ = self.extent
        place = F.col("py") - y0
        asked = points.filter((F.col("px") >= x0) & (F.col("py") >= y0)).select(
            *keys, "sign", F.col("px").cast("bigint").alias("x"), F.floor(place / self.strip).alias("strip"), (place % self.strip).cast("int").alias("_at")
        )
        few = count is not None and count <= BROADCAST_ROWS
        found = self.table.join(F.broadcast(asked) if few else unsized(asked), ["x", "strip"])
        return found.groupBy(*keys).agg(F.sum(F.col("sign") * F.get("sums", F.col("_at"))).alias("sum"))


def _line_points(boxes: DataFrame) -> DataFrame:
    """Points whose signed sums are the weights of a box up to each of its lines.

    The line before the first one gives what lies before the box.
    """
    first = F.when(F.col("on_x"), F.col("x0")).otherwise(F.col("y0"))
    last = F.when(F.col("on_x"), F.col("x1")).otherwise(F.col("y1"))
    lines = boxes.withColumn("line", F.explode(F.sequence(first - 1, last)))
    point = lambda px, py, sign: F.struct(px.alias("px"), py.alias("py"), F.lit(sign).alias("sign"))
    line, before_x, before_y = F.col("line"), F.col("x0") - 1, F.col("y0") - 1
    across = F.array(point(line, F.col("y1"), 1), point(line, before_y, -1))
    along = F.array(point(F.col("x1"), line, 1), point(before_x, line, -1))
    return lines.select("path", "line", F.inline(F.when(F.col("on_x"), across).otherwise(along)))


def _cuts(sums: PrefixSums, boxes: DataFrame, points: int) -> DataFrame:
    """(path, cut, part, total) of each open box: its line closest to the share, lowest on ties."""
    upto = sums.at(_line_points(boxes), ["path", "line"], points).join(boxes, "path")
    first = F.when(F.col("on_x"), F.col("x0")).otherwise(F.col("y0"))
    last = F.when(F.col("on_x"), F.col("x1")).otherwise(F.col("y1"))
    every = Window.partitionBy("path")  # one row per grid line of the box
    base = F.coalesce(F.max(F.when(F.col("line") == first - 1, F.col("sum"))).over(every), F.lit(0))
    total = F.max(F.when(F.col("line") == last, F.col("sum"))).over(every) - base
    gaps = upto.withColumns({"part": F.col("sum") - base, "total": total}).filter(F.col("line").between(F.col("lo"), F.col("hi")))
    gap = F.abs(F.col("part") - F.col("total") * F.col("left") / F.col("leaves"))
    picked = gaps.groupBy("path", "total").agg(F.min(F.struct(gap.alias("gap"), "line", "part")).alias("b"))
    return picked.select("path", F.col("b.line").alias("cut"), F.col("b.part").alias("part"), "total")


class Partition:
    """Leaves (path, x0, y0, x1, y1, weight) of a split grid, and its tree of cuts."""

    def __init__(self, leaves: list[tuple], cuts: dict[str, tuple[bool, int]]):
        self.leaves = sorted(leaves)
        self.cuts = cuts

    def leaf_at(self, x: Column, y: Column) -> Column:
        """Number of the leaf that holds a cell: a walk down the tree in one expression."""
        if not self.cuts:
            return F.lit(0)
        leaf = {row[0]: -1 - i for i, row in enumerate(self.leaves)}
        paths = sorted(self.cuts)
        node = {path: i for i, path in enumerate(paths)}
        child = lambda path: node[path] if path in node else leaf[path]
        table = lambda values: F.array(*map(F.lit, values))
        on_x, cut = table([self.cuts[p][0] for p in paths]), table([self.cuts[p][1] for p in paths])
        low, high = (table([child(p + side) for p in paths]) for side in "01")
        depth = max(map(len, paths)) + 1

        def step(at, _):
            line = F.when(F.get(on_x, at), x).otherwise(y)
            return F.when(at < 0, at).when(line <= F.get(cut, at), F.get(low, at)).otherwise(F.get(high, at))

        return (-1 - F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(node[""]), step)).cast("int")


def split_grid(grid: DataFrame, n: int, extent: Extent) -> Partition:
    """``n`` rectangles over a dense weighted grid (x, y, w) by recursive bisection.

    The longer axis splits (x when equal), the left part gets n//2 leaves and its share of
    the weight, each side keeps a line per leaf, the lowest line wins ties. All boxes of a
    level split at once. Their line weights are looked up in the summed-area table, one row
    per line; only the table of boxes (at most ``n`` rows) passes the driver.
    """
    x0, y0, x1, y1 = extent
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        total = grid.filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).agg(F.sum("w")).first()[0]
        return Partition([("", *extent, total or 0)], {})
    sums, leaves, cuts = PrefixSums(grid, extent), [], {}
    boxes = [("", x0, y0, x1, y1, n)]
    while boxes:
        splits = []
        for path, bx0, by0, bx1, by1, count in boxes:
            width, height, left = bx1 - bx0 + 1, by1 - by0 + 1, count // 2
            on_x = (width >= height and width >= count) or height < count
            a, b = (bx0, bx1) if on_x else (by0, by1)
            first, last = a + left - 1, b - (count - left)
            if first > last:
                raise ValueError(f"{count} regions need as many lines; the box at {bx0}, {by0} has {b - a + 1}")
            splits.append((path, bx0, by0, bx1, by1, count, left, on_x, first, last))
        names = ["path", "x0", "y0", "x1", "y1", "leaves", "left", "on_x", "lo", "hi"]
        points = sum(2 * (2 + (x1 - x0 if on_x else y1 - y0)) for _, x0, y0, x1, y1, _, _, on_x, _, _ in splits)
        found = {r["path"]: r for r in _cuts(sums, inline_table(grid.sparkSession, splits, names), points).collect()}
        boxes = []
        for path, bx0, by0, bx1, by1, count, left, on_x, _, _ in splits:
            cut, part, total = (found[path][c] for c in ("cut", "part", "total"))
            cuts[path] = (on_x, cut)
            halves = ((bx0, by0, cut, by1), (cut + 1, by0, bx1, by1)) if on_x else ((bx0, by0, bx1, cut), (bx0, cut + 1, bx1, by1))
            for side, half, size, weight in zip("01", halves, (left, count - left), (part, total - part)):
                if size == 1:
                    leaves.append((path + side, *half, weight))
                else:
                    boxes.append((path + side, *half, size))
    return Partition(leaves, cuts)


def balanced_partition(grid: DataFrame, n: int, extent: Extent) -> DataFrame:
    """The rectangles of ``split_grid`` as rows (shard, minx, miny, maxx, maxy, w)."""
    done = split_grid(grid, n, extent)
    rows = [(f"{i:02d}", *leaf[1:]) for i, leaf in enumerate(done.leaves)]
    table = inline_table(grid.sparkSession, rows, ["shard", "minx", "miny", "maxx", "maxy", "w"])
    return table.withColumn("w", F.col("w").cast("bigint" if isinstance(rows[0][-1], int) else "double"))
