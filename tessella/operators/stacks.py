"""Reductions of temporal stacks of any depth, in memory that does not grow with it.

Chunks are cut into strips, and the strips of a tile are dealt to one task in order. The
task reads them as a stream: whole stacks of a batch are reduced together, and a stack
that goes on is folded into a state before more of it is read. For the clearest value the
state is one strip. For the median of a deep stack a first pass takes range and number of the
values of each pixel; each further pass counts ``BINS`` equal steps of the range and goes on
with the step that holds the middle value, so 16-bit data take two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators import kernels
from tessella.operators.chunks import Ragged, _list_column, _same, _types
from tessella.operators.skew import unsized
from tessella.session import cut_lineage

STRIP = 1024  # values of a chunk that are reduced together
HELD = 64  # scenes of a strip that a task holds before it folds them
BINS = 256


def _strips(chunks: DataFrame, names: list[str], extra: list[Column]) -> DataFrame:
    count = F.ceil(F.size("data") / STRIP).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice("data", i * STRIP + 1, F.lit(STRIP)))
    return chunks.filter(F.size("data") > 0).select(*names, *extra, F.posexplode(cut).alias("strip", "part"))


def _dealt(strips: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return strips.repartition(*keys).sortWithinPartitions(*keys, *[F.desc(o) for o in order])


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Rows at which a key differs from the row before."""
    n = batch.num_rows
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for k in keys:
        column = batch.column(k)
        a, b = column.slice(1), column.slice(0, n - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        lone = pc.not_equal(pc.is_null(a), pc.is_null(b))
        new[1:] |= np.asarray(differ) | np.asarray(lone)
    return np.flatnonzero(new)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """(batch, starts, whole): batches of whole groups, or a piece of one that goes on.

    A group of more than ``HELD`` rows comes in pieces; ``whole`` is False for all of its
    pieces but the last, which is True, alone in its batch.
    """
    held, going = None, False
    alone = np.zeros(1, np.int64)
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        starts = _starts(batch, keys)
        last = int(starts[-1])
        if going and last:
            # the end of the stack that was going on
            yield batch.slice(0, int(starts[1])), alone, True
            batch, starts = batch.slice(int(starts[1])), starts[1:] - starts[1]
            last, going = int(starts[-1]), False
        if last:
            yield batch.slice(0, last), starts[:-1], True
        held = batch.slice(last)
        while held.num_rows > HELD:
            yield held.slice(0, HELD), alone, False
            held, going = held.slice(HELD), True
    if held is not None and held.num_rows:
        yield held, alone, True


def _stacks(batch: pa.RecordBatch, starts: np.ndarray):
    """Stacks (k, depth, n) of equal depth and length, with the rows that begin them."""
    data = Ragged(batch.column("part"))
    depth = np.diff(np.append(starts, batch.num_rows))
    for (deep, length), index in _same(depth, data.sizes[starts]):
        step = max(1, 8_000_000 // max(1, deep * length))
        for at in range(0, len(index), step):
            first = starts[index[at:at + step]]
            rows = first[:, None] + np.arange(deep)[None, :]
            yield first, data.rows(rows.ravel()).reshape(len(first), deep, length)


def _rows(batch: pa.RecordBatch, keys: list[str], at: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
    head = batch.select(keys).take(pa.array(at, pa.int64()))
    return pa.RecordBatch.from_arrays([*head.columns, *columns.values()], names=[*keys, *columns])


def _joined(strips: DataFrame, names: list[str]) -> DataFrame:
    """Strips back to whole chunks."""
    whole = strips.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("strip", "data"))).alias("parts"))
    return whole.select(*names, F.flatten(F.transform("parts", lambda p: p.data)).alias("data"))


def priority_chunks(chunks: DataFrame, keys: list[str], order: str = "scene", cloud: str = "cloud") -> DataFrame:
    """Per pixel the clear value of the least cloudy scene, on equal cloud of the later ``order``.

    Unknown cloud is worst. Pixels that are clear in no scene are 0.
    """
    names, place = [*keys, "w", "h"], [*keys, "w", "h", "strip"]
    clear = -F.coalesce(F.col(cloud).cast("double"), F.lit(float("inf")))
    strips = _dealt(_strips(chunks, names, [clear.alias("_clear"), F.col(order).alias("_order")]), place, ["_clear", "_order"])

    def reduce(batches):
        top = None
        for batch, starts, whole in _groups(batches, place):
            for first, stack in _stacks(batch, starts):
                if top is not None:
                    stack = np.concatenate([top[:, None], stack], axis=1)
                    top = None
                found = kernels.first_nonzero(stack)
                if whole:
                    yield _rows(batch, place, first, data=_list_column(found))
                else:
                    top = found

    return _joined(strips.mapInArrow(reduce, _types(strips, place) + "data array<int>"), names)


class _Middle:
    """Ranges of the two middle values of each pixel, and their ranks inside the ranges."""

    def __init__(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray):
        self.low, self.high, self.rank = low, high, rank
        self.width = (high - low) // BINS + 1
        self.counts = np.zeros((*low.shape, BINS), np.int64)

    def add(self, stack: np.ndarray) -> None:
        """Stack (depth, n); zeros do not count."""
        pixel = np.broadcast_to(np.arange(stack.shape[1]), stack.shape)
        for target in range(2):
            low, high = self.low[target], self.high[target]
            use = (stack != 0) & (stack >= low) & (stack <= high)
            code = pixel * BINS + (stack - low) // self.width[target]
            counted = np.bincount(code[use], minlength=self.counts[target].size)
            self.counts[target] += counted.reshape(self.counts[target].shape)

    def narrowed(self) -> "_Middle":
        upto = self.counts.cumsum(axis=2)
        at = np.minimum((upto <= self.rank[:, :, None]).sum(axis=2), BINS - 1)
        below = np.take_along_axis(upto - self.counts, at[:, :, None], axis=2)[:, :, 0]
        empty = self.rank < 0
        low = np.where(empty, 0, self.low + at * self.width)
        high = np.where(empty, 0, np.minimum(self.high, low + self.width - 1))
        return _Middle(low, high, np.where(empty, -1, self.rank - below))

    def row(self, batch: pa.RecordBatch, place: list[str], first: int) -> pa.RecordBatch:
        """The median where all ranges are one value, else the ranges."""
        at = np.array([first])
        if (self.low == self.high).all():
            middle = np.where(self.rank[0] < 0, 0, np.rint(self.low.sum(axis=0) / 2.0)).astype(np.int32)
            return _settled(batch, place, at, middle[None, :])
        lists = {n: pa.array([getattr(self, n).ravel()], pa.list_(pa.int64())) for n in ("low", "high", "rank")}
        return _rows(batch, place, at, data=pa.nulls(1, pa.list_(pa.int32())), **lists)


class _Extent:
    """Range and number of the values of each pixel."""

    def __init__(self, n: int):
        big = np.iinfo(np.int64).max
        self.low, self.high, self.clear = np.full(n, big), np.full(n, -big), np.zeros(n, np.int64)

    def add(self, stack: np.ndarray) -> None:
        big = np.iinfo(np.int64).max
        clear = stack != 0
        self.low = np.minimum(self.low, np.where(clear, stack, big).min(axis=0))
        self.high = np.maximum(self.high, np.where(clear, stack, -big).max(axis=0))
        self.clear += clear.sum(axis=0)

    def middle(self) -> _Middle:
        none = self.clear == 0
        low, high = np.where(none, 0, self.low), np.where(none, 0, self.high)
        rank = np.where(none, -1, np.stack([(self.clear - 1) // 2, self.clear // 2]))
        return _Middle(np.stack([low, low]), np.stack([high, high]), rank)


_STATE = "data array<int>, low array<bigint>, high array<bigint>, rank array<bigint>"


def _settled(batch, place, at, data) -> pa.RecordBatch:
    none = pa.nulls(len(at), pa.list_(pa.int64()))
    return _rows(batch, place, at, data=_list_column(data), low=none, high=none, rank=none)


def _first_pass(place: list[str]):
    """Medians of stacks that a task holds, and the ranges of the middle values of deeper ones."""

    def reduce(batches):
        deep = None
        for batch, starts, whole in _groups(batches, place):
            for first, stack in _stacks(batch, starts):
                if deep is None and whole:
                    yield _settled(batch, place, first, kernels.stack_median(stack))
                    continue
                deep = deep or _Extent(stack.shape[2])
                deep.add(stack[0].astype(np.int64))
                if whole:
                    yield deep.middle().row(batch, place, int(first[0]))
                    deep = None

    return reduce


def _next_pass(place: list[str]):
    """Narrower ranges; the first row of a stack holds those found so far."""

    def reduce(batches):
        deep = None
        for batch, starts, whole in _groups(batches, place):
            parts = Ragged(batch.column("part"))
            for first, end in zip(starts.tolist(), np.append(starts[1:], batch.num_rows).tolist()):
                at = first
                if deep is None:
                    deep = _Middle(*(batch.column(n)[first].values.to_numpy().reshape(2, -1) for n in ("low", "high", "rank")))
                    at += 1
                if at < end:
                    deep.add(parts.rows(np.arange(at, end)).astype(np.int64))
                if whole:
                    yield deep.narrowed().row(batch, place, first)
                    deep = None

    return reduce


def median_chunks(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Per-pixel temporal median of each tile's stack of any depth, half to even; 0 is nodata.

    Stacks of up to ``HELD`` scenes are settled in one pass. Only deeper ones are read again,
    one time for each factor of ``BINS`` in the range of their values. A task holds ``HELD``
    strips and one histogram of a strip, whatever the depth.
    """
    names, place = [*keys, "w", "h"], [*keys, "w", "h", "strip"]
    strips = _strips(chunks, names, [])
    schema = _types(strips, place) + _STATE
    found = cut_lineage(_dealt(strips, place, []).mapInArrow(_first_pass(place), schema))
    settled = found.filter(F.col("data").isNotNull()).select(*place, "data")
    left = found.filter(F.col("data").isNull())
    while not left.isEmpty():
        tiles = left.select(*[F.col(n).alias(f"_{n}") for n in place])
        same = F.lit(True)
        for n in place:
            same = same & F.col(n).eqNullSafe(F.col(f"_{n}"))
        again = strips.join(unsized(tiles), same, "left_semi").withColumn("first", F.lit(0))
        rows = again.unionByName(left.drop("data").withColumn("first", F.lit(1)), allowMissingColumns=True)
        found = cut_lineage(_dealt(rows, place, ["first"]).mapInArrow(_next_pass(place), schema))
        settled = settled.unionByName(found.filter(F.col("data").isNotNull()).select(*place, "data"))
        left = found.filter(F.col("data").isNull())
    return _joined(settled, names)
