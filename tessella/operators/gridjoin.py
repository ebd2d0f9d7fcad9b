"""Boxes that meet, found over a quadtree whose cells have the boxes' own sizes.

A box lies in the cells of the level whose side is its own longer side or more, four at
most. Two boxes meet at the coarser one's level: it waits in its own cells, the finer one
comes to the cells over it at that level. So each box has at most four rows for a level that
the other side uses, however its size compares with theirs. A pair is reported only in the
cell of the south-west corner of its overlap, hence once. Spans of days meet single days in
blocks of a power of two, about a quarter of the span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.skew import HOT_ROWS, salted

SPAN = 360.0
DEEPEST = 24
BLOCKS_OF_A_SPAN = 5
OWN, OVER = 0, 1  # the left box waits in its own cells, or comes to those over it
KEYS = ["_kind", "_level", "_cx", "_cy"]


def box_level(prefix: str) -> Column:
    """Finest level whose cells are not smaller than the box."""
    box = lambda name: F.col(prefix + name)
    size = F.greatest(box("maxx") - box("minx"), box("maxy") - box("miny"))
    level = F.floor(F.log2(F.lit(SPAN) / size))
    return F.when(size > 0, F.greatest(F.lit(0), F.least(level, F.lit(DEEPEST)))).otherwise(DEEPEST).cast("int")


Levels = dict[int, int]


def levels_of(*sides: tuple[DataFrame, Column]) -> list[Levels]:
    """The levels that each side uses and their rows, in one job; few values by construction."""
    listed = [df.select(F.lit(i).alias("side"), level.alias("level")).groupBy("side", "level").count() for i, (df, level) in enumerate(sides)]
    found = reduce(DataFrame.unionByName, listed).filter(F.col("level").isNotNull()).collect()
    return [{r["level"]: r["count"] for r in sorted(found, key=lambda r: r["level"]) if r["side"] == i} for i in range(len(sides))]


def most_rows(own: Levels, other: Levels) -> int:
    """More rows than a side can have once it is spread."""
    return sum(n * 4 * (1 + sum(o <= level for o in other)) for level, n in own.items())


def _side(level: Column) -> Column:
    return F.lit(SPAN) / F.pow(F.lit(2.0), level)


def _spread(df: DataFrame, prefix: str, meetings: Column) -> DataFrame:
    """One row for each cell of each (kind, level) of ``meetings``."""
    at = df.withColumn("_m", F.explode(meetings))
    side = _side(F.col("_m.level"))
    cell = lambda name: F.floor(F.col(prefix + name) / side).cast("int")
    at = at.withColumns({f"{prefix}_fx": cell("minx"), f"{prefix}_fy": cell("miny"), "_tx": cell("maxx"), "_ty": cell("maxy")})
    span = lambda lo, hi: F.explode(F.sequence(F.col(prefix + lo), F.col(hi)))
    cells = at.withColumn("_cx", span("_fx", "_tx")).withColumn("_cy", span("_fy", "_ty"))
    return cells.withColumns({"_kind": F.col("_m.kind"), "_level": F.col("_m.level")}).drop("_m", "_tx", "_ty")


def _meeting(kind: int, levels: Column) -> Column:
    return F.transform(levels, lambda l: F.struct(F.lit(kind).alias("kind"), l.cast("int").alias("level")))


def _if(condition: Column, level: Column) -> Column:
    return F.when(condition, F.array(level)).otherwise(F.array().cast("array<int>"))


def spread_boxes(
    left: DataFrame, right: DataFrame, left_prefix: str, right_prefix: str, levels: list[Levels]
) -> tuple[DataFrame, DataFrame]:
    """Both sides over the cells in which their boxes meet; join them on ``KEYS``.

    ``levels`` are those of both sides by ``box_level``, from ``levels_of``.
    """
    own_left, own_right = box_level(left_prefix), box_level(right_prefix)
    left_levels, right_levels = map(list, levels)
    table = lambda levels: F.array(*map(F.lit, levels)).cast("array<int>")
    coarser = lambda levels, own: F.filter(table(levels), lambda l: l < own)
    deepest = lambda levels: F.lit(max(levels, default=-1))
    for_left = F.concat(
        _meeting(OWN, _if(own_left <= deepest(right_levels), own_left)), _meeting(OVER, coarser(right_levels, own_left))
    )
    for_right = F.concat(
        _meeting(OWN, F.filter(table(left_levels), lambda l: l <= own_right)), _meeting(OVER, _if(own_right < deepest(left_levels), own_right))
    )
    return _spread(left, left_prefix, for_left), _spread(right, right_prefix, for_right)


def met_once(left_prefix: str, right_prefix: str) -> Column:
    """Whether the row's cell holds the south-west corner of the pair's overlap."""
    corner = lambda name: F.greatest(f"{left_prefix}{name}", f"{right_prefix}{name}")
    return (corner("_fx") == F.col("_cx")) & (corner("_fy") == F.col("_cy"))


def block_level(start: str, end: str) -> Column:
    """Smallest power of two of days that is not shorter than a quarter of the span."""
    days = F.datediff(end, start) + 1
    return F.greatest(F.lit(0), F.ceil(F.log2(days)) - 2).cast("int")


def _block(day: Column, level: Column) -> Column:
    return F.floor(F.unix_date(day) / F.pow(F.lit(2.0), level)).cast("int")


def spread_days(left: DataFrame, right: DataFrame, start: str, end: str, day: str, levels: Levels) -> tuple[DataFrame, DataFrame]:
    """Spans of days and single days over the blocks in which they meet; join on ``_block`` and ``_blocks``.

    A span has five rows at most, a day one for each length of blocks.
    """
    level = block_level(start, end)
    at = left.withColumn("_blocks", level)
    first, last = _block(F.col(start), F.col("_blocks")), _block(F.col(end), F.col("_blocks"))
    spans = at.withColumn("_block", F.explode(F.sequence(first, last)))
    table = F.array(*map(F.lit, levels)).cast("array<int>")
    days = right.withColumn("_blocks", F.explode(table))
    return spans, days.withColumn("_block", _block(F.col(day), F.col("_blocks")))


def boxes_of(left: DataFrame, right: DataFrame, left_prefix: str, right_prefix: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides spread over cells and hot cells salted; join them on ``KEYS`` and ``salt``."""
    levels = levels_of((left, box_level(left_prefix)), (right, box_level(right_prefix)))
    sides = spread_boxes(left, right, left_prefix, right_prefix, levels)
    return salted(*sides, KEYS, hot_rows, most_rows(*levels[::-1]))
