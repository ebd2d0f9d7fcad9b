"""Splitting hot join keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
BROADCAST_ROWS = 200_000  # of key columns, counted before a side is broadcast


def unsized(df: DataFrame) -> DataFrame:
    """Join side whose rows were multiplied by an explode.

    Size estimates do not see the growth, so such a side could be broadcast by
    mistake. The hint asks for a shuffled join, whose real sizes are known and whose
    skewed partitions are split at run time.
    """
    return df.hint("merge")


def salted(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, at_most: int | None = None):
    """Add a ``salt`` key that splits the hot keys of ``right``.

    Keys of ``right`` above ``hot_rows`` rows are spread over enough salts to bring
    each below it, and the rows of ``left`` with such a key are repeated once per
    salt. There are at most ``rows / hot_rows`` hot keys, which bounds the
    broadcast list; keys may not be null. Where ``right`` is known to have no more than
    ``at_most`` rows, and these are too few for a hot key, nothing is counted.
    """
    if at_most is not None and at_most <= hot_rows:
        return tuple(unsized(side.withColumn("salt", F.lit(0))) for side in (left, right))
    hot = (
        right.groupBy(*keys)
        .count()
        .filter(F.col("count") > hot_rows)
        .select(*keys, F.ceil(F.col("count") / hot_rows).cast("int").alias("_fan"))
    )
    hot = F.broadcast(hot)
    fan = F.coalesce("_fan", F.lit(1))
    hashable = [name for name, kind in right.dtypes if "map<" not in kind]
    spread = F.pmod(F.xxhash64(*hashable), fan).cast("int")
    right = right.join(hot, keys, "left").withColumn("salt", spread).drop("_fan")
    left = (
        left.join(hot, keys, "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), fan - 1)))
        .drop("_fan")
    )
    return unsized(left), unsized(right)
