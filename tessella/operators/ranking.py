"""Ranks and top-k inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.skew import HOT_ROWS
from tessella.session import cut_lineage


def _same_keys(keys: list[str], prefix: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def _ranged(rows: DataFrame, keys: list[str], order: list[Column], parts: int) -> DataFrame:
    """Rows dealt over ``parts`` ranges of the whole sort order, with the range in ``_part``.

    The rows' own number breaks ties, so that equal rows spread as well. The ranges come
    from a sample and would differ on another run, hence the checkpoint.
    """
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(parts, *keys, *order, "_tie")
    return cut_lineage(dealt.withColumn("_part", F.spark_partition_id()))


def _ranked_by_range(rows: DataFrame, keys: list[str], order: list[Column], parts: int, rank: str, total: str) -> DataFrame:
    """Ranks of large groups: place in the range, plus the group's rows in earlier ranges."""
    dealt = _ranged(rows, keys, order, parts)
    counts = dealt.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    # one row for each range and for each border of two groups: few by construction
    joined = dealt.join(F.broadcast(offsets), _same_keys(keys, "_k_") & (F.col("_part") == F.col("_p")))
    local = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order, "_tie"))
    ranked = joined.withColumn(rank, F.col("_offset") + local).withColumn(total, F.col("_total"))
    return ranked.drop("_tie", "_part", "_p", "_offset", "_total", *[f"_k_{k}" for k in keys])


def ranked_in_group(
    df: DataFrame, keys: list[str], order: list[Column], rank: str, total: str | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Exact 1-based rank in each group, and the group's size as ``total``, at any group size.

    A group of at most ``hot_rows`` rows is one window. Of larger groups there are at most
    rows / ``hot_rows``; their rows are dealt over ranges of the whole sort order, ties
    included, so that no task sorts more than about ``hot_rows`` of them. ``df`` is read for
    the counts first: pass a stored table if it is costly.
    """
    size = total or "_size"
    spark = df.sparkSession
    hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    hot = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_n").collect()
    window = Window.partitionBy(*keys)
    ranked = lambda rows: rows.withColumn(rank, F.row_number().over(window.orderBy(*order)).cast("bigint")).withColumn(
        size, F.count("*").over(window)
    )
    if not hot:
        done = ranked(df)
    else:
        kinds = dict(df.dtypes)
        schema = ", ".join(f"`_h_{k}` {kinds[k]}" for k in keys)
        listed = F.broadcast(spark.createDataFrame([tuple(r)[:-1] for r in hot], schema))
        same = _same_keys(keys, "_h_")
        parts = 1 + 2 * sum(r["_n"] for r in hot) // hot_rows
        large = _ranked_by_range(df.join(listed, same, "left_semi"), keys, order, parts, rank, size)
        done = ranked(df.join(listed, same, "left_anti")).unionByName(large)
    return done if total else done.drop(size)


def top_in_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group; Spark cuts groups to ``n`` before the shuffle."""
    if n <= 0:
        return df
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")
