"""Set operations on tile keys."""

from pyspark.sql import functions as F

from tessella.operators import tiles as T
from tessella.plans.planning import grid_tiles, shard_table
from tessella.queries import query
from tessella.queries.scalars import SHARDS


@query("set_union_tiles", """
    SELECT z, x, y, src, payload FROM (SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY src) AS r FROM (
      SELECT *, row_number() OVER (PARTITION BY src, z, x, y ORDER BY seq DESC) AS d FROM {fx_tiles}) AS a WHERE d = 1) AS b WHERE r = 1""")
def _(v):
    newest = T.last_wins(v.fx_tiles, ["seq"], ["src", "z", "x", "y"])
    archives = [newest.filter(F.col("src") == i) for i in range(3)]
    return T.union_tiles(archives).select("z", "x", "y", "src", "payload")


@query("set_upsert_tiles", """
    SELECT z, x, y, seq, payload FROM (SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY seq DESC) AS r FROM {fx_tiles}) AS t WHERE r = 1""")
def _(v):
    stored = v.fx_tiles.filter(F.col("src") < 2)
    once = T.upsert(stored, v.fx_tiles, ["seq"])
    return once.select("z", "x", "y", "seq", "payload")


@query("set_exact_cover", f"""
    SELECT x, y, n FROM (SELECT c.x, c.y, count(s.shard) AS n FROM (SELECT DISTINCT x >> (z - 6) AS x, y >> (z - 6) AS y FROM {{fx_tiles}}) AS c
      LEFT JOIN {SHARDS} ON c.x BETWEEN x0 AND x1 + 1 AND c.y BETWEEN y0 AND y1 GROUP BY c.x, c.y) AS t WHERE n <> 1""")
def _(v):
    shift = lambda c: F.call_function("shiftright", F.col(c), F.col("z") - 6)
    cells = v.fx_tiles.select(shift("x").alias("x"), shift("y").alias("y")).distinct()
    # widened by one column, so that shared columns must be reported
    wide = shard_table(v.spark).withColumn("maxx", F.col("maxx") + 1)
    return T.exact_cover(cells, wide)


@query("set_missing_tiles", """
    SELECT g.x, g.y FROM (SELECT a.i AS x, b.i AS y FROM range(128) AS a(i), range(128) AS b(i)) AS g
    WHERE NOT EXISTS (SELECT 1 FROM {fx_tiles} AS t WHERE t.z = 7 AND t.x = g.x AND t.y = g.y)""")
def _(v):
    return T.missing_tiles(grid_tiles(v.spark, 7), v.fx_tiles).select("x", "y")
