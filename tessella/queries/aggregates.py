"""Aggregations."""

from pyspark.sql import functions as F

from tessella.functions.grid import shard_of_tile
from tessella.operators import scenes as SC
from tessella.operators import stats
from tessella.operators import tiles as T
from tessella.operators.partitioning import balanced_partition
from tessella.operators.pixels import median_pixels
from tessella.plans.planning import grid_tiles, plan_summary, plan_tiles
from tessella.queries import query
from tessella.queries.filters import BOUNDS, LAND
from tessella.queries.scalars import SHARDS
from tessella.queries.sources import CATALOG


@query("agg_plan_summary", f"""
    SELECT CASE WHEN (s + n) / 2 >= 0 THEN 'northern_growing_season' ELSE 'southern_growing_season' END AS season, count(*) AS tiles
    FROM (SELECT {BOUNDS} FROM (SELECT DISTINCT z, x, y FROM {{fx_tiles}}) AS k) AS t WHERE {LAND} GROUP BY 1""")
def _(v):
    return plan_summary(plan_tiles(v.fx_tiles.select("z", "x", "y").distinct(), 2024))


@query("agg_catalog_zoom", f"""
    SELECT z, count(*) AS tiles, CAST(sum(size) AS BIGINT) AS bytes FROM ({CATALOG}) AS c GROUP BY ROLLUP (z)""")
def _(v):
    from tessella.sources.catalogs import parse_catalog_lines

    return stats.catalog_by_zoom(parse_catalog_lines(v.fx_catalog))


@query("agg_zoom_range", "SELECT src, min(z) AS minzoom, max(z) AS maxzoom FROM {fx_tiles} GROUP BY src")
def _(v):
    return T.zoom_range(v.fx_tiles, ["src"])


@query("agg_tileset_bounds", """
    SELECT src, round(min(x) / power(2, 10) * 360.0 - 180.0, 9) AS minx, round(degrees(atan(sinh(pi() * (1.0 - 2.0 * (max(y) + 1) / power(2, 10))))), 9) AS miny,
           round((max(x) + 1) / power(2, 10) * 360.0 - 180.0, 9) AS maxx, round(degrees(atan(sinh(pi() * (1.0 - 2.0 * min(y) / power(2, 10))))), 9) AS maxy
    FROM {fx_tiles} WHERE z = 10 GROUP BY src""")
def _(v):
    bounds = T.tileset_bounds(v.fx_tiles, ["src"])
    return bounds.select("src", *[F.round(n, 9).alias(n) for n in ("minx", "miny", "maxx", "maxy")])


WEIGHTS = """
    SELECT g.x, g.y, coalesce(w, 0) AS w FROM (SELECT a.i AS x, b.i AS y FROM range(64) AS a(i), range(64) AS b(i)) AS g
    LEFT JOIN (SELECT x >> (z - 6) AS x, y >> (z - 6) AS y, count(*) AS w FROM {fx_tiles} GROUP BY 1, 2) AS t ON g.x = t.x AND g.y = t.y"""


@query("agg_weight_grid", WEIGHTS)
def _(v):
    return stats.weight_grid(v.fx_tiles, grid_tiles(v.spark, 6), 6)


@query("agg_shard_balance", f"""
    SELECT shard, tiles, round(tiles / sum(tiles) OVER (), 9) AS share, round(max(tiles) OVER () / min(tiles) OVER (), 9) AS ratio
    FROM (SELECT shard, count(*) AS tiles FROM {{fx_tiles}} JOIN {SHARDS} ON (x >> (z - 6)) BETWEEN x0 AND x1 AND (y >> (z - 6)) BETWEEN y0 AND y1 GROUP BY shard) AS t""")
def _(v):
    balance = stats.shard_balance(v.fx_tiles.withColumn("shard", shard_of_tile("z", "x", "y")))
    return balance.select("shard", "tiles", F.round("share", 9).alias("share"), F.round("ratio", 9).alias("ratio"))


def _bisected(leaves: int, side: int, levels: int) -> str:
    """The recursive split as one pair of steps per level: the cuts, then the halves."""
    steps = [f"b0 AS (SELECT '' AS path, 0 AS x0, 0 AS y0, {side} AS x1, {side} AS y1, {leaves} AS n)"]
    for k in range(levels):
        steps.append(f"""c{k} AS (SELECT *, CASE WHEN onx THEN x0 ELSE y0 END + l - 1 AS lo, CASE WHEN onx THEN x1 ELSE y1 END - (n - l) AS hi FROM (
            SELECT *, n // 2 AS l, (x1 - x0 >= y1 - y0 AND x1 - x0 + 1 >= n) OR y1 - y0 + 1 < n AS onx FROM b{k} WHERE n > 1) AS t)""")
        steps.append(f"""k{k} AS (SELECT path, line AS cut FROM (
            SELECT path, line, row_number() OVER (PARTITION BY path ORDER BY abs(run - total * l / n), line) AS r FROM (
              SELECT *, sum(w) OVER (PARTITION BY path ORDER BY line) AS run, sum(w) OVER (PARTITION BY path) AS total FROM (
                SELECT path, l, n, lo, hi, CASE WHEN onx THEN x ELSE y END AS line, sum(w) AS w
                FROM c{k} JOIN cells ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY ALL) AS a) AS b WHERE line BETWEEN lo AND hi) AS d WHERE r = 1)""")
        steps.append(f"""b{k + 1} AS (SELECT path, x0, y0, x1, y1, n FROM b{k} WHERE n = 1
            UNION ALL SELECT path || '0', x0, y0, CASE WHEN onx THEN cut ELSE x1 END, CASE WHEN onx THEN y1 ELSE cut END, l FROM c{k} JOIN k{k} USING (path)
            UNION ALL SELECT path || '1', CASE WHEN onx THEN cut + 1 ELSE x0 END, CASE WHEN onx THEN y0 ELSE cut + 1 END, x1, y1, n - l FROM c{k} JOIN k{k} USING (path))""")
    return f"""WITH cells AS MATERIALIZED ({WEIGHTS}), {", ".join(steps)}
    SELECT lpad(CAST(rank AS VARCHAR), 2, '0') AS shard, CAST(x0 AS INT) AS minx, CAST(y0 AS INT) AS miny, CAST(x1 AS INT) AS maxx, CAST(y1 AS INT) AS maxy, CAST(sum(w) AS BIGINT) AS w
    FROM (SELECT *, row_number() OVER (ORDER BY path) - 1 AS rank FROM b{levels}) AS r JOIN cells ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY ALL"""


@query("agg_balanced_partition", _bisected(18, 63, 5))
def _(v):
    grid = stats.weight_grid(v.fx_tiles, grid_tiles(v.spark, 6), 6)
    return balanced_partition(grid, 18, (0, 0, 63, 63))


@query("agg_scene_dedup", """
    SELECT collection_id, item_id, z, x, y FROM (
      SELECT *, row_number() OVER (PARTITION BY collection_id, item_id ORDER BY x, y, z, seq) AS r FROM (
        SELECT concat('c', user_id % 3) AS collection_id, concat('S', user_id) AS item_id, event_id % 7 AS z, event_id * 31 % 64 AS x, event_id * 17 % 64 AS y, event_id AS seq FROM {events}) AS a) AS b WHERE r = 1""")
def _(v):
    rows = v.sql("""SELECT concat('c', user_id % 3) AS collection_id, concat('S', user_id) AS item_id, event_id % 7 AS z,
                    event_id * 31 % 64 AS x, event_id * 17 % 64 AS y, event_id AS seq FROM {events}""")
    return SC.unique_scenes(rows, ["x", "y", "z", "seq"]).select("collection_id", "item_id", "z", "x", "y")


ROLES = """SELECT CAST(5 AS INT) AS z, o_custkey % 32 AS x, o_orderkey % 32 AS y, concat('c', o_orderkey % 2) AS collection_id, concat('S', o_custkey) AS item_id,
           CASE WHEN o_orderkey % 32 < 9 OR o_orderstatus = 'F' THEN 'fallback' ELSE 'primary' END AS role FROM {orders}"""


@query("agg_manifest_summary", f"""
    SELECT CAST(1024 AS BIGINT) AS tiles_evaluated, (SELECT count(*) FROM (SELECT DISTINCT collection_id, item_id FROM ({ROLES}) AS a)) AS unique_scenes,
           1024 - (SELECT count(*) FROM (SELECT DISTINCT x, y FROM ({ROLES}) AS b WHERE role = 'primary')) AS fallback_tiles, 3 AS max_scenes_per_tile""")
def _(v):
    plan = grid_tiles(v.spark, 5)
    candidates = v.sql(ROLES)
    return SC.manifest_summary(plan, candidates, candidates, 3)


@query("agg_pixel_median", """
    SELECT z, x, y, px, py, band, CAST(coalesce(round_even(median(CASE WHEN dn <> 0 THEN dn END), 0), 0) AS INT) AS dn
    FROM {fx_obs} GROUP BY z, x, y, px, py, band""")
def _(v):
    return median_pixels(v.fx_obs, ["z", "x", "y", "px", "py", "band"])


@query("agg_footprint_envelope", """
    SELECT family, greatest(-120.5, min(minx)) AS minx, greatest(-60.5, min(miny)) AS miny, least(100.5, max(maxx)) AS maxx, least(70.5, max(maxy)) AS maxy
    FROM {fx_images} GROUP BY family HAVING greatest(-120.5, min(minx)) < least(100.5, max(maxx)) AND greatest(-60.5, min(miny)) < least(70.5, max(maxy))""")
def _(v):
    from tessella.operators.envelopes import footprint_envelope

    return footprint_envelope(v.fx_images, ["family"], (-120.5, -60.5, 100.5, 70.5))


@query("agg_tile_dedup", """
    SELECT CAST(sum(n) AS BIGINT) AS tiles, count(*) AS contents, CAST(sum(n * b) AS BIGINT) AS bytes_before, CAST(sum(b) AS BIGINT) AS bytes_after
    FROM (SELECT sha256(user_id || event_type) AS d, count(*) AS n, max(strlen(user_id || event_type)) AS b FROM {events} GROUP BY 1) AS t""")
def _(v):
    rows = v.events.select(F.concat("user_id", "event_type").alias("payload"))
    return T.dedup_ratio(rows)


@query("agg_fetch_stats", """
    SELECT s.*, coalesce(failed, 0) AS failed FROM (
      SELECT job, count(*) FILTER (WHERE status = 200) AS ok, count(*) FILTER (WHERE status = 0) AS cached, count(*) FILTER (WHERE status = 404) AS http_404,
             count(*) FILTER (WHERE status IN (403, 429, 503)) AS blocked, count(*) FILTER (WHERE status NOT IN (0, 200, 404, 403, 429, 503)) AS error,
             CAST(sum(CASE WHEN status = 200 THEN bytes ELSE 0 END) AS BIGINT) AS bytes FROM {fx_fetch_log} GROUP BY job) AS s
    LEFT JOIN (SELECT job, count(*) AS failed FROM (SELECT job, seq % 40 AS tile FROM {fx_fetch_log} GROUP BY 1, 2 HAVING count(*) >= 2 AND count(*) = count(*) FILTER (WHERE status IN (403, 429, 503))) AS t GROUP BY job) AS f USING (job)""")
def _(v):
    return stats.fetch_report(v.fx_fetch_log.withColumn("tile", F.col("seq") % 40), ["job"], ["tile"], 2)


@query("agg_transfer_health", """
    SELECT job, bytes, seconds, health, CASE health WHEN 'none' THEN 0.0E0 WHEN 'throttled' THEN 600.0E0 ELSE 60.0E0 END AS wait_min_s,
           CASE health WHEN 'none' THEN 0.0E0 WHEN 'throttled' THEN 900.0E0 ELSE 300.0E0 END AS wait_max_s
    FROM (SELECT *, CASE WHEN bytes <= 0 THEN 'none' WHEN seconds > 0 AND bytes / 1024.0 / seconds < 150 THEN 'throttled' ELSE 'healthy' END AS health
          FROM (SELECT concat(job, '-', seq % 4) AS job, CAST(sum(CASE WHEN seq % 4 = 3 THEN 0 ELSE bytes END) AS BIGINT) AS bytes, CAST(sum(CASE WHEN seq % 4 = 2 THEN 0 ELSE seq % 7 END) AS BIGINT) AS seconds FROM {fx_fetch_log} GROUP BY 1) AS a) AS b""")
def _(v):
    log = v.sql("""SELECT concat(job, '-', seq % 4) AS job, CASE WHEN seq % 4 = 3 THEN 0 ELSE bytes END AS bytes,
                   CASE WHEN seq % 4 = 2 THEN 0 ELSE seq % 7 END AS seconds FROM {fx_fetch_log}""")
    return stats.transfer_health(log, ["job"]).drop("kibps")


@query("agg_cache_rates", """
    SELECT job, count(*) AS fetches, round(count(*) FILTER (WHERE status = 0) / count(*), 9) AS hit_rate, round(count(*) FILTER (WHERE status = 200) / count(*), 9) AS redownload_rate,
           round(count(*) FILTER (WHERE status > 400) / count(*), 9) AS failed_rate FROM {fx_fetch_log} GROUP BY job""")
def _(v):
    outcome = F.when(F.col("status") == 0, "hit").when(F.col("status") == 200, "redownload").otherwise("failed")
    rates = stats.cache_rates(v.fx_fetch_log.withColumn("outcome", outcome), ["job"])
    return rates.select("job", "fetches", *[F.round(c, 9).alias(c) for c in rates.columns[2:]])
