"""Views that turn the supplied tables into tiles, scenes and pixels.

The SQL is written once in the common subset of Spark SQL and DuckDB, so that
the checks start from the same rows in both engines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS = {
    # tile rows of three archives, with many rewrites of the same key
    "fx_tiles": """
        SELECT event_id AS seq, CAST(event_id % 3 AS INT) AS src, CAST(6 + event_id % 5 AS INT) AS z,
               (event_id * 2654435761) % CAST(power(2, 6 + event_id % 5) AS BIGINT) AS x,
               (event_id * 40503) % CAST(power(2, 6 + event_id % 5) AS BIGINT) AS y,
               props AS payload
        FROM {events}""",
    # tile catalog text, with malformed, blank and digest-less lines
    "fx_catalog": """
        SELECT CASE WHEN seq % 50 = 0 THEN 'no tile here' WHEN seq % 50 = 1 THEN ''
                    WHEN seq % 50 = 3 THEN concat(z, '/', x, '/', y, 'a.jpg,1,2')
                    WHEN seq % 50 = 4 THEN concat(z, '/', x, '.jpg,1,2')
                    WHEN seq % 50 = 5 THEN concat(z, '/', x, '/', y, '.jpg,', seq)
                    WHEN seq % 50 = 2 THEN concat(z, '/', x, '/', y, '.jpg,', 1700000500 + seq, ',', 1000 + seq % 9000)
                    ELSE concat(z, '/', x, '/', y, '.jpg,', 1700000500 + seq, ',', 1000 + seq % 9000, ',', md5(payload))
               END AS line
        FROM {fx_tiles}""",
    # scene footprints of two degrees in three collections
    "fx_scenes": """
        SELECT CASE o_orderkey % 3 WHEN 0 THEN 'hls2-s30' WHEN 1 THEN 'hls2-l30' ELSE 'landsat-c2-l2' END AS collection_id,
               concat('S', o_orderkey) AS item_id,
               DATE '2024-01-01' + CAST(o_orderkey * 13 % 366 AS INT) AS acq_date,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST((o_orderkey * 37) % 101 AS DOUBLE) END AS cloud,
               CAST(o_custkey * 7 % 358 - 180 AS DOUBLE) AS minx, CAST(o_orderkey * 11 % 168 - 84 AS DOUBLE) AS miny,
               CAST(o_custkey * 7 % 358 - 178 AS DOUBLE) AS maxx, CAST(o_orderkey * 11 % 168 - 82 AS DOUBLE) AS maxy,
               o_orderkey % 7 <> 0 AS has_qa
        FROM {orders}""",
    # pixel observations, dn 0 is nodata
    "fx_obs": """
        SELECT 3 AS z, l_orderkey % 8 AS x, CAST(floor(l_orderkey / 8) AS BIGINT) % 8 AS y,
               CAST(l_partkey % 16 AS INT) AS px, CAST(l_suppkey % 16 AS INT) AS py,
               CAST(l_linenumber % 3 AS INT) AS band, l_orderkey AS scene, CAST(l_linenumber AS BIGINT) AS seq,
               CAST((l_partkey * 31 + l_suppkey * 17 + l_orderkey) % 4000 AS INT) AS dn,
               CAST((l_orderkey + l_linenumber) % 64 AS INT) AS qa,
               CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE CAST(l_suppkey % 101 AS DOUBLE) END AS cloud
        FROM {lineitem}""",
    # one value per pixel and scene
    "fx_scene_px": """
        SELECT scene, z, x, y, band, px, py, max(dn) AS dn, max(qa) AS qa, min(cloud) AS cloud
        FROM {fx_obs} GROUP BY scene, z, x, y, band, px, py""",
    # a temporal stack of five scenes over 16-pixel tiles, and its quality pixels
    "fx_stack": """
        SELECT CAST(l_orderkey % 5 AS INT) AS scene, 14 AS z, CAST(floor(l_orderkey / 512) AS BIGINT) AS x, l_suppkey % 4 AS y,
               CAST(l_linenumber % 3 AS INT) AS band, CAST(l_partkey % 16 AS INT) AS px, CAST(floor(l_extendedprice) AS INT) % 16 AS py,
               max(CAST((l_partkey * 31 + l_suppkey * 17 + l_orderkey) % 4000 AS INT)) AS dn,
               CASE WHEN l_orderkey % 5 = 4 THEN NULL ELSE CAST(l_orderkey % 5 * 37 % 50 AS DOUBLE) END AS cloud
        FROM {lineitem} GROUP BY l_orderkey % 5, floor(l_orderkey / 512), l_suppkey % 4, l_linenumber % 3, l_partkey % 16, CAST(floor(l_extendedprice) AS INT) % 16""",
    "fx_qa": """
        SELECT CAST(l_orderkey % 5 AS INT) AS scene, 14 AS z, CAST(floor(l_orderkey / 512) AS BIGINT) AS x, l_suppkey % 4 AS y,
               CAST(l_partkey % 16 AS INT) AS px, CAST(floor(l_extendedprice) AS INT) % 16 AS py,
               max(CAST((l_orderkey + l_linenumber) % 64 AS INT)) AS qa
        FROM {lineitem} WHERE l_orderkey % 5 <> 3
        GROUP BY l_orderkey % 5, floor(l_orderkey / 512), l_suppkey % 4, l_partkey % 16, CAST(floor(l_extendedprice) AS INT) % 16""",
    # tile pixels of an ordered stack: 0 at zoom 3, 1 at zooms 5 and 6
    "fx_layers": """
        SELECT ord AS src, CASE WHEN ord = 0 THEN 3 ELSE 5 END AS z,
               CASE WHEN ord = 0 THEN x ELSE x * 4 + 1 END AS x, CASE WHEN ord = 0 THEN y ELSE y * 4 + 2 END AS y, px, py, r, g, b, a FROM {fx_rgba}
        UNION ALL
        SELECT 1 AS src, 6 AS z, x * 8 + 3 AS x, y * 8 + 5 AS y, px, py, b AS r, r AS g, g AS b, a FROM {fx_rgba} WHERE ord = 0""",
    # RGBA pixels of two layers: 0 base, 1 overlay
    "fx_rgba": """
        SELECT CAST(l_linenumber % 2 AS INT) AS ord, 3 AS z, l_orderkey % 8 AS x,
               CAST(floor(l_orderkey / 8) AS BIGINT) % 8 AS y,
               CAST(l_partkey % 8 AS INT) AS px, CAST(l_suppkey % 8 AS INT) AS py,
               CAST(max(l_partkey) % 256 AS INT) AS r, CAST(max(l_suppkey) % 256 AS INT) AS g,
               CAST(max(l_orderkey) % 256 AS INT) AS b,
               CASE WHEN max(l_orderkey) % 3 = 0 THEN 0 ELSE 255 END AS a
        FROM {lineitem}
        GROUP BY 1, 2, 3, 4, 5, 6""",
    "fx_fetch_log": """
        SELECT event_id AS seq, ts, CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 404 WHEN 'click' THEN 0 ELSE 200 END AS status,
               CASE WHEN event_type IN ('view', 'purchase') THEN event_id % 100000 ELSE 0 END AS bytes,
               concat('tile-', user_id) AS job
        FROM {events}""",
    "fx_points": """
        SELECT event_id, (event_id * 7919 % 36000) / 100.0E0 - 180.0E0 AS lon,
               (event_id * 104729 % 17000) / 100.0E0 - 85.0E0 AS lat
        FROM {events}""",
    # boxes, some of them with reversed corners or over the edge of the world
    "fx_boxes": """
        SELECT o_orderkey AS box_id, (o_custkey * 131 % 37000) / 100.0E0 - 185.0E0 AS minx,
               (o_orderkey * 97 % 17600) / 100.0E0 - 88.0E0 AS miny,
               (o_custkey * 131 % 37000) / 100.0E0 - 185.0E0 + (o_orderkey % 9 - 1) * 1.5E0 AS maxx,
               (o_orderkey * 97 % 17600) / 100.0E0 - 88.0E0 + (o_orderkey % 7 - 1) * 1.25E0 AS maxy,
               CAST(3 + o_orderkey % 9 AS INT) AS z
        FROM {orders}""",
    # aerial images with ground sample distance
    "fx_images": """
        SELECT concat('https://img.example.org/', p_brand, '/', p_name, '_', p_partkey, '.tif?v=', p_size) AS url,
               CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size * 0.07E0 END AS gsd,
               CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat('20', 10 + p_partkey % 14, '-0', 1 + p_partkey % 9, '-1', p_partkey % 10, 'T00:00:00Z') END AS acquisition_start,
               CAST(p_partkey * 7 % 356 - 180 AS DOUBLE) AS minx, CAST(p_partkey * 11 % 166 - 84 AS DOUBLE) AS miny,
               CAST(p_partkey * 7 % 356 - 177 AS DOUBLE) AS maxx, CAST(p_partkey * 11 % 166 - 82 AS DOUBLE) AS maxy,
               p_type AS family, p_partkey AS image_id
        FROM {part}""",
    # one four-sided region per supplier
    "fx_corners": """
        SELECT s_suppkey AS region_id, s_nationkey AS nation, i AS corner,
               (s_suppkey * 53 % 320) - 160 + CASE i WHEN 0 THEN -9.13E0 WHEN 2 THEN 11.37E0 ELSE 0.71E0 + s_suppkey % 5 END AS lon,
               (s_suppkey * 29 % 130) - 65 + CASE i WHEN 1 THEN -7.31E0 WHEN 3 THEN 8.77E0 ELSE 0.53E0 + s_suppkey % 3 END AS lat
        FROM {supplier} CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) AS c""",
    "fx_edges": """
        SELECT a.region_id, a.nation, a.corner AS seg, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2
        FROM {fx_corners} AS a JOIN {fx_corners} AS b
          ON a.region_id = b.region_id AND b.corner = (a.corner + 1) % 4""",
    # elevation pixels of one raster per tile
    "fx_elev": """
        SELECT z, x, y, px, py, max(dn) - 2000 AS elev FROM {fx_obs} GROUP BY z, x, y, px, py""",
    # asset files and their catalog
    "fx_assets": """
        SELECT concat('asset_', c_custkey) AS asset_id, c_name AS name,
               md5(concat(c_name, c_custkey % 10)) AS checksum, concat(c_name, c_custkey % 10) AS expected, c_mktsegment AS license, c_acctbal AS size
        FROM {customer}""",
    "fx_files": """
        SELECT concat('asset_', CASE WHEN c_custkey % 17 = 0 THEN c_custkey + 10000000 ELSE c_custkey END) AS asset_id,
               concat(c_name, CASE WHEN c_custkey % 13 = 0 THEN 3 ELSE c_custkey % 10 END) AS content
        FROM {customer}""",
    "fx_products": """
        SELECT concat(CASE WHEN o_orderkey % 4 = 0 THEN 'viirs_vnp09ga_' ELSE 'modis_mcd43a4_' END,
                      CASE WHEN o_orderkey % 19 = 0 THEN '20241' ELSE concat(2020 + o_orderkey % 5, lpad(CAST(o_orderkey * 7 % 380 AS VARCHAR(8)), 3, '0')) END,
                      CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE concat('_h', lpad(CAST(o_custkey % 40 AS VARCHAR(8)), 2, '0'), 'v', lpad(CAST(o_custkey % 20 AS VARCHAR(8)), 2, '0')) END) AS product_id,
               o_orderkey, o_orderstatus
        FROM {orders}""",
}


def needed(text: str) -> list[str]:
    return re.findall(r"\{([a-z]\w*)\}", text)


class Views:
    """The supplied tables and derived views of one folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and name not in VIEWS:
            raise AttributeError(name)
        if name not in self._cache:
            if name in TABLES:
                frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                frame = self.sql(VIEWS[name])
            self._cache[name] = frame
        return self._cache[name]

    def sql(self, text: str) -> DataFrame:
        escaped = text.replace("{", "{{").replace("}", "}}")
        named = re.sub(r"\{\{([a-z]\w*)\}\}", r"{\1}", escaped)
        return self.spark.sql(named, **{n: getattr(self, n) for n in set(needed(text))})


def oracle_text(sql: str) -> str:
    """Oracle SQL with the views it names added as common table expressions."""
    order: list[str] = []

    def visit(text):
        for name in needed(text):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(sql)
    plain = lambda text: re.sub(r"\{([a-z]\w*)\}", r"\1", text)
    ctes = [f"{name} AS ({plain(VIEWS[name])})" for name in order]
    body = plain(sql).strip()
    if not ctes:
        return body
    if re.match(r"(?i)with\s", body):
        return "WITH " + ", ".join(ctes) + ", " + body[4:].lstrip()
    return "WITH " + ", ".join(ctes) + " " + body
