"""Streaming operators over the supplied tables, run until their input is used up."""

import uuid

from pyspark.sql import functions as F

from tessella.fixtures import Views
from tessella.queries import query
from tessella.queries.sources import CATALOG
from tessella.session import shared_folder
from tessella.sources.catalogs import parse_catalog_lines
from tessella.streaming import KeyIndex, TileTable, rolling_counters, skip_known


class StreamViews(Views):
    """The same views with ``events`` read as a stream of files."""

    @property
    def events(self):
        schema = self.spark.read.parquet(f"{self.sf_dir}/events.parquet").schema
        reader = self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
        return reader.parquet(self.sf_dir)


def streamed(v):
    return StreamViews(v.spark, v.sf_dir), f"{shared_folder(v.spark)}/{uuid.uuid4().hex}"


@query("str_catalog", CATALOG)
def _(v):
    s, folder = streamed(v)
    rows = parse_catalog_lines(s.fx_catalog)
    run = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/check")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    run.awaitTermination()
    return v.spark.read.parquet(f"{folder}/rows")


@query("str_tile_upsert", """
    SELECT z, x, y, seq, payload FROM (SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY seq DESC) AS r FROM {fx_tiles}) AS t WHERE r = 1""")
def _(v):
    s, folder = streamed(v)
    table = TileTable(f"{folder}/tiles", ["seq"])
    # five micro-batches, late older rows among them, and one stream that starts again
    for k in (3, 0, 4, 1, 2):
        table.start(s.fx_tiles.filter(F.col("seq") % 5 == k), f"{folder}/stream-{k}").awaitTermination()
    table.start(s.fx_tiles.filter(F.col("seq") % 5 == 3), f"{folder}/again").awaitTermination()
    return table.read(v.spark).select("z", "x", "y", "seq", "payload")


@query("str_skip_known", """
    SELECT seq, z, x, y FROM {fx_tiles} AS t WHERE NOT EXISTS (SELECT 1 FROM {fx_tiles} AS k WHERE k.src = 0 AND k.z = t.z AND k.x = t.x AND k.y = t.y)""")
def _(v):
    s, folder = streamed(v)
    index = KeyIndex(f"{folder}/index")
    index.add(v.fx_tiles.filter(F.col("src") == 0), 0)
    sink = lambda frame, batch_id: frame.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")
    skip_known(s.fx_tiles, index, sink, f"{folder}/check").awaitTermination()
    return v.spark.read.parquet(f"{folder}/rows").select("seq", "z", "x", "y")


@query("str_fetch_counters", """
    SELECT date_trunc('hour', ts) AS start, count(*) FILTER (WHERE status = 200) AS ok, count(*) FILTER (WHERE status = 0) AS cached, count(*) FILTER (WHERE status = 404) AS http_404,
           count(*) FILTER (WHERE status = 503) AS blocked, CAST(sum(bytes) AS BIGINT) AS bytes
    FROM {fx_fetch_log} GROUP BY 1""")
def _(v):
    s, folder = streamed(v)
    counters = rolling_counters(s.fx_fetch_log.withColumn("ts", F.col("ts").cast("timestamp")), "1 hour", "1 day")
    run = (
        counters.writeStream.foreachBatch(
            lambda frame, batch_id: frame.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")
        )
        .outputMode("update")
        .option("checkpointLocation", f"{folder}/check")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    rows = v.spark.read.parquet(f"{folder}/rows")
    # a window is rewritten by every batch that touched it; the last one counts
    values = ["ok", "cached", "http_404", "blocked", "bytes"]
    last = rows.groupBy("start").agg(F.max_by(F.struct(*values), "batch").alias("r"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "r.*")
