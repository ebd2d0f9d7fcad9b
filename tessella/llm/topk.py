"""Exact top-k inner products by distributed histogram selection.

Vectors become integers, so scores are exact. The queries lie in the shared folder; each
task streams them, in blocks, against each batch of its rows. No score is stored. Round by
round the rows are scored and counted, per query, in the bins of the query's present range,
from the top down to the batch's own k-th score (a lower score cannot be the k-th of all).
The sums narrow the range to the bin with the k-th score, until that bin is one value. Then
each batch sends its scores from that value on, of the ties only the k smallest ids, and a
window ranks what is left. The candidates are never shuffled.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.llm.arrow import map_batches
from tessella.llm.registry import query, table
from tessella.session import shared_folder

BINS = 1024
_BLOCK = 256
_HELD = 64 << 20
_EXACT = 2.0**53
_NONE = np.iinfo(np.int64).min


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, dim, vec) with floor(scale * x) of each component, without unusable vectors."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & finite)
    whole = F.transform(vec, lambda x: F.floor(x * scale).cast("long"))
    return usable.select(F.col(id_col).cast("long").alias("id"), F.size(vec_col).alias("dim"), whole.alias("vec"))


class _QueryBlocks:
    """Blocks of queries of one dimension, from Parquet; kept in memory up to a limit."""

    def __init__(self, folder: str):
        from pyarrow import dataset
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(folder)
        self.data = dataset.dataset(path, filesystem=fs, format="parquet")
        self.kept: list | None = None

    def _read(self):
        for batch in self.data.to_batches(batch_size=_BLOCK):
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(dims == dim) if (dims != dim).any() else batch
                flat = part.column("vec").flatten().to_numpy().reshape(len(part), dim)
                yield int(dim), flat, {n: part.column(n).to_numpy() for n in ("q", "own", "low", "high")}

    def __iter__(self):
        if self.kept is not None:
            return iter(self.kept)
        if self.data.count_rows() * 8 * 256 < _HELD:
            self.kept = list(self._read())
            return iter(self.kept)
        return self._read()


def _scored(batches, blocks: _QueryBlocks, k: int):
    """For each batch and query block: the queries, ids, scores and the batch's k-th scores."""
    for batch in batches:
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims):
            keep = np.flatnonzero(dims == dim)
            ids = batch["id"].to_numpy()[keep]
            vecs = batch["vec"].take(keep).flatten().to_numpy().reshape(len(keep), dim)
            largest = float(np.abs(vecs).max(initial=0))
            floats = vecs.T.astype(np.float64)
            for block_dim, block, info in blocks:
                if block_dim != dim:
                    continue
                if float(np.abs(block).max(initial=0)) * largest * max(dim, 1) < _EXACT:
                    scores = (block.astype(np.float64) @ floats).astype(np.int64)
                else:
                    scores = block @ vecs.T
                scores[info["own"][:, None] == ids[None, :]] = _NONE
                kth = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(block), _NONE)
                yield info, ids, scores, np.maximum(kth, _NONE + 1)


def _histogram(folder: str, k: int):
    def step(batches):
        blocks = _QueryBlocks(folder)
        for info, _, scores, kth in _scored(batches, blocks, k):
            low, high = info["low"], info["high"]
            rows, columns = np.nonzero((scores >= np.maximum(kth, low)[:, None]) & (scores < high[:, None]))
            width = -(-(high - low) // BINS)
            places = (scores[rows, columns] - low[rows]) // width[rows]
            key, n = np.unique(rows * BINS + places, return_counts=True)
            yield {"q": info["q"][key // BINS], "bin": key % BINS, "n": n}

    return step


def _chosen(folder: str, k: int):
    """Scores above the k-th, and of those equal to it the k smallest ids."""

    def step(batches):
        blocks = _QueryBlocks(folder)
        for info, ids, scores, kth in _scored(batches, blocks, k):
            rows, columns = np.nonzero(scores >= np.maximum(kth, info["low"])[:, None])
            found, names = scores[rows, columns], ids[columns]
            order = np.lexsort((names, -found, rows))
            rows, found, names = rows[order], found[order], names[order]
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
            keep = rank < k
            yield {"q": info["q"][rows[keep]], "query_id": info["own"][rows[keep]], "vec_id": names[keep], "score": found[keep]}

    return step


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest scores, ties to smaller ids.

    The score is the inner product of floor(scale * x). Rows with the query's own id are no
    candidates for it; rows of another dimension have no score with it. Rows with a null id
    or vector, or a null or non-finite component, take no part. Repeated rows are candidates
    each; a repeated query is answered once for each of its rows. With fewer than ``k``
    candidates all are returned; empty tables give no rows. Scores must lie within 2 ** 61;
    larger ones do not fail, but are not ranked rightly.
    """
    spark = vectors.sparkSession
    folder = f"{shared_folder(spark)}/topk-{uuid.uuid4().hex}"
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    asked = integer_vectors(queries, id_col, vec_col, scale)
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest = rows.agg(F.max(norm)).first()[0] or 0.0
    # no score exceeds the product of the norms
    bound = F.least(F.ceil(F.sqrt(norm * longest) * (1 + 1e-9)), F.lit(1 << 61)) + 1
    state = asked.select(
        F.monotonically_increasing_id().alias("q"), F.col("id").alias("own"), "dim", "vec",
        (-bound).alias("low"), (bound + 1).alias("high"), F.lit(0).cast("long").alias("above"),
    )
    step = 0
    while True:
        path = f"{folder}/round-{step}"
        state.write.parquet(path)
        state = spark.read.parquet(path)
        if (state.agg(F.max(F.col("high") - F.col("low"))).first()[0] or 0) <= 1:
            break
        counts = map_batches(rows, _histogram(path, k), "q bigint, bin bigint, n bigint").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        summed = counts.select("q", "bin", "n", F.sum("n").over(down).alias("upto")).join(state.select(F.col("q"), "above"), "q")
        place = summed.where(F.col("above") + F.col("upto") >= k).groupBy("q").agg(F.max(F.struct("bin", (F.col("upto") - F.col("n")).alias("over"))).alias("at"))
        width = F.ceil((F.col("high") - F.col("low")) / BINS)
        first = F.col("low") + F.col("at.bin") * width
        open_ = F.col("high") - F.col("low") > 1
        # a query without a k-th score takes all there is from the low end of its range
        state = state.join(place, "q", "left").select(
            "q", "own", "dim", "vec",
            F.when(open_ & F.col("at").isNotNull(), first).otherwise(F.col("low")).cast("long").alias("low"),
            F.when(open_ & F.col("at").isNotNull(), F.least("high", first + width)).otherwise(F.col("low") + 1).cast("long").alias("high"),
            F.when(open_ & F.col("at").isNotNull(), F.col("above") + F.col("at.over")).otherwise(F.col("above")).cast("long").alias("above"),
        )
        step += 1
    found = map_batches(rows, _chosen(path, k), "q bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op4_topk", """
    WITH v AS MATERIALIZED (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * c.vec[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec))
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""")
def op4_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))
