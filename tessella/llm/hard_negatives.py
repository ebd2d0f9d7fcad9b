"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors near each other share a block of at most ``BLOCK``, and a block holds its minimum
spanning tree. A score at a child lies within edge length times candidate norm of the score
at its parent, so bounds run down the tree from the root, where all scores are known. Only
candidates whose bounds overlap an anchor's window are scored there, exactly, and go on with
the exact score as their bounds.

The blocks lie in the shared folder. Each task holds a bounded run of candidates and streams
the blocks against it, once with the windows of the positives (from the score that the
block's own anchors already reach), once with the windows that the positives give.
Candidates never shuffle; a run sends the few best of each anchor and window.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.llm.arrow import map_batches
from tessella.llm.registry import query, table
from tessella.session import cut_lineage, shared_folder

BLOCK = 256
_SLAB = 8192
_HELD = 64 << 20
_EXACT = 2.0**53
#: Scores are held within 64 bits.
LARGEST = (1 << 63) - 2
_NONE = -LARGEST - 1
_SLACK = 1 + 1e-9
_KEY = 16
_BLOCKS = (
    "block bigint, dim int, ids array<bigint>, labels array<bigint>, vecs array<bigint>, parents array<int>, edges array<double>, lows array<bigint>"
)


def labelled_vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, dim, vec) with floor(scale * x) of each component, without unusable rows."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
    whole = F.transform(vec, lambda x: F.floor(x * scale).cast("long"))
    return usable.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.size(vec_col).alias("dim"), whole.alias("vec"))


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, within ``LARGEST``."""
    top = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(a.shape[1], 1)
    if top < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < LARGEST:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -LARGEST, LARGEST).astype(np.int64)


def spanning_tree(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parents (places in the order, -1 for the root) and edge lengths, root first."""
    n, real = len(vecs), vecs.astype(np.float64)
    order, parents, edges = [0], [-1], [0.0]
    best, near = np.full(n, np.inf), np.zeros(n, np.int64)
    inside = np.zeros(n, bool)
    inside[0] = True
    while len(order) < n:
        gap = real - real[order[-1]]
        length = np.sqrt((gap * gap).sum(axis=1))
        closer = length < best
        best[closer], near[closer] = length[closer], len(order) - 1
        at = int(np.argmin(np.where(inside, np.inf, best)))
        if inside[at]:
            at = int(np.flatnonzero(~inside)[0])
        inside[at] = True
        order.append(at)
        parents.append(int(near[at]))
        edges.append(float(best[at]))
    return np.array(order), np.array(parents, np.int32), np.array(edges)


def _blocks(k: int):
    """Blocks of consecutive anchors of one dimension, with their trees and first windows."""

    def block(number, ids, labels, vecs):
        order, parents, edges = spanning_tree(vecs)
        ids, labels, vecs = ids[order], labels[order], vecs[order]
        scores = _inner(vecs, vecs)
        scores[(labels[:, None] != labels[None, :]) | (ids[:, None] == ids[None, :])] = _NONE
        # the k-th best of any rows is a lower bound of the k-th best of all
        lows = np.sort(scores, axis=1)[:, -k] if len(ids) >= k else np.full(len(ids), _NONE)
        return {"block": number, "dim": vecs.shape[1], "ids": ids, "labels": labels, "vecs": vecs.ravel(), "parents": parents, "edges": edges, "lows": lows}

    def step(batches):
        number, held = TaskContext.get().partitionId() << 32, {}

        def out(dim):
            nonlocal number
            ids, labels, vecs = zip(*held.pop(dim))
            number += 1
            row = block(number, np.array(ids, np.int64), np.array(labels, np.int64), np.array(vecs, np.int64).reshape(len(ids), dim))
            return {name: [value] for name, value in row.items()}

        for batch in batches:
            for i, label, dim, vec in zip(*(batch[c].to_pylist() for c in ("id", "label", "dim", "vec"))):
                held.setdefault(dim, []).append((i, label, vec))
                if len(held[dim]) == BLOCK:
                    yield out(dim)
        for dim in list(held):
            yield out(dim)

    return step


def _stream(folder: str, extra: tuple[str, ...] = ()):
    """The blocks of the shared folder, a few at a time."""
    from pyarrow import dataset
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(folder)
    for batch in dataset.dataset(path, filesystem=fs, format="parquet").to_batches(batch_size=8, batch_readahead=1, fragment_readahead=1):
        for row in range(len(batch)):
            value = lambda c: batch.column(c)[row].values.to_numpy(zero_copy_only=False)
            one = {c: value(c) for c in ("ids", "labels", "parents", "edges", "lows", *extra)}
            one["block"], dim = batch.column("block")[row].as_py(), batch.column("dim")[row].as_py()
            yield dim, one | {"vecs": value("vecs").reshape(len(one["ids"]), dim)}


class _Run:
    """Candidates of one dimension that a task holds."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray):
        self.ids, self.labels, self.vecs = ids, labels, vecs
        self.slabs = []
        for at in range(0, len(ids), _SLAB):
            part = vecs[at:at + _SLAB]
            norms = np.sqrt((part.astype(np.float64) ** 2).sum(axis=1)) * _SLACK
            self.slabs.append((ids[at:at + _SLAB], labels[at:at + _SLAB], part, norms))


def _runs(batches):
    """The task's candidates in runs of a bounded size, each of one dimension."""
    held: dict[int, list] = {}
    size = 0

    def out():
        for dim, parts in held.items():
            yield dim, _Run(*(np.concatenate(x) for x in zip(*parts)))
        held.clear()

    for batch in batches:
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims):
            keep = np.flatnonzero(dims == dim)
            vecs = batch["vec"].take(pa.array(keep)).flatten().to_numpy().reshape(len(keep), dim)
            held.setdefault(int(dim), []).append((batch["id"].to_numpy()[keep], batch["label"].to_numpy()[keep], vecs))
            size += vecs.nbytes
        if size >= _HELD:
            yield from out()
            size = 0
    yield from out()


def _down_the_tree(block: dict, slab, wanted, take) -> None:
    """Carry score bounds from anchor to anchor; ``take`` gets the exact scores it needs.

    ``wanted(place)`` gives (mask of candidates, low, high): those whose bounds overlap
    [low, high] are scored.
    """
    ids, _, vecs, norms = slab
    bounds: list = []
    for place, parent in enumerate(block["parents"]):
        anchor = block["vecs"][place:place + 1]
        if parent < 0:
            exact = _inner(anchor, vecs)[0]
            low = high = exact.astype(np.float64)
            known = None
        else:
            reach = block["edges"][place] * _SLACK * norms + 1e-6
            low, high = bounds[parent][0] - reach, bounds[parent][1] + reach
            slack = np.maximum(np.abs(low), np.abs(high)) * 1e-12
            low, high = low - slack, high + slack
        mask, least, most = wanted(place)
        # a bound that is not a number settles nothing
        near = np.flatnonzero(mask & ~(high < least) & ~(low > most))
        if parent < 0:
            scores = exact[near]
        else:
            scores = _inner(anchor, vecs[near])[0] if len(near) else np.zeros(0, np.int64)
            low[near] = high[near] = scores
        bounds.append((low, high))
        take(place, near, scores)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: high scores first, ties by small ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def _positives(folder: str, k: int):
    def step(batches):
        for dim, run in _runs(batches):
            for block_dim, block in _stream(folder):
                if block_dim != dim:
                    continue
                low = block["lows"].copy()
                found: list = [[] for _ in low]
                for slab in run.slabs:
                    ids, labels = slab[:2]

                    def wanted(place):
                        return (labels == block["labels"][place]) & (ids != block["ids"][place]), low[place], np.inf

                    def take(place, near, scores):
                        near, scores = near[scores >= low[place]], scores[scores >= low[place]]
                        best = _best(scores, ids[near], k)
                        found[place] = sorted(found[place] + [(-s, i) for s, i in zip(scores[best].tolist(), ids[near[best]].tolist())])[:k]
                        if len(found[place]) == k:
                            low[place] = max(low[place], -found[place][-1][0])

                    _down_the_tree(block, slab, wanted, take)
                rows = [(block["block"], place, i, -s) for place, best in enumerate(found) for s, i in best]
                if rows:
                    yield dict(zip(("block", "place", "id", "score"), map(list, zip(*rows))))

    return step


def _negatives(folder: str, k: int, low_share: tuple[int, int], high_share: tuple[int, int]):
    """The best of each positive's window, for candidates with other labels."""

    def window(score: int) -> tuple[int, int]:
        return -((-score * low_share[0]) // low_share[1]), score * high_share[0] // high_share[1]

    def step(batches):
        for dim, run in _runs(batches):
            for block_dim, block in _stream(folder, ("p_place", "p_id", "p_score")):
                if block_dim != dim:
                    continue
                windows: dict[int, list] = {}
                for n, (place, score) in enumerate(zip(block["p_place"].tolist(), block["p_score"].tolist())):
                    low, high = window(score)
                    if low <= high:
                        windows.setdefault(place, []).append([n, low, high, []])
                for slab in run.slabs:
                    ids, labels = slab[:2]

                    def wanted(place):
                        ranges = windows.get(place)
                        if not ranges:
                            return np.zeros(len(ids), bool), 0, -1
                        mask = (labels != block["labels"][place]) & (ids != block["ids"][place])
                        return mask, min(r[1] for r in ranges), max(r[2] for r in ranges)

                    def take(place, near, scores):
                        for one in windows.get(place, ()):
                            _, low, high, best = one
                            inside = np.flatnonzero((scores >= low) & (scores <= high))
                            top = inside[_best(scores[inside], ids[near[inside]], k)]
                            best = sorted(best + [(-s, i) for s, i in zip(scores[top].tolist(), ids[near[top]].tolist())])[:k]
                            one[3] = best
                            if len(best) == k:
                                one[1] = max(low, -best[-1][0])

                    _down_the_tree(block, slab, wanted, take)
                rows = [
                    (block["block"], n, int(block["ids"][place]), int(block["p_id"][n]), int(block["p_score"][n]), i, -s)
                    for place, ranges in windows.items() for n, _, _, best in ranges for s, i in best
                ]
                if rows:
                    names = ("block", "n", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
                    yield dict(zip(names, map(list, zip(*rows))))

    return step


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low_share: tuple[int, int] = (50, 100), high_share: tuple[int, int] = (95, 100),
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    The score is the inner product of floor(scale * x); higher scores come first, ties by
    smaller id. An anchor's positives are its first ``positives`` rows of the same label; for
    each, the first ``negatives`` rows of another label whose scores lie between the two
    shares of the positive's score. Rows with the anchor's id take no part for it, rows of
    another dimension have no score with it. Rows with a null id, label or vector, or a null
    or non-finite component, take no part. Repeated rows count each; a repeated anchor is
    answered for each of its rows. Empty tables give no rows; other columns are not read.
    Scores beyond 64 bits are held at their ends.
    """
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/hard-negatives-{uuid.uuid4().hex}"
    args = (id_col, vec_col, label_col, scale)
    candidates, asked = labelled_vectors(rows, *args), labelled_vectors(anchors, *args)
    # anchors with like signs fall into the same blocks
    signs = F.array_join(F.transform(F.slice("vec", 1, _KEY), lambda x: F.when(x >= 0, "1").otherwise("0")), "")
    ordered = asked.withColumn("signs", signs).repartitionByRange("dim", "signs", "id").sortWithinPartitions("dim", "signs", "id").drop("signs")
    map_batches(ordered, _blocks(positives), _BLOCKS).write.parquet(f"{folder}/trees")
    trees = spark.read.parquet(f"{folder}/trees")
    found = map_batches(candidates, _positives(f"{folder}/trees", positives), "block bigint, place int, id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= positives)
    # at most BLOCK * positives of a block
    lists = best.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "rank", "id", "score"))).alias("p"))
    lists = lists.select("block", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("place", "id", "score")])
    trees.join(lists.hint("merge"), "block").write.parquet(f"{folder}/windows")
    columns = "block bigint, n int, anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    mined = map_batches(candidates, _negatives(f"{folder}/windows", negatives, low_share, high_share), columns)
    rank = F.row_number().over(Window.partitionBy("block", "n").orderBy(F.desc("negative_score"), "negative_id"))
    chosen = mined.withColumn("rank", rank).where(F.col("rank") <= negatives)
    result = cut_lineage(chosen.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    drop_folder(folder)
    return result


def drop_folder(folder: str) -> None:
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(folder)
    fs.delete_dir(path)


@query("op13_hard_negatives", """
    WITH v AS MATERIALIZED (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS MATERIALIZED (
      SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.vec) + 1), lambda i: a.vec[i] * c.vec[i])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.vec) = len(c.vec)),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    QUALIFY rank <= 3""")
def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0))
