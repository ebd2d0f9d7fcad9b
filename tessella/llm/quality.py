"""Quality scores by compression with a good and a bad dictionary.

Two zstandard dictionaries are built from labelled text. A text is cut into short blocks,
each compressed with either dictionary, so that the dictionaries count in every part of a
long text. The difference of the two sizes, divided by the text's length, is turned into a
probability by a logistic curve fitted to labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.arrow import map_batches, map_series
from tessella.llm.registry import query, table
from tessella.session import cut_lineage

LEVEL = 3
BLOCK = 1024


@dataclass(frozen=True)
class QualityModel:
    """Both dictionaries, and the curve's offset and slope."""

    good: bytes
    bad: bytes
    offset: float
    slope: float


class _Sizes:
    """Normalised size differences under a model's dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.used = []
        for data in (bad, good):
            dictionary = zstandard.ZstdCompressionDict(data) if data else None
            if dictionary:
                dictionary.precompute_compress(level=LEVEL)
            options = {"write_content_size": False, "write_dict_id": False, "write_checksum": False}
            self.used.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, **options))

    def difference(self, text: str | None) -> float:
        data = (text or "").encode()
        if not data:
            return 0.0
        view = memoryview(data)
        bad, good = (sum(len(c.compress(view[i:i + BLOCK])) for i in range(0, len(data), BLOCK)) for c in self.used)
        return (bad - good) / len(data)


def _slices(size: int):
    """One piece of each text, at a place its hash decides."""

    def step(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                data = (text.as_py() or "").encode()
                at = xxhash.xxh64_intdigest(data) % max(1, len(data) - size + 1)
                out.append(data[at:at + size])
            yield {"label": batch["label"], "place": batch["place"], "piece": out}

    return step


def _dictionary(pieces: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the pieces themselves when they are too few for one."""
    pieces = [p for p in pieces if p]
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[-size:]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Weighted logistic fit with a light pull to 0, which keeps it finite on separable data."""
    scale = float(np.abs(x).max(initial=0)) or 1.0
    design = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, design.T @ (weight * (y - p)) - 1e-3 * w)
        w += move / max(1.0, float(np.abs(move).max()) / 5)
    return float(w[0]), float(w[1] / scale)


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_class: int = 2000, in_dictionary: int = 500, piece_bytes: int = 4000, dictionary_bytes: int = 32768,
) -> QualityModel:
    """Fit on at most ``per_class`` labelled documents of each class, chosen by the id's hash.

    Up to ``in_dictionary`` of them (half at most) give a piece of ``piece_bytes`` each to
    the class's dictionary; the others, as whole texts, fit the curve, weighted so that the
    classes have their shares among all labels. These bounds are all that comes to the
    driver. Ids with contradicting labels are left out; of repeated rows of an id the least
    text counts. Without labels of both classes the score is the share of good labels (0.5
    without any).
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(shares) < 2:
        share = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
        return QualityModel(b"", b"", float(np.log(share / (1 - share))), 0.0)
    mixed = F.xxhash64("id", F.lit("quality"))
    chosen = [known.where(F.col("label") == c).orderBy(mixed, "id").limit(per_class) for c in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).withColumn("place", mixed)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # two times per_class rows of an id, a label and a hash
    sample = cut_lineage(texts.join(F.broadcast(chosen), "id").groupBy("id", "label", "place").agg(F.min("text").alias("text")))
    places = {c: sorted(r[0] for r in sample.where(F.col("label") == c).select("place").collect()) for c in (0, 1)}
    limit = {c: p[min(in_dictionary, len(p) // 2)] if len(p) > 1 else None for c, p in places.items()}
    if None in limit.values():
        return QualityModel(b"", b"", float(np.log(shares[1] / shares[0])), 0.0)
    border = F.when(F.col("label") == 1, limit[1]).otherwise(limit[0])
    pieces = map_batches(sample.where(F.col("place") < border), _slices(piece_bytes), "label int, place bigint, piece binary").collect()
    good, bad = (
        _dictionary([bytes(r["piece"]) for r in sorted(pieces, key=lambda r: r["place"]) if r["label"] == c], dictionary_bytes) for c in (1, 0)
    )

    def measure(batches):
        sizes = _Sizes(good, bad)
        for batch in batches:
            yield {"label": batch["label"], "place": batch["place"], "x": [sizes.difference(t.as_py()) for t in batch["text"]]}

    rows = map_batches(sample.where(F.col("place") >= border), measure, "label int, place bigint, x double").orderBy("place", "label").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])
    weight = np.where(y == 1, shares[1] / max(1, (y == 1).sum()), shares[0] / max(1, (y == 0).sum()))
    offset, slope = _curve(x, y, weight / weight.mean())
    return QualityModel(good, bad, offset, slope)


def quality_score(model: QualityModel, text: Column) -> Column:
    """The probability that the label is 1; null and empty texts have difference 0."""

    def task():
        sizes = _Sizes(model.good, model.bad)

        def score(body: str | None) -> float:
            x = sizes.difference(body) if model.slope else 0.0
            return 1 / (1 + math.exp(-min(30.0, max(-30.0, model.offset + model.slope * x))))

        return score

    return map_series(task, "double")(text)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on_learning_rows(docs: DataFrame, labels: DataFrame) -> QualityModel:
    return fit_quality(docs, labels.where(~held_out(F.col("doc_id"))))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Whole texts are scored; nothing else of a row is an input. Null and empty texts get the
    curve's offset; repeated rows are scored alike; an empty table gives no rows.
    """
    model = fit_on_learning_rows(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op1_quality")
def op1_quality(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
