"""Quality scores: held-out accuracy, rows that teach nothing, odd rows."""

import zlib

from tessella.llm.quality import fit_on_learning_rows, held_out, score_documents
from tests.conftest import SF
from tests.llm.cases import documents, empty


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    share = sum(r["quality"] for r in rows) / len(rows)
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    assert right > 0.95 > share and all(0 <= r["score"] <= 1 for r in rows)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", labels["quality"])
    turned = turned.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    assert fit_on_learning_rows(docs, labels) == fit_on_learning_rows(docs, turned)
    assert labels.where(held_out(labels["doc_id"])).count() > 0


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0, "c") for i, q in rows], "doc_id long, quality int, toxic int, text string")


def test_odd_rows(spark):
    docs = documents(spark, [(100 + i, f"good words of prose number {i} " * 9 if i % 2 else f"$$$ {i} &&& " * 20, "s") for i in range(60)])
    known = labels(spark, [(100 + i, i % 2) for i in range(60)] + [(100, 1), (5, None), (None, 1), (4, 7), (101, 1)])
    rows = score_documents(docs, known).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    good = {r["doc_id"]: r["score"] for r in rows}
    assert min(good[100 + i] for i in range(1, 60, 2)) > max(good[100 + i] for i in range(0, 60, 2))
    twins = [r["score"] for r in rows if r["doc_id"] in (5, 6)]
    assert len(set(twins)) == 1 and not next(r for r in rows if r["doc_id"] is None)["held_out"]


def test_labels_of_one_class_or_none(spark):
    docs = documents(spark)
    for known in ([], [(1, 1), (2, 1), (3, 1)], [(2, 1), (5, 0)]):
        rows = score_documents(docs, labels(spark, known)).collect()
        assert len(rows) == docs.count() and len({r["score"] for r in rows}) == 1
    assert score_documents(empty(spark), labels(spark, [])).collect() == []
