"""Corpus pipeline: quality, near duplicates, benchmark passages, mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``docs``. ``run`` writes each stage's rows to the shared folder and hands the
next stage what it reads back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, mixing, near_copies, quality, token_files
from tessella.llm.registry import table
from tessella.session import shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of the rows it gets."""
    model = quality.fit_on_learning_rows(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model, F.col("text")) >= 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one with the smallest id."""
    return near_copies.first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return docs.where(~decontaminate.is_leaked(table(spark, sf_dir, "benchmark"), F.col("text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: runs of words of the documents, sources in their target shares."""
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, and their index as read back."""
    return token_files.token_index(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("source mix", mix_sources),
    ("token files", write_token_files),
]

#: SQL has no compression dictionaries, XXH64, tokenizers or seeded permutations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage-{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
