"""Mixing sources to target weights, in words.

Each source's documents form one stream of words, in an order their hashes decide, cut into
blocks of equal length. A source's target, in blocks, is its number of slots. Each slot falls
on an output shard at random, so the shards' counts of a source are one multinomial draw,
given its number of slots; this makes a source's share of the mix exact and leaves the
shards' sizes to chance. A slot maps to a block through a pseudorandom permutation of its
source and epoch: every block comes once before any comes again. Slots and the documents'
parts of blocks are joined by (source, block). No text moves until the mix is made.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, LongType, StringType
from pyspark.sql.window import Window

from tessella.llm.arrow import give_back
from tessella.llm.registry import query, table
from tessella.session import cut_lineage, shared_folder

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK_WORDS = 512
SHARD_SLOTS = 4096
SEED = 7
_BUCKETS = 1024
_CHUNK = 4096
_WORD = r"[^\x20\x09-\x0D]+"


def _source_key(source: Column) -> Column:
    """A key without nulls that sorts like the source by code point, null last."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("a"), source))


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, row: Column | None = None) -> DataFrame:
    """(row, id, key, size, mixed), one per row; numbers given here hold once the result is cut off."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(id_col).alias("id"), _source_key(F.col(source_col)).alias("key"),
        F.regexp_count(body, F.lit(_WORD)).cast("long").alias("size"), F.xxhash64(id_col, body, F.lit(SEED)).alias("mixed"),
    )


def source_targets(rows: DataFrame) -> DataFrame:
    """(key, total, target, base, extra, blocks), one row per source.

    The targets share all words by weight, none above ``MOST_TIMES`` its source's words: in
    the order of the words a source has for its weight, a source is full when the rest of
    the words, shared over it and all later ones, would exceed its limit. ``blocks`` blocks
    have ``base`` words each, the first ``extra`` one more. Windows over all sources see one
    row each.
    """
    totals = rows.groupBy("key").agg(F.sum("size").alias("total"))
    place = (F.row_number().over(Window.orderBy("key")) - 1) % len(WEIGHTS)
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), place + 1))
    limit = (F.col("total") * MOST_TIMES).cast("double")
    order = Window.orderBy(limit / F.col("weight"), "key")
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0.0)
    level = (F.sum("total").over(all_rows) - F.coalesce(F.sum(limit).over(before), zero)) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), zero)
    )
    levelled = weighed.withColumn("level", level).withColumn("full", limit <= F.col("level") * F.col("weight"))
    free = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(all_rows)
    target = F.when(F.col("full"), limit).otherwise(F.least(limit, free * F.col("weight")))
    blocks = F.greatest(F.lit(1), F.round(F.col("total") / BLOCK_WORDS)).cast("long")
    out = levelled.select("key", "total", target.alias("target"), blocks.alias("blocks"))
    base = F.floor(F.col("total") / F.col("blocks")).cast("long")
    return out.select("key", "total", "target", "blocks", base.alias("base"), (F.col("total") - base * F.col("blocks")).alias("extra"))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(place: np.ndarray, count: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """``place`` under a pseudorandom permutation of 0 .. ``count`` - 1 for each ``seed``.

    Four Feistel rounds over the next even power of two; what falls outside goes round again.
    """
    value, count, seed = (np.asarray(a).astype(np.uint64) for a in (place, count, seed))
    half = np.maximum(1, np.ceil(np.log2(np.maximum(count.astype(np.float64), 2)) / 2)).astype(np.uint64)
    # the logarithm of a large count may be rounded down
    half += (np.uint64(1) << (half * np.uint64(2))) < count
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(value))
    while len(todo):
        h, m, s = half[todo], mask[todo], seed[todo]
        left, right = value[todo] >> h, value[todo] & m
        for turn in range(4):
            left, right = right, left ^ (_mix(right ^ _mix(s + np.uint64(turn))) & m)
        value[todo] = (left << h) | right
        todo = todo[value[todo] >= count[todo]]
    return value.astype(np.int64)


@arrow_udf(LongType())
def _permuted(place: pa.Array, count: pa.Array, seed: pa.Array) -> pa.Array:
    return pa.array(permuted(place.to_numpy(), count.to_numpy(), seed.to_numpy()))


def slots(targets: DataFrame, seed: int = SEED) -> DataFrame:
    """(key, slot, shard, epoch, block, words), one row per slot of the mix.

    The last slot of a source takes only the words that are left to its target.
    """
    size = F.col("total") / F.col("blocks")
    whole = F.floor(F.col("target") / size + 1e-9).cast("long")
    rest = F.round(F.col("target") - whole * size).cast("long")
    need = targets.where("total > 0").select("*", whole.alias("whole"), rest.alias("rest")).withColumn("slots", F.col("whole") + (F.col("rest") > 0).cast("long"))
    shards = max(1, -(-(need.agg(F.sum("slots")).first()[0] or 0) // SHARD_SLOTS))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / _CHUNK).cast("long")))
    chunked = need.where("slots > 0").withColumn("chunk", chunks).repartition("key", "chunk")
    last = F.least(F.col("slots") - 1, F.col("chunk") * _CHUNK + _CHUNK - 1)
    rows = chunked.withColumn("slot", F.explode(F.sequence(F.col("chunk") * _CHUNK, last)))
    epoch = F.floor(F.col("slot") / F.col("blocks")).cast("long")
    block = _permuted(F.pmod("slot", "blocks"), F.col("blocks"), F.xxhash64("key", epoch, F.lit(seed)))
    words = F.when(F.col("slot") < F.col("whole"), F.lit(1 << 62)).otherwise(F.col("rest"))
    shard = F.pmod(F.xxhash64("key", "slot", F.lit(seed + 1)), F.lit(shards))
    return rows.select("key", "slot", shard.alias("shard"), epoch.alias("epoch"), block.alias("block"), words.alias("words"))


def block_parts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(row, key, block, skip, first, stop): the words of documents in the blocks.

    ``skip`` is the place in the block of the document's word ``first``. A document's place
    in its source's stream is found in two steps, over buckets of hashes and within one, so
    that no task sees a whole source.
    """
    placed = rows.where("size > 0").withColumn("bucket", F.pmod("mixed", F.lit(_BUCKETS)))
    sums = placed.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("key").orderBy("bucket")
    starts = cut_lineage(sums.select("key", "bucket", (F.sum("words").over(ahead) - F.col("words")).alias("start")))
    inside = Window.partitionBy("key", "bucket").orderBy("mixed", "id", "row").rowsBetween(Window.unboundedPreceding, 0)
    offset = placed.withColumn("upto", F.sum("size").over(inside)).join(starts, ["key", "bucket"])
    offset = offset.select("row", "key", "size", (F.col("start") + F.col("upto") - F.col("size")).alias("at"))
    known = offset.join(targets.select("key", "base", "extra"), "key")
    longer = F.col("extra") * (F.col("base") + 1)

    def block_of(word: Column) -> Column:
        short = F.col("extra") + F.floor((word - longer) / F.greatest("base", F.lit(1)))
        return F.when(word < longer, F.floor(word / (F.col("base") + 1))).otherwise(short).cast("long")

    first, last = block_of(F.col("at")), block_of(F.col("at") + F.col("size") - 1)
    cut = known.withColumn("block", F.explode(F.sequence(first, last)))
    start = F.col("block") * F.col("base") + F.least("block", "extra")
    stop = start + F.col("base") + (F.col("block") < F.col("extra")).cast("long")
    return cut.select(
        "row", "key", "block", F.greatest(F.col("at") - start, F.lit(0)).alias("skip"),
        F.greatest(start - F.col("at"), F.lit(0)).alias("first"), F.least(stop - F.col("at"), F.col("size")).alias("stop"),
    )


def taken_parts(rows: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """(row, key, shard, slot, epoch, first, stop): the words of documents that the mix takes."""
    # both sides come from explode, whose size the planner takes for that of its input
    joined = block_parts(rows, targets).hint("merge").join(slots(targets, seed), ["key", "block"])
    stop = F.least(F.col("stop"), F.col("first") + F.col("words") - F.col("skip"))
    return joined.select("row", "key", "shard", "slot", "epoch", "first", stop.alias("stop")).where("stop > first")


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken, all in words.

    A null text has size 0; such rows, and rows of sources with no words, are taken 0 times.
    A null source is a source of its own, the last. Repeated rows are documents of their
    own. Runs over the same rows agree, however the rows are laid out, up to the order of
    rows equal in id and text. An empty table gives no rows. Other columns are not read.
    """
    rows = cut_lineage(sized_rows(docs, id_col, text_col, source_col))
    targets = cut_lineage(source_targets(rows))
    taken = taken_parts(rows, targets).groupBy("row").agg(F.sum(F.col("stop") - F.col("first")).alias("taken"))
    out = rows.join(targets.select("key", F.col("total").alias("source_size"), "target"), "key").join(taken, "row", "left")
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


@arrow_udf(ArrayType(StringType()))
def _runs(text: pa.Array, parts: pa.Array) -> pa.Array:
    """The texts of a document's runs: parts of one epoch that touch are one run."""
    word = re.compile(_WORD)

    def cut(body, rows):
        runs: list[list[int]] = []
        for epoch, first, stop in sorted((p["epoch"], p["first"], p["stop"]) for p in rows):
            if runs and runs[-1][0] == epoch and runs[-1][2] == first:
                runs[-1][2] = stop
            else:
                runs.append([epoch, first, stop])
        places = [m.span() for m in word.finditer(body)]
        whole = lambda first, stop: first == 0 and stop == len(places)
        return [body if whole(f, s) else body[places[f][0]:places[s - 1][1]] for _, f, s in runs]

    try:
        return pa.array([cut(b.as_py(), p.as_py()) for b, p in zip(text, parts)], pa.list_(pa.string()))
    finally:
        give_back()


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as rows with the columns of ``docs``.

    Each row is one run of words that the mix takes from a document in one epoch; a document
    taken whole stands as it is, once per epoch. Documents of no words are not taken. The
    rows are first written to the shared folder, so that row numbers hold.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/mix-{uuid.uuid4().hex}"
    docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    kept = spark.read.parquet(path)
    rows = cut_lineage(sized_rows(kept, f"doc.{id_col}", f"doc.{text_col}", f"doc.{source_col}", F.col("row")))
    parts = taken_parts(rows, cut_lineage(source_targets(rows)))
    runs = parts.groupBy("row").agg(F.collect_list(F.struct("epoch", "first", "stop")).alias("parts"))
    made = kept.join(runs, "row").withColumn("run", F.explode(_runs(F.col(f"doc.{text_col}"), F.col("parts"))))
    changed = {text_col: F.col("run")} | ({"n_chars": F.length("run").cast("long")} if "n_chars" in docs.columns else {})
    return made.select(*[changed.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


@query("op5_mixing")
def op5_mixing(spark, sf_dir):
    return mix_report(table(spark, sf_dir, "documents"))
