"""Near duplicates by SimHash, over an inverted index of positional bytes.

Fingerprints at ``MAX_BITS`` differing bits or fewer differ in as many bytes at most, so
they share five of eight positional bytes, and three of these lie in one half. The index
lists each distinct fingerprint under the eight triples of positional bytes of its halves.
Within a list the shared bytes of each pair are tallied, pairs with fewer than five are
dropped, and the rest is verified bit by bit. A list sends on a spanning set of its links,
never all pairs, which keeps its components whole. A list of more than ``BLOCK``
fingerprints is cut into blocks; every two blocks meet in a group of their own.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.arrow import map_batches, map_series
from tessella.llm.components import components
from tessella.llm.registry import query, table
from tessella.session import cut_lineage

MAX_BITS = 3
SHARED = 8 - MAX_BITS
BLOCK = 2048
SEED = 42
_TRIPLES = [(h + a, h + b, h + c) for h in (0, 4) for a, b, c in ((0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3))]
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits, each 1 where over half of the shingles' hashes have it; 0 without words."""
    found = _WORD.findall((text or "").encode().translate(_LOWER))
    if not found:
        return 0
    ends = np.cumsum([len(w) + 1 for w in found])
    joined = b" ".join(found)
    starts = np.concatenate([[0], ends[:-1]])
    count = max(1, len(found) - words + 1)
    lasts = ends[min(words, len(found)) - 1:] - 1
    pieces = (joined[s:e] for s, e in zip(starts[:count].tolist(), lasts.tolist()))
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in pieces), np.uint64, count)
    total = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        total += np.unpackbits(hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > count).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, print) of each row's whole text, the print as a signed bigint."""

    def step(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch["text"]], np.uint64)
            yield {"id": batch["id"], "print": prints.view(np.int64)}

    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), step, "id bigint, print bigint")


def _list_key(triple: int) -> Column:
    """The number of the triple and its three bytes."""
    key = F.lit(triple).cast("long")
    for position in _TRIPLES[triple]:
        byte = F.shiftrightunsigned(F.col("print"), 8 * position).bitwiseAND(F.lit(255))
        key = F.shiftleft(key, 8).bitwiseOR(byte)
    return key


class _Sets:
    """Least-number labels over local rows; links of one row to many at a time."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, row: int, others: np.ndarray):
        touched = np.unique(np.append(self.label[others], self.label[row]))
        if len(touched) > 1:
            self.label[np.isin(self.label, touched)] = touched[0]


def _linked(prints: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of two lists' fingerprints are near: bytes tallied, then bits counted."""
    a, b = prints.view(np.uint8).reshape(-1, 8), others.view(np.uint8).reshape(-1, 8)
    tally = np.zeros((len(a), len(b)), np.uint8)
    for position in range(8):
        tally += a[:, position, None] == b[None, :, position]
    near = tally >= SHARED
    rows, columns = np.nonzero(near)
    near[rows, columns] = np.bitwise_count(prints[rows] ^ others[columns]) <= MAX_BITS
    return near


def group_links(prints: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """A spanning set of the links of one group.

    In a group of one block all pairs count, in a group of two those between the blocks.
    """
    two = block.min() != block.max()
    order = np.lexsort((prints, block))
    prints = prints[order]
    cut = int((block == block.min()).sum()) if two else 0
    sets = _Sets(len(prints))
    rows = range(0, cut) if two else range(0, len(prints) - 1)
    for at in range(rows.start, rows.stop, 256):
        stop = min(rows.stop, at + 256)
        first = cut if two else at + 1
        near = _linked(prints[at:stop], prints[first:])
        for i in np.flatnonzero(near.any(axis=1)):
            sets.link(at + i, first + np.flatnonzero(near[i]))
    moved = np.flatnonzero(sets.label != np.arange(len(prints)))
    return [(int(prints[i].view(np.int64)), int(prints[sets.label[i]].view(np.int64))) for i in moved]


def _small_links(prints: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links of many small sorted groups: each row against the next, the second next ..."""
    left, right, step = [], [], 1
    while step < len(prints):
        same = np.flatnonzero(groups[step:] == groups[:-step])
        if not len(same):
            break
        a, b = prints[same], prints[same + step]
        tally = (np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8) == np.ascontiguousarray(b).view(np.uint8).reshape(-1, 8)).sum(axis=1)
        near = (tally >= SHARED) & (np.bitwise_count(a ^ b) <= MAX_BITS)
        left.append(a[near])
        right.append(b[near])
        step += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (prints[:0], prints[:0])


_SMALL = 16


def _links(batches):
    """Links of each run of equal ``cell`` values; runs may go over batch borders."""
    held: list[tuple[np.ndarray, ...]] = []

    def work(cells, prints, blocks):
        starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        sizes = np.diff(np.append(starts, len(cells)))
        number = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat((sizes <= _SMALL) & (blocks[starts] < 0), sizes)
        u, v = _small_links(prints[small], number[small])
        out = [(u.view(np.int64), v.view(np.int64))] if len(u) else []
        for s, size in zip(starts, sizes):
            if size > 1 and not small[s]:
                pairs = group_links(prints[s:s + size], blocks[s:s + size])
                if pairs:
                    out.append(tuple(np.array(pairs, np.int64).T))
        if out:
            yield {"u": np.concatenate([o[0] for o in out]), "v": np.concatenate([o[1] for o in out])}

    for batch in batches:
        cells = batch["cell"].to_numpy(zero_copy_only=False)
        held.append((cells, batch["print"].to_numpy(zero_copy_only=False).view(np.uint64), batch["block"].to_numpy(zero_copy_only=False)))
        cells, prints, blocks = (np.concatenate(x) for x in zip(*held))
        last = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
        held = [(cells[last:], prints[last:], blocks[last:])]
        if last:
            yield from work(cells[:last], prints[:last], blocks[:last])
    if held and len(held[0][0]):
        yield from work(*held[0])


def near_links(nodes: DataFrame) -> DataFrame:
    """(u, v) links among distinct fingerprints (column ``print``) that span all near pairs."""
    listed = nodes.select("print", F.explode(F.array(*[_list_key(t) for t in range(len(_TRIPLES))])).alias("key"))
    long = listed.groupBy("key").count().where(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    cut = listed.join(long, "key", "left").withColumn("block", F.when(F.col("blocks").isNull(), -1).otherwise(own))
    met = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = cut.select("key", "print", "block", F.explode(met).alias("other"))
    cell = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    ordered = cells.select(cell.alias("cell"), "print", "block").repartition("cell").sortWithinPartitions("cell")
    return map_batches(ordered, _links, "u bigint, v bigint")


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, DataFrame]:
    """(id, print) of each row, and (print, least, root, component_id) of each fingerprint."""
    prints = cut_lineage(fingerprints(docs, id_col, text_col, words))
    nodes = cut_lineage(prints.groupBy("print").agg(F.min("id").alias("least")))
    roots = components(near_links(nodes)).withColumnRenamed("node", "print")
    rooted = nodes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    named = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    return prints, cut_lineage(rooted.join(named, "root").select("print", "least", "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, ``print`` (bigint) and ``component_id``.

    Rows whose fingerprints differ in ``MAX_BITS`` bits or fewer are linked; the component's
    id is the smallest id in it (null ids count only when there is no other). Null and empty
    texts and texts without words have fingerprint 0 and are linked like all others; texts
    of fewer words than a shingle are one shingle. Copies share one fingerprint and are
    never paired; an empty table gives no rows. Other columns are not read.
    """
    prints, classes = _classes(docs, id_col, text_col, words)
    return prints.join(classes.select("print", "component_id"), "print").select(F.col("id").alias(id_col), "print", "component_id")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One row of each group of near duplicates, with all columns: that of the smallest id.

    Of rows that share the id and the fingerprint, the one with the least text hash stays.
    """
    _, classes = _classes(docs, id_col, text_col, words)
    chosen = classes.where(F.col("least").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(F.struct("print", "component_id")).alias("first"))
    no_id, some_id = F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("some_id")
    chosen = chosen.select("first.print", F.col("first.component_id").alias("id")).select("print", no_id, some_id)

    def task():
        return lambda text: int(np.uint64(fingerprint(text, words)).view(np.int64))

    printed = map_series(task, "bigint")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), printed(F.col(text_col)).alias("print"))
    rows = rows.select("doc", "print", no_id, some_id).groupBy("print", "no_id", "some_id").agg(F.min_by("doc", F.xxhash64(f"doc.{text_col}")).alias("doc"))
    return rows.join(chosen, ["print", "no_id", "some_id"], "left_semi").select("doc.*")


@query("op6_simhash")
def op6_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
