"""Near copies: texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Distinct shingle sets are nodes with a SimHash print of ``BYTES`` bytes. An inverted index
lists each node under ``TABLES`` pairs of positional bytes; a pair of similarity 0.8 differs
in 15% of its bits and shares no list with a chance of 8e-3, one of 0.85 with 6e-4, a closer
pair with less. A list's rows carry eight more bytes of the print, which drop pairs by
differing bits. For the others the shared positional bytes of the whole prints are tallied,
then their differing bits, and what is left is checked on the whole sets.

Copies are one node. A list of more near pairs than rows sends on its rows instead, which meet
again by their whole prints and leave a spanning set of the pairs that pass. The pairs of all
lists join the nodes to clusters, and in each cluster the whole sets are checked, nearest pairs
first and only those that no link has joined yet. So a large group of near copies passes
through rows in proportion to its nodes, never as pairs. Large groups are cut into
blocks; every two blocks meet in a cell of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.arrow import map_batches, map_series
from tessella.llm.components import components
from tessella.llm.simhash import _LOWER, _WORD, SEED, _Sets
from tessella.operators.skew import BROADCAST_ROWS
from tessella.session import cut_lineage, shared_folder

WORDS, SIMILARITY = 5, 0.8
BYTES = 128
TABLES = BYTES // 2
#: Differing bits of the eight bytes beside a list's own: 9.7 +- 2.9 at similarity 0.8, 32 +- 4 by chance.
BESIDE_BITS = 18
#: A pair of similarity 0.8 shares 35 +- 5 of the print's bytes and differs in 155 +- 12 of its bits.
SHARED, PRINT_BITS = 16, 195
#: Sets of fewer shingles vary more: 192 +- 13 bits at 4 of 5 shingles, 384 +- 15 by chance for the smallest.
SMALL, SMALL_BITS = 64, 300
#: Lists of more rows, or with more near pairs a row, send on rows; those of ``SLAB`` all of theirs.
LONG, DENSE, SLAB = 128, 1, 1 << 16
#: Rows of a list's and of a cluster's block while there are at most ``BLOCKS``; then blocks grow to ``WEIGHT`` hashes.
LIST_BLOCK, BLOCK, BLOCKS, WEIGHT = 512, 96, 64, 1 << 18
#: Links for each task of the rounds that join them.
LINKS = 1 << 15
#: Odd factors of the hashes that make a print; fixed values.
_FACTOR = np.array([xxhash.xxh64_intdigest(f"factor{i}".encode(), SEED) | 1 for i in range(BYTES // 8 + 1)], np.uint64)
_TIE = np.uint64(xxhash.xxh64_intdigest(b"tie", SEED))
_HALF = np.uint64(32)
_LANES = 255  # bits that a byte can count


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles' hashes in order; a text of fewer words is one shingle."""
    found = _WORD.findall((text or "").encode().translate(_LOWER))
    pieces = {b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else ()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in pieces), np.uint64, len(pieces)))


def node_of(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63)


def long_print(found: np.ndarray) -> bytes:
    """SimHash of ``BYTES`` bytes: each bit is that of most shingles.

    An even number gets one more vote, the same for all sets, so there are no ties. An empty
    set has no print, as it is near to itself only.
    """
    if not len(found):
        return b""
    votes = found if len(found) % 2 else np.append(found, _TIE)
    total = np.zeros(8 * BYTES, np.int64)
    for at in range(0, len(votes), 16 * _LANES):
        mixed = votes[at:at + 16 * _LANES, None] * _FACTOR[:-1]
        mixed = (mixed ^ mixed >> _HALF) * _FACTOR[-1]
        bits = np.unpackbits((mixed ^ mixed >> _HALF).view(np.uint8), axis=1)
        counts = np.add.reduceat(bits.view(np.uint64), range(0, len(bits), _LANES), axis=0)  # eight counts in one number
        total += counts.view(np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(votes)).tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _described(words: int):
    def task():
        def one(text):
            found = shingles(text, words)
            return {"node": node_of(found), "size": len(found), "print": long_print(found)}

        return one

    return map_series(task, "struct<node:bigint,size:int,print:binary>")


def _packed(words: int):
    def step(batches):
        for batch in batches:
            yield {"key": batch["key"], "node": batch["node"], "packed": [shingles(t.as_py(), words).tobytes() for t in batch["text"]]}

    return step


def _prints(column) -> np.ndarray:
    return np.frombuffer(b"".join(p.as_py() for p in column), np.uint8).reshape(-1, BYTES)


def _beside(prints: np.ndarray, table: int) -> np.ndarray:
    """The eight bytes after a list's own two, as numbers."""
    return np.ascontiguousarray(np.take(prints, range(2 * table + 2, 2 * table + 10), axis=1, mode="wrap")).view(np.int64).ravel()


def _listed(batches):
    """The index: each node under its pairs of positional bytes, with the eight bytes beside."""
    for batch in batches:
        prints = _prints(batch["print"])
        for table in range(TABLES):
            key = prints[:, 2 * table].astype(np.int32) << 8 | prints[:, 2 * table + 1]
            yield {"cell": key | table << 16, "node": batch["node"], "beside": _beside(prints, table)}


def _joined(beside: np.ndarray) -> np.ndarray:
    """The least row that each row of a list is joined to by near pairs."""
    sets = _Sets(len(beside))
    for i in range(len(beside) - 1):
        near = np.flatnonzero(np.bitwise_count(beside[i + 1:] ^ beside[i]) <= BESIDE_BITS)
        if len(near):
            sets.link(i, i + 1 + near)
    return sets.label


def _met(cells: np.ndarray, nodes: np.ndarray, beside: np.ndarray, whole: int = -1) -> Iterator[dict]:
    """Near pairs of lists: each row against the next, the second next ...

    Of a long or dense list, the rows with a near row, as pairs that join them, with the
    list's cell. All rows of the cell ``whole`` go on.
    """
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    sizes = np.diff(np.append(starts, len(cells)))
    owner = np.repeat(np.arange(len(starts)), sizes)
    dense = (sizes > LONG) | (cells[starts] == whole)
    short = np.flatnonzero(~dense[owner])
    at, group, mark = short, owner[short], beside[short]
    pairs, found = np.zeros(len(starts), np.int64), []
    for step in range(1, int(sizes[~dense].max(initial=1))):
        same = np.flatnonzero(group[step:] == group[:-step])
        same = same[np.bitwise_count(mark[same] ^ mark[same + step]) <= BESIDE_BITS]
        if len(same):
            pairs += np.bincount(group[same], minlength=len(starts))
            found.append((at[same], at[same + step]))
    dense |= pairs > DENSE * sizes
    for a, b in found:
        kept = ~dense[owner[a]]
        yield {"cell": pa.nulls(int(kept.sum()), pa.int32())} | _ordered(nodes[a[kept]], nodes[b[kept]])
    for i in np.flatnonzero(dense):
        own = slice(starts[i], starts[i] + sizes[i])
        if cells[starts[i]] == whole:
            near, label = np.arange(sizes[i]), np.zeros(sizes[i], np.int64)
        else:
            label = _joined(beside[own])
            near = np.flatnonzero(label != np.arange(len(label)))
        yield {"cell": cells[starts[i]].repeat(len(near))} | _ordered(nodes[own][near], nodes[own][label[near]])


def _ordered(a: np.ndarray, b: np.ndarray) -> dict:
    return {"u": np.minimum(a, b), "v": np.maximum(a, b)}


def _candidates(batches):
    """What lists send on, from runs of equal cells: pairs, or (cell, node, node) for rows.

    Runs may go over batch borders.
    """
    held, whole = None, -1

    def sent(columns):
        for out in _met(*columns, whole):
            if isinstance(out["cell"], np.ndarray):
                nodes = np.unique(np.concatenate([out["u"], out["v"]]))
                out = {"cell": out["cell"][:1].repeat(len(nodes)), "u": nodes, "v": nodes}
            yield out

    for batch in batches:
        columns = [_numbers(batch[n]) for n in ("cell", "node", "beside")]
        held = columns if held is None else [np.concatenate(pair) for pair in zip(held, columns)]
        if not len(held[0]):
            continue
        last = int(np.searchsorted(held[0], held[0][-1]))
        if len(held[0]) - last >= SLAB:
            last, whole = len(held[0]), int(held[0][-1])
        if last:
            yield from sent([c[:last] for c in held])
        held = [c[last:] for c in held]
    if held is not None and len(held[0]):
        yield from sent(held)


def _passes(left: np.ndarray, right: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two columns of prints that share enough bytes and differ in few bits; all rows' differing bits."""
    bits = np.bitwise_count(left.view(np.uint64) ^ right.view(np.uint64)).sum(axis=1, dtype=np.int32)
    near = np.flatnonzero(bits <= np.where(small, SMALL_BITS, PRINT_BITS))
    shared = (left[near] == right[near]).sum(axis=1) >= SHARED
    return near[small[near] | shared], bits


def _alike(batches):
    """Pairs that share enough positional bytes and differ in few bits, with the number of these."""
    for batch in batches:
        small = batch["size"].to_numpy(zero_copy_only=False) < SMALL
        near, bits = _passes(_prints(batch["left"]), _prints(batch["right"]), small)
        yield {"u": batch["u"].take(near), "v": batch["v"].take(near), "bits": bits[near]}


def _cell_pairs(prints: np.ndarray, sizes: np.ndarray, block: np.ndarray, least: float):
    """(rows, rows, differing bits) of a cell's pairs whose sizes and prints allow the similarity.

    Of a cell of two blocks, only pairs between them. ``block`` is in order.
    """
    cut = int(np.searchsorted(block, block[0], "right"))
    two = cut < len(block)
    words = prints.view(np.uint64)
    step = max(1, (1 << 21) // (len(block) * BYTES))
    for at in range(0, cut, step):
        stop = min(cut, at + step)
        first = cut if two else at + 1
        bits = np.zeros((stop - at, len(block) - first), np.uint16)
        for word in range(words.shape[1]):
            bits += np.bitwise_count(words[at:stop, word, None] ^ words[None, first:, word])
        a, b = np.nonzero(bits <= SMALL_BITS)
        a, b = a + at, b + first
        lower, upper = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
        fits = (a < b) & (lower >= least * upper)
        a, b, small = a[fits], b[fits], lower[fits] < SMALL
        for part in range(0, len(a), 1 << 14):
            i, j = a[part:part + (1 << 14)], b[part:part + (1 << 14)]
            near, own = _passes(prints[i], prints[j], small[part:part + (1 << 14)])
            yield i[near], j[near], own[near]


def _print_links(cell: dict, least: float) -> Iterator[tuple[int, int]]:
    """A spanning set of a list's pairs that are near by the eight bytes and by the whole prints."""
    prints, sets = _prints(cell["print"]), _Sets(len(cell["node"]))
    beside = _beside(prints, cell["key"][0].as_py() >> 16)
    for a, b, _ in _cell_pairs(prints, _numbers(cell["size"]), _numbers(cell["block"]), least):
        near = np.bitwise_count(beside[a] ^ beside[b]) <= BESIDE_BITS
        yield from _joining(sets, a[near], b[near])


def _set_links(cell: dict, least: float) -> Iterator[tuple[int, int]]:
    """A spanning set of a cluster's pairs whose whole sets are near enough, nearest prints first."""
    hashes, sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in cell["packed"]], _Sets(len(cell["node"]))
    found = list(_cell_pairs(_prints(cell["print"]), _numbers(cell["size"]), _numbers(cell["block"]), least))
    if found:
        a, b, bits = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(bits, kind="stable")
        yield from _joining(sets, a[order], b[order], lambda i, j: similarity(hashes[i], hashes[j]) >= least)


def _joining(sets: _Sets, a: np.ndarray, b: np.ndarray, true=lambda i, j: True) -> Iterator[tuple[int, int]]:
    """The pairs that are true and join rows not joined before."""
    for at in range(0, len(a), 1024):
        i, j = a[at:at + 1024], b[at:at + 1024]
        apart = np.flatnonzero(sets.label[i] != sets.label[j])
        for x, y in zip(i[apart].tolist(), j[apart].tolist()):
            if sets.label[x] != sets.label[y] and true(x, y):
                sets.link(x, np.array([y]))
                yield x, y


def _linked(links, least: float):
    """(u, v) of ``links`` in each run of equal cells; runs may go over batch borders."""

    def whole(columns):
        nodes = _numbers(columns["node"])
        pairs = np.array(list(links(columns, least)), np.int64).reshape(-1, 2)
        return _ordered(nodes[pairs[:, 0]], nodes[pairs[:, 1]])

    def step(batches):
        held: list[dict] = []
        for batch in batches:
            cells = _numbers(batch["cell"])
            starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else []
            for start, stop in zip(starts, [*starts[1:], len(cells)]):
                if held and held[0]["cell"][0].as_py() != cells[start]:
                    yield whole(_together(held))
                    held = []
                held.append({n: c.slice(start, stop - start) for n, c in batch.items()})
        if held:
            yield whole(_together(held))

    return step


def _together(parts: list[dict]) -> dict:
    return {n: pa.concat_arrays([p[n] for p in parts]) for n in parts[0]} if len(parts) > 1 else parts[0]


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _few(rows: DataFrame) -> DataFrame:
    """Cut off and counted, to go to the other side of a join if it is small."""
    rows = cut_lineage(rows)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows.hint("merge")


def _agree(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """(u, v): the pairs whose sizes and prints allow the similarity."""
    own = F.struct("size", "print")
    side = lambda name, side: nodes.select(F.col("node").alias(name), own.alias(side)).hint("merge")
    both = pairs.join(side("u", "left"), "u").join(side("v", "right"), "v")
    both = both.where(F.least("left.size", "right.size") >= least * F.greatest("left.size", "right.size"))
    size = F.least("left.size", "right.size").alias("size")
    prints = both.select("u", "v", size, F.col("left.print").alias("left"), F.col("right.print").alias("right"))
    return map_batches(prints, _alike, "u bigint, v bigint, bits int").select("u", "v")


def _large(rows: DataFrame, block: int, weight) -> DataFrame:
    """(key, blocks) of the keys with too many rows or hashes for one block."""
    few, heavy = F.least(F.ceil(F.count("*") / block), F.lit(BLOCKS)), F.ceil(F.sum(weight) / WEIGHT)
    return _few(rows.groupBy("key").agg(F.greatest(few, heavy).cast("int").alias("blocks")).where("blocks > 1"))


def _in_cells(rows: DataFrame, large: DataFrame) -> DataFrame:
    """The rows of each ``key`` side by side, with ``cell`` and ``block``; large keys by twos of blocks."""
    cut = rows.join(large, "key", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("node"), "blocks").cast("int"), F.lit(0)))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other"))
    cell = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    return cut.select(cell.alias("cell"), *rows.columns, "block").repartition("cell").sortWithinPartitions("cell", "block")


def near_links(texts: DataFrame, nodes: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """(u, v) links that join the near ``nodes`` (node, size, print); ``texts`` has (node, text) rows."""
    step = lambda links: _linked(links, least)
    listed = map_batches(nodes.where("size > 0").select("node", "print"), _listed, "cell int, node bigint, beside bigint")
    ordered = listed.repartition("cell").sortWithinPartitions("cell", "node")
    met = cut_lineage(map_batches(ordered, _candidates, "cell int, u bigint, v bigint").distinct())
    pairs, rows = met.where("cell IS NULL").select("u", "v"), met.where("cell IS NOT NULL").select(F.col("cell").alias("key"), F.col("u").alias("node"))
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).unionByName(rows.select("node")).distinct()
    here = cut_lineage(nodes.select("node", "size", "print").join(_few(wanted), "node", "left_semi"))
    alike = _agree(pairs, here, least)
    printed = rows.join(here.hint("merge"), "node").select("key", "node", "size", "print")
    dense = map_batches(_in_cells(printed, _large(rows, LIST_BLOCK, F.lit(BYTES // 8))), step(_print_links), "u bigint, v bigint")
    clusters = components(alike.unionByName(dense), LINKS)
    keyed = clusters.select("node", F.col("root").alias("key")).unionByName(clusters.select(F.col("root").alias("node"), F.col("root").alias("key")).distinct())
    wanted = _few(keyed)
    own = texts.join(wanted, "node").groupBy("node", "key").agg(F.first("text").alias("text"))
    sets = map_batches(own, _packed(words), "key bigint, node bigint, packed binary")
    members = cut_lineage(sets.join(here.hint("merge"), "node").select("key", "node", "size", "print", "packed"))
    return cut_lineage(map_batches(_in_cells(members, _large(members, BLOCK, F.col("size"))), step(_set_links), "u bigint, v bigint"))


def first_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: float = SIMILARITY,
) -> DataFrame:
    """One row of each group of near copies, with all columns: that of the smallest id.

    Groups are the components of pairs of similarity ``least`` or more. Words are lower-cased
    in ASCII and split at ASCII white space. Null and empty texts and texts without words
    are copies of each other; texts count whole, however long. Null ids count only when a
    group has no other. Of rows that share the id and the shingle set, the one with the least
    text hash stays. An empty table gives no rows. Ids are integers; other columns are kept
    as they are, whatever their names.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/near-copies-{uuid.uuid4().hex}"
    docs.select(F.struct("*").alias("doc"), _described(words)(F.col(text_col)).alias("d")).write.parquet(folder)
    kept = spark.read.parquet(folder)
    doc = lambda name: F.col("doc").getField(name)
    described = kept.select(doc(id_col).alias("id"), F.col("d.node").alias("node"), F.col("d.size").alias("size"), F.col("d.print").alias("print"))
    nodes = cut_lineage(described.groupBy("node").agg(F.min("id").alias("lowest"), F.first("size").alias("size"), F.first("print").alias("print")))
    texts = kept.select(F.col("d.node").alias("node"), doc(text_col).alias("text"))
    roots = components(near_links(texts, nodes, words, least), LINKS)
    rooted = cut_lineage(nodes.select("node", "lowest").join(roots.hint("merge"), "node", "left").select("node", "lowest", F.coalesce("root", "node").alias("root")))
    # the smallest id, nulls last; among nodes with that id, the least node
    rank = F.struct(F.col("lowest").isNull().alias("no_id"), F.coalesce("lowest", F.lit(0)).alias("some_id"), F.col("node").alias("node"))
    chosen = rooted.groupBy("root").agg(F.min(rank).alias("first")).select("first.*")
    no_id, some_id = doc(id_col).isNull().alias("no_id"), F.coalesce(doc(id_col), F.lit(0)).alias("some_id")
    named = kept.select("doc", F.col("d.node").alias("node"), no_id, some_id).join(chosen.hint("merge"), ["node", "no_id", "some_id"], "left_semi")
    one = named.groupBy("node", "no_id", "some_id").agg(F.min_by("doc", F.xxhash64(doc(text_col))).alias("doc"))
    return one.select("doc.*")
