"""Near copies against brute-force Jaccard similarity."""

import random
import re

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tessella.llm import near_copies
from tests.conftest import SF
from tests.llm.cases import documents, empty
from tests.llm.test_simhash import roots


def plain_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def first_ids(rows):
    """The smallest id of each component of pairs of 0.8 or more; None if it has no other."""
    sets = [plain_set(t) for _, t in rows]
    near = lambda a, b: a == b or (both := len(a & b)) >= 0.8 * (len(a) + len(b) - both)
    root = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if near(sets[i], sets[j])])
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(root[i], []).append(doc)
    return sorted((min((d for d in ids if d is not None), default=None) for ids in least.values()), key=repr)


def edited(count):
    """Chains and groups of texts, each a few words from another, on both sides of 0.8."""
    rnd = random.Random(11)
    texts = [[f"w{rnd.randrange(5000)}" for _ in range(rnd.choice((60, 200, 600)))] for _ in range(12)]
    for i in range(count):
        words = list(rnd.choice(texts))
        for _ in range(round(len(words) * rnd.choice((0.005, 0.01, 0.02, 0.03)))):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        texts.append(words)
    return [(100 + i, " ".join(t)) for i, t in enumerate(texts)]


def test_stage_meets_brute_force(spark):
    docs = documents(spark, [(i, t, "s") for i, t in edited(250)])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    want = first_ids([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


def test_stage_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == first_ids([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_no_rows(spark):
    assert near_copies.first_of_each(empty(spark)).collect() == []


def print_pair(rng, size, both):
    """Prints of two sets of ``size`` hashes, ``both`` of them in common."""
    hashes = rng.integers(0, 2**63, 2 * size - both, dtype=np.int64).view(np.uint64)
    return [near_copies.long_print(np.unique(s)) for s in (hashes[:size], hashes[size - both:])]


def listed_pairs(prints):
    """Pairs of rows that meet in the index of positional bytes."""
    batch = {"node": np.arange(len(prints)), "print": pa.array(prints, pa.binary())}
    rows = [np.concatenate(c) for c in zip(*((b["cell"], b["node"], b["beside"]) for b in near_copies._listed([batch])))]
    order = np.lexsort((rows[1], rows[0]))
    return {pair for out in near_copies._met(*(r[order] for r in rows)) for pair in zip(out["u"].tolist(), out["v"].tolist())}


def test_prints_are_majorities():
    rng = np.random.default_rng(4)
    for size in (1, 2, 255, 256, 5001):
        found = np.unique(rng.integers(0, 2**63, size, dtype=np.int64).view(np.uint64))
        ones = [np.unpackbits(np.frombuffer(near_copies.long_print(np.array([h])), np.uint8)) for h in found]
        ones += [np.unpackbits(np.frombuffer(near_copies.long_print(np.array([near_copies._TIE])), np.uint8))] * (len(found) % 2 == 0)
        want = np.packbits(2 * np.sum(ones, axis=0, dtype=np.int64) > len(ones)).tobytes()
        assert near_copies.long_print(found) == want
    assert near_copies.long_print(np.empty(0, np.uint64)) == b""


def test_index_of_positional_bytes_finds_near_sets():
    """Sets at a similarity of 0.8 meet in a list and pass the tally; sets of chance do not."""
    rng = np.random.default_rng(6)
    prints = [p for size in (20, 90, 450) for _ in range(100) for p in print_pair(rng, size, -(-size * 8 // 9))]
    found = listed_pairs(prints)
    want = {(i, i + 1) for i in range(0, len(prints), 2)}
    assert len(found & want) >= 0.98 * len(want) and len(found - want) < 60
    row = pa.array(range(len(want)))
    ends = {"left": pa.array(prints[::2], pa.binary()), "right": pa.array(prints[1::2], pa.binary()), "size": pa.array([450] * len(want)), "u": row, "v": row}
    alike = next(near_copies._alike([ends]))
    assert len(alike["u"]) >= 0.98 * len(want) and (alike["bits"] <= near_copies.PRINT_BITS).all()


def test_long_lists_have_leaders():
    """A large group of near nodes is joined by far fewer pairs than all."""
    rng = np.random.default_rng(8)
    core = rng.integers(0, 2**63, 300, dtype=np.int64).view(np.uint64)
    edited = lambda: np.unique(np.append(core[rng.permutation(300)[:297]], rng.integers(0, 2**63, 3, dtype=np.int64).view(np.uint64)))
    prints = [near_copies.long_print(edited()) for _ in range(1500)]
    found = listed_pairs(prints)
    assert set(roots(range(1500), found).values()) == {0}
    assert len(found) < 1500 * 1499 / 2 / 4


def wide_group(rnd, count, edits):
    """Edits of one text, few to many: its pairs lie on both sides of 0.8."""
    base = [f"w{rnd.randrange(5000)}" for _ in range(150)]
    texts = []
    for _ in range(count):
        words = list(base)
        for _ in range(rnd.randrange(edits)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        texts.append(" ".join(words))
    return texts


def sent_rows(texts):
    """Rows that the lists of these texts' nodes send on."""
    sets = [near_copies.shingles(t) for t in texts]
    batch = {"node": np.array([near_copies.node_of(s) for s in sets]), "print": pa.array([near_copies.long_print(s) for s in sets], pa.binary())}
    rows = [np.concatenate(c) for c in zip(*((b["cell"], b["node"], b["beside"]) for b in near_copies._listed([batch])))]
    order = np.lexsort((rows[1], rows[0]))
    lists = {n: pa.array(r[order]) for n, r in zip(("cell", "node", "beside"), rows)}
    sent = zip(*(np.concatenate(c) for c in zip(*((np.array(b["cell"], float), b["u"], b["v"]) for b in near_copies._candidates([lists])))))
    return len({(str(cell), u, v) for cell, u, v in sent})


def test_rows_of_a_wide_group_grow_with_its_size():
    texts = wide_group(random.Random(5), 2400, 20)
    rows = [sent_rows(texts[:n]) for n in (1200, 2400)]
    assert rows[1] <= 2.5 * rows[0] and rows[1] <= near_copies.TABLES * 2400


def test_wide_group_meets_brute_force(spark, monkeypatch):
    docs = documents(spark, [(100 + i, t, "s") for i, t in enumerate(wide_group(random.Random(7), 300, 12))])
    want = first_ids([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert 20 < len(want) < 250
    for name, rows in (("LIST_BLOCK", 40), ("BLOCK", 70), ("SLAB", 50)):
        monkeypatch.setattr(near_copies, name, rows)
    kept = near_copies.first_of_each(docs)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want
