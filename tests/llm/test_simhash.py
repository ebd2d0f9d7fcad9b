"""Fingerprints and components against all pairs; long lists and components by force."""

import random
import re

import numpy as np
import xxhash

from tessella.llm import simhash
from tessella.llm.components import components
from tests.llm.cases import documents, empty

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_texts(count):
    rnd = random.Random(3)
    base = [rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(400)]
    out = []
    for i in range(count):
        words = list(base)
        for _ in range(rnd.randrange(3)):
            words[rnd.randrange(len(words))] = f"new{i}"
        out.append(" ".join(words))
    return out


def test_fingerprint():
    for text in (None, "", " \n", "One", "One TWO", "a b c d", "é É 日本 x", "a\x0bb\x0cc d\u00a0e", "w " * 5000):
        assert simhash.fingerprint(text) == plain_print(text), text


def test_components_of_documents(spark):
    docs = documents(spark, [(100 + i, t, "s") for i, t in enumerate(near_texts(60))] + [(50, WORDS[0], "s"), (51, WORDS[0].upper(), "s")])
    rows = docs.collect()
    prints = [plain_print(r["text"]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert len(links) > 100
    root = roots(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[root[i]] = min(least.get(root[i], r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"], np.uint64(p).astype(np.int64).item(), least.get(root[i])) for i, (r, p) in enumerate(zip(rows, prints))]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == sorted(want, key=repr)


def test_long_lists_lose_no_link(spark, monkeypatch):
    """Lists of more than a block are cut; their components are those of all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rnd = random.Random(5)
    values = {rnd.getrandbits(64) for _ in range(20)}
    for _ in range(400):
        values.add(rnd.choice(sorted(values)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "print long")).collect()
    mask = (1 << 64) - 1
    every = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3]
    assert roots(signed, [(r["u"], r["v"]) for r in links]) == roots(signed, every)


def test_chain_of_links(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001: 1000}


def test_one_of_each_group_stays(spark):
    docs = documents(spark, [(100 + i, t, "s") for i, t in enumerate(near_texts(30))])
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    classes = {(r["doc_id"], r["print"]): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    want = sorted({c for c in classes.values() if c is not None})
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == want and got.count(None) == 1


def test_no_rows(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == [] and simhash.first_of_each(empty(spark)).collect() == []
