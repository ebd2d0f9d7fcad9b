"""Mix: targets by plain filling, permutations, takes near targets, text runs."""

import re

import numpy as np
import pytest

from tessella.llm.mixing import MOST_TIMES, WEIGHTS, mix_report, mixed_documents, permuted
from tests.llm.cases import documents, empty

COUNT = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def plain_targets(sizes):
    keys = sorted(sizes, key=lambda k: (k is None, k or ""))
    weight = {k: WEIGHTS[i % len(WEIGHTS)] for i, k in enumerate(keys)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [k for k in keys if k not in full]
        rest = total - sum(MOST_TIMES * sizes[k] for k in full)
        share = {k: rest * weight[k] / sum(weight[f] for f in free) for k in free}
        over = {k for k in free if share[k] > MOST_TIMES * sizes[k]}
        if not over:
            return {k: MOST_TIMES * sizes[k] if k in full else share[k] for k in keys}
        full |= over


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation(count):
    places = np.arange(count)
    first, second = (permuted(places, np.full(count, count), np.full(count, seed)) for seed in (1, -2))
    assert sorted(first.tolist()) == sorted(second.tolist()) == places.tolist()
    assert count < 16 or first.tolist() != second.tolist()


def test_large_permutation_stays_inside():
    count = np.full(1000, 3 * 10**12)
    got = permuted(np.arange(1000) * 10**9, count, np.full(1000, 9))
    assert len(set(got.tolist())) == 1000 and got.min() >= 0 and got.max() < 3 * 10**12


def mixed_docs(spark):
    text = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(100 + i, text(i, 37 * (i % 11)), f"src{i % 4}") for i in range(200)] + [(400 + i, text(i, 3), "A small") for i in range(3)] + [(500, "one", "s1")]
    return documents(spark, rows)


def test_report(spark):
    docs = mixed_docs(spark)
    rows = docs.collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + COUNT(r["text"])
    targets = plain_targets(sizes)
    got = mix_report(docs).collect()
    keyed = sorted(((r["doc_id"], COUNT(r["text"]), sizes[r["source"]]) for r in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["source_size"]) for r in got), key=repr) == keyed
    assert all(r["taken"] <= MOST_TIMES * r["size"] for r in got)
    by_size = {s: k for k, s in sizes.items()}
    taken = {}
    for r in got:
        key = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(targets[key])
        taken[key] = taken.get(key, 0) + r["taken"]
    for key, words in taken.items():
        assert words == pytest.approx(targets[key], rel=0.01, abs=1)


def test_runs_agree_over_layouts(spark):
    docs = mixed_docs(spark)
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert order(mix_report(docs)) == order(mix_report(docs.repartition(7)))


def test_texts_of_the_mix(spark):
    docs = mixed_docs(spark)
    words = {}
    source = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        assert r["text"] in source[r["doc_id"]] and r["n_chars"] == len(r["text"]) and r["print"] == "p"
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + COUNT(r["text"])
    want = {}
    for r in mix_report(docs).collect():
        if r["taken"]:
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    assert words == want


def test_no_rows(spark):
    assert mix_report(empty(spark)).collect() == [] and mixed_documents(empty(spark)).collect() == []
