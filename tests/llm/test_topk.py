"""Top-k against a full sort."""

import math

from tessella.llm.topk import top_k

ROWS = [(i, [math.sin(i * 7 + j) for j in range(8)]) for i in range(300)]
ROWS += [(1000 + i, [0.5] * 8) for i in range(60)] + [(5, [0.5] * 8), (7, [0.1] * 8), (7, [0.1] * 8)]
ROWS += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (None, [1.0] * 8), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (2102, [])]


def plain(rows, queries, k):
    usable = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, v in ((i, [math.floor(1024 * x) for x in v]) for i, v in queries if i is not None and usable(v)):
        scores = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in whole if i != q and len(c) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score string, dim int, q int")


def test_against_sort(spark):
    queries = [r for r in ROWS if r[0] is not None and (r[0] % 10 == 0 or r[0] in (5, 7, 2101, 2102))]
    got = top_k(frame(spark, ROWS), frame(spark, queries), 10)
    assert sorted(map(tuple, got.collect())) == plain(ROWS, queries, 10)


def test_large_values_and_few_candidates(spark):
    rows = [(i, [float(i * 10**5), -3.5e5]) for i in range(-3, 4)]
    got = top_k(frame(spark, rows), frame(spark, rows), 10)
    assert sorted(map(tuple, got.collect())) == plain(rows, rows, 10)


def test_scores_beyond_64_bits_do_not_fail(spark):
    rows = [(i, [1e300 * i, 2e10]) for i in range(4)]
    assert top_k(frame(spark, rows), frame(spark, rows), 2).count() <= 8


def test_no_rows(spark):
    assert top_k(frame(spark, []), frame(spark, [])).collect() == []
    assert top_k(frame(spark, ROWS[:3]), frame(spark, [])).collect() == []
