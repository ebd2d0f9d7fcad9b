"""Collocations against plain counting, the parse, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tessella.llm import phrases
from tests.llm.cases import LONG, documents, empty

SMALL = "doc_id long, text string, lang string, phrase string, n int, part int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, 2) for i, (g, t) in enumerate(rows)], SMALL)


def plain(rows, least, limit):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        over = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    over[p[i:i + k]] = max(over[p[i:i + k]], a)
        best = []
        for p, a in found.items():
            if 100 * over[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(seed, count):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Größe", "new", "york", "city", "hall", "in", "a", "b", "c", "日本", "x y"] + [f"w{i}" for i in range(40)]
    fixed = ["new york city hall", "the new york city", "a b a b a b", "in the city of new york"]
    rows = []
    for _ in range(count):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(0, 80))]
        joins = [rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "!", "\x0b", "\r\n"]) for _ in parts]
        rows.append((rng.choice(["en", "en", "de", None]), "".join(p + j for p, j in zip(parts, joins))))
    return rows


def test_against_plain_counts(spark):
    rows = texts(1, 300) + [("en", "Copy of one Passage " * 12)] * 40 + [(None, None), ("fr", ""), ("fr", " . ")]
    for limit in (5, 2000):
        got = phrases.collocations(frame(spark, rows), 30, limit)
        assert sorted(map(tuple, got.collect())) == plain(rows, 30, limit)


def test_many_parts_give_the_same(spark, monkeypatch):
    rows = texts(2, 200)
    monkeypatch.setattr(phrases, "PART_BYTES", 500)
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows), 10, 50).collect())) == plain(rows, 10, 50)


def test_equal_hashes_do_not_mix_counts(spark, monkeypatch):
    """All n-grams in one cell: the second pass still counts texts."""
    rows = texts(3, 60)
    monkeypatch.setattr(phrases, "_split", lambda value, lang, buckets: (np.zeros(len(value), np.int64), value & np.uint64(3)))
    found = phrases.frequent_phrases(frame(spark, rows), 10).where("words > 1").collect()
    want = {}
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", text.replace("G", "g")):
            words = re.findall(r"[^ \t]+", piece)
            for k in range(2, 5):
                for i in range(len(words) - k + 1):
                    key = (lang or "und", " ".join(words[i:i + k]))
                    want[key] = want.get(key, 0) + 1
    assert {(r["lang"], r["phrase"]): r["f"] for r in found} == {k: v for k, v in want.items() if v >= 10}


def test_chunks_overlap_and_count_once():
    rng = random.Random(5)
    data = " ".join(f"v{rng.randrange(50)}" for _ in range(5000))
    chunk_rows = [r for out in phrases._parse([_batch("en", data)]) for r in zip(out["chunk"], out["fresh"], out["n"])]
    assert len(chunk_rows) > 100
    assert sum(fresh * n for _, fresh, n in chunk_rows) == 5000
    for chunk, fresh, _ in chunk_rows:
        assert 0 <= len(chunk.split()) - fresh <= phrases.OVERLAP


def _batch(lang, text):
    import pyarrow as pa

    return {"lang": pa.array([lang]), "text": pa.array([text.encode()], pa.binary())}


def test_odd_rows(spark):
    got = phrases.collocations(documents(spark), 30)
    rows = [("en", t) for t in (None, "", " \n\t ", LONG, "twin text of five words", "twin text of five words", "twin text of five words", "***!!!###", "a text without an id")]
    assert sorted(map(tuple, got.collect())) == plain(rows, 30, 2000)
    assert phrases.collocations(empty(spark)).collect() == []
