"""License rules against a plain scan, odd rows, overlaps."""

import re

from tessella.llm import licenses
from tests.llm.cases import documents, empty


def sample(rule):
    """A text that the rule's tokens match: every optional word there, first alternatives."""
    return " ".join(t.removesuffix("?").split("|")[0] for t in rule.tokens.split() if not t.startswith("~"))


def plain(text):
    """Words, base places and kept detections by comparing all pairs of hits."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    normal = "".join(f" {w} " for w in words)
    hits = []
    for rank, rule in enumerate(licenses.rules()):
        for m in re.finditer(rule.pattern, normal):
            start = normal[:m.start()].count(" ") // 2
            hits.append((start, start + m.group().count(" ") // 2, rank, rule))
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and ((a[0], a[1]) != (b[0], b[1]) or b[2] < a[2])
    named = [h for h in hits if not h[3].generic]
    kept = [h for h in named if not any(inside(h, o) for o in named)]
    vague = [h for h in hits if h[3].generic]
    vague = [h for h in vague if not any(o[0] < h[1] and h[0] < o[1] for o in named)]
    kept += [h for h in vague if not any(inside(h, o) for o in [v for v in hits if v[3].generic])]
    return len(words), sorted((h[0], h[1], h[3].label) for h in hits if h[3].base), sorted((h[0], h[1], h[3].label) for h in kept)


def found(row):
    spans = lambda column: sorted((h["start"], h["stop"], h["label"]) for h in row[column])
    return row["n_words"], spans("places"), spans("detections")


TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License).",
    "GNU Lesser General Public License version 2.1 or any later version; also the MIT license and mit  LICENSE.",
    "licensed under some very odd license agreement", "licensed under the odd mit license agreement",
    "SPDX-License-Identifier: MIT\nlicensed under CC BY-NC-SA 4.0, ©-Ä MIT License", "general public license general public license",
    "BSD 3-Clause License or Simplified BSD License", "ＭＩＴ license, mit license, mit\x00license",
]


def test_against_a_plain_scan(spark):
    texts = TEXTS + [sample(r) for r in licenses.rules()] + [" ; ".join(TEXTS) * 3]
    docs = documents(spark, [(1000 + i, t, "s") for i, t in enumerate(texts)])
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(docs).where("doc_id >= 1000").collect()}
    for i, text in enumerate(texts):
        assert found(rows[1000 + i]) == plain(text), text


def test_gates_and_keywords_lose_nothing():
    for rule in licenses.rules():
        normal = "".join(f" {w} " for w in sample(rule).split())
        assert re.search(rule.pattern, normal) and any(g in normal for g in licenses.GATES), rule
        assert f" {rule.keyword} " in normal, rule


def test_odd_rows(spark):
    rows = {}
    for r in licenses.scan_licenses(documents(spark)).collect():
        rows.setdefault(r["doc_id"], []).append(found(r))
    assert rows[1] == rows[2] == rows[3] == rows[7] == [(0, [], [])]
    assert len(rows[5]) == 2 and rows[5][0] == rows[6][0] == (5, [], [])
    assert rows[4] == [(180_000, [], [])]
    assert licenses.scan_licenses(empty(spark)).collect() == []


def test_many_hits_in_one_text(spark):
    text = "Released under the MIT License. filler words here " * 3000
    row = licenses.scan_licenses(documents(spark, [(99, text, "s")])).where("doc_id = 99").first()
    assert [h["start"] for h in row["places"]] == [8 * i + 3 for i in range(3000)]
    assert [(h["start"], h["stop"]) for h in row["detections"]] == [(8 * i, 8 * i + 5) for i in range(3000)]
