"""Decontamination: Myers' distance and the search against the table method."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tessella.llm import decontaminate
from tessella.llm.decontaminate import Pattern, is_leaked, leaks, normal_form
from tests.llm.cases import documents, empty


def distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_pattern():
    rnd = random.Random(1)
    for _ in range(500):
        pattern = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 80)))
        text = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 120)))
        found, end = Pattern(pattern).best(text)
        assert found == distance(pattern, text) and distance(pattern, text[:end]) == found


ITEM = "The quick brown fox jumps over the lazy dog, while seven other foxes look on from the far side of a river."
ITEMS = [(1, ITEM), (2, "four words are few"), (3, None), (4, ""), (5, "?!"), (None, ITEM), (1, ITEM), (6, " ".join(f"part{i}" for i in range(400)))]


def edited(text, edits, seed=2):
    rnd = random.Random(seed)
    chars = list(text)
    for at in rnd.sample(range(len(chars)), edits):
        chars[at] = rnd.choice(["", "z", chars[at] + "q"])
    return "".join(chars)


def items(spark):
    return spark.createDataFrame([(i, t, "c") for i, t in ITEMS], "item_id long, text string, doc string")


def test_leaks(spark):
    before, after = "some words before " * 200, " and words after" * 200
    rows = [(100, before + ITEM.upper().replace(",", " --") + after), (101, "Four, words: are few!"), (102, "four words are few and more")]
    rows += [(110 + k, before + edited(ITEM, k, k) + after) for k in range(12)] + [(130, ITEM[:50]), (131, ITEM), (131, ITEM), (132, ITEMS[-1][1][500:2600])]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = sorted((r["doc"], r["item"], r["distance"]) for r in leaks(docs, items(spark)).collect())
    norm, budget = normal_form(ITEM), int(decontaminate.RATE * len(normal_form(ITEM)))
    # item 2 also inside a document; of item 6 the document has a part only
    want = [(101, 2, 0), (102, 2, 0)]
    for i, t in rows[:1] + rows[3:-1]:
        d = distance(norm, normal_form(t))
        if d <= budget:
            want.append((i, 1, d))
    assert got == sorted(want)
    flagged = docs.where(is_leaked(items(spark), F.col("text"))).select("doc_id").collect()
    assert sorted({r["doc_id"] for r in flagged}) == sorted({w[0] for w in want})


def test_many_blocks_give_the_same(spark):
    docs = documents(spark, [(100, "x " + ITEM, "s"), (101, "four words are few", "s")])
    one = sorted(map(tuple, leaks(docs, items(spark)).collect()))
    matchers = decontaminate.Matchers(decontaminate.write_items(items(spark)), decontaminate.RATE, 60)
    known = [i[:2] for m in matchers for i in m.items]
    assert len(list(matchers)) == 3 and sorted(t for _, t in known) == sorted(normal_form(t) for i, t in ITEMS[:2] + ITEMS[-1:])
    assert sorted(map(tuple, leaks(docs, items(spark), block_chars=60).collect())) == one
    assert docs.where(is_leaked(items(spark), F.col("text"), block_chars=60)).count() == 2


def test_items_without_spaces():
    rnd = random.Random(4)
    item = normal_form("".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(200)))
    matcher = decontaminate.Matcher([(1, item)], decontaminate.RATE)
    assert matcher.matches("前" * 50 + item + "后" * 50) == [(1, 0, 50, 250)]


def test_half_of_a_long_item_is_no_leak():
    """Items just above ``PART`` are found as a whole, with all their edits, not by one half."""
    rnd = random.Random(6)
    item = "".join(rnd.choice("abcdefghij") for _ in range(1001))
    matcher = decontaminate.Matcher([(1, item)], decontaminate.RATE)
    assert matcher.matches("x" * 300 + item[:501] + "y" * 300) == matcher.matches(item[500:]) == []
    found = edited(item, 40)
    assert [m[:2] for m in matcher.matches("x" * 300 + found + "y" * 300)] == [(1, distance(item, found))]
    # all edits in the middle of an item of 1,500, more than any stretch of it may have
    item = "".join(rnd.choice("abcdefghij") for _ in range(1500))
    found = item[:600] + "z" * 80 + item[680:]
    assert [m[:2] for m in decontaminate.Matcher([(1, item)], decontaminate.RATE).matches(found)] == [(1, 80)]


def test_short_items_stand_between_words():
    find = lambda item, text: decontaminate.Matcher([(1, item)], decontaminate.RATE).matches(text)
    assert find("is it so", "I ask: is it so?") == [(1, 0, 6, 14)]
    assert find("is it so", "this it so") == find("is it so", "is it sore") == find("is it so", "is it to") == []
    assert find("is it so", "this it so, is it so") == [(1, 0, 11, 19)]
    assert find("什么是光", "请问什么是光合作用") == [(1, 0, 2, 6)]
    short, long = "a" * 11 + " " + "b" * 12, "a" * 12 + " " + "b" * 12
    assert find(short, f"x{short}") == [] and find(long, f"x{long}") == [(1, 0, 1, 26)]
    assert find(short, short[:-2] + "cb") == [] and find(long, long[:-2] + "cb") == [(1, 1, 0, 25)]


def test_against_the_table_method():
    rnd = random.Random(7)
    for round_ in range(60):
        item = normal_form("".join(rnd.choice("abcd ") for _ in range(rnd.choice([30, 60, 200]))))
        if len(item) < decontaminate.LEAST_CHARS:
            continue
        budget = int(decontaminate.RATE * len(item))
        noise = lambda: "".join(rnd.choice("abcd ") for _ in range(100))
        text = normal_form(noise() + edited(item, min(len(item) // 5, round_ % (budget + 3)), round_) + noise() + item[:len(item) // 2] + noise())
        got, least = decontaminate.Matcher([(1, item)], decontaminate.RATE).matches(text), distance(item, text)
        assert [g[:2] for g in got] == ([(1, least)] if least <= budget else [])
        assert all(distance(item, text[start:stop]) == least for _, _, start, stop in got)


def test_long_items():
    rnd = random.Random(8)
    item = normal_form("".join(rnd.choice("abcdefghijklmnop ") for _ in range(20_000)))
    found = edited(item, 200)
    matcher = decontaminate.Matcher([(1, item)], decontaminate.RATE)
    began = time.process_time()
    (_, least, start, stop), = matcher.matches("x " * 500 + found + " y" * 500)
    assert 150 <= least <= 200 and 990 <= start <= 1010 and abs(stop - start - len(found)) < 20
    assert matcher.matches(item[:10_000]) == matcher.matches("x " * 10_000 + item[:9_000]) == []
    assert time.process_time() - began < 10


@pytest.mark.parametrize("side", ["docs", "items"])
def test_no_rows(spark, side):
    docs = empty(spark) if side == "docs" else documents(spark)
    known = items(spark) if side == "docs" else items(spark).limit(0)
    assert leaks(docs, known).collect() == []
    assert docs.where(is_leaked(known, F.col("text"))).count() == 0
