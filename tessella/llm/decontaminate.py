"""Benchmark passages in documents, within an edit budget.

Texts are compared in a normal form: lower case, runs of anything but letters and digits as
one space. An item may occur with up to ``rate`` edits per character. It is split into one
piece more than its edit budget, so at least one piece of any such occurrence is intact. An
automaton finds all exact pieces in one pass over a document; around the hits the item is
verified with Myers' bit-parallel edit distance, once for all hits that lie as close as edits
can shift them. Items count whole, at any length; only items below ``LEAST_CHARS`` characters
have no budget and must begin and end with words. They lie in the shared folder, from where
each task streams them in blocks.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.arrow import map_arrays, map_batches
from tessella.llm.registry import query, table
from tessella.session import shared_folder

RATE = 0.06
_OTHER = re.compile(r"[\W_]+")
#: Shorter items must occur exactly, between word borders.
LEAST_CHARS = 25
#: Characters of items in one automaton; more items take more passes.
BLOCK_CHARS = 4_000_000
#: Scripts written without spaces, where any place is a word border.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\uabff\uf900-\ufaff]")


def normal_form(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


class Pattern:
    """Myers' search: the least edit distance of a pattern to any stretch of a text."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.all = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the best stretch, the first of several."""
        plus, minus, score = self.all, 0, self.size
        least, end = score, 0
        for j, c in enumerate(text, 1):
            match = self.masks.get(c, 0)
            vertical = match | minus
            level = (((match & plus) + plus) ^ plus) | match
            up = minus | (self.all & ~(level | plus))
            down = plus & level
            if up & self.top:
                score += 1
            elif down & self.top:
                score -= 1
                if score < least:
                    least, end = score, j
            up, down = up << 1 & self.all, down << 1 & self.all
            plus = down | (self.all & ~(vertical | up))
            minus = up & vertical
        return least, end


def _border(body: str, at: int) -> bool:
    """Whether a word begins or ends before the character at ``at``."""
    pair = body[max(0, at - 1):at + 1]
    return at in (0, len(body)) or " " in pair or _UNSPACED.search(pair) is not None


class Matcher:
    """Finds all items of one block in a document."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(item, text, int(rate * len(text)) if len(text) >= LEAST_CHARS else 0) for item, text in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, budget) in enumerate(self.items):
            for i in range(budget + 1):
                start, stop = len(text) * i // (budget + 1), len(text) * (i + 1) // (budget + 1)
                pieces.setdefault(text[start:stop], []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, stop) of each item's best place in the normal form."""
        body = normal_form(text)
        best: dict[int, tuple[int, int, int]] = {}
        exact: set[int] = set()
        # starts of the items that have an intact piece, rounded to multiples of the budget
        near: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(body) if self.items and body else ():
            for number, offset in places:
                item, whole, budget = self.items[number]
                if number in exact or len(whole) - budget > len(body):
                    continue
                at = end + 1 - length - offset
                if at >= 0 and body.startswith(whole, at) and (len(whole) >= LEAST_CHARS or _border(body, at) and _border(body, at + len(whole))):
                    exact.add(number)
                    best[item] = min(best.get(item, (0, at, at + len(whole))), (0, at, at + len(whole)))
                elif budget:
                    near.setdefault(number, set()).add(at // budget)
        for number, starts in near.items():
            item = self.items[number][0]
            for start in sorted(starts) if number not in exact else ():
                place = self._verified(number, start, body)
                if place is not None:
                    best[item] = min(best.get(item, place), place)
        return [(item, *place) for item, place in best.items()]

    def _verified(self, number: int, start: int, body: str) -> tuple[int, int, int] | None:
        """The best place whose intact pieces say that it starts near ``start`` budgets."""
        _, whole, budget = self.items[number]
        if number not in self.patterns:
            self.patterns[number] = Pattern(whole), Pattern(whole[::-1])
        forward, backward = self.patterns[number]
        first = max(0, (start - 1) * budget)
        window = body[first:max(0, (start + 2) * budget + len(whole))]
        distance, end = forward.best(window)
        if distance > budget:
            return None
        _, length = backward.best(window[:end][::-1])
        return distance, first + end - length, first + end


def _normal(batches):
    for batch in batches:
        yield {"id": batch["id"], "text": [normal_form(t.as_py()) for t in batch["text"]]}


def write_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> str:
    """Write the items in normal form to a folder of their own in the shared folder."""
    known = items.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    folder = f"{shared_folder(items.sparkSession)}/items-{uuid.uuid4().hex}"
    map_batches(known, _normal, "id bigint, text string").where("text <> ''").distinct().write.parquet(folder)
    return folder


class Matchers:
    """A matcher for each block of the written items; a single block's matcher is kept."""

    def __init__(self, folder: str, rate: float, block_chars: int):
        self.folder, self.rate, self.block_chars = folder, rate, block_chars
        self.kept: Matcher | None = None

    def _blocks(self) -> Iterator[list[tuple[int, str]]]:
        from pyarrow import dataset
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(self.folder)
        block, size = [], 0
        for batch in dataset.dataset(path, filesystem=fs, format="parquet").to_batches(batch_size=1024, batch_readahead=1, fragment_readahead=1):
            for item, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if block and size + len(text) > self.block_chars:
                    yield block
                    block, size = [], 0
                block.append((item, text))
                size += len(text)
        yield block

    def __iter__(self) -> Iterator[Matcher]:
        if self.kept is not None:
            yield self.kept
            return
        count = 0
        for block in self._blocks():
            count += 1
            matcher = Matcher(block, self.rate)
            yield matcher
        if count == 1:
            self.kept = matcher


def _search(folder: str, rate: float, block_chars: int):
    def step(batches):
        matchers = Matchers(folder, rate, block_chars)
        for batch in batches:
            for matcher in matchers:
                found = [(doc.as_py(), *m) for doc, text in zip(batch["id"], batch["text"]) for m in matcher.matches(text.as_py())]
                yield {n: [f[i] for f in found] for i, n in enumerate(("doc", "item", "distance", "start", "stop"))}

    return step


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE,
    item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc, item, distance, start, stop): each item found in each row of ``docs``.

    ``distance`` is the least at any place; start and stop are code points of the document's
    normal form. Of places of one distance an early one is named. Null, empty and symbol-only
    texts hold nothing; such items and null ids are left out. An item occurs as a whole, with
    up to ``rate`` edits per character, or, below ``LEAST_CHARS`` characters, exactly and
    between word borders. Repeated documents are searched one by one, repeated items count
    once; several texts of one item id count as one item. Empty tables give no rows. Texts
    and items have any length; verifying an item takes time with the square of its length.
    Ids are integers. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = "doc bigint, item bigint, distance int, start bigint, stop bigint"
    return map_batches(rows, _search(write_items(items, item_id, item_text), rate, block_chars), schema)


def is_leaked(items: DataFrame, text: Column, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> Column:
    """Whether a text holds any of the items; false for null and empty texts."""
    folder = write_items(items)

    def step(batches):
        matchers = Matchers(folder, rate, block_chars)
        for texts in batches:
            held = [False] * len(texts)
            for matcher in matchers:
                held = [h or bool(matcher.matches(t.as_py())) for h, t in zip(held, texts)]
            yield held

    return map_arrays(step, "boolean")(text)


@query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "distance", "start", "stop")
