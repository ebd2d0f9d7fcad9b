"""Collocations over a prefix-free parse.

Pieces of texts are cut where the hash of ``OVERLAP`` words in a row is a trigger; a chunk
reaches over the words of the next trigger, so equal passages become equal chunks wherever
they stand. The distinct chunks with their frequencies are the dictionary; an n-gram belongs
to the chunk in which it starts before the next trigger, so that overlaps count once.

Counting has two passes over the dictionary, which is dealt into parts of about
``PART_BYTES``. In the first each part sends hashes and counts of its n-grams, packed by
bucket; a bucket's sums name the hashes that may be frequent enough, and the parts that hold
them. Equal hashes of unlike n-grams only name too many. In the second pass each part looks
up the hashes that were named for it and sends these n-grams as text with their exact
counts. Rare n-grams, nearly all of them, never travel as text.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.llm.arrow import give_back, map_batches
from tessella.llm.registry import query, table
from tessella.session import cut_lineage

LONGEST, OVERLAP, TRIGGER = 4, 3, 16
PART_BYTES = 3 << 20
_SLAB = 1 << 20
_HELD = 400_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0x100000001B3)
_BREAK, _BLANK = 2, 1
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in ".,;:!?\x0a\x0b\x0c\x0d"]] = _BREAK
_KIND[[0x20, 0x09]] = _BLANK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of one byte array: normal text (a blank after each word), places, pieces, hashes."""

    def __init__(self, data: np.ndarray):
        kind = _KIND[data]
        inside = kind == 0
        before = np.append(False, inside[:-1])
        ends = np.flatnonzero(before & ~inside)
        starts = np.flatnonzero(inside & ~before)
        keep = inside | (before & ~inside)
        self.text = _LOWER[data][keep]
        self.text[~inside[keep]] = 0x20
        length = ends - starts
        self.stop = np.cumsum(length + 1) - 1
        self.start = self.stop - length
        breaks = np.cumsum(kind == _BREAK)
        self.piece = breaks[starts]
        # sum of byte * base ** place, made independent of the place
        power = np.ones(int(length.max(initial=0)) + 1, np.uint64)
        power[1:] = _BASE
        power = np.cumprod(power)
        place = np.arange(len(self.text)) - np.repeat(self.start, length + 1)
        each = (self.text.astype(np.uint64) + np.uint64(1)) * power[place]
        each[self.stop] = 0
        self.hash = _mixed(np.add.reduceat(each, self.start) if len(self.start) else np.zeros(0, np.uint64))

    def bytes_at(self, first: int, last: int) -> bytes:
        return self.text[self.start[first]:self.stop[last]].tobytes()

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether ``n`` words from each place on lie in one piece, and their hash."""
        size = len(self.hash) - n + 1
        if size <= 0:
            return np.zeros(0, bool), np.zeros(0, np.uint64)
        value = np.full(size, n, np.uint64)
        for i in range(n):
            value = _mixed(value * _MIX[0] + self.hash[i:i + size])
        return self.piece[:size] == self.piece[n - 1:], value


def _joined(texts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)


def _slabs(lang: pa.Array, text: pa.Array):
    """(lang, bytes) of whole texts, a few MB at a time."""
    for name in pc.unique(lang).to_pylist():
        held, size = [], 0
        for value in text.filter(pc.equal(lang, name)):
            value = value.as_buffer()
            held.append(value.to_pybytes())
            size += value.size
            if size >= _SLAB:
                yield name, _joined(held)
                held, size = [], 0
        if held:
            yield name, _joined(held)


def cut_points(words: Words) -> np.ndarray:
    """Words at which a chunk starts: the first of each piece, and triggers."""
    first = np.append(True, words.piece[1:] != words.piece[:-1])
    whole, value = words.grams(OVERLAP)
    first[:len(value)] |= whole & (value % np.uint64(TRIGGER) == 0)
    return np.flatnonzero(first)


def _parse(batches):
    """Chunks of batches of texts with their counts, emptied before they grow large.

    ``fresh`` is the number of words up to the next trigger: those at which n-grams count.
    """
    held: dict[str, Counter] = {}

    def out():
        rows = [(lang, chunk, fresh, n) for lang, counts in held.items() for (chunk, fresh), n in counts.items()]
        held.clear()
        lang, chunk, fresh, n = zip(*rows)
        return {"lang": list(lang), "chunk": list(chunk), "fresh": list(fresh), "n": list(n)}

    for batch in batches:
        for lang, data in _slabs(batch["lang"], batch["text"]):
            words = Words(data)
            if not len(words.hash):
                continue
            at = cut_points(words)
            ends = np.append(at[1:], len(words.hash))
            # over the next trigger, not over the end of the piece
            pieces = np.append(words.piece, -1)
            reach = ends.copy()
            for _ in range(OVERLAP):
                more = (reach < len(words.hash)) & (pieces[np.minimum(reach, len(words.hash))] == words.piece[at])
                reach = np.where(more, reach + 1, reach)
            text = words.text.tobytes()
            begin, stop = words.start[at].tolist(), words.stop[reach - 1].tolist()
            held.setdefault(lang, Counter()).update(zip((text[a:b] for a, b in zip(begin, stop)), (ends - at).tolist()))
            if sum(map(len, held.values())) >= _HELD:
                yield out()
    if held:
        yield out()


def dictionary(docs: DataFrame, lang_col: str, text_col: str, parts: int) -> DataFrame:
    """(lang, part, chunk, fresh, n): the distinct chunks and how often the parse has them."""
    rows = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.encode(F.coalesce(text_col, F.lit("")), "utf-8").alias("text"))
    found = map_batches(rows, _parse, "lang string, chunk binary, fresh int, n bigint")
    part = F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int")
    # dealt by part at once: the same exchange serves the sums and the groups below
    dealt = found.withColumn("part", part).repartition("lang", "part")
    return dealt.groupBy("lang", "part", "chunk", "fresh").agg(F.sum("n").alias("n"))


class Part:
    """One part of the dictionary: its words, and for each word how often it counts."""

    def __init__(self, data: pa.Table):
        # an own piece each
        self.words = Words(_joined([v.as_buffer().to_pybytes() for c in data["chunk"].chunks for v in c]))
        fresh, n = data["fresh"].to_numpy(), data["n"].to_numpy()
        size = np.diff(np.append(np.flatnonzero(np.append(True, self.words.piece[1:] != self.words.piece[:-1])), len(self.words.hash)))
        place = np.arange(len(self.words.hash)) - np.repeat(np.cumsum(size) - size, size)
        self.weight = np.where(place < np.repeat(fresh, size), np.repeat(n, size), 0)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, hashes and weights of the n-grams that count here."""
        whole, value = self.words.grams(n)
        at = np.flatnonzero(whole & (self.weight[:len(value)] > 0))
        return at, value[at], self.weight[at]


def _split(value: np.ndarray, lang: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket, and the hash inside it, of an n-gram of a language."""
    value = _mixed(value ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
    return ((value >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), value & np.uint64(0xFFFFFFFF)


def _hashes(buckets: int):
    def step(key, data):
        part, lang = Part(data), key[0].as_py()
        found = [part.grams(n)[1:] for n in range(1, LONGEST + 1)]
        bucket, low = _split(np.concatenate([f[0] for f in found]), lang, buckets)
        code, at = np.unique(bucket.astype(np.uint64) << np.uint64(32) | low, return_inverse=True)
        total = np.bincount(at, np.concatenate([f[1] for f in found]), len(code)).astype(np.int64)
        bucket = (code >> np.uint64(32)).astype(np.int64)
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(code) else np.zeros(0, np.int64)
        stop = np.append(start[1:], len(code))
        low = code.astype("<u4")
        rows = {
            "bucket": bucket[start], "lang": [lang] * len(start), "part": [key[1].as_py()] * len(start),
            "codes": [low[a:b].tobytes() for a, b in zip(start, stop)], "counts": [total[a:b].astype("<i8").tobytes() for a, b in zip(start, stop)],
        }
        give_back()
        return pa.table(rows, pa.schema([("bucket", pa.int64()), ("lang", pa.string()), ("part", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())]))

    return step


def _frequent(least: int):
    """Of one bucket: for each part those of its codes whose sum over all parts is enough."""

    def step(key, data):
        read = lambda name, kind: [np.frombuffer(v.as_buffer(), kind) for c in data[name].chunks for v in c]
        codes, counts = read("codes", "<u4"), read("counts", "<i8")
        known, at = np.unique(np.concatenate(codes), return_inverse=True)
        enough = (np.bincount(at, np.concatenate(counts), len(known)) >= least)[at]
        ends = np.cumsum([len(c) for c in codes])
        chosen = [c[enough[e - len(c):e]] for c, e in zip(codes, ends)]
        keep = np.array([len(c) > 0 for c in chosen])
        out = pa.table({
            "lang": data["lang"].filter(keep), "part": data["part"].filter(keep), "bucket": data["bucket"].filter(keep),
            "codes": pa.chunked_array([pa.array([c.tobytes() for c in chosen if len(c)], pa.binary())]),
        })
        give_back()
        return out

    return step


def _texts(buckets: int):
    """Of one part: the named n-grams as text with their exact counts, and its number of words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def step(key, data, named):
        if not data.num_rows:
            return schema.empty_table()
        part, lang = Part(data), key[0].as_py()
        wanted = [np.uint64(b.as_py()) << np.uint64(32) | np.frombuffer(v.as_buffer(), "<u4").astype(np.uint64) for b, v in zip(named["bucket"], named["codes"])]
        wanted = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.uint64)
        text = part.words.text.tobytes()
        phrases, sizes, totals = [None], [0], [int(part.weight.sum())]
        for n in range(1, LONGEST + 1):
            at, value, weight = part.grams(n)
            bucket, low = _split(value, lang, buckets)
            code = bucket.astype(np.uint64) << np.uint64(32) | low
            place = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1) if len(wanted) else np.zeros(0, np.int64)
            hit = np.flatnonzero(wanted[place] == code) if len(wanted) else place
            counts = Counter()
            # most chunks occur once: these n-grams are counted in one call
            for once in (True, False):
                some = hit[(weight[hit] == 1) == once]
                first, last = part.words.start[at[some]].tolist(), part.words.stop[at[some] + n - 1].tolist()
                found = map(text.__getitem__, map(slice, first, last))
                if once:
                    counts.update(found)
                else:
                    for one, w in zip(found, weight[some].tolist()):
                        counts[one] += w
            phrases += [p.decode() for p in counts]
            sizes += [n] * len(counts)
            totals += counts.values()
        give_back()
        return pa.table({"lang": [lang] * len(phrases), "phrase": phrases, "words": sizes, "n": totals}, schema)

    return step


def frequent_phrases(docs: DataFrame, least: int = 30, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, words, f) of all phrases of 1 to 4 words with ``f`` >= ``least``.

    The row with a null phrase and 0 words holds the language's number of words.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts, buckets = 1 + size // PART_BYTES, 1 + size // PART_BYTES
    chunks = dictionary(docs, lang_col, text_col, parts)
    packed = chunks.groupBy("lang", "part").applyInArrow(_hashes(buckets), "bucket bigint, lang string, part int, codes binary, counts binary")
    named = packed.groupBy("bucket").applyInArrow(_frequent(least), "lang string, part int, bucket bigint, codes binary")
    found = chunks.groupBy("lang", "part").cogroup(named.groupBy("lang", "part")).applyInArrow(_texts(buckets), "lang string, phrase string, words int, n bigint")
    return found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where((F.col("words") == 0) | (F.col("f") >= least))


def _slice_of(phrase, first, count):
    """``count`` words of a phrase from word ``first`` (from 1) on."""
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def collocations(docs: DataFrame, least: int = 30, limit: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``limit`` strongest phrases of each language.

    Words are lower-cased in ASCII, pieces end at ``.,;:!?`` and line ends. A phrase of 2 to
    4 words with at least ``least`` places is scored by its weakest cut, 2,000,000 a / (l + r),
    rounded down; one that lies inside a longer candidate with four fifths of its places is
    dropped. Ties go to more places, then to the phrase's bytes. A null text counts as empty
    and adds nothing; a null language is ``und``; texts have any length; repeated rows count
    each; an empty table gives no rows. Other columns, whatever their names, are not read.
    """
    counted = cut_lineage(frequent_phrases(docs, least, lang_col, text_col))
    known = counted.where("words > 0")
    found = known.where("words > 1").withColumnRenamed("f", "a")
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", _slice_of("phrase", F.lit(1), F.col("k")).alias("first"), _slice_of("phrase", F.col("k") + 1, F.col("words")).alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    exact = F.expr("CAST((CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    weakest = both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _slice_of("phrase", i, n))))
    inner = found.where("words > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("over"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    ten = lambda name, k: F.col(name).cast("decimal(20,0)") * F.lit(k).cast("decimal(3,0)")
    kept = weakest.join(inner, ["lang", "phrase"], "left").where(F.col("over").isNull() | (ten("over", 100) < ten("a", 80)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank).where(F.col("rank") <= limit)
    words = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


_ORACLE = r"""
    WITH p AS MATERIALIZED (
      SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^ \t]+') AS w
      FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS part FROM documents)),
    s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
    f AS MATERIALIZED (
      SELECT lang, words, phrase, count(*) AS f
      FROM (SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM s, range(1, 5) t(k) WHERE i + k - 1 <= len(w))
      GROUP BY ALL HAVING count(*) >= 30),
    n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
    c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
    cuts AS (
      SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, words)) AS k FROM c) c
      JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') AND x.words = k
      JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ') AND y.words = c.words - k),
    weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_ AS (
      SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS over_
      FROM c, range(2, 4) t(m), range(1, 4) u(i) WHERE m < words AND i + m - 1 <= words GROUP BY ALL)
    SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, k.phrase) AS rank, k.phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM weakest k LEFT JOIN inner_ i ON i.lang = k.lang AND i.phrase = k.phrase JOIN n ON n.lang = k.lang
    WHERE over_ IS NULL OR 100::HUGEINT * over_ < 80::HUGEINT * a
    QUALIFY rank <= 2000"""


@query("op12_phrases", _ORACLE)
def op12_phrases(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
