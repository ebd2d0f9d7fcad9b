"""License scan with ordered signature rules, in SQL expressions only.

A text becomes its words, each between two blanks of its own, so that a rule is a regular
expression over whole words and a place is a count of words. A rule runs only where the
text holds its keyword, and no rule runs where the text holds none of ``GATES``. Detections
that overlap are settled by priority and by containment: a detection inside another one, or
on the same words as an earlier rule's, goes; a detection of the lower priority class goes
where it overlaps one of the higher class.

Positions are sums over the gaps and hits before. Sums and running maxima go over blocks of
a fixed length, which keeps a text with very many hits far from quadratic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.registry import query, table
from tessella.session import pinned

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_STEP = 256
_FAR = 1 << 60


@dataclass(frozen=True)
class Rule:
    """``tokens`` are words: ``a|b`` alternatives, ``a?`` optional, ``~3`` up to three of any."""

    label: str
    tokens: str
    keyword: str
    score: float
    base: bool = False
    generic: bool = False

    @property
    def pattern(self) -> str:
        parts = []
        for token in self.tokens.split():
            if token.startswith("~"):
                parts.append(f"(?: [^ ]+ ){{0,{token[1:]}}}")
            else:
                words = token.removesuffix("?")
                one = f" (?:{words}) " if "|" in words else f" {words} "
                parts.append(f"(?:{one})?" if token.endswith("?") else one)
        return "".join(parts)


_L = "license|licence"
#: Label, keyword, the name in a text, the identifier in a header. Versions come before the plain name.
FAMILIES = (
    ("mit-0", "mit", f"mit no attribution {_L}?", "mit 0"),
    ("mit", "mit", f"mit x11? {_L}", "mit"),
    ("mit", "expat", f"expat {_L}", "expat"),
    ("x11", "x11", f"x11 {_L}", "x11"),
    ("apache-1.0", "apache", f"apache software? {_L} version|v|ver? 1 0", "apache 1 0"),
    ("apache-1.1", "apache", f"apache software? {_L} version|v|ver? 1 1", "apache 1 1"),
    ("apache-2.0", "apache", f"apache software? {_L} version|v|ver? 2|v2 0?", "apache 2 0"),
    ("apache", "apache", f"apache software? {_L}", "apache"),
    ("gpl-1.0", "general", f"gnu? general public {_L} version|v|ver? 1|v1 0?", "gpl 1 0 only|or? later?"),
    ("gpl-2.0", "general", f"gnu? general public {_L} version|v|ver? 2|v2 0?", "gpl 2 0 only|or? later?"),
    ("gpl-3.0", "general", f"gnu? general public {_L} version|v|ver? 3|v3 0?", "gpl 3 0 only|or? later?"),
    ("gpl", "general", f"gnu? general public {_L}", "gpl"),
    ("lgpl-2.0", "general", f"gnu? library|lesser general public {_L} version|v|ver? 2|v2 0?", "lgpl 2 0 only|or? later?"),
    ("lgpl-2.1", "general", f"gnu? library|lesser general public {_L} version|v|ver? 2|v2 1", "lgpl 2 1 only|or? later?"),
    ("lgpl-3.0", "general", f"gnu? library|lesser general public {_L} version|v|ver? 3|v3 0?", "lgpl 3 0 only|or? later?"),
    ("lgpl", "general", f"gnu? library|lesser general public {_L}", "lgpl"),
    ("agpl-3.0", "affero", f"gnu? affero general public {_L} version|v|ver? 3|v3 0?", "agpl 3 0 only|or? later?"),
    ("agpl", "affero", f"gnu? affero general public {_L}", "agpl"),
    ("gfdl", "documentation", f"gnu? free documentation {_L} version? ~2", "gfdl 1 1|2|3"),
    ("bsd-2-clause", "bsd", f"bsd 2|two clause {_L}?", "bsd 2 clause"),
    ("bsd-2-clause", "bsd", f"2|two clause bsd {_L}", "bsd 2 clause freebsd"),
    ("bsd-2-clause", "bsd", f"simplified bsd {_L}", "bsd 2 clause views"),
    ("bsd-3-clause", "bsd", f"bsd 3|three clause {_L}?", "bsd 3 clause"),
    ("bsd-3-clause", "bsd", f"3|three clause bsd {_L}", "bsd 3 clause clear"),
    ("bsd-3-clause", "bsd", f"new|revised|modified bsd {_L}", "bsd 3 clause attribution"),
    ("bsd-4-clause", "bsd", f"bsd 4|four clause {_L}?", "bsd 4 clause"),
    ("0bsd", "bsd", f"zero clause bsd {_L}", "0bsd"),
    ("bsd", "bsd", f"bsd style? {_L}", "bsd"),
    ("isc", "isc", f"isc {_L}", "isc"),
    ("mpl-1.0", "mozilla", f"mozilla public {_L} version|v|ver? 1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla", f"mozilla public {_L} version|v|ver? 1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", f"mozilla public {_L} version|v|ver? 2|v2 0?", "mpl 2 0"),
    ("mpl", "mozilla", f"mozilla public {_L}", "mpl"),
    ("epl-1.0", "eclipse", f"eclipse public {_L} version|v|ver? 1|v1 0?", "epl 1 0"),
    ("epl-2.0", "eclipse", f"eclipse public {_L} version|v|ver? 2|v2 0?", "epl 2 0"),
    ("epl", "eclipse", f"eclipse public {_L}", "epl"),
    ("eupl-1.2", "european", f"european union public {_L} version|v? 1 2", "eupl 1 2"),
    ("eupl", "european", f"european union public {_L}", "eupl"),
    ("cddl-1.0", "distribution", f"common development and distribution {_L} version|v? ~2", "cddl 1 0|1"),
    ("cpl-1.0", "common", f"common public {_L} version|v? ~2", "cpl 1 0"),
    ("artistic-1.0", "artistic", f"artistic {_L} version|v? 1 0", "artistic 1 0 perl?"),
    ("artistic-2.0", "artistic", f"artistic {_L} version|v? 2|v2 0?", "artistic 2 0"),
    ("artistic", "artistic", f"artistic {_L}", "artistic"),
    ("boost-1.0", "boost", f"boost software {_L} version|v? ~2", "bsl 1 0"),
    ("zlib", "zlib", f"zlib libpng? {_L}", "zlib"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "fuck", f"do what the fuck you want to public {_L}", "wtfpl"),
    ("postgresql", "postgresql", f"postgresql {_L}", "postgresql"),
    ("python-2.0", "python", f"python software foundation {_L} version|v? ~2", "python 2 0|0"),
    ("php-3.01", "php", f"php {_L} version|v? ~3", "php 3 0|01"),
    ("ofl-1.1", "font", f"sil? open font {_L} version|v? ~2", "ofl 1 1|0"),
    ("odbl-1.0", "database", f"open database {_L} version|v? ~2", "odbl 1 0"),
    ("odc-by-1.0", "commons", f"open data commons attribution {_L} version|v? ~2", "odc by 1 0"),
    ("sspl-1.0", "server", f"server side public {_L} version|v? ~2", "sspl 1 0"),
    ("elastic-2.0", "elastic", f"elastic {_L} version|v? 2|v2 0?", "elastic 2 0"),
    ("busl-1.1", "business", f"business source {_L} version|v? ~2", "busl 1 1"),
    ("ms-pl", "microsoft", f"microsoft public {_L}", "ms pl"),
    ("ms-rl", "microsoft", f"microsoft reciprocal {_L}", "ms rl"),
    ("ncsa", "ncsa", f"illinois? ncsa open source {_L}", "ncsa"),
    ("openssl", "openssl", f"openssl {_L}", "openssl"),
    ("vim", "vim", f"vim {_L}", "vim"),
    ("ruby", "ruby", f"ruby {_L}", "ruby"),
    ("w3c", "w3c", f"w3c software ~3 {_L}", "w3c"),
    ("lppl-1.3", "latex", f"latex project public {_L} version|v? ~2", "lppl 1 3|3a|3c"),
)
_CC_PARTS = (("by", "attribution"), ("by-sa", "attribution share alike"), ("by-sa", "attribution sharealike"), ("by-nc", "attribution noncommercial"),
             ("by-nc", "attribution non commercial"), ("by-nd", "attribution noderivatives|noderivs"), ("by-nc-sa", "attribution noncommercial sharealike"),
             ("by-nc-sa", "attribution non commercial share alike"), ("by-nc-nd", "attribution noncommercial noderivatives|noderivs"))
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
_GRANT = "licensed|released|distributed|published|available|provided|redistributed under|by the|a? terms? of? the?"


def rules() -> list[Rule]:
    """All rules in order; the place of a rule is its priority inside its class."""
    found = []
    for label, keyword, name, header in FAMILIES:
        first = header.split()[0]
        found += [
            Rule(label, f"spdx {_L} identifier {header}", first, 1.0),
            Rule(label, f"{_GRANT} {name}", keyword, 0.95),
            Rule(label, f"{name} or any? later version?" if "version" in name else f"the {name}", keyword, 0.85),
            Rule(label, name, keyword, 0.7),
        ]
    for version in _CC_VERSIONS:
        for short in dict.fromkeys(s for s, _ in _CC_PARTS):
            words = short.replace("-", " ")
            label = f"cc-{short}-{version.replace(' ', '.')}"
            found += [Rule(label, f"spdx {_L} identifier cc {words} {version}", "cc", 1.0), Rule(label, f"{_GRANT} cc {words} {version}", "cc", 0.95), Rule(label, f"cc {words} {version}", "cc", 0.8)]
        for short, words in _CC_PARTS:
            found.append(Rule(f"cc-{short}-{version.replace(' ', '.')}", f"creative commons {words} {version} ~1 {_L}?", "commons", 0.9))
    found += [
        Rule("cc0-1.0", f"spdx {_L} identifier cc0 1 0", "cc0", 1.0), Rule("cc0-1.0", "cc0 1 0", "cc0", 0.9),
        Rule("cc0-1.0", "creative commons zero", "commons", 0.8), Rule("public-domain", "released|placed|dedicated into|to|in the public domain", "domain", 0.8),
        Rule("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby", 0.95),
        Rule("isc", "permission to use copy modify and or? distribute this software for any purpose", "permission", 0.9),
        Rule("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution", 0.9),
        Rule("zlib", "altered source versions must be plainly marked as such", "altered", 0.9),
        Rule("mit", "mit license", "mit", 0.5, base=True), Rule("apache", "apache license", "apache", 0.5, base=True),
        Rule("gpl", "general public license", "general", 0.5, base=True),
        Rule("other", f"licensed under ~6 {_L}", "licensed", 0.3, generic=True), Rule("other", f"{_L} agreement", "agreement", 0.3, generic=True),
    ]
    return found


#: Every match of a rule holds one of these; a text without them has no detection.
GATES = ("licen", " cc ", " cc0 ", " commons ", " domain ", " permission ", " redistribution ", " altered ")
_RULES = rules()


def _words_in(normal: Column) -> Column:
    """Words of a piece of normal text: each has two blanks."""
    return ((F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit("")))) / 2).cast("long")


def normal_text(text: Column) -> Column:
    """Each word between two blanks of its own; empty without words."""
    body = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS, "  "))
    return F.when(body == "", "").otherwise(F.concat(F.lit(" "), body, F.lit(" ")))


def _rule_table() -> Column:
    quoted = lambda v: f"'{v}'"
    rows = ", ".join(
        f"named_struct('rank', {i}, 'label', {quoted(r.label)}, 'keyword', {quoted(f' {r.keyword} ')}, 'pattern', {quoted(r.pattern)}, "
        f"'score', {r.score}D, 'base', {str(r.base).lower()}, 'generic', {str(r.generic).lower()})"
        for i, r in enumerate(_RULES)
    )
    return F.expr(f"array({rows})")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _block_values(values: Column, fold) -> Column:
    """``fold`` of each block of ``_STEP`` values; empty for no values."""
    last = F.floor((F.size(values) - 1) / _STEP).cast("int")
    each = F.transform(F.sequence(F.lit(0), last), lambda b: fold(F.slice(values, b * _STEP + 1, F.lit(_STEP))))
    return F.when(F.size(values) > 0, each).otherwise(F.array().cast("array<bigint>"))


def _before(values: Column, blocks: Column, i: Column, fold) -> Column:
    """``fold`` of the values before place ``i``: whole blocks, then the rest."""
    block = F.floor(i / _STEP).cast("int")
    parts = F.concat(F.slice(blocks, F.lit(1), block), F.slice(values, block * _STEP + 1, (i % _STEP).cast("int")))
    return fold(parts)


def _highest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(-_FAR))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``places`` and ``detections``.

    ``places`` are all hits of the base phrases, ``detections`` those of all rules that
    priority and containment leave, each (start, back, rank, label, stop, score, base,
    generic): words from 0, stop exclusive, in order of start. A null text counts as empty;
    empty texts and texts without words have no words and no hits. A text is read whole,
    however long. Repeated rows are answered one by one, null ids stay as they are, an empty
    table gives no rows. Other columns, whatever their names, are not read.
    """
    work = pinned(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("raw")), normal=normal_text(F.col("raw"))).drop("raw")
    normal, all_rules = F.col("normal"), _rule_table()
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(normal, F.lit(word))
    there = F.filter(all_rules, lambda r: F.contains(normal, r["keyword"]))
    work = pinned(work, present=F.when(gate, there).otherwise(F.filter(all_rules, lambda r: F.lit(False))))

    def hits(r):
        found = F.regexp_extract_all(normal, r["pattern"], F.lit(0))
        gaps = F.transform(F.split(normal, r["pattern"], -1), _words_in)
        return F.struct(r.alias("rule"), F.transform(found, _words_in).alias("lengths"), gaps.alias("gaps"))

    work = pinned(work, n_words=_words_in(normal), found=F.filter(F.transform("present", hits), lambda f: F.size(f["lengths"]) > 0)).drop("normal", "present")
    stepped = lambda f: F.struct(f["rule"].alias("rule"), f["lengths"].alias("lengths"), f["gaps"].alias("gaps"), F.zip_with(f["lengths"], F.slice(f["gaps"], F.lit(1), F.size(f["lengths"])), lambda n, g: n + g).alias("steps"))
    work = pinned(work, found2=F.transform("found", stepped)).drop("found")
    summed = lambda f: F.struct(*[f[c].alias(c) for c in ("rule", "lengths", "gaps", "steps")], _block_values(f["steps"], _total).alias("sums"))
    work = pinned(work, found3=F.transform("found2", summed)).drop("found2")

    def placed(f):
        def one(length, i):
            start = _before(f["steps"], f["sums"], i, _total) + F.get(f["gaps"], i)
            return F.struct(
                start.alias("start"), (-(start + length)).alias("back"), f["rule"]["rank"].alias("rank"), f["rule"]["label"].alias("label"),
                (start + length).alias("stop"), f["rule"]["score"].alias("score"), f["rule"]["base"].alias("base"), f["rule"]["generic"].alias("generic"),
            )

        return F.transform(f["lengths"], one)

    # by start, the longest first, then by rule
    work = pinned(work, hits=F.array_sort(F.flatten(F.transform("found3", placed)))).drop("found3")
    hits_ = F.col("hits")
    work = pinned(
        work,
        places=F.filter(hits_, lambda h: h["base"]),
        named=F.transform(hits_, lambda h: F.when(h["generic"], -_FAR).otherwise(h["stop"])),
        vague=F.transform(hits_, lambda h: F.when(h["generic"], h["stop"]).otherwise(-_FAR)),
        later=F.reverse(F.transform(hits_, lambda h: F.when(h["generic"], -_FAR).otherwise(-h["start"]))),
    )
    work = pinned(work, **{f"{c}_blocks": _block_values(F.col(c), _highest) for c in ("named", "vague", "later")})

    def stays(h, i):
        upto = lambda c, at: _before(F.col(c), F.col(f"{c}_blocks"), at, _highest)
        own = h["stop"] > upto("named", i)
        free = (upto("named", i) <= h["start"]) & (-upto("later", F.size("hits") - 1 - i) >= h["stop"]) & (h["stop"] > upto("vague", i))
        return F.when(h["generic"], free).otherwise(own)

    return work.select(F.col("id").alias(id_col), "n_words", "places", F.filter("hits", stays).alias("detections"))


def _oracle() -> str:
    values = ",\n".join(f"({i}, '{r.label}', '{r.pattern}', CAST({r.score} AS DOUBLE), {str(r.base).lower()}, {str(r.generic).lower()})" for i, r in enumerate(_RULES))
    return f"""
    WITH rules(rank, label, pattern, score, base, generic) AS (VALUES {values}),
    d AS MATERIALIZED (
      SELECT row_number() OVER () AS row, doc_id, CASE WHEN body = '' THEN '' ELSE ' ' || body || ' ' END AS body
      FROM (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS}', '  ', 'g')) AS body FROM documents)),
    h AS (
      SELECT row, rank, label, score, base, generic,
             list_sum(list_transform(gaps[1:i], lambda s: length(s) - length(replace(s, ' ', '')))) // 2
               + coalesce(list_sum(list_transform(hits[1:i - 1], lambda s: length(s) - length(replace(s, ' ', '')))), 0) // 2 AS start,
             (length(hits[i]) - length(replace(hits[i], ' ', ''))) // 2 AS n
      FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
            FROM (SELECT row, rank, label, score, base, generic, regexp_extract_all(body, pattern) AS hits, regexp_split_to_array(body, pattern) AS gaps FROM d, rules)
            WHERE len(hits) > 0)),
    w AS (
      SELECT *, start + n AS stop,
             max(CASE WHEN NOT generic THEN start + n END) OVER before AS named, max(CASE WHEN generic THEN start + n END) OVER before AS vague,
             min(CASE WHEN NOT generic THEN start END) OVER after AS later
      FROM h WINDOW before AS (PARTITION BY row ORDER BY start, start + n DESC, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    after AS (PARTITION BY row ORDER BY start, start + n DESC, rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    k AS (
      SELECT *, CASE WHEN generic THEN coalesce(named <= start, true) AND coalesce(later >= stop, true) AND coalesce(stop > vague, true)
                     ELSE coalesce(stop > named, true) END AS kept FROM w),
    g AS (
      SELECT row, count(*) FILTER (base) AS n_base, CAST(min(start) FILTER (base) AS BIGINT) AS first_word, CAST(max(start) FILTER (base) AS BIGINT) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept) AS labels,
             max(score) FILTER (kept) AS score FROM k GROUP BY row)
    SELECT doc_id, CAST((length(body) - length(replace(body, ' ', ''))) // 2 AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, CAST(0 AS DOUBLE)) AS score
    FROM d LEFT JOIN g USING (row)"""


@query("op11_licenses", _oracle())
def op11_licenses(spark, sf_dir):
    found = scan_licenses(table(spark, sf_dir, "documents"))
    labels = lambda column: F.array_sort(F.array_distinct(F.transform(column, lambda h: h["label"])))
    starts = F.transform("places", lambda h: h["start"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(labels(F.col("places")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels(F.col("places")), labels(F.col("detections")))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda h: h["score"])), F.lit(0.0)).alias("score"),
    )
