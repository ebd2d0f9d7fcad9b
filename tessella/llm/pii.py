"""Personal data in texts, with SQL expressions only.

Patterns propose spans, checksums (Luhn, mod 97) and value rules confirm them, and words
just before a span raise its score. Spans of the four base kinds always stay; the added
kinds stay when their score reaches ``keep``.

Positions come from the gaps between matches: ``split`` and ``regexp_extract_all`` see the
same matches, so a start is the sum of all gaps and matches before it. The sums run over
blocks of a fixed length, which keeps a text with very many matches far from quadratic.

The patterns are written so that no input makes them slow: greedy runs that cannot give
anything back are possessive, and a run is only tried from its first character (or from the
end of the match before), since a later start meets the same end.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.registry import query, table
from tessella.llm.spans import SPAN, count_kind, oracle, span_text
from tessella.session import pinned

_BLOCK = 256
_CONTEXT = 40
#: No match is shorter than five characters, so that many fill the context.
_REACH = _CONTEXT // 5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _digit_count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(_digits(hit)).between(low, high)


def _luhn(hit: Column) -> Column:
    """Every second digit from the right doubled, minus 9 above 9; the sum ends in 0."""
    digits = F.reverse(_digits(hit))
    parts = F.transform(
        F.split(digits, "(?<=.)(?=.)"),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d >= "5", 9).otherwise(0)),
    )
    return F.aggregate(parts, F.lit(0), lambda total, d: total + d) % 10 == 0


def _mod97(hit: Column) -> Column:
    """The first four characters moved to the end, letters as 10 to 35, remainder 1."""
    compact = F.regexp_replace(hit, " ", "")
    moved = F.concat(F.substring(compact, 5, 34), F.substring(compact, 1, 4))
    value = lambda c: F.when(c < "A", c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.split(moved, "(?<=.)(?=.)"),
        F.lit(0),
        lambda total, c: (total * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97,
    )
    return rest == 1


def _ip_parts(hit: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return hit.rlike(f"^{part}(?:\\.{part}){{3}}$")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    probe: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: t.contains("@"), lambda hit: F.lit(True), 0.8, "mail|contact|write to|kontakt|correo|courriel",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"), _ip_parts, 0.6, r"\bip\b|address|host|server|adresse|direcci",
    ),
    Kind(
        "card", r"[0-9](?:[ -]?[0-9])++",
        lambda t: t.rlike("[0-9][ 0-9-][0-9]"), lambda hit: _digit_count(12, 19)(hit) & _luhn(hit), 0.7,
        "card|visa|master|credit|karte|carte|tarjeta",
    ),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]",
        lambda t: t.contains("+"), _digit_count(9, 15), 0.6, "phone|tel|call|mobile|fax|anruf",
    ),
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
        lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), _mod97, 0.8, "iban|account|bank|konto|compte|cuenta", base=False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda t: t.contains("-"), lambda hit: ~hit.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3,
        r"ssn|social security|soc\. sec", base=False,
    ),
)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, sorted by start and kind.

    A span is (start, rank, kind, stop, score) in code points, stop exclusive; ``rank`` is
    the kind's place in ``KINDS``. A null text counts as empty and has no spans; repeated
    rows are answered one by one; an empty table gives no rows. Other columns, whatever
    their names, are not read.
    """
    work = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    body = F.col("body")
    empty_hits = F.array().cast("array<string>")
    work = pinned(work, **{
        f"hit_{k.name}": F.when(k.probe(body), F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0))).otherwise(empty_hits)
        for k in KINDS
    })
    gap_type = "array<struct<n:int,before:string>>"
    gaps = {
        f"gap_{k.name}": F.when(
            F.size(f"hit_{k.name}") > 0,
            F.transform(F.split(body, k.pattern, -1), lambda s: F.struct(F.length(s).alias("n"), F.lower(F.right(s, F.lit(_CONTEXT))).alias("before"))),
        ).otherwise(F.array().cast(gap_type))
        for k in KINDS
    }
    hits = [f"hit_{k.name}" for k in KINDS]
    work = pinned(work.select("id", "body", *hits), **gaps).drop("body")

    def total(steps):
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def steps(k: Kind) -> Column:
        gap = F.col(f"gap_{k.name}")
        return F.transform(F.col(f"hit_{k.name}"), lambda h, i: (F.get(gap, i)["n"] + F.length(h)).cast("long"))

    def sums(k: Kind) -> Column:
        step = F.col(f"step_{k.name}")
        blocks = F.sequence(F.lit(0), F.floor((F.size(step) - 1) / _BLOCK).cast("int"))
        each = F.transform(blocks, lambda b: total(F.slice(step, b * _BLOCK + 1, F.lit(_BLOCK))))
        return F.when(F.size(step) > 0, each).otherwise(F.array().cast("array<bigint>"))

    work = pinned(work, **{f"step_{k.name}": steps(k) for k in KINDS})
    work = pinned(work, **{f"sum_{k.name}": sums(k) for k in KINDS})

    def found(rank: int, k: Kind) -> Column:
        gap, step, sums = F.col(f"gap_{k.name}"), F.col(f"step_{k.name}"), F.col(f"sum_{k.name}")

        def span(hit, i):
            block = F.floor(i / _BLOCK).cast("int")
            before = F.get(gap, i)
            start = total(F.slice(sums, F.lit(1), block)) + total(F.slice(step, block * _BLOCK + 1, i % _BLOCK)) + before["n"]
            # the text before goes on over earlier matches
            back = F.least(i, F.lit(_REACH))
            earlier = lambda values: F.slice(values, i - back + 1, back)
            texts = F.zip_with(earlier(gap), earlier(F.col(f"hit_{k.name}")), lambda g, h: F.concat(g["before"], F.lower(F.right(h, F.lit(_CONTEXT)))))
            context = F.right(F.concat(F.array_join(texts, ""), before["before"]), F.lit(_CONTEXT))
            score = F.least(F.lit(1.0), F.lit(k.score) + F.when(context.rlike(k.context), 0.3).otherwise(0.0))
            ok = k.valid(hit) if k.base else k.valid(hit) & (score >= keep)
            return F.when(ok, F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), F.lit(k.name).alias("kind"),
                (start + F.length(hit)).alias("stop"), score.alias("score"),
            ))

        return F.filter(F.transform(F.col(f"hit_{k.name}"), span), lambda s: s.isNotNull()).cast(f"array<{SPAN}>")

    every = F.array_sort(F.concat(*[found(rank, k) for rank, k in enumerate(KINDS)]))
    return work.select(F.col("id").alias(id_col), every.alias("spans"))


_BASE = tuple(k.name for k in KINDS if k.base)


def _oracle() -> str:
    """The same spans in DuckDB: gaps and matches of each kind, summed up."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
    }
    luhn = (
        "list_sum(list_transform(range(1, length(num) + 1), lambda i: CASE WHEN (length(num) - i) % 2 = 0 THEN CAST(num[i] AS INT) "
        "WHEN CAST(num[i] AS INT) >= 5 THEN CAST(num[i] AS INT) * 2 - 9 ELSE CAST(num[i] AS INT) * 2 END)) % 10 = 0"
    )
    moved = "regexp_replace(hit, '[^A-Z0-9]', '', 'g')"
    numbers = (
        f"array_to_string(list_transform(string_split(substr({moved}, 5) || substr({moved}, 1, 4), ''), "
        "lambda c: CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), '')"
    )
    mod97 = (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({numbers}, ''), lambda c: CAST(c AS BIGINT))), lambda a, b: (a * 10 + b) % 97) = 1"
    )
    valid = {
        "email": "true",
        "ip": r"list_max(list_transform(string_split(hit, '.'), lambda x: CAST(x AS HUGEINT))) <= 255",
        "card": f"CASE WHEN length(num) BETWEEN 12 AND 19 THEN {luhn} ELSE false END",
        "phone": "length(num) BETWEEN 9 AND 15",
        "iban": mod97,
    }
    return oracle(patterns, valid, _BASE)


@query("op2_pii", _oracle())
def op2_pii(spark, sf_dir):
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*_BASE))
    return found.select(
        "doc_id",
        *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in _BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
