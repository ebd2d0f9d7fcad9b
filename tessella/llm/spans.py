"""Character spans: their order, text form and digest, shared by the span finders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,rank:int,kind:string,stop:bigint,score:double>"


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def oracle(patterns: dict[str, str], valid: dict[str, str], base: tuple[str, ...]) -> str:
    """DuckDB SQL for a span query: gaps and matches of each kind, summed up.

    ``valid`` are conditions on ``hit``, or on ``num``, its digits.
    """
    parts = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        parts.append(f"""
        SELECT row, {rank} AS rank, '{kind}' AS kind, start, start + length(hit) AS stop FROM (
          SELECT row, hit, regexp_replace(hit, '[^0-9]', '', 'g') AS num,
                 list_sum(list_transform(gaps[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda s: length(s))), 0) AS start
          FROM (SELECT row, hits, gaps, unnest(hits) AS hit, unnest(range(1, len(hits) + 1)) AS i
                FROM (SELECT row, regexp_extract_all(body, '{pattern}') AS hits, regexp_split_to_array(body, '{pattern}') AS gaps FROM d)))
        WHERE {valid[kind]}""")
    text = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank)"
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents),
    s AS ({" UNION ALL ".join(parts)}),
    g AS (SELECT row, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)},
                 {text} FILTER (rank < {len(base)}) AS base, {text} AS spans
          FROM s GROUP BY row)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in base)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (row)"""
