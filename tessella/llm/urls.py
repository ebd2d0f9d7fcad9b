"""URL filters with SQL expressions only: path rules, then a list of canonical URLs.

A blocked Bloom filter of the list lets possible hits through to an exact hash join, which
removes the false positives. Each key sets eight bits of one 256-bit block. The filter is
one array in a scalar subquery; its size follows the list up to ``max_blocks`` blocks of
32 bytes. A longer list only fills the filter more, so more URLs reach the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.registry import query, table
from tessella.session import cut_lineage, pinned

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``; else empty."""
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def canonical_url(url: Column, host: Column, path: Column) -> Column:
    """Host and path with the sorted query, without fragment, campaign arguments, final slash."""
    arguments = F.split(F.regexp_extract(_after_scheme(url), "^[^?#]*\\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(arguments, lambda a: (a != "") & ~a.rlike("^(?:utm_[a-z]+|ref|gclid|fbclid)=")))
    text = F.array_join(kept, "&")
    return F.concat(host, F.regexp_replace(path, "(?<!^)/+$", ""), F.when(text != "", F.concat(F.lit("?"), text)).otherwise(""))


def domain_key(host: Column, depth: int) -> Column:
    """``domain/`` of the host's last ``depth`` labels; null when it has fewer."""
    labels = F.split(host, "[.]")
    tail = F.array_join(F.slice(labels, F.greatest(F.size(labels) - depth + 1, F.lit(1)), F.lit(depth)), ".")
    return F.when((host != "") & (F.size(labels) >= depth), F.concat(tail, F.lit("/")))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) that covers the URL, as struct(size, rule, verdict)."""
    found = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.filter(F.array(*found), lambda r: r.isNotNull()))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _words(key: Column) -> list[Column]:
    """The four 64-bit words of a key's eight bits."""
    seed = F.xxhash64(key, F.lit("bits"))
    bits = [F.shiftrightunsigned(seed, 8 * i).bitwiseAND(F.lit(255)).cast("int") for i in range(8)]
    out = []
    for w in range(4):
        word = F.lit(0).cast("long")
        for b in bits:
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), b % 64)
            word = word.bitwiseOR(F.when(F.floor(b / 64) == w, mask).otherwise(F.lit(0).cast("long")))
        out.append(word)
    return out


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row, one array: the blocks' words in order."""
    words = listed.select(_block(F.col(key), blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(_words(F.col(key)))])
    filled = words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])
    every = listed.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    zero = F.lit(0).cast("long")
    rows = every.join(filled, "block", "left").select(F.struct("block", *[F.coalesce(F.col(f"w{i}"), zero).alias(f"w{i}") for i in range(4)]).alias("r"))
    sorted_rows = F.array_sort(F.collect_list("r"))
    return rows.agg(F.flatten(F.transform(sorted_rows, lambda r: F.array(r["w0"], r["w1"], r["w2"], r["w3"]))).alias("words"))


def _may_hold(key: Column, words: Column, blocks: int) -> Column:
    base = _block(key, blocks) * 4
    tests = [F.get(words, base + i).bitwiseAND(w) == w for i, w in enumerate(_words(key))]
    return tests[0] & tests[1] & tests[2] & tests[3]


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]],
    id_col: str = "page_id", url_col: str = "url", bits_per_key: int = 16, max_blocks: int = 1 << 17,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    ``listed`` has one column ``key``: canonical URLs, or ``host/`` for a whole domain. The
    longest rule decides; without one a listed URL or domain is blocked, the rest allowed.
    Null URLs and URLs without ``://`` have an empty host and path and are allowed unless a
    rule says otherwise. Null and repeated keys of the list do no harm; repeated pages are
    judged one by one; empty tables give no rows. Other columns are not read.
    """
    keys = listed.select(F.col("key")).where(F.col("key").isNotNull()).distinct()
    # the list's size, and the label counts of its domains: a name has at most 127 labels
    domain = F.when(F.col("key").rlike("^[^/]+/$"), F.size(F.split("key", "[.]")))
    size, depths = keys.agg(F.count("*"), F.collect_set(F.when(domain <= 127, domain))).first()
    blocks = max(1, min(max_blocks, -(-size * bits_per_key // 256)))
    url = F.coalesce(F.col("url"), F.lit(""))
    work = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    work = pinned(work.select("id", url.alias("url")), host=url_host(F.col("url")), path=url_path(F.col("url")))
    work = pinned(work, found=matched_rule(F.col("host"), F.col("path"), rules))
    out = [F.col("id"), F.col("host"), F.col("path"), F.col("found.rule").alias("rule")]
    ruled = work.where("found IS NOT NULL").select(*out, F.col("found.verdict").alias("verdict"))
    open_ = work.where("found IS NULL")
    # built once; every test reads the same row
    words = cut_lineage(bloom_filter(keys, "key", blocks)).scalar()
    tried = {"k0": canonical_url(F.col("url"), F.col("host"), F.col("path"))} | {f"k{d}": domain_key(F.col("host"), d) for d in sorted(depths)}
    open_ = pinned(open_, **tried)
    passed = [F.when(_may_hold(F.col(k), words, blocks), F.col(k)).alias(k) for k in tried]
    open_ = pinned(open_.select("id", "host", "path", "found", *passed), hits=F.filter(F.array_distinct(F.array(*tried)), lambda k: k.isNotNull()))
    clear = open_.where(F.size("hits") == 0).select(*out, F.lit("allow").alias("verdict"))
    likely = open_.where(F.size("hits") > 0).withColumn("row", F.monotonically_increasing_id())
    tried = likely.select("row", *out, F.explode("hits").alias("key")).join(keys.withColumn("on_list", F.lit(True)), "key", "left")
    exact = tried.groupBy("row").agg(*[F.any_value(c).alias(c) for c in ("id", "host", "path", "rule")], F.max("on_list").alias("on_list"))
    exact = exact.select("id", "host", "path", "rule", F.when(F.col("on_list"), "block").otherwise("allow").alias("verdict"))
    return ruled.unionByName(clear).unionByName(exact).withColumnRenamed("id", id_col)


#: The rules (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Words that put a host on the list when one of its labels, or a part of one, is such a word.
LISTED_WORDS = "casino|bet|bets|pills|ads|spam|adult|porn|viagra|poker"


def listed_hosts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """The list of the query: ``host/`` of every host with a listed word."""
    host = url_host(F.coalesce(F.col(url_col), F.lit("")))
    return pages.select(host.alias("host")).where(F.col("host").rlike(f"(?:^|[.-])(?:{LISTED_WORDS})(?:[.-]|$)")).distinct().select(F.concat("host", F.lit("/")).alias("key"))


def _oracle() -> str:
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    rules = " UNION ALL ".join(f"SELECT '{h}' AS h, '{p}' AS p, '{v}' AS v" for h, p, v in RULES)
    return f"""
    WITH u AS MATERIALIZED (SELECT row_number() OVER () AS row, page_id, {rest} AS rest FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
    s AS MATERIALIZED (SELECT row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
    r AS ({rules}),
    m AS (SELECT row, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
          FROM s JOIN r ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p) GROUP BY row)
    SELECT page_id, host, path, rule,
           coalesce(v, CASE WHEN regexp_matches(host, '(?:^|[.-])(?:{LISTED_WORDS})(?:[.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
    FROM s LEFT JOIN m USING (row)"""


@query("op8_urls", _oracle())
def op8_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, listed_hosts(pages), RULES)
