"""Secret scans over a ledger of content-addressed texts.

Every version of every text is named by the SHA-256 of its bytes (its blob). A blob is
scanned once per version of the rules: pairs that the ledger holds are left out, equal blobs
are reduced before they are shuffled, and texts travel compressed. Findings are joined back
to all rows that hold the blob.
"""

from __future__ import annotations

import re
import uuid

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.arrow import map_batches
from tessella.llm.registry import query, table
from tessella.llm.spans import SPAN, count_kind, oracle, span_text
from tessella.session import shared_folder

#: Changes with every change of the rules below, so that old ledger rows no longer count.
RULES_VERSION = "3"

_BASE = ("assign", "access", "hex")

#: From the first eyJ of a run, tried once a run and without backtracking: linear at any length.
_JWT = r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(?P<span>eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++)"

#: Kind, words of which a text must hold one (lower case), pattern, least length, its group.
RULES = (
    ("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
     r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
    ("access", ("akia",), r"AKIA[A-Z0-9]+", 18, 0),
    ("hex", (), r"[0-9a-f]{16,}", 16, 0),
    ("pem", ("private key-----",), r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", ("eyj",), _JWT, 0, 0),
    ("hosted", ("ghp_", "gho_", "ghs_", "glpat-", "xoxb-", "xoxp-"), r"(?:gh[pos]_|glpat-|xox[bp]-)[A-Za-z0-9_-]{16,}", 0, 0),
)

LEDGER = f"blob string, rules string, spans array<{SPAN}>"


def text_spans(text: str) -> list[dict]:
    """The spans of one text, by start and then rule; code points, stop exclusive."""
    lower = text.lower()
    out = []
    for rank, (kind, words, pattern, least, group) in enumerate(RULES):
        if words and not any(w in lower for w in words):
            continue
        for hit in re.finditer(pattern, text, re.ASCII):
            if hit.end(group) - hit.start(group) >= least:
                start = hit.start("span") if "span" in hit.re.groupindex else hit.start()
                out.append({"start": start, "rank": rank, "kind": kind, "stop": hit.end(), "score": 1.0})
    return sorted(out, key=lambda s: (s["start"], s["rank"]))


def addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, blob); a null text counts as empty."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), body.alias("text"), F.sha2(body, 256).alias("blob"))


def _packed(batches):
    """The first row of each blob in this task, its text compressed."""
    seen: set[bytes] = set()
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        blobs, texts = [], []
        for blob, text in zip(batch["blob"], batch["text"]):
            name = bytes.fromhex(blob.as_py())
            if name not in seen:
                seen.add(name)
                blobs.append(blob.as_py())
                texts.append(pack.compress(text.as_buffer()))
        yield {"blob": blobs, "packed": texts}


def _scanned(batches):
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        texts = (unpack.decompress(p.as_py()).decode() for p in batch["packed"])
        yield {"blob": batch["blob"], "rules": [RULES_VERSION] * len(batch["blob"]), "spans": [text_spans(t) for t in texts]}


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """New ledger rows (blob, rules, spans): one for each blob the ledger lacks under these rules."""
    texts = map_batches(addressed(docs, id_col, text_col).select("blob", "text"), _packed, "blob string, packed binary")
    if ledger is not None:
        texts = texts.join(ledger.where(F.col("rules") == RULES_VERSION).select("blob"), "blob", "left_anti")
    return map_batches(texts.groupBy("blob").agg(F.first("packed").alias("packed")), _scanned, LEDGER)


def findings(docs: DataFrame, ledger: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and ``spans``, looked up by its blob under the present rules.

    A blob stands in the ledger once for each version of the rules, so the join needs no
    reduction and a blob that many rows share can be split.
    """
    found = ledger.where((F.col("rules") == RULES_VERSION) & (F.size("spans") > 0)).select("blob", "spans")
    named = addressed(docs, id_col, text_col).select("id", "blob").join(found, "blob", "left")
    return named.select(F.col("id").alias(id_col), F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def scan_versions(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bring the ledger at ``ledger_path`` (Parquet) up to date and return each row's findings.

    One row per row of ``docs``: its id and ``spans`` (start, rank, kind, stop, score), by
    start. Null texts are empty and have no spans; repeated rows and copies share one scan;
    an empty table gives no rows. Other columns are not read. A run that fails half way
    leaves the ledger as it was, so it can be repeated; one run writes to a ledger at a time.
    """
    spark = docs.sparkSession
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger_path)
    known = None
    if fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        known = spark.read.schema(LEDGER).parquet(ledger_path)
    scan_unseen(docs, known, id_col, text_col).write.mode("append").parquet(ledger_path)
    return findings(docs, spark.read.schema(LEDGER).parquet(ledger_path), id_col, text_col)


def _oracle() -> str:
    patterns = {kind: pattern.replace("'", "''") for kind, _, pattern, _, _ in RULES}
    # the oracle has no possessive runs; its own form stops at 1,000 characters a part
    patterns["jwt"] = r"eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]+"
    valid = {kind: "true" for kind in patterns} | {
        "assign": f"length(regexp_extract(hit, '{patterns['assign']}', 1)) >= 12",
        "access": "length(hit) >= 18",
    }
    return oracle(patterns, valid, _BASE)


@query("op9_secrets", _oracle())
def op9_secrets(spark, sf_dir):
    """Two versions of the table: first the rows of even ids, then all, on one ledger.

    The second scan reads only blobs that the first one did not bring; the result has every row.
    """
    docs = table(spark, sf_dir, "documents")
    ledger = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    scan_versions(docs.where(F.col("doc_id") % 2 == 0), ledger)
    found = scan_versions(docs, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*_BASE))
    return found.select(
        "doc_id",
        *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in _BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
