"""Main text of web pages by wrapper induction.

Pages of one host come from one template. Each page's containers form a tree, articles
included; the tree that most pages of a host have is its reference, and every other tree is
aligned to it by simple tree matching, once per distinct tree. A text that a container has on
nearly all distinct pages of the host is template; pages on which this container says
something else keep it. What is left are slots, outside the elements and names that never
hold main text. Of the slots in articles, in main parts and elsewhere, those with most text
are the main text, where text in an article counts ``WEIGHTS`` times, and so on. Forms and
named parts that hold a title or an article count only where nothing else is left.

Pages whose longest container says the same count as one page, so copies under other titles
are no template. The title and the longest container of an article are never template.
Statistics are kept per (tree, container, text) and summed before they are shuffled, so a
host with a third of all pages costs no task more than others.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.arrow import map_batches
from tessella.llm.html_tree import Block, align, listed, read_page, shape
from tessella.llm.registry import query, table
from tessella.llm.urls import url_host
from tessella.session import cut_lineage, pinned

#: A container is template when this share of at least so many distinct pages agree on it.
SHARE, LEAST_PAGES = 0.8, 5
#: What a character counts in an article, in a main part, elsewhere; doubtful parts count 1 in all.
WEIGHTS = {2: 8, 1: 4, 0: 1}
#: Templates up to this size are sent to all tasks; larger ones meet the pages in a shuffle.
BROADCAST_BYTES = 8 << 20


def _signed(data: str) -> int:
    return xxhash.xxh64_intdigest(data.encode()) - (1 << 63)


def _containers(blocks: list[Block]) -> tuple[dict[int, int], int, set[int]]:
    """Hash of each container's text, that of the page's main container, and fixed content.

    The main container is the longest one of the highest scope. In a marked part it is
    content whatever other pages say, and so is the title.
    """
    texts: dict[int, list[Block]] = {}
    for b in blocks:
        texts.setdefault(b.node, []).append(b)
    hashes = {node: _signed("\n".join(b.text for b in parts)) for node, parts in texts.items()}
    main = max(texts, key=lambda n: (texts[n][0].scope, sum(len(b.text) for b in texts[n]), -n), default=0)
    content = {node for node, parts in texts.items() if parts[0].scope > 0 and (node == main or parts[0].title)}
    return hashes, hashes.get(main, 0), content


def _statistics(batches):
    """Per page and container: the tree and the texts, as hashes."""
    for batch in batches:
        out = {n: [] for n in ("host", "tree", "outline", "page", "node", "text")}
        for host, html in zip(batch["host"], batch["html"]):
            root, blocks = read_page(html.as_py() or "")
            hashes, page, _ = _containers(blocks)
            outline = shape(root)
            tree = _signed(outline)
            for node, text in hashes.items():
                for n, v in zip(out, (host.as_py(), tree, outline, page, node, text)):
                    out[n].append(v)
        yield out


def _aligned(batches):
    for batch in batches:
        pairs = []
        for own, reference in zip(batch["outline"], batch["reference"]):
            found = align(listed(own.as_py()), listed(reference.as_py()))
            pairs.append([{"node": a, "ref": b} for a, b in found.items()])
        yield {"host": batch["host"], "tree": batch["tree"], "pairs": pairs}


def _small_or_merged(side: DataFrame, weight: Column) -> DataFrame:
    size = side.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(side) if size <= BROADCAST_BYTES else side.hint("merge")


def templates(pages: DataFrame) -> DataFrame:
    """(host, tree, fixed): containers and their texts' hashes that are template in a tree.

    ``pages`` has host and html. A host's statistics come from all its pages.
    """
    seen = map_batches(pages.select("host", "html"), _statistics, "host string, tree bigint, outline string, page bigint, node int, text bigint")
    # one row per distinct page and container; copies fall together before the shuffle
    nodes = cut_lineage(seen.groupBy("host", "tree", "page", "node", "text").agg(F.first("outline").alias("outline")))
    trees = nodes.groupBy("host", "tree").agg(F.first("outline").alias("outline"), F.count("*").alias("n"))
    trees = cut_lineage(trees)
    reference = trees.groupBy("host").agg(F.max(F.struct("n", "tree", "outline")).alias("best")).select("host", F.col("best.outline").alias("reference"))
    matched = cut_lineage(map_batches(trees.join(cut_lineage(reference), "host"), _aligned, "host string, tree bigint, pairs array<struct<node:int,ref:int>>"))
    to_reference = matched.select("host", "tree", F.inline("pairs"))
    texts = nodes.groupBy("host", "tree", "node", "text").agg(F.count("*").alias("n"))
    texts = texts.join(_small_or_merged(to_reference, F.length("host") + 32), ["host", "tree", "node"]).groupBy("host", "ref", "text").agg(F.sum("n").alias("n"))
    # the share is above one half, so no container has two such texts
    fixed = texts.groupBy("host", "ref").agg(F.max(F.struct("n", "text")).alias("most"), F.sum("n").alias("pages"))
    fixed = fixed.where((F.col("pages") >= LEAST_PAGES) & (F.col("most.n") >= SHARE * F.col("pages"))).select("host", "ref", "most.text")
    return to_reference.join(fixed, ["host", "ref"]).groupBy("host", "tree").agg(F.collect_set(F.struct("node", "text")).alias("fixed"))


def _read(batches):
    for batch in batches:
        out = {"id": batch["id"], "url": batch["url"], "host": batch["host"], "tree": [], "blocks": []}
        for html in batch["html"]:
            root, blocks = read_page(html.as_py() or "")
            hashes, _, content = _containers(blocks)
            out["tree"].append(_signed(shape(root)))
            out["blocks"].append(
                [{"place": {"node": b.node, "text": hashes[b.node]}, "content": b.node in content, "scope": b.scope, "line": b.text} for b in blocks]
            )
        yield out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars.

    Blocks stand in page order, joined by a line feed; white space inside a block is one
    space. Null and empty pages give an empty text, as do pages without main text. A null
    URL, or one without host, belongs to a host of its own, the empty one. Repeated pages
    are answered one by one; an empty table gives no rows. Texts and trees count whole,
    however long or deep. Ids are integers. Other columns are not read.
    """
    host = url_host(F.coalesce(F.col(url_col), F.lit("")))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    known = cut_lineage(templates(rows))
    block = "struct<place:struct<node:int,text:bigint>,content:boolean,scope:int,line:string>"
    read = map_batches(rows, _read, f"id bigint, url string, host string, tree bigint, blocks array<{block}>")
    read = read.join(_small_or_merged(known, F.length("host") + 16 * F.size("fixed") + 16), ["host", "tree"], "left")
    slots = pinned(read, slots=_slots())
    slots = pinned(slots, scope=_scope())
    text = F.array_join(F.transform(F.filter("slots", lambda b: b["scope"] == F.col("scope")), lambda b: b["line"]), "\n")
    out = slots.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def _slots() -> Column:
    """The blocks that are content or say something else than the template."""
    return F.filter("blocks", lambda b: b["content"] | F.col("fixed").isNull() | ~F.array_contains(F.col("fixed"), b["place"]))


def _scope() -> Column:
    """The scope whose slots weigh most; the highest of equal ones, the doubtful one last."""

    def chars(scope: int) -> Column:
        return F.aggregate("slots", F.lit(0).cast("long"), lambda n, b: n + F.when(b["scope"] == scope, F.length(b["line"])).otherwise(0))

    known = [(chars(scope) * value, scope) for scope, value in WEIGHTS.items()] + [(F.least(chars(-1), F.lit(1)), -1)]
    return F.greatest(*[F.struct(weight.alias("weight"), F.lit(scope).alias("scope")) for weight, scope in known])["scope"]


@query("op10_extract")
def op10_extract(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))
