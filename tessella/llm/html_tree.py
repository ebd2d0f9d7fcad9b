"""A light reader of HTML: text blocks, and the tree of the containers they stand in."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from html import unescape

#: Elements and names that never hold the main text.
RAW = "script|style|noscript|template|textarea|iframe|svg|canvas"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var "
    "math mi mo mn ms mrow mtext msup msub msubsup mfrac msqrt mroot mfenced munder mover semantics".split()
)
NEVER = set("head nav footer aside button select fieldset dialog menu audio video".split())
NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay comment comments respond disqus share sharing social "
    "related newsletter subscribe pagination pager widget toolbar masthead login signup search skip".split()
)
#: Words that may stand beside such a name; any other word makes it another name (has-sidebar, share-price).
BESIDE = set(
    "box bar block container wrapper wrap section area panel list links link buttons button inner outer unit slot items item top bottom left right header title "
    "icons icon row column group form posts site page main primary secondary global google tools text".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: An opening tag on the left ends an open element on the right, up to one of the borders.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<({RAW})\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_FORM_END = re.compile("</form", re.I)
_MARKED = re.compile(r"<(?:article|main)\b", re.I)
_CONTENT = re.compile(r"<(?:article|main|h1)\b", re.I)
OPEN, DOUBTFUL, CLOSED = range(3)


@dataclass
class Node:
    """A container: its signature, its number in page order, its parts by signature."""

    sign: str
    number: int
    parts: list["Node"] = field(default_factory=list)


@dataclass
class Block:
    """A text block, the number of its container, and its scope.

    The scope is 2 in an article, 1 in main, else 0; it is -1 where only a form or a name
    speaks against a part that holds a title, an article or a main part.
    """

    text: str
    node: int
    scope: int
    title: bool = False
    shut: "_Shut | None" = None


@dataclass
class _Shut:
    """A part that should hold no main text, inside another one or none.

    ``maybe``: only forms and names say so, here and outside. What one holds, the outer holds.
    """

    outer: "_Shut | None"
    maybe: bool
    holds: bool = False

    def doubtful(self) -> bool:
        return self.maybe and self.holds


@dataclass
class _Open:
    tag: str
    node: Node
    scope: int
    shut: _Shut | None


def _attributes(text: str) -> tuple[set[str], str, str]:
    """Tokens of class and id, the role, and the first class as a signature."""
    words, role, first = set(), "", ""
    if "=" in text:
        for name, *values in _ATTRIBUTE.findall(text):
            value = next((v for v in values if v), "").lower()
            if name.lower() == "role":
                role = value.strip()
            else:
                words.update(value.split())
                first = first or (value.split() or [""])[0]
    return words, role, first


def _named(token: str) -> bool:
    """Whether a class or id names such a part, alone or beside words that do not change it."""
    words = {w for w in _NAME.findall(token) if len(w) > 1}
    return bool(words & NAMES) and words <= NAMES | BESIDE


def _verdict(tag: str, tokens: set[str], role: str, scope: int) -> int:
    """Whether an element may hold main text: open, closed, or closed by its name only."""
    if tag in ("html", "body", "main"):
        return OPEN
    if tag in NEVER or (tag == "header" and scope == 0) or role in ROLES:
        return CLOSED
    if tag == "article" and scope < 2:
        return OPEN
    header = scope == 0 and tag not in ("h1", "article") and any("header" in _NAME.findall(t) for t in tokens)
    return DOUBTFUL if header or any(map(_named, tokens)) else OPEN


def _wraps(html: str, start: int) -> bool:
    """Whether the form opened before ``start`` wraps the page's content."""
    end = _FORM_END.search(html, start)
    stop = end.start() if end else len(html)
    if _CONTENT.search(html, start, stop):
        return True
    return 2 * (stop - start) > len(html) and not _MARKED.search(html)


def read_page(html: str) -> tuple[Node, list[Block]]:
    """The tree of containers and the blocks of a page, outside what never holds main text.

    Neighbours with one signature count as one container; a closed container is a leaf.
    """
    root = Node("", 0)
    count = 1
    stack = [_Open("", root, 0, None)]
    blocks: list[Block] = []
    held: list[str] = []

    def flush():
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                top = stack[-1]
                blocks.append(Block(text, top.node.number, top.scope, top.node.sign.partition(".")[0] == "h1", top.shut))

    def close(index: int):
        flush()
        del stack[index:]

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at and (stack[-1].shut is None or stack[-1].shut.maybe):
            held.append(html[at:token.start()])
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            # only a closed inline element matters: its text is left out
            words, role, _ = _attributes(token[4]) if not token[2] and token[4] else (set(), "", "")
            if token[2]:
                index = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag not in INLINE or stack[i].tag == tag), 0)
                if index and stack[index].tag == tag:
                    del stack[index:]
            elif words or role:
                top = stack[-1]
                shut = _Shut(top.shut, False) if _verdict(tag, words, role, top.scope) else top.shut
                stack.append(_Open(tag, top.node, top.scope, shut))
            continue
        if token[2]:
            index = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if index:
                close(index)
            else:
                flush()
            continue
        flush()
        if tag in VOID:
            continue
        ended, borders = ENDS.get(tag, ((), ()))
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in borders:
                break
            if stack[i].tag in ended:
                close(i)
                break
        # a block ends an open paragraph, and inline elements left open in it
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                close(i)
                break
            if stack[i].tag not in INLINE:
                break
        top = stack[-1]
        words, role, first = _attributes(token[4])
        verdict, shut = _verdict(tag, words, role, top.scope), top.shut
        if tag == "form" and verdict == OPEN and not _wraps(html, at):
            verdict = DOUBTFUL
        if tag in ("article", "main", "h1"):
            outer = shut
            while outer is not None and not outer.holds:
                outer.holds, outer = True, outer.outer
        if verdict:
            shut = _Shut(shut, verdict == DOUBTFUL and (shut is None or shut.maybe))
        scope = max(top.scope, 2 if tag == "article" else 1 if tag == "main" or role == "main" else 0)
        node = top.node
        if top.shut is None:
            sign = f"{tag}.{first}" if first else tag
            if node.parts and node.parts[-1].sign == sign:
                node = node.parts[-1]
            else:
                node.parts.append(Node(sign, count))
                node, count = node.parts[-1], count + 1
        stack.append(_Open(tag, node, scope, shut))
    if at < len(html) and (stack[-1].shut is None or stack[-1].shut.maybe):
        held.append(html[at:])
    flush()
    for block in blocks:
        block.scope = block.scope if block.shut is None else -1
    return root, [b for b in blocks if b.shut is None or b.shut.doubtful()]


def outline(node: Node) -> list:
    """The tree as nested lists: [signature, part, part ...], in page order."""
    return listed(shape(node))


def shape(node: Node) -> str:
    """The tree as text, a line with level and signature for each container in page order."""
    lines, stack = [], [(0, node)]
    while stack:
        level, at = stack.pop()
        lines.append(f"{level} {at.sign}")
        stack.extend((level + 1, part) for part in reversed(at.parts))
    return "\n".join(lines)


def listed(text: str) -> list:
    """The nested lists of a tree's text form."""
    path: list[list] = []
    for line in text.split("\n"):
        level, sign = line.split(" ", 1)
        del path[int(level):]
        own = [sign]
        if path:
            path[-1].append(own)
        path.append(own)
    return path[0]


@dataclass
class _Tree:
    """Containers in page order: signature, parts, size and kind (equal for equal subtrees)."""

    signs: list[str]
    parts: list[list[int]]
    sizes: list[int]
    kinds: list[int]


def _tree(nested: list, kinds: dict) -> _Tree:
    signs, parts, stack = [], [], [(nested, -1)]
    while stack:
        node, parent = stack.pop()
        if parent >= 0:
            parts[parent].append(len(signs))
        stack.extend((part, len(signs)) for part in reversed(node[1:]))
        signs.append(node[0])
        parts.append([])
    sizes, own = [1] * len(signs), [0] * len(signs)
    for i in reversed(range(len(signs))):
        sizes[i] += sum(sizes[p] for p in parts[i])
        own[i] = kinds.setdefault((signs[i], tuple(own[p] for p in parts[i])), len(kinds))
    return _Tree(signs, parts, sizes, own)


def _best(xs: list[int], ys: list[int], match: Callable[[int, int], int]) -> list[list[int]]:
    """The table of the best ordered matchings of leading parts."""
    rows = [[0] * (len(ys) + 1)]
    for x in xs:
        row = [0]
        for k, y in enumerate(ys):
            size = match(x, y)
            row.append(max(rows[-1][k + 1], row[-1], rows[-1][k] + size if size else 0))
        rows.append(row)
    return rows


def align(left: list, right: list) -> dict[int, int]:
    """Simple tree matching of two outlines: container numbers of the left to the right's.

    Equal roots match one and the best ordered matching of their parts. Numbers follow page
    order, which is the order of the nested lists. Equal parts at both ends match each other,
    which no other choice exceeds, so trees of any size cost time only where they differ.
    """
    kinds: dict = {}
    a, b = _tree(left, kinds), _tree(right, kinds)
    # calls are as deep as the trees; they take no room on the native stack
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 2 * len(a.signs) + 1000))
    known: dict[tuple[int, int], int] = {}

    def trimmed(i: int, j: int) -> tuple[list[int], list[int], list[tuple[int, int]]]:
        xs, ys, same = a.parts[i], b.parts[j], []
        least = min(len(xs), len(ys))
        head = next((k for k in range(least) if a.kinds[xs[k]] != b.kinds[ys[k]]), least)
        tail = next((k for k in range(least - head) if a.kinds[xs[-1 - k]] != b.kinds[ys[-1 - k]]), least - head)
        same = [*zip(xs[:head], ys[:head]), *zip(xs[len(xs) - tail:], ys[len(ys) - tail:])]
        return xs[head:len(xs) - tail], ys[head:len(ys) - tail], same

    def match(i: int, j: int) -> int:
        if a.kinds[i] == b.kinds[j]:
            return a.sizes[i]
        if a.signs[i] != b.signs[j]:
            return 0
        if (i, j) not in known:
            xs, ys, same = trimmed(i, j)
            known[i, j] = 1 + sum(a.sizes[x] for x, _ in same) + _best(xs, ys, match)[-1][-1]
        return known[i, j]

    pairs, stack = {}, [(0, 0)] if match(0, 0) else []
    while stack:
        i, j = stack.pop()
        if a.kinds[i] == b.kinds[j]:
            pairs.update((i + k, j + k) for k in range(a.sizes[i]))
            continue
        pairs[i] = j
        xs, ys, same = trimmed(i, j)
        stack.extend(same)
        rows = _best(xs, ys, match)
        x, y = len(xs), len(ys)
        while x and y:
            if rows[x][y] == rows[x - 1][y]:
                x -= 1
            elif rows[x][y] == rows[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                stack.append((xs[x], ys[y]))
    return pairs
