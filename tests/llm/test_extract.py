"""Main text of pages: marked articles, induced templates, odd HTML."""

import itertools
import re
from html import unescape

from tessella.llm.extract import main_text
from tessella.llm.html_tree import align, outline, read_page
from tests.conftest import SF


def text_of(html):
    blocks = read_page(html)[1]
    scope = max((b.scope for b in blocks), default=0)
    return "\n".join(b.text for b in blocks if b.scope == scope)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in main_text(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        blocks = re.split("</?(?:p|h1|br)>", re.sub("</?b>", "", article))
        want = "\n".join(b for b in (" ".join(unescape(x).split()) for x in blocks) if b)
        assert got[r["page_id"]] == (r["url"], want, len(want))


def test_reader():
    assert text_of("<nav>n</nav><article><h1>T &amp; U</h1><p>a <b>b\n c<p>d&nbsp;e</article><footer>f</footer>") == "T & U\na b c\nd e"
    assert text_of("<main><p>m</p><div class='share-box'>s</div><section id=comments><p>c</p></section></main>") == "m"
    assert text_of("<article><p>x</p><aside>y</aside><form>z</form><!-- n --><script>'</p>'</script><p>w<span class=ad>q</span>!</p></article>") == "x\nw!"
    assert text_of("<body><header>h</header><div>a<br>b</div><ul><li>1<li>2</ul><table><tr><td>3<td>4</table>") == "a\nb\n1\n2\n3\n4"
    assert text_of("plain < text & more") == "plain < text & more"
    assert text_of("<p>open <a href='x>y'>link</a> <!-- never closed <p>gone") == "open link"
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text_of("<article><p>" + "long " * 100_000 + "</p></article>") == ("long " * 100_000).strip()
    assert text_of("") == text_of("<script>x") == ""


def test_names_in_compounds():
    for name in ("has-sidebar", "with-sidebar", "no-comments", "ad-free", "related-topic", "search-result", "notice-board", "share-price"):
        assert text_of(f"<article class='post {name}'><p>x</p></article>") == "x"
        assert text_of(f"<div id='content' class='{name}'><p>x</p></div>") == "x"
    for name in ("ad", "ad-box", "site-footer", "comments-area", "cookie-banner", "sidebar-left"):
        assert text_of(f"<div class='{name}'><p>x</p></div><p>y</p>") == "y"
    assert text_of("<article class='notice'><p>x</p><article class='comment'><p>c</p></article></article>") == "x"


def best(a, b):
    """Size of the largest ordered matching, by trying all."""
    if a[0] != b[0]:
        return 0
    top = 0
    for n in range(min(len(a), len(b))):
        for xs in itertools.combinations(a[1:], n):
            for ys in itertools.combinations(b[1:], n):
                sizes = [best(x, y) for x, y in zip(xs, ys)]
                top = max(top, sum(sizes))
    return top + 1


def test_alignment_is_the_largest():
    trees = [["r"], ["r", ["a"], ["b"]], ["r", ["b"], ["a"]], ["r", ["a", ["x"], ["y"]], ["a", ["y"]], ["c"]], ["r", ["a", ["y"]], ["b"], ["a", ["x"], ["y"], ["z"]]], ["q"]]
    for a, b in itertools.product(trees, trees):
        assert len(align(a, b)) == best(a, b)
    assert align(trees[1], trees[2]) in ({0: 0, 1: 2}, {0: 0, 2: 1})


def test_tree_joins_neighbours():
    assert outline(read_page("<div class=x><p>1<p>2</div><div class=x><p>3</div><div></div>")[0]) == ["", ["div.x", ["p"]], ["div"]]


def site(i, host="x.example"):
    extra = "<div class=top2>hot</div>" if i % 3 == 0 else ""
    return (i, f"http://{host}/{i}", f"<body><div class=top>My site</div>{extra}<div id=c><h2>Title {i}</h2><p>Text {i * 7} &amp; more</div><div class=legal>All rights</div>")


def test_induced_template(spark):
    rows = [site(i) for i in range(8)] + [site(20, "alone.example")] + [(i, f"http://copy.example/{i}", site(30)[2]) for i in range(40, 60)]
    rows += [(70, None, None), (71, "", ""), (72, "http://x.example/", None), (73, None, "<p>no host</p>"), (1, "http://x.example/1", site(1)[2]), (None, "u", "<p>no id")]
    pages = spark.createDataFrame([(*r, "c", 5, 6) for r in rows], "page_id long, url string, html string, host string, tree int, blocks int")
    got = [(r["page_id"], r["url"], r["text"]) for r in main_text(pages).collect()]
    whole = lambda i: f"My site\n{'hot' + chr(10) if i % 3 == 0 else ''}Title {i}\nText {i * 7} & more\nAll rights"
    want = [(i, f"http://x.example/{i}", f"Title {i}\nText {i * 7} & more" if i % 3 or True else "") for i in [*range(8), 1]]
    # the third of pages with one more container: it says the same on all, but on too few pages
    want = [(i, u, ("hot\n" if i % 3 == 0 else "") + t) for i, u, t in want]
    want += [(20, "http://alone.example/20", whole(20))] + [(i, f"http://copy.example/{i}", whole(30)) for i in range(40, 60)]
    want += [(70, None, ""), (71, "", ""), (72, "http://x.example/", ""), (73, None, "no host"), (None, "u", "no id")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def texts_of(spark, htmls, host="h.example"):
    pages = spark.createDataFrame([(i, f"http://{host}/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return [r["text"] for r in main_text(pages).orderBy("page_id").collect()]


def words(i, n=30):
    return " ".join(f"w{i}x{k * k % 97}" for k in range(n))


def test_template_lines_inside_articles(spark):
    page = "<article><h1>Same title</h1><div class=note>Read our rules</div><p>{}</p><div class=legal>All rights</div></article>"
    assert texts_of(spark, [page.format(words(i)) for i in range(12)]) == [f"Same title\n{words(i)}" for i in range(12)]


def test_copies_under_other_titles_are_no_template(spark):
    page = "<article><h1>T{}</h1><p>" + words(0) + "</p></article>"
    assert texts_of(spark, [page.format(i) for i in range(40)]) == [f"T{i}\n{words(0)}" for i in range(40)]
    page = "<div class=head>T{}</div><div class=body><p>" + words(0) + "</p></div>"
    assert texts_of(spark, [page.format(i) for i in range(40)]) == [f"T{i}\n{words(0)}" for i in range(40)]


def test_own_text_in_a_template_container(spark):
    page = "<div class=a>{}</div><div class=b>{}</div>"
    rows = [page.format(words(i), "not available") for i in range(16)] + [page.format(words(i), f"own {i}") for i in range(16, 20)]
    assert texts_of(spark, rows) == [words(i) + (f"\nown {i}" if i > 15 else "") for i in range(20)]


def test_teasers_beside_the_body(spark):
    teaser = "<article><p>Read {} next</p></article>"
    rows = [teaser.format(i) + f"<div class=body><p>{words(i)}</p></div>" for i in range(3)]
    rows += [f"<main><p>{words(i)}</p>{teaser.format(i)}</main>" for i in range(3, 6)]
    rows += [f"<article><p>{words(6)}</p></article><div class=more><p>Read 6 next</p></div>"]
    assert texts_of(spark, rows) == [words(i) for i in range(7)]


def test_forms_and_names_around_the_page(spark):
    rows = [f"<form id=f><div class=top></div><div><p>{words(0)}</p></div><select><option>o</select></form>"]
    rows += [f"<form><article><p>{words(1)}</p></article></form>", f"<article><p>{words(2)}</p></article><form><p>Your name</p></form>"]
    rows += [f"<div class='item alert'><h1>T</h1><p>{words(3)}</p><nav>n</nav></div>", "<div class=ad><p>buy</p></div><form><p>q</p></form><footer>f"]
    rows += ["<article><p>a <math><mi>x</mi><mo>+</mo><mn>1</mn></math> b</p><object>o</object></article>"]
    assert texts_of(spark, rows) == [words(0), words(1), words(2), f"T\n{words(3)}", "", "a x+1 b\no"]


def test_large_and_deep_trees(spark):
    parts = lambda i, n: "".join(f"<div class=c{k}><span>a</span></div>" for k in range(n) if k % (i + 2))
    rows = [f"{parts(i, 1000)}<div class=body>{words(i)}</div><div class=legal>All rights</div>" for i in range(6)]
    rows += ["<div>" * 3000 + f"<p>{words(i)}</p>" + "</div>" * 3000 for i in range(6, 8)]
    got = texts_of(spark, rows)
    assert all(g.endswith(words(i)) for i, g in enumerate(got))
    assert got[6:] == [words(6), words(7)]


def test_no_rows(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
