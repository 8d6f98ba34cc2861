import random

from dealflow.llm.url_filter import RULES, filter_urls, page_links


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    tail = rest[cut:]
    stop = min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:stop]


def rule(url):
    host, path = parts(url)
    fits = [(len(h + p), v == "allow", h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, verdict string, node string")


URLS = [None, "", "nothing", "http://a.COM/x", "https://com", "https://www.example.com/en/1?x=1", "https://example.com/en/2", "http://EXAMPLE.com/en/",
        "https://x.net/es/1", "https://x.net/es", "http://x.net/es/", "https://net/fr/a#t", "ftp://u:p@x.net:80/fr/2", "://x.org/a", "http://a.org://b/c", "http://É.org/", "x://y.net/en/../fr/",
        "http://example.com.evil.org/en/", "http://notexample.com/en/1", "https://x.net?u=/es/", "http://x.net/es/\n2"]


def test_rules_against_brute_force(spark):
    rows = [(i, u, "", "old", "old") for i, u in enumerate(URLS)]
    out = filter_urls(pages(spark, rows), spark.createDataFrame([], "src string, dst string")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.host, r.path) == parts(URLS[r.page_id]) and r.rule == rule(URLS[r.page_id])[0], URLS[r.page_id]
        assert rule(URLS[r.page_id])[1] in (None, r.verdict)
    by = {r.page_id: r.verdict for r in out}
    assert by[URLS.index("https://x.net/es")] == "block"  # the same address but for a slash at the end
    assert by[0] == by[1] == by[2] == "allow"


def test_blocks_reach_aliases_however_far_and_explicit_allow_holds(spark):
    r = random.Random(3)
    chain = [f"http://s{i}.org/p" for i in range(40)]
    links = [(a, b) if r.random() < 0.5 else (b, a) for a, b in zip(chain, chain[1:], strict=False)]
    links += [(chain[-1], "http://hidden.net/fr/x"), (chain[3], "http://fine.com/a"), ("http://lone.org/1", "http://lone.org/2"), (None, "http://x.net/es/1"), ("http://loop.org/", "http://loop.org")]
    r.shuffle(links)
    urls = [*chain, "http://fine.com/a", "http://lone.org/1", "http://lone.org/2", "http://loop.org/", "https://S7.org/p/?utm_source=x#top"]
    out = filter_urls(pages(spark, [(i, u, None, None, None) for i, u in enumerate(urls)] + [(0, urls[0], None, None, None)]), spark.createDataFrame(links, "src string, dst string"))
    got = {urls[x.page_id]: x.verdict for x in out.collect()}
    assert out.count() == len(urls) + 1
    assert {got[u] for u in chain} == {"block"} and got["https://S7.org/p/?utm_source=x#top"] == "block"
    assert got["http://fine.com/a"] == "allow" and got["http://lone.org/1"] == got["http://lone.org/2"] == got["http://loop.org/"] == "allow"


def test_links_of_pages(spark):
    rows = [(1, "https://a.org/x/y?q", '<LINK href="/c" rel=canonical><meta http-equiv="refresh" content="0; url=https://b.org/">', None, None),
            (2, "https://a.org/x/y", "<link rel='canonical' href='//c.org/z'>", None, None), (3, "https://a.org/x/y", '<link rel="canonical" href="k.html">', None, None),
            (4, None, '<link rel="canonical" href="/k">', None, None), (5, "https://a.org", None, None, None)]
    got = sorted(tuple(r) for r in page_links(pages(spark, rows)).collect())
    assert got == sorted([("https://a.org/x/y?q", "https://a.org/c"), ("https://a.org/x/y?q", "https://b.org/"), ("https://a.org/x/y", "https://c.org/z"), ("https://a.org/x/y", "https://a.org/x/k.html")])


def test_empty(spark):
    p = pages(spark, [])
    assert filter_urls(p, page_links(p)).count() == 0
