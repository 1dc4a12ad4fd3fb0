from siltframe.llm import urls
from siltframe.llm.queries import URL_RULES

CANONICAL = '<head><link rel="canonical" href="{}"></head>'
PAGES = [
    (0, None, None, "", "", None, "allow"),
    (1, "nothing here", "<p>", "", "", None, "allow"),
    (2, "HTTP://WWW.Example.com/en/x?y#z", "", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (3, "http://a.example.com/en/", "", "a.example.com", "/en/", "example.com/en/", "block"),
    (4, "http://badexample.com/en/", "", "badexample.com", "/en/", "com/", "allow"),
    (5, "http://x.net?u=http://y.com/en/", "", "x.net", "", None, "allow"),
    (6, "http://x.net/fr/a/b", "", "x.net", "/fr/a/b", "net/fr/", "block"),
    (7, "https://a.org/1", CANONICAL.format("http://b.example.com/en/7"), "a.org", "/1", None, "block"),
    (8, "https://a.org/2#part", CANONICAL.format("/1"), "a.org", "/2", None, "block"),
    (9, "https://c.org/1", CANONICAL.format("http://www.example.com/en/7"), "c.org", "/1", None, "allow"),
    (10, "https://c.org/2", '<meta http-equiv="refresh" content="0; url=http://q.net/es/">', "c.org", "/2", None, "block"),
    (11, "https://c.org/2", "", "c.org", "/2", None, "block"),
    (12, "https://d.com/1", CANONICAL.format("http://r.net/es/"), "d.com", "/1", "com/", "allow"),
    (13, "https://e.org/1", CANONICAL.format("https://d.com/1"), "e.org", "/1", None, "allow"),
    (None, "https://e.org/2", "<link rel=stylesheet href=http://q.net/es/>", "e.org", "/2", None, "allow"),
]


def test_rules_and_aliases(frame):
    pages = frame("page_id long, url string, html string, host string, verdict int", *[(*p[:3], "x", 1) for p in PAGES])
    got = urls.judged(pages, URL_RULES, urls.page_links(pages)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((p[0], *p[3:]) for p in PAGES), key=repr)
    empty = pages.limit(0)
    assert urls.judged(empty, URL_RULES, urls.page_links(empty)).count() == 0


def test_redirects_given_as_a_table(frame):
    pages = frame("page_id long, url string, html string", (1, "http://s.org/a", None), (2, "http://s.org/b", None))
    links = frame("src string, dst string", ("http://s.org/a", "http://t.org/"), ("http://t.org/#x", "http://z.net/fr/"), (None, "x"), ("http://s.org/b", ""))
    got = urls.judged(pages, URL_RULES, links).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {1: "block", 2: "allow"}
