import random

import pytest

from siltframe.llm import pagetext

ARTICLE = "<h1>Title &amp; more</h1><p>First  <b>para</b>graph\nwith words<p>Second one<br>goes on &eacute;"
CASES = [
    (None, ""),
    ("", ""),
    ("<html><body></body></html>", ""),
    ("just plain text", "just plain text"),
    (f"<nav><ul><li><a href='/'>Home</a></ul></nav><article>{ARTICLE}</article><footer>Foot</footer>", "Title & more\nFirst paragraph with words\nSecond one goes on é"),
    (f"<body><div class='cookie-notice'><p>We use cookies here</div><div id=content>{ARTICLE}</div><section class='comments'><p>Nice post</p></section>", "Title & more\nFirst paragraph with words\nSecond one goes on é"),
    ("<article><p>Before the break with words</p><div class='ad'>Buy this now</div><p>After the break</p><form><label>Mail</label></form></article>", "Before the break with words\nAfter the break"),
    ("<article><p>One</p><script>var x='<p>no</p>'</script><!-- <p>no</p> --><style>p{}</style><p>Two &am; &#233;</p></article>", "One\nTwo &am; é"),
    ("<article><p>unclosed <a href='x>y z</p></article>", "unclosed y z"),
    *[
        (f"<nav><a href='/'>Home</a></nav><{tag}>{core}</{tag.split()[0]}><footer>Foot</footer>", "Title & more\nFirst paragraph with words\nSecond one goes on é")
        for tag in ("div class='content-area has-sidebar'", "div class='no-sidebar'", "div id='site-nav wrapper'", "div class='layout-sidebar-right'", "form action='/x'")
        for core in (f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>", f"<div>{ARTICLE}</div>")
    ],
    (
        f"<article>{ARTICLE}</article><section class='comments'><article class='comment'><p>{'I like this post very much ' * 5}</p></article></section>",
        "Title & more\nFirst paragraph with words\nSecond one goes on é",
    ),
    (f"<aside><article><p>Read this too</p></article></aside><main>{ARTICLE}</main>", "Title & more\nFirst paragraph with words\nSecond one goes on é"),
    ("<p>" + "word " * 20_000 + "</p>", ("word " * 20_000).strip()),
]


@pytest.mark.parametrize("page, text", CASES)
def test_pages_by_names_alone(page, text):
    assert pagetext.main_text(page, {}) == text


def test_query_over_a_table(frame):
    schema = "page_id long, url string, html string, text string, key int"
    pages = frame(schema, *[(i, f"u{i}", page, "own", 1) for i, (page, _) in enumerate(CASES)], (None, None, "<p>x y</p>", None, 2), (3, "u3", "just plain text", "own", 1))
    got = pagetext.extracted(pages).collect()
    expected = [(i, f"u{i}", text, len(text)) for i, (_, text) in enumerate(CASES)] + [(None, None, "x y", 3), (3, "u3", "just plain text", 15)]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert pagetext.extracted(pages.limit(0)).count() == 0


def test_weights_follow_labelled_pages():
    weights = {("word", "body>p", False, False): (0, 10_000), ("tag", "body>p", False, False): (0, 100)}
    page = "<p>bad text here</p><div><h2>Good text that is long enough</h2></div>"
    assert pagetext.main_text(page, weights) == "Good text that is long enough"


def test_region_equals_brute_force():
    chance = random.Random(2)
    for _ in range(300):
        scores = [chance.randrange(-4, 5) for _ in range(chance.randrange(12))]
        runs = [(a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        largest = max([sum(scores[a:b]) for a, b in runs], default=0)
        start, end = pagetext.best_region(scores)
        assert sum(scores[start:end]) == max(largest, 0)
        assert largest > 0 or start == end


def test_wrapped_pages_teach_and_are_read(frame):
    """Pages whose wrapper is named after a sidebar label themselves and give their articles."""
    chance = random.Random(6)
    words = lambda n: " ".join(chance.choices("some words of an article about rivers and stones".split(), k=n))
    texts = [[words(30), words(25)] for _ in range(50)]
    pages = [
        f"<body class='home'><div class='content has-sidebar'><article><p>{a}</p><p>{b}</p></article><div class='sidebar'><p>{words(4)}</p></div></div></body>"
        for a, b in texts
    ]
    table = frame("page_id long, url string, html string", *[(i, "u", page) for i, page in enumerate(pages)])
    got = {r["page_id"]: r["text"] for r in pagetext.extracted(table).collect()}
    assert got == {i: "\n".join(t) for i, t in enumerate(texts)}
