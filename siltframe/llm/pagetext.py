"""Main text of web pages as the maximum-scoring contiguous region.

A page is a sequence of tags and words. Words score positive, tags negative: a word counts as the share of words in the
same surroundings that labelled pages have in their article, a tag as the logarithm of the share of such tags there.
Shares start from what an element's name says (a footer is not text, a paragraph is) and follow the labelled pages
as those say more. One linear scan finds the region with the largest sum. Inside it, text in surroundings that are
mostly not article (an advert between two paragraphs) is left out.

Names of elements are a prior only for what they enclose beside the article: an element that holds all of the page's main
elements (or else its articles, or else its first headings) and most of its paragraphs is a wrapper, whatever its name.
So a form around the body, or a column beside whose class a sidebar is named, keeps its article. Names that state what an
element has or lacks (``has-sidebar``) say nothing about it.

Labelled pages are those with exactly one article element, which serves as their label; up to SAMPLE_PAGES of them are
counted. Block elements and ``<br>`` end a run of white space; blocks are joined by one line feed, runs of white space
inside a block are one space. Null html, and a page without text, give an empty text. Repeated rows are treated alike.
Extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import prepare

SAMPLE_PAGES = 4000
#: Kinds of surroundings and tags that weights are kept for, by how often they are met.
KINDS = 8192
#: No tag scores less, so that an advert does not cut off the short rest of an article.
TAG_FLOOR = -3.25

#: Names of HTML elements and of their usual classes.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template iframe object svg math canvas title textarea select option".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
ASIDE = frozenset("nav header footer aside form menu dialog button fieldset label input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
STRUCTURE = frozenset("article main section div body td ul ol dl table".split()) | ASIDE
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
ASIDE_NAME = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|side-?bar|menu\w*|nav\w*|"
    r"breadcrumbs?|footer|site-?header|masthead|comments?|comment-?list|disqus|replies|respond|discussion|share|sharing|social|related|"
    r"recommend\w*|newsletter|subscri\w+|sign-?up|login|popup|modal|overlay|widgets?|pagination|pager|tags|toolbar|copyright|disclaimer)(?:$|[-_\s])",
    re.I,
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_STATE = re.compile(r"(?:has|have|no|not|with|without|is|hide|show)[-_]", re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


class _Open:
    """An open element: its name, the key of its surroundings, whether its text is hidden, aside or in an article, and where
    the elements around it begin whose names say that they are aside."""

    __slots__ = ("name", "key", "hidden", "aside", "article", "named")

    def __init__(self, name: str, key: str, hidden: bool, aside: bool, article: bool, named: tuple[int, ...]):
        self.name, self.key, self.hidden, self.aside, self.article, self.named = name, key, hidden, aside, article, named


def parts(page: str, wrappers: frozenset = frozenset(), held: dict[int, Counter] | None = None):
    """The page in order as (kind, key, text, block, aside, article): tags with their key, text with its surroundings.

    ``block`` numbers the blocks; hidden text is left out. Elements that begin at ``wrappers`` are not aside by their names.
    ``held`` receives, for the whole page (-1) and every element aside by its name, what it holds: main elements, articles
    and first headings, words of paragraphs and all words.
    """
    stack = [_Open("body", "body", False, False, False, (-1,))]
    at, block = 0, 0

    def hold(places: tuple[int, ...], what: str, n: int = 1):
        if held is not None and n:
            for place in places:
                held.setdefault(place, Counter())[what] += n

    def text(run: str):
        top = stack[-1]
        if run and not top.hidden:
            n = len(run.split())
            hold(top.named, "words", n)
            hold(top.named, "paragraphs", n if top.key.endswith(">p") else 0)
            yield "word", top.key, run, block, top.aside, top.article

    while at < len(page):
        match = _TAG.search(page, at)
        if match is None:
            yield from text(page[at:])
            return
        yield from text(page[at : match.start()])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            continue
        if match["end"] or match["end2"]:
            if name not in INLINE:
                block += 1
            known = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name), 0)
            key = stack[known].key if known else name
            if known:
                del stack[known:]
            if name not in INLINE and not stack[-1].hidden:
                yield "tag", "/" + key, "", block, stack[-1].aside and not stack[-1].article, stack[-1].article
            continue
        if name == "br":
            yield from text(" ")
            continue
        if name in CLOSES_P:
            open_p = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name not in INLINE), 0)
            if open_p and stack[open_p].name == "p":
                del stack[open_p:]
        top = stack[-1]
        if name in INLINE and not match["rest"]:
            if name not in VOID:
                stack.append(_Open(name, top.key, top.hidden, top.aside, top.article, top.named))
            continue
        rest = match["rest"] or match["rest2"] or ""
        names = " ".join(sorted({x for found in _NAMES.findall(rest) for x in "".join(found).lower().split()}))
        hidden = top.hidden or name in HIDDEN or bool(_UNSEEN.search(rest))
        article = top.article or name in ("article", "main")
        telling = " ".join(x for x in names.split() if not _STATE.match(x))
        own = name in ASIDE or (name not in ("main", "body", "html") and bool(ASIDE_NAME.search(telling)))
        named = (*top.named, match.start()) if own and name != "article" else top.named
        if name in ("main", "article", "h1") and not hidden and not own:
            hold(named, name)
        aside = top.aside or (own and name != "article" and match.start() not in wrappers)
        if name in HEADINGS and top.aside and top.article and top.name == "header":
            aside = False  # the headline of an article
        key = top.key if name in INLINE else (top.key.split(">")[0] + ">" + name)
        if name in STRUCTURE:
            key = f"{name} {names}".strip()
        if name not in INLINE:
            block += 1
            if not hidden:
                yield "tag", key, "", block, aside and not article, article
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = close.start() if close else len(page)
            if not close:
                return
        if name not in VOID and not rest.rstrip().endswith("/"):
            stack.append(_Open(name, key, hidden, aside, article, named))


def outline(page: str) -> list[tuple]:
    """The parts of a page, its wrappers told from what stands beside the article."""
    held: dict[int, Counter] = {}
    found = list(parts(page, held=held))
    whole = held.pop(-1, Counter())
    core = next((x for x in ("main", "article", "h1") if whole[x]), None)
    text = "paragraphs" if whole["paragraphs"] else "words"
    wrappers = frozenset(at for at, of in held.items() if core and of[core] == whole[core] and 2 * of[text] > whole[text])
    return list(parts(page, wrappers)) if wrappers else found


def _prior(key: str, aside: bool, article: bool) -> tuple[float, float]:
    """Words inside and outside of articles that an element's name counts for before any page is seen."""
    if aside:
        return 0.05, 5.0
    inner = key.lstrip("/").split(">")[-1].split(" ")[0]
    if article or inner in HEADINGS or inner in ("p", "blockquote", "pre", "figcaption", "article", "main"):
        return 3.0, 0.2
    return (0.7, 0.6) if inner in ("body", "div", "section", "td", "table", "tr", "dd", "dt", "html") else (0.3, 1.0)


def share(weights: dict, kind: str, key: str, aside: bool, article: bool) -> float:
    inside, outside = weights.get((kind, key, aside, article), (0, 0))
    a, b = _prior(key, aside, article)
    return (inside + a) / (inside + outside + a + b)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum, the first and shortest of equals, by one scan."""
    best, best_from, best_to, total, start = 0.0, 0, 0, 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, best_from, best_to = total, start, at + 1
    return best_from, best_to


def main_text(page: str | None, weights: dict) -> str:
    if not page:
        return ""
    items, scores = [], []
    for kind, key, text, block, aside, article in outline(page):
        of = share(weights, kind, key, aside, article)
        words = html.unescape(text) if kind == "word" else ""
        items.append((kind, words, block, of))
        scores.append(of * len(words.split()) if kind == "word" else max(math.log(of), TAG_FLOOR))
    start, end = best_region(scores)
    blocks: list[list[str]] = []
    last = None
    for kind, words, block, of in items[start:end]:
        if kind == "word" and of >= 0.5:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(words)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def label_counts(page: str) -> Counter:
    """(kind, key, aside, article, inside) of the parts of a labelled page: words, or tags."""
    out: Counter = Counter()
    for kind, key, text, _, aside, article in outline(page):
        out[kind, key, aside, article, article and not aside] += len(text.split()) if kind == "word" else 1
    return out


def is_labelled(page: str | None) -> bool:
    return bool(page) and len(re.findall(r"<article\b", page, re.I)) == 1 == len(re.findall(r"</article\b", page, re.I))


def _count(batches):
    total: Counter = Counter()
    for batch in batches:
        for page in batch.column("html").to_pylist():
            if is_labelled(page):
                total.update(label_counts(page))
    rows = [(*k[:4], n if k[4] else 0, 0 if k[4] else n) for k, n in total.items() if n]
    types = (pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
    columns = list(zip(*rows)) or [()] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["kind", "key", "aside", "article", "inside", "outside"])


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict:
    """Counts inside and outside of articles by kind of part, from the labelled pages with the smallest hashed ids."""
    labelled = pages.where(F.col("html").rlike("(?i)<article\\b") & F.col("page_id").isNotNull())
    ids = labelled.select("page_id").orderBy(F.xxhash64(F.lit("sample"), "page_id"), "page_id").limit(sample_pages).distinct()
    sample = labelled.select("page_id", "html").join(F.broadcast(ids), "page_id").select("html")
    keys = ["kind", "key", "aside", "article"]
    counts = sample.mapInArrow(_count, "kind string, key string, aside boolean, article boolean, inside long, outside long")
    counts = counts.groupBy(*keys).agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    top = counts.orderBy(F.desc(F.col("inside") + F.col("outside")), *keys).limit(KINDS).collect()
    return {tuple(r[k] for k in keys): (r["inside"], r["outside"]) for r in top}


def _extract(weights):
    def extract(batches):
        known = weights.value
        for batch in batches:
            texts = [main_text(page, known) for page in batch.column("html").to_pylist()]
            lengths = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    return extract


def extracted(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    spark = prepare(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    weights = spark.sparkContext.broadcast(learn(pages, sample_pages))
    return pages.mapInArrow(_extract(weights), "page_id long, url string, text string, n_chars long")
