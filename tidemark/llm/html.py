"""Main text of web pages by the maximum-scoring subsequence (operator 10).

A page is a sequence of tags and text. Elements that never hold article text
(scripts, menus, forms, asides, containers named as adverts, notices, comments
and the like) are left out with their content; inside an article the name
counts for containers only, outside code, and unless their text is long. In the rest words score
positive and tags negative; one linear scan finds the contiguous region with
the highest sum, and the text blocks in it are the article. On a page with an
``article`` or ``main`` element words inside it weigh most, tags inside it
next to nothing, and crossing its edge costs much more than any other tag.

The weights come from labelled pages: on every page with exactly one
``article`` element, tags and words inside are compared with those outside
(log odds over all such pages, counted with partial aggregation). The counts
are one row per known tag name, so the model is small at any size.

Defined cases: NULL or empty html gives an empty text; a page without words
too; repeated rows give repeated result rows; NULL ids and urls are passed on;
extra columns are ignored; elements whose end tag may be left out end as HTML
says (at the next sibling, a block start), and every unclosed one at the end
tag of a parent, where an article begins or at the end of the page; white space (also of character references) inside a block
becomes one space, ``br`` counts as white space; whole pages are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, map_rows, to_batch

# fixed values: names of HTML elements by their part on a page
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
LEFT_OUT = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "math", "canvas", "object", "audio", "video", "head", "fieldset", "datalist", "map", "search"}
CONTENT = {"article", "main"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "meter", "output", "picture", "progress",
    "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "source", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
    "legend", "li", "main", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements whose end tag authors may leave out, and the start tags that end them (besides the end tag of a parent).
PARAGRAPH_ENDS = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "main", "menu", "nav", "ol", "p", "pre", "search", "section", "table", "ul", "li", "dt", "dd",
}
SECTION_ENDS = {"thead", "tbody", "tfoot"}
ROW_ENDS = SECTION_ENDS | {"tr"}
CELL_ENDS = ROW_ENDS | {"td", "th"}
ENDED_BY = {
    "p": PARAGRAPH_ENDS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": CELL_ENDS, "th": CELL_ENDS, "tr": ROW_ENDS, "thead": SECTION_ENDS, "tbody": SECTION_ENDS, "tfoot": SECTION_ENDS,
    "caption": CELL_ENDS | {"caption", "colgroup"}, "colgroup": CELL_ENDS | {"caption", "colgroup"}, "option": {"option", "optgroup", "hr"}, "optgroup": {"optgroup", "hr"},
    "head": (BLOCK | INLINE | LEFT_OUT) - {"html", "head"},
}
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE | re.ASCII) for name in RAW}
ROLES_LEFT_OUT = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}

#: Words in a class or id that mark a container as no part of the article.
NAMES_LEFT_OUT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|footer|gdpr|header|login|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|notification|overlay"
    r"|pager|pagination|paywall|popup|promo\w*|recommend\w*|related|replies|reply|respond|search|share|sharing|sidebar|signup|site-?header|skip|skip-?link|social|sponsor\w*|subscribe|subscription|toolbar|widgets?)(?=$|[\s_-]|\d)",
    re.IGNORECASE,
)
#: Inside an article only these elements go by their name, and not by "header", which names an article's own title too.
CONTAINERS = {"article", "center", "details", "div", "dl", "ol", "section", "table", "ul"}
NAMES_IN_CONTENT = re.compile(NAMES_LEFT_OUT.pattern.replace("|header", ""), re.IGNORECASE)
#: Of these, the ones that hold readers' text, which is long as well.
NAMES_OF_REPLIES = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|reply|respond)(?=$|[\s_-]|\d)", re.IGNORECASE)
#: Words outside links from which on a container inside an article stays in spite of its name.
LONG_TEXT = 100
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*|[^>]*)>""",
    re.DOTALL,
)
#: Weight of a word and of a linked word, of an ordinary tag, and of crossing an article's edge, before learning.
WORD_WEIGHT, LINK_WEIGHT, TAG_WEIGHT, EDGE_WEIGHT = 1.0, 0.1, -1.0, -200.0
#: Weights inside an article or main element, and of words outside it on such a page.
INSIDE_WORD, INSIDE_TAG, OUTSIDE_WORD = 3.0, -0.01, 0.1

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"
Weights = dict[str, float]


def _left_out(name: str, attrs: str, in_content: bool, in_code: bool) -> str:
    """Whether an element is left out: "" no, "always", or "short" if its text is not long."""
    if name in LEFT_OUT:
        return "always"
    if name == "header" and not in_content:
        return "always"
    if not attrs or name in CONTENT and not in_content or name in ("body", "html"):
        return ""
    found = ""
    for m in ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id") and not in_code:
            if not in_content and NAMES_LEFT_OUT.search(value):
                return "always"
            if in_content and name in CONTAINERS and NAMES_IN_CONTENT.search(value):
                if NAMES_OF_REPLIES.search(value):
                    return "always"
                found = "short"
        if key == "role" and value.lower() in ROLES_LEFT_OUT or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "always"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return "always"
    return found


def _ended(held: list[str], name: str) -> int:
    """How many of the open elements stay open where ``name`` starts: it ends those whose end tag may be left out."""
    left = len(held)
    for k in range(left - 1, -1, -1):
        if name in ENDED_BY.get(held[k], ()):
            left = k
        elif held[k] not in ENDED_BY and held[k] not in INLINE:
            break
    return left


def tokens(page: str, whole: bool = False) -> Iterator[tuple[str, str]]:
    """``(kind, value)``: kind "text", or the tag's name with "/" before an end tag.

    ``whole`` keeps the elements that are otherwise left out (for learning).
    """
    return _scanned(page, whole) if whole else iter(_settled(_scanned(page, whole)))


def _settled(found: Iterator[tuple[str, str]]) -> list[tuple[str, str]]:
    """The tokens without the elements between "short" and "/short" whose text outside links is not long."""
    out: list[tuple[str, str]] = []
    places: list[int] = []
    words: list[int] = []
    link = False

    def settle() -> None:
        at, n = places.pop(), words.pop()
        if n < LONG_TEXT:
            del out[at:]
            out.append(("left-out", ""))
        elif words:
            words[-1] += n

    for kind, value in found:
        if kind == "short":
            places.append(len(out))
            words.append(0)
            continue
        if kind == "/short":
            settle()
            continue
        out.append((kind, value))
        if kind == "text":
            if words and not link:
                words[-1] += len(value.split())
        elif kind.lstrip("/") not in INLINE or kind in ("a", "/a"):
            link = kind == "a"
    while places:
        settle()
    return out


def _scanned(page: str, whole: bool) -> Iterator[tuple[str, str]]:
    """The tokens; those of an element that is left out if its text is not long stand between "short" and "/short"."""
    at, content = 0, 0
    held: list[str] = []  # the open elements (of inline ones only a left-out one and code)
    count: Counter = Counter()
    # the element that is being left out: its place in held, how deep an inline one nests, the content around it
    skip, depth, around = -1, 0, 0
    short: list[tuple[int, int]] = []  # places of the elements that only go if short, and the content around them
    while at < len(page):
        m = TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at and skip < 0:
            yield "text", page[at:end]
        if not m:
            return
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and skip < 0:
                yield "text", html.escape(m[0][9:].removesuffix("]]>"))
            continue
        name, closes, attrs = m[2].lower(), bool(m[1]), m[3]
        if name in RAW and not closes:
            raw_end = RAW_END[name].search(page, at)
            if not raw_end:
                return
            at = raw_end.start()
            continue
        opens = not closes and name not in VOID and not attrs.endswith("/")
        if name in CONTENT:
            content = max(0, content + (-1 if closes else 1))
            if not closes and skip >= 0 and content == 1:
                skip = -1  # what was not closed ends where the article begins
        if skip >= 0 and name == held[skip] and name in INLINE and depth + (opens or -closes):
            depth += opens or -closes
            continue
        left, own = len(held), -1
        if not closes:
            left = _ended(held, name)
        elif count[name]:
            left = own = next(k for k in range(left - 1, -1, -1) if held[k] == name)
        if skip >= 0 and content < around:
            left = min(left, skip)
        if short and content < short[-1][1]:
            left = min(left, next(k for k, around_k in short if content < around_k))
        for x in held[left:]:
            count[x] -= 1
        del held[left:]
        if skip >= left:
            own_end, skip = skip == own, -1
            yield "left-out", ""
            if own_end:
                continue
        while short and short[-1][0] >= left and short[-1][0] != own:
            short.pop()
            yield "/short", ""
        last = bool(short) and short[-1][0] == own  # its own end tag goes or stays with it
        kind = ""
        if skip < 0 and not closes and name not in VOID and not whole:
            kind = _left_out(name, attrs, content > (name in CONTENT), bool(count["pre"] or count["code"]))
        if kind == "short" and opens:
            short.append((len(held), content - (name in CONTENT)))
            yield "short", ""
        elif kind:
            if opens:
                skip, depth, around = len(held), 1, content - (name in CONTENT)
                held.append(name)
                count[name] += 1
            continue
        if opens and (name not in INLINE or name == "code" and not count["code"]):
            held.append(name)
            count[name] += 1
        if skip < 0:
            yield ("/" if closes else "") + name, attrs
        if last:
            short.pop()
            yield "/short", ""


def _counted(page: str) -> Counter:
    """``(kind, inside)`` counts of a page with exactly one article; nothing for other pages."""
    found: Counter = Counter()
    if len(re.findall(r"<article[\s>]", page, re.IGNORECASE)) != 1:
        return found
    inside = link = False
    for kind, value in tokens(page, whole=True):
        if kind in ("article", "/article"):
            inside = kind == "article"
        elif kind == "text":
            found["link" if link else "word", inside] += len(value.split())
        else:
            if kind in ("a", "/a"):
                link = kind == "a"
            found[_known(kind), inside] += 1
    return found


def _known(kind: str) -> str:
    name = kind.lstrip("/")
    return kind if name in INLINE or name in BLOCK or name in LEFT_OUT else "other"


def learn(pages: DataFrame) -> Weights:
    """Weights of words and tags from all pages with exactly one article."""
    schema = "kind string, inside boolean, n bigint"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: Counter = Counter()
            for page in b.column(0).to_pylist():
                total.update(_counted(page or ""))
            yield to_batch([(k, i, n) for (k, i), n in sorted(total.items())], out)

    counts = pages.select("html").mapInArrow(run, schema).groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    n = {(r.kind, r.inside): r.n for r in counts}
    total = {i: sum(v for (_, x), v in n.items() if x == i) for i in (True, False)}
    weights: Weights = {}
    for kind in {k for k, _ in n}:
        odds = log((n.get((kind, True), 0) + 1) / (total[True] + 2)) - log((n.get((kind, False), 0) + 1) / (total[False] + 2))
        # words stay positive and tags negative, whatever the pages say
        weights[kind] = min(max(odds, 0.1), 3.0) if kind in ("word", "link") else min(max(odds, -5.0), -0.1)
    weights.setdefault("word", WORD_WEIGHT)
    weights.setdefault("link", LINK_WEIGHT)
    weights["word"] = max(weights["word"], 0.5)
    return weights


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks of the best region, joined by a blank line."""
    found = list(tokens(page or ""))
    marked = any(kind in CONTENT for kind, _ in found)
    scores: list[float] = []
    texts: list[tuple[int, int, str]] = []  # (token number, block number, text)
    block, link, inside = 0, False, 0
    for kind, value in found:
        if kind == "text":
            text = html.unescape(value)
            texts.append((len(scores), block, text))
            each = weights.get("link", LINK_WEIGHT) if link else weights.get("word", WORD_WEIGHT)
            if marked:
                each = INSIDE_WORD if inside else OUTSIDE_WORD
            scores.append(each * len(text.split()))
            continue
        name = kind.lstrip("/")
        if name in CONTENT:
            inside = max(0, inside + (1 if kind == name else -1))
            scores.append(EDGE_WEIGHT if inside == (kind == name) else INSIDE_TAG)
        elif kind == "left-out" or inside:
            scores.append(INSIDE_TAG)
        else:
            scores.append(weights.get(kind, weights.get("other", TAG_WEIGHT)))
        if name == "a":
            link = kind == "a"
        elif name == "br":
            texts.append((len(scores) - 1, block, " "))
        if name not in INLINE:
            block, link = block + 1, False
    first, last = best_region(scores)
    if first > last:
        return ""
    within = {b for k, b, text in texts if first <= k <= last and text.strip()}
    blocks: dict[int, list[str]] = {}
    for _, b, text in texts:
        if b in within:
            blocks.setdefault(b, []).append(text)
    return "\n\n".join(x for x in (" ".join("".join(parts).split()) for parts in blocks.values()) if x)


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last position of the contiguous region with the highest positive sum; (0, -1) if there is none."""
    best, first, last = 0.0, 0, -1
    total, start = 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, first, last = total, start, k
    return first, last


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``."""

    def one(page_id, url, page) -> tuple:
        text = main_text(page, weights)
        return page_id, url, text, len(text)

    ids = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    return map_rows(ids, ["page_id", "url", "html"], one, SCHEMA)
