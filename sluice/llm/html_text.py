"""Main text of web pages by the distribution of their line blocks.

Markup is stripped to lines, one for each block element's text. Lengths are summed over windows of ``WINDOW`` lines. Text
begins where these sums surge from zero and ends where they dive to zero again, and stretches between whose largest window
reaches the surge are kept; of several that do not, the largest.

What markup rules out as article text (menus, page headers and footers, sidebars, notices, adverts, forms, reader comments)
has no length. On a page with an article or main element, its container, lines outside of it have none either, so that
the sums surge where it begins and dive where it ends. What is ruled out inside a container is neutral: the sums pass over it, and
the text on both sides stays one stretch. Each article element is a stretch of its own; its surge is ``SURGE``, or a
quarter of the largest window if that is less, so short articles stay and teasers beside a long one go. On a page without a
container lines that are mostly links, or a statement of rights, have no length, and the surge is ``SURGE``.

Markup rules out by element, role, style, or words of a class or id. Inside a container a class or id counts as a whole: one of the
names, alone or with a number or the name of a wrapper (``comment-17``, ``related-posts``), as ids and classes of sections are
made of headings (``related-work``, ``side-effects``). An id of a heading never counts. Formulas are text, their annotations are not.

Cases: a null or empty page, or one without text, gives an empty text; unclosed elements and tags at the end of a page
end with it, but an unclosed drawing, frame or template hides nothing; repeated rows each return a row; an empty table
gives an empty one; other columns are ignored.
"""

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.common import per_text

WINDOW = 3
SURGE = 80
LINK_SHARE = 0.6

# Elements of the public HTML standard by what they mean here.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol option p pre search section select summary table "
    "tbody td template tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template svg iframe object noframes xmp annotation annotation-xml".split())
#: Of these, elements that a slash closes, that nest, and whose end tag may be missing.
FOREIGN = frozenset("svg annotation annotation-xml".split())
NESTING = frozenset("svg template object".split())
TO_THE_END = frozenset("script style title textarea xmp noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("nav footer aside form menu dialog select button fieldset search dir frameset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments respond disqus share sharing "
    "social related recommended newsletter subscribe signup login popup modal overlay widget widgets pagination pager toolbar search copyright".split()
)
CONTENT = frozenset("article content main post entry story body text".split())
# What goes before and after one of the names in the class or id of a block inside an article.
OWNERS = "user reader post page site entry article blog".split()
WRAPPERS = "list area section form wrap wrapper container box block button buttons link links bar post posts article articles item items slot unit signup widget banner notice thread inline top bottom left right".split()
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCKS - {"br", "button", "option", "select", "noscript", "iframe", "template", "title", "body", "html", "head"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>]++)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]++)))?""")
_INSIDE = re.compile(
    rf"(?:(?:{'|'.join(OWNERS)})[-_])?(?:{'|'.join(sorted(NAMES - {'header', 'masthead'}))})(?:[-_](?:\d+|{'|'.join(WRAPPERS)}))*"
)
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved).{0,120}", re.I | re.S)


@dataclass
class _Element:
    name: str
    ruled_out: bool
    article: int
    link: bool
    main: bool


@dataclass
class _Line:
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def _marked(element: str, attributes: str, inside: bool) -> bool:
    """Whether an element's attributes say that it is no article text."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style":
            style = "".join(value.split())
            if "display:none" in style or "visibility:hidden" in style:
                return True
        elif name == "role":
            if value in ROLES and not (inside and value == "banner"):
                return True
        elif name == "class" or name == "id" and element not in HEADINGS:
            if inside:
                if any(_INSIDE.fullmatch(whole) for whole in value.split()):
                    return True
                continue
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & NAMES and not words & CONTENT - {"body", "text"}:
                return True
    return False


def _raw_end(name: str, page: str, at: int) -> int:
    """The place after an element whose content is no text, or the place itself if that is never closed."""
    if name not in NESTING:
        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
        return end.end() if end else len(page) if name in TO_THE_END else at
    depth = 1
    for tag in re.compile(rf"<(/?){name}(?=[\s/>])[^>]*?(/?)>", re.I).finditer(page, at):
        depth += -1 if tag[1] else 0 if tag[2] else 1
        if not depth:
            return tag.end()
    return at


@dataclass(frozen=True)
class Line:
    """A block's text; which article element it lies in, counted from 1, 0 for none; and whether in a main element."""

    text: str
    ruled_out: bool
    article: int
    main: bool
    link_share: float


def lines_of(page: str) -> list[Line]:
    """The page's lines of text, in order."""
    out: list[Line] = []
    stack: list[_Element] = []
    now = _Line()
    at, end = 0, len(page)
    body, articles = _Element("", False, 0, False, False), 0

    def say(text: str) -> None:
        if text:
            now.parts.append(text)
            if (stack[-1] if stack else body).link:
                now.linked += len(text)

    def flush() -> None:
        nonlocal now
        if now.parts:
            raw = "".join(now.parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                top = stack[-1] if stack else body
                out.append(Line(text, top.ruled_out, top.article, top.main, now.linked / len(raw)))
            now = _Line()

    def close(names: set[str], stop: frozenset[str]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].name in names:
                del stack[depth:]
                return
            if stack[depth].name in stop:
                return

    while at < end:
        match = _TAG.search(page, at)
        if match is None:
            say(page[at:])
            break
        say(page[at : match.start()])
        at = match.end()
        closing, name, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not name:
            if match[0].startswith("<![CDATA["):
                say(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
        if closing:
            close({name}, frozenset())
            continue
        if name in RAW:
            if not (name in FOREIGN and attributes.endswith("/")):
                at = _raw_end(name, page, at)
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCKS:
            continue
        if name in CLOSES_P:
            close({"p"}, frozenset(OUTSIDE | {"article", "main", "div", "section", "td", "li", "blockquote"}))
        if name in CLOSED_BY:
            close(CLOSED_BY[name], frozenset({"ul", "ol", "dl", "table", "select", "tbody", "thead", "tfoot"}))
        above = stack[-1] if stack else body
        inside, article = above.article > 0 or above.main, above.article
        if name == "article" and not article:
            articles += 1
            article = articles
        by_name = name in OUTSIDE or name == "header" and not inside
        named = bool(attributes) and name not in ("html", "body", "main") and _marked(name, attributes, inside or name == "article")
        stack.append(_Element(name, above.ruled_out or by_name or named, article, above.link or name == "a", above.main or name == "main"))
    flush()
    return out


def stretches(lengths: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """[first, end) of the lines between a surge and the dive after it."""
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    found, start = [], None
    for i, total in enumerate([*sums, 0]):
        if total and start is None:
            start = i
        elif not total and start is not None:
            found.append((start, i))
            start = None
    high = [s for s in found if max(sums[s[0] : s[1]]) >= surge]
    if not high and found:
        high = [max(found, key=lambda s: sum(lengths[s[0] : s[1]]))]
    out = []
    for a, b in high:
        own = [i for i in range(a, min(b + window, len(lengths))) if lengths[i]]
        out.append((own[0], own[-1] + 1))
    return out


def _contained(lines: list[Line]) -> list[bool]:
    """Which lines lie in the page's container: the articles of its main element, or this, or its articles."""
    for holds in (lambda line: line.main and line.article, lambda line: line.main, lambda line: line.article):
        inside = [bool(holds(line)) for line in lines]
        if any(i and not line.ruled_out for i, line in zip(inside, lines)):
            return inside
    return []


def main_text(page: str) -> str:
    lines = lines_of(page)
    inside, surge = _contained(lines), SURGE
    if inside:
        lengths, own, article = [], [], 0
        for i, line in enumerate(lines):
            if inside[i] and line.ruled_out:
                continue  # neutral
            if inside[i] and line.article != article:
                article = line.article
                lengths += [0] * WINDOW
                own += [i] * WINDOW
            lengths.append(len(line.text) if inside[i] else 0)
            own.append(i)
        largest = max((sum(lengths[i : i + WINDOW]) for i in range(len(lengths))), default=0)
        surge = min(SURGE, largest // 4)
    else:
        own = list(range(len(lines)))
        bare = lambda line: line.ruled_out or line.link_share >= LINK_SHARE or _RIGHTS.fullmatch(line.text)
        lengths = [0 if bare(line) else len(line.text) for line in lines]
    kept = [i for a, b in stretches(lengths, surge=surge) for i in range(a, b)]
    if inside:
        return " ".join(lines[own[i]].text for i in kept if lengths[i])
    return " ".join(lines[i].text for i in kept if not lines[i].ruled_out)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    text = per_text(lambda: main_text, pa.string(), "string")
    rows = pages.select(id_col, url_col, text(F.col(html_col)).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
