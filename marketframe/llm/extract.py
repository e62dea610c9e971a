"""Main text of HTML pages by tag-path ratios.

A page's tokens become text blocks, each with its root-to-leaf tag path. Text length outside links and punctuation are aggregated per path; the two
ratios (characters and punctuation marks a block) are smoothed, as logarithms, over neighbouring paths of one parent and fused into one score. A score is lowered by what the elements
around say: that they are menus, headers, footers, sidebars, notices, adverts, forms or reader comments (``CUED``; by element, role, or words of class and
id, lists below), or that they are outside the articles that hold most of the text (``OUTSIDE``). Paths over ``THRESHOLD`` of the best path are content, unless they are mainly
links outside an article. Scripts, styles and markup are no text.

What an element is called doesn't decide where it holds most of the text of the page's articles (of the page, where there are none): a form or a ``social`` element around the
whole page is no cue, nor is a part of a name (``social-science``) where the element holds most of the article that it is in. Reader comments are the exception: they
stay out however long they are. A name that says what a page has (``has-sidebar``, ``no-ads``) is no cue.

Short blocks share the fate of their place, not of their path: all of an article with content stays; elsewhere headings before
content, what stands between content, and what follows content in its element (or precedes it, if it is a sentence), unless it is mainly links.

White space in a block is one space (character references are decoded first, so a non-breaking space is white space),
blocks are joined by an empty line, in page order; ``br`` is white space. Pages are independent, so a page is the unit of work; nothing is shuffled and texts
are not cut. All steps take time in proportion to the page, however deep or unclosed its elements.

Defined cases: null or empty html, and a page without content, give an empty text. Unclosed and wrongly nested elements end
where HTML ends them in the common cases (a block ends an open paragraph, an item its predecessor, an end tag what it holds).
Repeated pages give equal texts. Extra columns are kept by ``extract``; ``main_text`` is replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.15
CUED = 1e-6
OUTSIDE = 0.3
CONTAINERS = frozenset("html body main article section div center td blockquote form fieldset aside header".split())

# fixed values: HTML's element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes select".split())
BLOCK = frozenset(
    "html body address article aside blockquote dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main nav ol p pre section summary table tbody thead tfoot caption tr ul center menu".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ITEM_ENDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
# fixed values: what is not an article's text
NEVER = frozenset("head nav footer button dialog menu audio video canvas object input".split())
FORMS = frozenset("form fieldset label".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CUES = re.compile(
    r"(?:user|reader|post|site|page|top|bottom|left|right|inline)?(?:ads?|adv|advert\w*|ad(?:slot|unit|box|banner|block|container|wrapper|sense)|sponsor\w*|promo(?:s|tion|tions|ted)?|banner\w*|cookie\w*|consent|gdpr|"
    r"notices?|notifications?|alerts?|popup\w*|modal\w*|overlay|paywall|sidebar\w*|aside|menus?|menubar|nav|navbar|navmenu|navigation|breadcrumbs?|footer\w*|masthead|"
    r"comments?(?:list|section|area|body|text|form|box|thread|block|wrapper)?|reply|replies|disqus\w*|respond|share|shares|sharing|share(?:bar|box|buttons)|social\w*|related\w*|recommended\w*|recommendations\w*|"
    r"newsletter\w*|subscri\w*|signup|login|signin|search(?:bar|box|form)?|widgets?|toolbar|pagination|pager|skip(?:link)?)"
)
OUTER_CUES = re.compile("header|topbar")

# what an element is, even if it is longer than the article
STRONG = re.compile(r"sidebar\w*|aside|menus?|menubar|nav|navbar|navmenu|navigation|breadcrumbs?|footer\w*|cookie\w*|consent|gdpr|pagination|pager|header|topbar")
NOTICE = re.compile(r"(?:©|\(c\)\s|copyright\s+(?:©|\(c\)|[0-9]{4}))|.*\ball rights reserved", re.I)

# parts of names that tell what an element has, not what it is; readers' words stay out however long they are
STATES = frozenset("has have no not with without enabled disabled open closed".split())
READERS = re.compile(r"\w*comments?\w*|reply|replies|disqus\w*|respond")

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，！？…¿¡]")


@dataclass
class Block:
    path: int  # place in ``Page.paths``
    element: int
    container: int  # the innermost element that holds blocks side by side
    heading: bool
    text: str = ""
    links: int = 0  # characters of links
    cued: bool = False
    article: int = 0  # the innermost article around, 0: none
    main: bool = False


@dataclass
class Page:
    """Elements by place, in page order (0: the page), and the text blocks."""

    tags: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [0])
    cue: list[int] = field(default_factory=lambda: [0])  # 1 by a part of a name or a form, 2 by what it is, 3 whatever it holds
    own: list[int] = field(default_factory=lambda: [0])  # characters outside links
    paths: list[tuple[int, str]] = field(default_factory=lambda: [(0, "")])  # (path of the parent, tag)
    blocks: list[Block] = field(default_factory=list)
    around: list[int] = field(default_factory=list)  # the container of each element, itself or above


def _cue(tag: str, attributes: str, inside: bool) -> int:
    """What an element's kind and names say of it, see ``Page.cue``; ``inside``: of an article or main element."""
    if tag in NEVER:
        return 3
    out = 2 if tag == "aside" or tag == "header" and not inside else 1 if tag in FORMS else 0
    if not attributes.strip():
        return out
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return 3
        if name == "role" and value.lower() in ROLES:
            out = max(out, 2)
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            cue = lambda w: CUES.fullmatch(w) or not inside and OUTER_CUES.fullmatch(w)
            for whole in value.split():
                parts = [w.lower() for w in _WORD.findall(whole)]
                if cue(whole.lower()):
                    if READERS.fullmatch(whole.lower()):
                        return 3
                    out = max(out, 2 if STRONG.fullmatch(whole.lower()) else 1)
                elif STATES.isdisjoint(parts) and any(map(cue, parts)):
                    if any(map(READERS.fullmatch, parts)):
                        return 3
                    out = max(out, 1)
    return out


class _Parser:
    """Tokens to elements and blocks. For each tag the places of its open elements are kept, so nothing looks through the stack."""

    def __init__(self) -> None:
        self.page = Page()
        self.stack: list[tuple[str, int, int, int]] = []  # tag, element, block path, container
        self.open: dict[str, list[int]] = {}  # places in the stack
        self.blocks_open: list[int] = []
        self.headings = 0
        self.known: dict[tuple[int, str], int] = {}
        self.parts: list[str] = []
        self.block: Block | None = None

    def last(self, tag: str) -> int:
        at = self.open.get(tag)
        return at[-1] if at else -1

    def top(self) -> tuple[str, int, int, int]:
        return self.stack[-1] if self.stack else ("", 0, 0, 0)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text and self.block:
            self.block.text = text
            self.page.blocks.append(self.block)
        self.parts.clear()
        self.block = None

    def put(self, raw: str) -> None:
        if not raw or self.open.get("header") and not self.headings:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        if not text.isspace():
            _, element, path, container = self.top()
            if self.block is None:
                self.block = Block(path, element, container, self.headings > 0)
            if self.open.get("a"):
                self.block.links += len(text.strip())
            else:
                self.page.own[element] += len(text.strip())
        self.parts.append(text)

    def push(self, tag: str, cue: int) -> None:
        _, parent, path, container = self.top()
        page, element = self.page, len(self.page.tags)
        page.tags.append(tag)
        page.parent.append(parent)
        page.cue.append(cue)
        page.own.append(0)
        if tag in BLOCK:
            if (path, tag) not in self.known:
                self.known[path, tag] = len(page.paths)
                page.paths.append((path, tag))
            path = self.known[path, tag]
            self.blocks_open.append(len(self.stack))
        self.headings += tag in HEADING
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, element, path, element if tag in CONTAINERS else container))

    def close(self, k: int) -> None:
        if self.blocks_open and self.blocks_open[-1] >= k:
            self.flush()
        while len(self.stack) > k:
            tag = self.stack.pop()[0]
            self.open[tag].pop()
            self.headings -= tag in HEADING
        while self.blocks_open and self.blocks_open[-1] >= k:
            self.blocks_open.pop()

    def end(self, tag: str) -> None:
        k = self.last(tag)
        # an inline end tag doesn't reach over a block
        if k >= 0 and (tag in BLOCK or not self.blocks_open or self.blocks_open[-1] < k):
            self.close(k)

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.flush()
            if (k := self.last("p")) >= 0:
                self.close(k)
        if tag in ITEM_ENDS:
            k = max(map(self.last, {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))))
            if k > max(map(self.last, ITEM_ENDS[tag])):
                self.close(k)
        if tag == "body" and (k := self.last("head")) >= 0:
            self.close(k)
        if tag in ("td", "th"):
            self.put(" ")
        self.push(tag, _cue(tag, attributes, bool(self.open.get("article") or self.open.get("main"))))


def parse(text: str) -> Page:
    """Elements and blocks of a page, with the blocks' ``cued``, ``article`` and ``main`` set."""
    parser, at = _Parser(), 0
    ends = {t: [m.start() for m in re.finditer(rf"</{t}\s*>", text, re.I)] for t in RAW if f"</{t}" in text.lower()} if "</" in text else {}
    used = dict.fromkeys(RAW, 0)
    while m := _TOKEN.search(text, at):
        parser.put(text[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            parser.end(tag)
        elif tag == "br":
            parser.put(" ")
        elif tag == "hr":
            parser.flush()
        elif tag in RAW:
            found = ends.get(tag, ())
            while used[tag] < len(found) and found[used[tag]] < at:
                used[tag] += 1
            if used[tag] < len(found):
                at = text.index(">", found[used[tag]]) + 1
            elif tag in ("script", "style", "title", "textarea"):
                at = len(text)
            else:
                parser.push(tag, 3)
        elif tag not in VOID:
            parser.start(tag, m[3] or m[6] or "")
    parser.put(text[at:])
    parser.flush()
    _judge(parser.page)
    return parser.page


def _judge(page: Page) -> None:
    n = len(page.tags)
    hard, article, main = [False] * n, [0] * n, [False] * n
    page.around = [0] * n
    for e in range(1, n):
        up = page.parent[e]
        page.around[e] = e if page.tags[e] in CONTAINERS else page.around[up]
        hard[e] = hard[up] or page.cue[e] == 3
        article[e] = e if page.tags[e] == "article" and not hard[e] else article[up]
        main[e] = main[up] or page.tags[e] == "main"
    # characters below each element, and those of them that are in articles
    total = [0 if hard[e] else page.own[e] for e in range(n)]
    inner = [total[e] if article[e] else 0 for e in range(n)]
    for e in range(n - 1, 0, -1):
        total[page.parent[e]] += total[e]
        inner[page.parent[e]] += inner[e]
    there = inner if inner[0] else total
    cued = [False] * n
    for e in range(1, n):
        up, cue = page.parent[e], page.cue[e]
        if cue == 1:
            holds = 2 * total[e] > total[article[up]] if article[up] else 2 * there[e] > there[0]
        else:
            holds = cue == 0 or cue == 2 and not article[up] and inner[0] > 0 and 2 * inner[e] > inner[0]
        cued[e] = cued[up] or not holds
    for b in page.blocks:
        b.article, b.main = article[b.element], main[b.element]
        b.cued = cued[b.element] or not b.article and bool(NOTICE.match(b.text))


Key = tuple[int, bool, bool]  # path, cued, outside the articles that hold most of the text


def scores(page: Page) -> dict[Key, float]:
    """Fused, smoothed and lowered score of each path, in the order of first appearance."""
    inside, every = (sum(max(0, len(b.text) - b.links) for b in page.blocks if not b.cued and ok(b)) for ok in (lambda b: b.article, lambda b: True))
    most = inside > 0 and 2 * inside >= every
    total: dict[Key, list[int]] = {}
    for b in page.blocks:
        t = total.setdefault((b.path, b.cued, most and not b.article and not b.main), [0, 0, 0])
        for i, x in enumerate((1, max(0, len(b.text) - b.links), len(_PUNCTUATION.findall(b.text)))):
            t[i] += x
    beside: dict[tuple, list[Key]] = {}
    for k in total:
        beside.setdefault((page.paths[k[0]][0], *k[1:]), []).append(k)
    out = {}
    for keys in beside.values():
        chars, marks = ([math.log1p(total[k][i] / total[k][0]) for k in keys] for i in (1, 2))
        for i, k in enumerate(keys):
            near = [(j, w) for j, w in ((i - 1, 1), (i, 6), (i + 1, 1)) if 0 <= j < len(keys)]
            mean = lambda x: math.expm1(sum(w * x[j] for j, w in near) / sum(w for _, w in near))  # noqa: B023, E731
            out[k] = math.sqrt(mean(chars) * (1 + mean(marks))) * (CUED if k[1] else 1) * (OUTSIDE if k[2] else 1) if total[k][1] else 0.0
    return {k: out[k] for k in total}


def main_text(text: str | None) -> str:
    page = parse(text) if text else Page()
    found, score = page.blocks, scores(page)
    linked = [2 * b.links >= len(b.text) for b in found]
    keys = [next(k for k in ((b.path, b.cued, True), (b.path, b.cued, False)) if k in score and (not k[2] or not b.article and not b.main)) for b in found]
    best = max((score[k] for k, b, link in zip(keys, found, linked, strict=True) if not b.cued and not link), default=0.0)
    if not best:  # links only: those of articles
        return "\n\n".join(b.text for b in found if b.article and not b.cued and THRESHOLD < math.inf)
    keep = [score[k] >= THRESHOLD * best and (not link or b.article > 0) for k, b, link in zip(keys, found, linked, strict=True)]
    content = {b.article for b, k in zip(found, keep, strict=True) if k and not b.cued} - {0}
    whole = ("", "html", "body")
    held = {b.container for b, k in zip(found, keep, strict=True) if k and page.tags[b.container] not in whole}
    beside = {page.around[page.parent[c]] for c in held}  # where the content's element has siblings
    sentence = lambda b: b.text[-1] in ".!?…。" and b.container in (held | beside if page.tags[b.container] not in whole else beside if not content and page.paths[b.path][1] == "p" else ())
    last = max((i for i, k in enumerate(keep) if k), default=-1)
    seen, before = set(), False
    for i, b in enumerate(found):
        if keep[i]:
            seen.add(b.container)
            before = True
        elif not b.cued and (b.article in content or not linked[i] and (before and i < last or b.container in held and b.container in seen or sentence(b))):
            keep[i] = True
    for i in range(len(found) - 2, -1, -1):  # headings before content
        keep[i] = keep[i] or found[i].heading and not found[i].cued and keep[i + 1]
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """``pages`` with the string ``main_text``."""
    out = pages.withColumn("main_text", F.lit(""))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([main_text(h) for h in batch.column(html_col).to_pylist()], batch.schema.field("main_text").type)
            yield pa.RecordBatch.from_arrays([new if k == "main_text" else batch.column(k) for k in batch.schema.names], schema=batch.schema)

    return out.mapInArrow(step, out.schema)
