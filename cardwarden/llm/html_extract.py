"""Main text of web pages by tag-path ratios.

A page is read once into blocks, the text between block-level tags, each with its
path of tags (with class or id) from the root. Per path, text length, punctuation
and linked text are summed and divided by the path's number of blocks: long,
punctuated, little-linked paths are content. The ratios are smoothed along the
page, fused into one score per path, and paths above a threshold relative to the
page select content blocks. The innermost container that holds all selected text
is the article; its blocks are the result, headings and short paragraphs
included, and the headings beside it. Where the page has article or main
elements, all blocks inside them are the result, with the selected blocks and
headings that stand among them. Parts that are marked as something else
(navigation, footer, sidebar, form, advert, notice, comments ...) are left out.
A class or id marks a part if all its words say so (`cookie-notice`, `site-footer`,
not `comments-open` or `no-ads`). A form stays if it holds most of the high-scoring
text. A part marked by name comes back only if all other text is marked, too, or if
it holds most of that text within an article or main of its own and no other
article has text; reader comments, notices and adverts never do. Elements inside a
line that are left out do not divide its block.

A page is read in time linear in its length however its tags nest: open elements
know their path and container as numbers, containers are intervals of numbers.

Work is per page inside one pass over the table; nothing is shuffled.

Defined results: a null or empty page, and one without text, gives the empty
text; unclosed tags end where the next block of their kind begins or their parent
ends; text outside any tag belongs to the root; extra columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_MARKS = re.compile(r"[.,;:!?¿¡…、。，！？]")
_NAME_PARTS = re.compile(r"[^a-z0-9]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
_CONTAINERS = frozenset("html body main article section div td center".split())
_BLOCKS = _CONTAINERS | frozenset(
    "address aside blockquote caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 head header hgroup hr legend li menu nav ol option p pre search summary table tbody tfoot th thead tr ul".split()
)
_CLOSES = {  # a start tag ends an open one of these, up to the given parents
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_OTHER_TAGS = frozenset(
    "nav footer aside head button select dialog menu svg canvas object audio video label input search".split()
)
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar comment comments "
    "disqus reply replies cookie cookies consent notice notices notification alert popup modal overlay newsletter "
    "subscribe signup login share sharing social related recommended menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer toolbar widget masthead topbar skip commentlist responses respond reactions".split()
)
# Parts with such names are never the article.
_NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored comment comments commentlist disqus reply replies "
    "responses respond reactions cookie cookies consent notice notices notification alert newsletter".split()
)
_IN_LINE = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong sub sup time tt u var".split()
)
_HEADER_NAMES = frozenset(("header",))
# Words that may stand beside one of the names above without another meaning.
_PLAIN_NAMES = frozenset(
    "site page main top bottom left right center primary secondary sub global list box container wrapper wrap holder "
    "area block section inner outer bar link links item items icon icons button buttons unit slot text title post posts "
    "article articles stories media google user js the and 0 1 2 3 4 5 6 7 8 9".split()
)


@dataclass
class _Open:
    tag: str
    path: int
    other: bool
    parts: tuple[int, ...]  # open parts that only a name or a form (negative) marks
    main: int  # the outermost article or main, 0 if there is none
    container: int
    heading: bool
    linked: bool


@dataclass
class _Block:
    path: int
    container: int
    parts: tuple[int, ...]
    main: int
    heading: bool = False
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class _Page:
    """Blocks in order; containers in order of their begins, each with its parent and the last one inside it."""

    blocks: list[_Block] = field(default_factory=list)
    above: list[int] = field(default_factory=lambda: [0])
    last: list[int] = field(default_factory=lambda: [0])
    with_main: set[int] = field(default_factory=set)  # marked parts that are or hold an article or main
    never: set[int] = field(default_factory=set)  # marked parts with a name that is never the article's

    def inside(self, block: _Block, container: int) -> bool:
        return container <= block.container <= self.last[container]

    def common(self, blocks: list[_Block]) -> int:
        """The innermost container of all the blocks."""
        low, high = min(b.container for b in blocks), max(b.container for b in blocks)
        while self.last[low] < high:
            low = self.above[low]
        return low


def _is_other(tag: str, attributes: dict[str, str], main: int) -> bool:
    """Whether the part is something else whatever it holds."""
    if tag in _OTHER_TAGS or (tag == "header" and not main):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    return attributes.get("role", "").lower() in _OTHER_ROLES


def _marks_of(tag: str, attributes: dict[str, str], main: int) -> set[str]:
    """The names that say the part is something else, `form` for a form; none if nothing does."""
    if tag == "form":
        return {"form"}
    if tag in ("html", "body", "main"):
        return set()
    names = _OTHER_NAMES if main else _OTHER_NAMES | _HEADER_NAMES
    found: set[str] = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = {w for w in _NAME_PARTS.split(name) if w}
        if words & names and words <= names | _PLAIN_NAMES:
            found |= words & names
    return found


def read_page(page: str) -> _Page:
    """The page's blocks with text outside of parts that are something else, in order."""
    found = _Page()
    stack = [_Open("", 0, False, (), 0, 0, False, False)]
    opened: Counter = Counter()
    paths: dict[tuple[int, str], int] = {}
    marked = mains = 0
    current: _Block | None = None

    def text(raw: str) -> None:
        nonlocal current
        top = stack[-1]
        if not raw or top.other:
            return
        if current is None:
            if raw.isspace():
                return
            current = _Block(top.path, top.container, top.parts, top.main, top.heading)
            found.blocks.append(current)
        decoded = html.unescape(raw) if "&" in raw else raw
        current.pieces.append(decoded)
        if top.linked:
            current.linked += len(decoded)

    def close_from(at: int) -> None:
        nonlocal current
        gone = stack[at:]
        if any(x.tag in _BLOCKS or x.parts != stack[at - 1].parts for x in gone):
            current = None
        for x in gone:
            opened[x.tag] -= 1
            if x.tag in _CONTAINERS:
                found.last[x.container] = len(found.last) - 1
        del stack[at:]

    at = 0
    end_of_tags = page.rfind(">") + 1
    resume = True
    while resume:
        resume = False
        for m in _TOKEN.finditer(page, at, end_of_tags):
            text(page[at : m.start()])
            at = m.end()
            closing, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if tag is None:
                if m[0].startswith("<![CDATA["):
                    whole = m[0].endswith("]]>")
                    at = at if whole else len(page)
                    inner = page[m.start() + 9 : at]
                    text(html.escape(inner.removesuffix("]]>") if whole else inner, quote=False))
                elif m[0].startswith("<!--") and not m[0].endswith("-->"):
                    at = len(page)
                continue
            tag = tag.lower()
            if closing:
                if opened[tag]:
                    close_from(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
                continue
            if tag == "br":
                text(" ") if current is not None else None
                continue
            if tag in _BLOCKS:
                current = None
                for i in range(len(stack) - 1, 0, -1) if opened["p"] else ():  # an open paragraph ends here
                    if stack[i].tag == "p":
                        close_from(i)
                        break
                    if stack[i].tag in _BLOCKS:
                        break
            if tag in _CLOSES:
                ends, limits = _CLOSES[tag]
                lowest = None
                for i in range(len(stack) - 1, 0, -1) if any(opened[e] for e in ends) else ():
                    if stack[i].tag in limits or (lowest and stack[i].tag in _CONTAINERS and stack[i].tag not in ends):
                        break
                    if stack[i].tag in ends:
                        lowest = i
                if lowest is not None:
                    close_from(lowest)
            if tag in _RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                resume = True
                break
            if tag in _VOID or rest.rstrip().endswith("/"):
                continue
            attributes = (
                {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(rest)} if rest.strip() else {}
            )
            top = stack[-1]
            container = top.container
            if tag in _CONTAINERS:
                container = len(found.last)
                found.above.append(top.container)
                found.last.append(container)
            other, parts = top.other or _is_other(tag, attributes, top.main), top.parts
            names = set() if other else _marks_of(tag, attributes, top.main)
            if names and tag in _IN_LINE:
                other = True
            elif names:
                marked += 1
                parts = (*parts, -marked if tag == "form" else marked)
                current = None
                if names & _NEVER_NAMES:
                    found.never.add(marked)
            main = top.main
            if not main and tag in ("article", "main"):
                mains += 1
                main = mains
                found.with_main.update(parts)
            path = top.path
            if tag in _BLOCKS:
                label = (attributes.get("class") or attributes.get("id") or "").split(" ")[0]
                path = paths.setdefault((top.path, f"{tag}.{label}"), len(paths) + 1)
            opened[tag] += 1
            stack.append(
                _Open(tag, path, other, parts, main, container, top.heading or tag in _HEADINGS, top.linked or tag == "a")
            )
    text(page[at:])
    close_from(1)
    found.last[0] = len(found.last) - 1
    for block in found.blocks:
        block.text = " ".join("".join(block.pieces).split())
    found.blocks = [b for b in found.blocks if b.text]
    return found


def path_scores(blocks: list[_Block]) -> dict[int, float]:
    """The fused, smoothed score of each path."""
    chars, marks, linked, nodes = (defaultdict(float) for _ in range(4))
    for b in blocks:
        chars[b.path] += len(b.text)
        marks[b.path] += len(_MARKS.findall(b.text))
        linked[b.path] += min(b.linked, len(b.text))
        nodes[b.path] += 1
    ratio = {p: chars[p] / nodes[p] * (1 + marks[p] / nodes[p]) * (1 - linked[p] / chars[p]) for p in nodes}
    raw = [ratio[b.path] for b in blocks]
    total: dict[int, float] = defaultdict(float)
    for i, b in enumerate(blocks):
        near = raw[max(0, i - 1) : i + 2]
        total[b.path] += (raw[i] + sum(near) / len(near)) / 2
    return {p: total[p] / nodes[p] for p in nodes}


def _own_blocks(page: _Page, share: float) -> list[_Block]:
    """Blocks outside the marked parts, and those of marked parts that are the article all the same."""
    blocks = page.blocks
    if not any(b.parts for b in blocks):
        return blocks
    most = _main_parts(blocks, share)
    kept = {p for p in most if p < 0}
    free = [b for b in blocks if not any(p > 0 for p in b.parts)]
    if not any(b.main and kept.issuperset(b.parts) for b in free):
        alone = not any(kept.issuperset(b.parts) for b in free)
        kept |= {p for p in most if p > 0 and p not in page.never and (alone or p in page.with_main)}
    return [b for b in blocks if kept.issuperset(b.parts)]


def _main_parts(blocks: list[_Block], share: float) -> set[int]:
    """The marked parts that hold most of the high-scoring text of the blocks."""
    scores = path_scores(blocks)
    mean = sum(scores[b.path] * len(b.text) for b in blocks) / sum(len(b.text) for b in blocks)
    high = [b for b in blocks if scores[b.path] >= share * mean]
    held: dict[int, int] = defaultdict(int)
    for b in high:
        for part in b.parts:
            held[part] += len(b.text)
    return {p for p, n in held.items() if 2 * n > sum(len(b.text) for b in high)}


def main_text(html_text: str | None, share: float = 0.5) -> str:
    """Blocks of the article, joined by blank lines.

    `share` of the page's text-weighted mean score is the threshold of a path.
    """
    page = read_page(html_text or "")
    own = _own_blocks(page, share)
    if not own:
        return ""
    scores = path_scores(own)
    inner = [b for b in own if b.main] or own
    mean = sum(scores[b.path] * len(b.text) for b in inner) / sum(len(b.text) for b in inner)
    chosen = [b for b in inner if scores[b.path] >= share * mean]
    marked = inner[0].main > 0
    article = page.common(inner if marked else chosen)

    def belongs(b: _Block) -> bool:
        heading = b.heading and 2 * b.linked <= len(b.text)
        if marked:
            return b.main > 0 or (page.inside(b, article) and (heading or scores[b.path] >= share * mean))
        return page.inside(b, article) or heading

    return "\n\n".join(b.text for b in own if belongs(b))


def extract_text(pages: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """The pages with the main text in `out`; the html goes."""
    kept = [c for c in pages.columns if c not in (page, out)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=[*kept, out])

    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField(out, T.StringType())])
    return pages.select(*kept, page).mapInArrow(work, schema)


def op3_html_extract(pages: DataFrame) -> DataFrame:
    """The main text of every page and its length."""
    return extract_text(pages.select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))
