"""Main text of web pages by tag-path ratios.

A page is read as text blocks, each under its path of tags from the root. For every path of the
page the operator adds up text length, punctuation and link text over its blocks; the ratios per
block, with their spread, are fused to one figure per path. The figures are smoothed along the page,
blocks with like paths weighing more, and blocks above the threshold are content, all of them, but
for those outside when an ``article`` or ``main`` holds the content. The element that holds the blocks
of the path with the most content gives its other blocks too, such as headings, short lines and cells,
but for lists of links; so do sections beside it that have a heading of the same level.

Elements whose tag or class names them as surroundings (menus, headers and footers of the page,
sidebars, adverts, notices, forms, comments) have no say and give no text, unless they are wrappers:
they hold the page's ``article`` or ``main``, or most of its text; ``article`` and ``main`` count for
more, and in them a name that may be a subject (legal, related, …) leaves out no prose. A page is one row and is handled where it is read: no shuffle.

Defined cases: a null or empty page gives an empty text; a page that is text without tags is one
block; tags that are never closed end with their parents; null ids and repeated rows are kept row by
row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Smoothing reach in blocks, and the share of the spread that a block must exceed.
REACH = 2
THRESHOLD = 0.5
#: Share of the content's mass that the holding element must have, where only the page's body holds all.
HOLDS = 0.8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s"
    " samp small span strike strong sub sup time tt u var wbr br img".split()
)
#: Their content is no text of the page.
SILENT = frozenset(
    "script style noscript template svg math iframe object audio video canvas head title textarea"
    " select option button datalist map".split()
)
RAW = frozenset("script style textarea title noscript iframe template svg".split())
SURROUNDING = frozenset("nav footer aside form menu dialog fieldset".split())
#: These may be put around a whole page, as names may.
FORMS = frozenset(("form", "fieldset"))
#: Surroundings by tag or role, and by name only.
SAID, NAMED = 2, 1
CONTENT = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: An opening tag ends an open one of these in the same holder.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
HOLDERS = frozenset("ul ol dl table td th body article main section div aside nav footer header".split())
#: Whole classes or ids: surroundings by name, with words of place and number around them. Others
#: (has-sidebar, comments-open, tag-legal) tell of the page, not of the element.
_SURE = (
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|side-?bar|cookies?|consent|gdpr"
    r"|notice|nav(?!y)\w*|menu|bread-?crumbs?|footer|foot|masthead|site-?header|page-?header|topbar"
    r"|toolbar|share|sharing|recommend\w*|newsletter|subscribe|sign-?up|login|popup"
    r"|modal|overlay|comments?|comment-?list|respon(?:d|ses?)|repl(?:y|ies)|disqus"
    r"|pagination|pager|tags?-?list|skip-?link|copyright"
)
#: Words that name a subject as well: inside the content they tell nothing of prose.
_UNSURE = r"alert|social|related|discussion|widget|legal|disclaimer|search"
_PLACE = (
    r"(?:left|right|top|bottom|main|site|page|global|primary|secondary|mobile|desktop|sticky|post|entry|article"
    r"|blog|area|box|bar|list|links?|items?|section|block|wrap|wrapper|container|inner|buttons?|icons?|form|posts"
    r"|field|panel|header|\d+)"
)


def _names(words: str) -> re.Pattern:
    name = rf"(?:{words})\d*"
    return re.compile(rf"(?:^|(?<=\s))(?:{_PLACE}[_-]+)*{name}(?:[_-]+(?:{name}|{_PLACE}))*(?=$|\s)", re.I)


SURROUNDING_NAME, SURE_NAME = _names(f"{_SURE}|{_UNSURE}"), _names(_SURE)
#: Sentences and characters that an element inside the content must have to be prose whatever its
#: name, and the share of link text that it may have.
PROSE_SENTENCES, PROSE_CHARS, PROSE_LINKS = 3, 80, 0.2
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|$)", re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
STOPS = re.compile(r"[.!?…。！？؟]")
MARKS = re.compile(r"[.,;:!?…。，、！？؟¿¡]")
BLANKS = re.compile(r"\s+")


@dataclass
class Element:
    tag: str
    path: str
    parent: "Element | None"
    excluded: bool
    content: bool
    surrounding: int = 0
    unsure: bool = False
    within: set = field(default_factory=set)


@dataclass
class Block:
    holder: Element
    text: str
    linked: int
    heading: bool


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, those of surroundings left out."""
    return _without_surroundings(_all_blocks(page))


def _without_surroundings(blocks: list[Block]) -> list[Block]:
    """Blocks in no element of surroundings, but for those that are wrappers of the page's content."""
    _acquit_prose(blocks)
    over = [[e for e in stack_of(b.holder) if e.surrounding] for b in blocks]
    if not any(over):
        return blocks
    wrappers: set[int] = set()

    def bars(i: int) -> list[Element]:
        return [e for e in over[i] if id(e) not in wrappers]

    free = [len(b.text) - min(b.linked, len(b.text)) for b in blocks]
    marks = [len(MARKS.findall(b.text)) for b in blocks]
    while True:
        left = [bars(i) for i in range(len(blocks))]
        if any(b.holder.content and not x for b, x in zip(blocks, left, strict=True)):
            break
        # The outermost ones that hold an article or main, else one with most of the text.
        open_to = [all(e.surrounding == NAMED for e in x) for x in left]
        found = {
            id(x[-1]) for b, x, o in zip(blocks, left, open_to, strict=True)
            if o and b.holder.content and not x[-1].content
        }
        if not found:
            mass: dict[int, list[int]] = defaultdict(lambda: [0, 0])
            for i, x in enumerate(left):
                if x and open_to[i]:
                    mass[id(x[-1])][0] += free[i]
                    mass[id(x[-1])][1] += marks[i]
            text, mark = (sum(v for v, o in zip(f, open_to, strict=True) if o) for f in (free, marks))
            found = {k for k, (t, m) in mass.items() if 2 * t > text and 2 * m >= mark}
        if not found:
            break
        wrappers |= found
    kept = [b for b, x in zip(blocks, left, strict=True) if not x]
    if not kept:  # look again, past names
        kept = [b for b, o in zip(blocks, open_to, strict=True) if o]
    return kept


def _acquit_prose(blocks: list[Block]) -> None:
    """Elements inside an article or main that an unsure name alone takes for surroundings are none if
    their ratios are those of prose."""
    held: dict[int, tuple[Element, list[Block]]] = {}
    for b in blocks:
        for e in stack_of(b.holder):
            if e.unsure:
                held.setdefault(id(e), (e, []))[1].append(b)
    for element, inside in held.values():
        size = sum(len(b.text) for b in inside)
        stops = sum(len(STOPS.findall(b.text)) for b in inside)
        if size >= PROSE_CHARS and stops >= PROSE_SENTENCES and sum(b.linked for b in inside) <= PROSE_LINKS * size:
            element.surrounding = 0


def _all_blocks(page: str) -> list[Block]:
    """Text blocks in page order, without hidden ones."""
    root = Element("", "", None, False, False)
    stack = [root]
    out: list[Block] = []
    parts: list[str] = []
    linked, links = 0, 0
    owner = root

    def close() -> None:
        nonlocal parts, linked
        text = BLANKS.sub(" ", html.unescape("".join(parts))).strip()
        if text and not owner.excluded:
            tags = {e.tag for e in stack_of(owner)}
            out.append(Block(owner, text, linked, bool(tags & HEADINGS)))
        parts, linked = [], 0

    def pop_to(tag: str, until: frozenset) -> None:
        nonlocal links
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                links -= sum(e.tag == "a" for e in stack[k:])
                del stack[k:]
                return
            if stack[k].tag in until:
                return

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.search(page, at)
        piece = page[at : token.start() if token else end]
        if piece:
            if not parts:
                owner = _block_holder(stack)
            parts.append(piece)
            if links:
                linked += len(piece)
        if not token:
            break
        at = max(token.end(), token.start() + 1)
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            close()
        elif tag == "br" and parts:
            parts.append(" ")
        if token["end"]:
            pop_to(tag, frozenset() if tag not in INLINE else HOLDERS)
            continue
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = over.end() if over else end
            if tag in INLINE:
                close()
            continue
        if tag in VOID or token["rest"].rstrip().endswith("/") and tag not in HOLDERS:
            continue
        if tag not in INLINE:
            for open_tag in ("p", *HEADINGS):
                if open_tag in [e.tag for e in stack[-12:]]:
                    pop_to(open_tag, HOLDERS)
        for open_tag in ENDS.get(tag, ()):
            pop_to(open_tag, HOLDERS - {"td", "th"} if tag in ("tr", "tbody", "tfoot", "td", "th") else HOLDERS)
        stack.append(_element(tag, token["rest"], stack))
        links += tag == "a"
    close()
    return out


def stack_of(element: Element | None):
    while element is not None:
        yield element
        element = element.parent


def _block_holder(stack: list[Element]) -> Element:
    """The innermost open element that is no inline one; it is left out if an inline one is."""
    for element in reversed(stack):
        if element.excluded or element.surrounding or element.tag not in INLINE:
            return element
    return stack[0]


def _element(tag: str, rest: str, stack: list[Element]) -> Element:
    parent = stack[-1]
    names = {}
    if "=" in rest:
        names = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(rest)}
    label = f"{names.get('class', '')} {names.get('id', '')}".strip()
    inside = parent.content
    excluded = (
        parent.excluded or tag in SILENT or "hidden" in rest.split()
        or names.get("aria-hidden") == "true" or "display:none" in names.get("style", "").replace(" ", "")
    )
    role = names.get("role", "").lower()
    surrounding = 0
    if tag in SURROUNDING - FORMS or tag == "header" and not inside or role in ROLES - FORMS:
        surrounding = SAID
    elif tag in FORMS or role in FORMS or (
        label and tag not in ("body", "html", *CONTENT) and SURROUNDING_NAME.search(label)
    ):
        surrounding = NAMED
    first = label.split()[0].rstrip("0123456789") if label else ""
    path = parent.path if tag in INLINE else f"{parent.path}/{tag}{'.' + first if first and tag not in ('p', 'li') else ''}"
    unsure = surrounding == NAMED and inside and tag not in FORMS and role not in FORMS and not SURE_NAME.search(label)
    return Element(tag, path, parent, excluded, inside or tag in CONTENT, surrounding, unsure)


def path_figures(blocks: list[Block]) -> dict[str, float]:
    """One figure per tag path: text, punctuation and their spread per block, fused."""
    groups: dict[str, list[Block]] = defaultdict(list)
    for b in blocks:
        groups[b.holder.path].append(b)
    out = {}
    for path, group in groups.items():
        n = len(group)
        texts = [len(b.text) for b in group]
        marks = [len(MARKS.findall(b.text)) for b in group]
        text, mark = sum(texts) / n, sum(marks) / n
        spread = math.sqrt(sum((t - text) ** 2 for t in texts) / n)
        free = 1 - min(1.0, sum(b.linked for b in group) / max(1, sum(texts)))
        out[path] = math.log1p(text) * math.log1p(mark) * (1 + math.log1p(spread)) * free
        out[path] *= 2 if group[0].holder.content else 1
    return out


def likeness(a: str, b: str) -> float:
    """Share of the longer path that both have in common from the root."""
    x, y = a.split("/"), b.split("/")
    same = 0
    for u, v in zip(x, y, strict=False):
        if u != v:
            break
        same += 1
    return same / max(len(x), len(y))


def select(blocks: list[Block]) -> list[bool]:
    """Which blocks are content."""
    if not blocks:
        return []
    figures = path_figures(blocks)
    raw = [figures[b.holder.path] for b in blocks]
    smooth = []
    alike: dict[tuple[str, str], float] = {}
    for i, b in enumerate(blocks):
        total = weight = 0.0
        for j in range(max(0, i - REACH), min(len(blocks), i + REACH + 1)):
            pair = (b.holder.path, blocks[j].holder.path)
            if pair not in alike:
                alike[pair] = likeness(*pair)
            w = math.exp(-((i - j) ** 2) / 2) * alike[pair] ** 2
            total += w * raw[j]
            weight += w
        smooth.append(total / weight if weight else raw[i])
    mean = sum(smooth) / len(smooth)
    spread = math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
    least = min(spread, max(smooth)) * THRESHOLD
    chosen = [s >= least and r > 0 for s, r in zip(smooth, raw, strict=True)]
    if not any(chosen):
        chosen = [s == max(smooth) for s in smooth]
    return _fuse(blocks, chosen)


def _fuse(blocks: list[Block], chosen: list[bool]) -> list[bool]:
    """The chosen blocks, and all blocks of the element that holds those of the leading path, but
    those of other paths that mostly are links."""
    mass: dict[int, int] = defaultdict(int)
    leading: dict[str, int] = defaultdict(int)
    depth: dict[int, int] = {}
    for b, c in zip(blocks, chosen, strict=True):
        if c:
            line = list(stack_of(b.holder))
            leading[b.holder.path] += len(b.text)
            for d, e in enumerate(reversed(line)):
                mass[id(e)] += len(b.text)
                depth[id(e)] = d
    lead = max(leading, key=leading.__getitem__)
    first, *others = [b.holder for b, c in zip(blocks, chosen, strict=True) if c and b.holder.path == lead]
    above = list(stack_of(first))
    common = {id(e) for e in above}
    for other in {id(e): e for e in others}.values():
        common &= {id(e) for e in stack_of(other)}
    if all(e.tag in ("", "html", "body") for e in above if id(e) in common):
        # Blocks of one path all over the page: the chosen ones stay, most of them have a holder.
        total = max(mass.values())
        holder = max((k for k in mass if mass[k] >= HOLDS * total), key=lambda k: depth[k])
        above = next(a for b, c in zip(blocks, chosen, strict=True) if c and holder in map(id, a := list(stack_of(b.holder))))
    else:
        holder = next(id(e) for e in above if id(e) in common)
    # An element that says it is the content holds it.
    above = above[[id(e) for e in above].index(holder):]
    said = next((e for e in above if e.tag in CONTENT), None)
    holder = id(said) if said else holder
    inner = [any(id(e) == holder for e in stack_of(b.holder)) for b in blocks]
    if sum(inner) == 1:  # one block: its siblings belong to it
        own = next(b for b, i in zip(blocks, inner, strict=True) if i).holder
        near = own.parent
        while near is not None and near.parent is not None and near.tag in HEADINGS:
            near = near.parent
        if near is not None and (near.content or near.tag in ("div", "section")):
            inner = [any(e is near for e in stack_of(b.holder)) for b in blocks]
            above = list(stack_of(near))
    else:
        above = above[[id(e) for e in above].index(holder):]
    if said is None:
        inner = [i or j for i, j in zip(inner, _sections_like(above[0], blocks), strict=True)]
    paths = {b.holder.path for b, c in zip(blocks, chosen, strict=True) if c}
    out = [
        i and (b.holder.path in paths or b.heading or b.holder.content or 2 * b.linked < len(b.text))
        or c and (said is None or b.holder.content)
        for b, i, c in zip(blocks, inner, chosen, strict=True)
    ]
    # Headings right before a block, in an element around it, are its own.
    for i in range(len(blocks) - 2, -1, -1):
        if out[i + 1] and not out[i] and blocks[i].heading:
            out[i] = any(e is blocks[i].holder.parent for e in stack_of(blocks[i + 1].holder))
    return out


def _sections_like(section: Element, blocks: list[Block]) -> list[bool]:
    """Blocks of the siblings of a section with a heading: elements of its tag that have a heading of
    the same level, and less than half of their text in links."""
    beside: list[Element | None] = [
        next((e for e in stack_of(b.holder) if e.parent is section.parent and e.tag == section.tag), None) for b in blocks
    ]
    held: dict[int, list[Block]] = defaultdict(list)
    for b, e in zip(blocks, beside, strict=True):
        if e is not None:
            held[id(e)].append(b)

    def levels(element: Element | None) -> set[str]:
        return {e.tag for b in held[id(element)] for e in stack_of(b.holder)} & HEADINGS

    own = levels(section)
    like = {
        key for key, inside in held.items()
        if own & {e.tag for b in inside for e in stack_of(b.holder)}
        and 2 * sum(b.linked for b in inside) < sum(len(b.text) for b in inside)
    } if section.parent is not None and section.tag in ("div", "section") else set()
    return [e is not None and id(e) in like for e in beside]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, c in zip(blocks, select(blocks), strict=True) if c)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""

    def read(batches):
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"),
                        F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{source}`").alias("html"))
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
