"""Main text of web pages by composite text density.

A page becomes a tree. Parts that are never main text (scripts, navigation, forms) are cut, and elements whose
class, id or role names an advert, a menu, a notice, comments and the like, but for those that hold the page's main
element or its longest article: a layout may be named after a sidebar that it has. For each node that is
left, the composite text density is its characters per tag, adjusted by its share of link
characters and link tags. The sum over a node's children of their densities is largest for the node that directly holds
the text. The smallest density on the path from that node up to the body is the page's threshold; every
part that reaches it gives its own subtree with the largest sum. Within those, lists and blocks that are mostly links go if
they stay below the threshold.

Reading a page takes time in proportion to its length, however deep its elements are nested.

A page is one row and a small tree; Spark spreads the pages.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import prepare

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:/?>|\Z)"
    r"|<[A-Za-z/][^<>]*(?:>|\Z)",  # an attribute whose quote never ends
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PART = re.compile(r"[a-z]+")

# Element names of HTML, in families.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset(
    "head script style noscript template iframe object embed svg math canvas nav footer aside form button select "
    "textarea input dialog menu audio video noembed noframes title".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: A start of one of these ends an open one of the same row, up to the element that holds the list or table.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "optgroup")),
}
#: Words in a class, an id or a role that name a part outside the main text.
OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar sidenav aside rail footer masthead cookie cookies consent gdpr "
    "notice notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments disqus respond replies reply pagination pager widget "
    "toolbar search contentinfo complementary copyright skip".split()
)
#: Of these, the ones that also name subjects: they count only among words that name parts of pages.
VAGUE = frozenset(
    "social related notice search share sharing skip rail reply replies alert notification recommended login overlay "
    "subscribe subscription promotion copyright complementary".split()
)
COMPANIONS = frozenset(
    "links link icons icon bar box list posts post articles stories section block container wrapper widget buttons button "
    "items item top bottom left right header area panel inner outer content form field input media site page main primary "
    "secondary to for us on by row col column group module component small large".split()
)
#: With one of these, a name says what a layout has or lacks.
ABOUT = frozenset("has have with without no not hide hides hidden is show shows".split())
PLAIN = frozenset("html body article main".split())
LINK_BLOCKS = frozenset("div ul ol dl section table".split())
_P_BARRIERS = PLAIN | NEVER | frozenset("div section td th li dd blockquote table ul ol header".split())
NO_HINT = frozenset("h1 h2 h3 h4 h5 h6 b i em strong code pre a".split())


def _names_outside(value: str) -> bool:
    """Whether one of the names in an attribute stands for a part outside the main text."""
    for token in value.split():
        parts = _NAME_PART.findall(token)
        hints = OUTSIDE.intersection(parts)
        if not hints or not ABOUT.isdisjoint(parts):
            continue
        if not hints <= VAGUE or all(x in OUTSIDE or x in COMPANIONS for x in parts):
            return True
    return False


def _never(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no main text whatever it holds."""
    if name in NEVER or (name == "header" and not in_article):
        return True
    if not attributes.strip() or name in PLAIN or name in NO_HINT:
        return False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            return True
    return False


def _hinted(name: str, attributes: str) -> bool:
    """Whether an element's class, id or role says that it is no main text."""
    if not attributes.strip() or name in ("html", "body", "main") or name in NO_HINT:
        return False
    found = ((key.lower(), (a or b or c).lower()) for key, a, b, c in _ATTRIBUTE.findall(attributes))
    return any(key in ("class", "id", "role") and (value == "header" or _names_outside(value)) for key, value in found)


class _Tree:
    """Nodes in page order: name, parent, the texts between their tags (text, node or -1 for a break)."""

    def __init__(self, page: str):
        self.name, self.parent, self.pieces = ["#page"], [-1], []
        self.in_article, self.hinted = [False], [False]
        self.open: Counter[str] = Counter()
        self._read(page)
        self._cut_hinted()

    def _text(self, node: int, raw: str) -> None:
        if raw:
            self.pieces.append((html.unescape(raw), node))

    def _read(self, page: str) -> None:
        stack, cut, at, find = [0], 0, 0, _TAG.search  # cut: depth of the stack at which a part is left out
        lower = None
        while match := find(page, at):
            if match.start() > at and not cut:
                self._text(stack[-1], page[at : match.start()])
            at = match.end()
            name = match[2]
            if name is None:
                continue
            name = name.lower()
            if match[1]:
                cut = self._end(name, stack, cut)
                continue
            self._imply_ends(name, stack)
            if cut and len(stack) < cut:
                cut = 0
            if name not in INLINE and not cut:
                self.pieces.append(("", -1))
            outside = not cut and _never(name, match[3], self.in_article[stack[-1]])
            hinted = not cut and not outside and name not in RAW and name not in VOID and _hinted(name, match[3])
            if name in RAW:
                lower = lower or page.lower()
                end = lower.find("</" + name, at)
                end = len(page) if end < 0 else end
                if not cut and not outside:
                    self._text(stack[-1], page[at:end])
                close = page.find(">", end)
                at = len(page) if close < 0 else close + 1
                continue
            if name in VOID or match[0].endswith("/>") and name not in ENDS_PARAGRAPH and name not in INLINE:
                if not cut and not outside:
                    self._node(name, stack[-1])
                continue
            stack.append(self._node(name, stack[-1], hinted))
            self.open[name] += 1
            if outside:
                cut = len(stack)
        if not cut:
            self._text(stack[-1], page[at:])

    def _node(self, name: str, parent: int, hinted: bool = False) -> int:
        self.name.append(name)
        self.parent.append(parent)
        self.in_article.append(self.in_article[parent] or name in ("article", "main"))
        self.hinted.append(hinted)
        return len(self.name) - 1

    def _cut_hinted(self) -> None:
        """Leave out the texts of hinted parts, but for those round the page's main element or longest article."""
        n = len(self.name)
        if not any(self.hinted):
            return
        chars, linked = [0] * n, [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parent[i]] or self.name[i] == "a"
        for text, node in self.pieces:
            if node >= 0 and not linked[node]:
                chars[node] += len(text)
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        mains = [i for i in range(1, n) if self.name[i] == "main"]
        holders = mains or [i for i in range(1, n) if self.name[i] == "article" and not self.hinted[i]]
        at = max(holders, key=lambda i: (chars[i], -i), default=0)
        while at > 0:
            self.hinted[at] = False
            at = self.parent[at]
        gone = self.hinted[:]
        for i in range(1, n):
            gone[i] = gone[i] or gone[self.parent[i]]
        # A node that is left out holds no text and is no tag to the densities.
        number, kept = [-1] * n, [i for i in range(n) if not gone[i]]
        for new, old in enumerate(kept):
            number[old] = new
        self.pieces = [(text, number[node] if node >= 0 else -1) for text, node in self.pieces if node < 0 or not gone[node]]
        self.name, self.parent = [self.name[i] for i in kept], [number[self.parent[i]] if i else -1 for i in kept]

    def _close(self, stack: list[int], depth: int) -> None:
        for i in stack[depth:]:
            self.open[self.name[i]] -= 1
        del stack[depth:]

    def _imply_ends(self, name: str, stack: list[int]) -> None:
        if name in ENDS_PARAGRAPH:
            self._pop_to(("p",), _P_BARRIERS, stack)
        if name in SIBLINGS:
            self._pop_to(*SIBLINGS[name], stack)

    def _pop_to(self, names, barriers, stack: list[int]) -> None:
        if not any(self.open[name] for name in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            here = self.name[stack[depth]]
            if here in names:
                self._close(stack, depth)
                return
            if here in barriers:
                return

    def _end(self, name: str, stack: list[int], cut: int) -> int:
        if not cut and name not in INLINE:
            self.pieces.append(("", -1))
        for depth in range(len(stack) - 1, 0, -1) if self.open[name] else ():
            here = self.name[stack[depth]]
            if here == name:
                self._close(stack, depth)
                break
            # An inline end never closes a block, and a paragraph's end nothing around it.
            if name in INLINE and here not in INLINE or name == "p" and here in ENDS_PARAGRAPH:
                break
        return 0 if cut and len(stack) < cut else cut


def _densities(tree: _Tree) -> tuple[list[float], list[float], list[int], list[bool]]:
    """Composite density of each node, the sum over its children, its characters, and whether it is mostly links."""
    n = len(tree.name)
    chars, tags, link_chars, link_tags, own = ([0] * n for _ in range(5))
    for text, node in tree.pieces:
        if node >= 0:
            own[node] += sum(map(len, text.split()))
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[tree.parent[i]] or tree.name[i] == "a"
    for i in range(n - 1, -1, -1):
        chars[i] += own[i]
        if linked[i]:
            link_chars[i] += own[i]
        if i:
            p = tree.parent[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (tree.name[i] == "a")
    body_share = link_chars[0] / max(1, chars[0])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c, lc, t, lt = chars[i], max(1, link_chars[i]), max(1, tags[i]), max(1, link_tags[i])
        if c:
            other = max(1, c - link_chars[i])
            base = math.log(c / other * link_chars[i] + body_share * c + math.e)
            density[i] = c / t * max(0.0, math.log(max(1.0, c / lc * t / lt)) / max(1e-9, math.log(base + 1e-9) if base > math.e else 1.0))
        if i:
            total[tree.parent[i]] += density[i]
    mostly_links = [link_tags[i] >= 3 and 2 * link_chars[i] > chars[i] for i in range(n)]
    return density, total, chars, mostly_links


def main_text(page: str | None) -> str:
    """The main text of a page: blocks in page order, white space as single spaces. Empty for null and for pages without text."""
    if not page:
        return ""
    tree = _Tree(page)
    density, total, chars, mostly_links = _densities(tree)
    if not chars[0]:
        return ""
    n = len(tree.name)
    best = max(range(n), key=lambda i: (total[i], density[i], -i))
    threshold, at = density[best], best
    while at > 0 and tree.name[at] not in ("body", "#page"):
        threshold = min(threshold, density[at])
        at = tree.parent[at]
    # The best node of each subtree, and then every part from the page down that reaches the threshold.
    top = list(range(n))
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        if total[top[i]] > total[top[p]]:
            top[p] = top[i]
    whole = _wholes(tree)
    content = [False] * n
    content[whole[best]] = True
    for i in range(1, n):
        if tree.name[i] in ("article", "main", "section", "div") and density[i] >= threshold and chars[i] > 0:
            content[whole[top[i]]] = True
    for i in range(1, n):
        links = tree.name[i] in LINK_BLOCKS and mostly_links[i] and density[i] < threshold
        content[i] = (content[i] or content[tree.parent[i]]) and not links
    out = "".join(" " if node < 0 else text if content[node] else "" for text, node in tree.pieces)
    return " ".join(out.split())


def _wholes(tree: _Tree) -> list[int]:
    """For each node, the article that holds it, or the nearest element that is no mere paragraph or phrase."""
    small = INLINE | {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6"}
    article, block = [0] * len(tree.name), [0] * len(tree.name)
    for i in range(1, len(tree.name)):
        p, name = tree.parent[i], tree.name[i]
        article[i] = i if name in ("article", "main") else article[p]
        block[i] = block[p] if name in small else i
    return [a or b for a, b in zip(article, block)]


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text and n_chars. A null page, or one without text, has the empty text.

    Repeated rows are read alike. Unclosed and cut-off tags end where HTML ends them or with the page.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(page) for page in batch.column(2).to_pylist()], type=pa.string())
            sizes = pa.array([len(x) for x in texts.to_pylist()], type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, sizes], names=["page_id", "url", "text", "n_chars"])

    prepare(pages.sparkSession)
    source = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.mapInArrow(scan, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
