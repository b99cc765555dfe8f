"""HTML extraction by consensus host paths.

Pages of a host share a template.  Each page's containers are scored by the
running text of their paragraphs (links count nothing; a paragraph counts full
for its parent and half for the parent's parent), and the best one's
generalised path - tag and class names from the root, digits replaced - is the
page's vote.  Votes are added up per host in Spark, weighted by score; every
page is then extracted again along its host's winning path.  A page that has
no such path, or no text there, follows its own vote.

The winning path may be that of a wrapper inside the article.  On each page it
is widened to the outermost article around it, to a main or another container
that holds headings or running text of its own or several of the path's
elements; the body adds what stands directly in it.

Blocks keep page order.  Menus, headers, footers, side bars, notices, adverts,
forms, reader comments, scripts and styles inside a container are left out by
their tag or class, also where they stand inside a line of text; a header that holds
the main heading stays.  A mark by name, or that of a form, does not hold for an
element around the article itself.  Character references are decoded, white space in
a block becomes one space, blocks are joined by one space.

Null, empty and cut-off pages are read as far as they go (an open tag at the
end is dropped); pages without any container are read whole.  An open select,
object or drawing ends with the block around it.  Very long and very deep pages are
read whole, in time and memory that grow with their length: paths are kept as
hashes, step by step, and written out for votes only.  Of containers with equal scores
the first in page order votes; of paths with equal votes the first as text wins.
Pages without url or host vote and win among themselves.  Repeated rows are rows of
their own; an empty table gives an empty result.  Other columns of the input are not
read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvial.llm.common import materialize, table

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea)(?=[\s/>]).*?(?:</(?P=raw)(?:[\s/][^>]*)?>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:(?:\"[^\"]*\"|'[^']*'|[^\"'>])*+(?=>))|[^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-z][^>]*\Z|</\Z", re.S | re.I)
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_ONLY_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end a running block; all others are inside one.
BLOCK = frozenset((
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead title tr ul").split())
CONTAINER = frozenset("html body article main section div td blockquote center ol ul".split())
#: Containers that can stand for a whole article; the others are parts of its running text.
WRAPPER = frozenset("html body article main section div td center".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_TAG = frozenset((
    "nav menu footer aside form head button dialog fieldset title input label iframe select datalist object svg").split())
#: Elements of a line of text, and names that do not mark these: they tell of the line's place.
INLINE = frozenset((
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time "
    "tt u var").split())
PLACE_NAME = re.compile(r"(?:^|[_-])(?:header|masthead|footer|foot|side|rail)(?=$|[_-])", re.I)
#: Words in a class, id or role that mark a part as not of the article.
BOILERPLATE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|"
    r"header|masthead|footer|foot|sidebar\w*|side|rail|widgets?|related|recommend\w*|cookies?\w*|consent|notice\w*|alert|"
    r"popup|modal|overlay|subscribe|subscription|newsletter|signup|login|search|share|sharing|social|comments?|"
    r"commentlist|replies|reply|disqus|toolbar|pagination|pager|complementary|contentinfo)(?=$|[\s_-])", re.I)
#: Names that tell of the layout of what they hold, not what it is.
LAYOUT_NAME = re.compile(
    r"(?:^|[_-])(?:with|has|no|without|layout|page)[_-]|[_-](?:wrap|wrapper|container|layout|left|right|enabled|disabled|"
    r"on|off|open|closed|active|visible|hidden|none|grid|row|col|columns?|inner|outer|area|main|content|body|page|post|"
    r"article|entry|top|bottom)(?:[_-]|$)", re.I)
#: Names of what readers write, which can be longer than the article.
READERS_NAME = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|replies|reply|disqus)(?=$|[\s_-])", re.I)
_DIGITS = re.compile(r"\d+")


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    step: str             # tag and class names
    key: int              # hash of the path from the root
    parent: Node | None
    dropped: bool
    linked: bool
    header: Node | None   # the innermost header around, itself included
    block: Node | None = None       # the innermost block around, itself included
    container: Node | None = None   # the innermost container around, itself included
    wrapper: Node | None = None     # the innermost wrapper around, itself included
    keeper: Node | None = None      # the innermost block or marked element around, itself included
    score: float = 0.0
    mark: str = ""        # names by which the element is boilerplate, if it does not hold the article
    hard: bool = False    # boilerplate by a tag other than form, or inside one


@dataclass
class Page:
    """Blocks of a page with the elements that hold them."""
    blocks: list[str]
    holders: list[Node]
    nodes: list[Node]
    plain: list[int]   # characters of each block that no link holds


def _names(attrs: str, pattern: re.Pattern) -> str:
    return " ".join(a or b or c for a, b, c in pattern.findall(attrs))


def _key(above: int, step: str) -> int:
    return xxhash.xxh64_intdigest(step.encode("utf-8", "replace"), above)


def path_key(path: str) -> int:
    """The hash that the elements with a path have."""
    key = 0
    for step in path.split(">")[1:]:
        key = _key(key, step)
    return key


def path_of(node: Node) -> str:
    steps = [n.step for n in _upward(node)]
    return ">".join(reversed(steps))


@dataclass(slots=True)
class _Piece:
    """Text of a block that one element, a block or a marked one, holds."""
    keeper: Node
    text: list[str]
    plain: int = 0     # characters that no link holds


class _Reader:
    """The open elements of a page, and its blocks so far."""

    def __init__(self) -> None:
        root = Node("#root", "", 0, None, False, False, None)
        root.block = root.container = root.wrapper = root.keeper = root
        self.nodes, self.stack = [root], [root]
        self.open: dict[str, int] = {}      # open elements of each tag
        self.pieces: list[_Piece] = []      # of the running block
        self.ended: list[tuple[Node, list[_Piece]]] = []

    def text(self, piece: str) -> None:
        top = self.stack[-1]
        if not self.pieces or self.pieces[-1].keeper is not top.keeper:
            self.pieces.append(_Piece(top.keeper, []))
        self.pieces[-1].text.append(piece)
        if not top.linked:
            self.pieces[-1].plain += len(piece)

    def end_block(self) -> None:
        if self.pieces:
            self.ended.append((self.stack[-1].block, self.pieces))
            self.pieces = []

    def pop(self) -> Node:
        node = self.stack.pop()
        self.open[node.tag] -= 1
        return node

    def is_block(self, tag: str) -> bool:
        return tag in BLOCK and not (tag == "title" and self.open.get("svg", 0))

    def end_tag(self, tag: str) -> None:
        if self.open.get(tag, 0):
            while self.pop().tag != tag:
                pass

    def start_tag(self, tag: str, attrs: str) -> None:
        block = self.is_block(tag)
        if block:
            # running text does not go on inside a choice or a drawing
            for outer in ("select", "svg"):
                if self.open.get(outer, 0) and not self.open.get("foreignobject", 0):
                    self.end_tag(outer)
        if block and self.open.get("p", 0) and self.stack[-1].block.tag == "p":
            self.end_tag("p")        # a block ends an open paragraph, unless something stands between them
        if tag in ("li", "td", "tr", "dd", "dt") and self.stack[-1].tag == tag:
            self.pop()
        parent = self.stack[-1]
        name = ""
        if attrs:
            name = ".".join(sorted(_DIGITS.sub("#", _names(attrs, _ONLY_CLASS)).lower().split())).replace(">", "&gt;")
        mark = "form" if tag == "form" else ""
        if attrs and tag not in ("html", "body", "article", "main"):
            mark = " ".join(n for n in _names(attrs, _CLASS).split() if BOILERPLATE_NAME.search(n)
                            and not (tag in INLINE and PLACE_NAME.search(n))) or mark
        step = f"{tag}.{name}" if name else tag
        hard = parent.hard or tag in BOILERPLATE_TAG and tag != "form"
        node = Node(tag, step, _key(parent.key, step), parent, hard or parent.dropped or bool(mark),
                    parent.linked or tag == "a", parent.header, mark=mark, hard=hard)
        node.header = node if tag == "header" else parent.header
        node.block = node if block else parent.block
        node.container = node if tag in CONTAINER else parent.container
        node.wrapper = node if tag in WRAPPER else parent.wrapper
        node.keeper = node if block or mark or hard and not parent.hard else parent.keeper
        self.nodes.append(node)
        if not attrs.endswith("/") or block:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1


def read_page(html: str) -> Page:
    """A page's text blocks in order, each with its innermost block element."""
    reader, at = _Reader(), 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            reader.text(html[at:token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if reader.is_block(tag):
            reader.end_block()
        if token["close"]:
            reader.end_tag(tag)
        elif tag not in VOID:
            reader.start_tag(tag, token["attrs"] or "")
    if at < len(html):
        reader.text(html[at:])
    reader.end_block()
    nodes = reader.nodes
    if any(n.mark and not n.hard for n in nodes):
        _unmark(nodes, [p for _, pieces in reader.ended for p in pieces])
    page = Page([], [], nodes, [])
    for holder, pieces in reader.ended:
        kept = [p for p in pieces if not p.keeper.dropped]
        joined = " ".join(unescape("".join(t for p in kept for t in p.text)).split())
        if joined:
            page.blocks.append(joined)
            page.holders.append(holder)
            page.plain.append(min(sum(p.plain for p in kept), len(joined)))
            if page.plain[-1]:
                _credit(holder, page.plain[-1])
    return page


def _unmark(nodes: list[Node], pieces: list[_Piece]) -> None:
    """Take the marks off elements that stand around the article; set ``dropped`` anew.

    An element keeps its mark unless it holds a main, most of the page's running
    text with the main heading or as one article, or has a name of layout (or is
    a form) and holds most of the text while no article or main heading stands
    outside of marked elements.  If then no running text is left at all, marks
    come off articles, and after them off what holds most of the text.
    """
    text: dict[int, float] = {}       # running text inside each element
    holds: dict[int, set[str]] = {}   # h1, main, article inside, and "most": an article with most text
    sizes = [min(p.plain, len(" ".join("".join(p.text).split()))) for p in pieces]
    for piece, n in zip(pieces, sizes):
        if not piece.keeper.hard:
            text[id(piece.keeper)] = text.get(id(piece.keeper), 0) + n
            if piece.keeper.block.tag == "h1":
                holds.setdefault(id(piece.keeper), set()).add("h1")
    total = sum(text.values())
    for node in reversed(nodes):      # children first
        if node.hard:
            continue
        mine, inside = text.get(id(node), 0), holds.setdefault(id(node), set())
        if node.tag in ("main", "article"):
            inside.add(node.tag)
            if 2 * mine > total:
                inside.add("most")
        if node.parent is not None:
            text[id(node.parent)] = text.get(id(node.parent), 0) + mine
            holds.setdefault(id(node.parent), set()).update(inside)

    def spread() -> None:
        for node in nodes[1:]:
            node.dropped = node.hard or node.parent.dropped or bool(node.mark)

    def left() -> bool:
        return any(n and not p.keeper.dropped for p, n in zip(pieces, sizes))

    marked = [n for n in nodes if n.mark and not n.hard]
    outside = any(not n.dropped and n.tag in ("main", "article", "h1") for n in nodes)
    for node in marked:
        inside, most = holds[id(node)], 2 * text.get(id(node), 0) > total
        layout = not READERS_NAME.search(node.mark) and (
            node.mark == "form" or all(LAYOUT_NAME.search(n) for n in node.mark.split()))
        if "main" in inside or most and ("h1" in inside or "most" in inside or layout and not outside):
            node.mark = ""
    spread()
    if total and not left():
        for node in marked:
            if "article" in holds[id(node)]:
                node.mark = ""
        spread()
    if total and not left():
        for node in marked:
            if 2 * text.get(id(node), 0) > total:
                node.mark = ""
        spread()


def _credit(holder: Node, n: int) -> None:
    """A paragraph's text counts for its container and half for the next one."""
    share, node = float(n), holder
    if node.tag not in CONTAINER and node.parent is not None:
        node = node.parent
    for _ in range(2):
        node = node.container
        node.score += share
        share /= 2
        if node.parent is None:
            break
        node = node.parent


def best_container(page: Page) -> tuple[str, float]:
    """(path, score) of the page's best container; ("", 0) without text."""
    scores: dict[int, float] = {}
    first: dict[int, Node] = {}
    for node in page.nodes:
        if node.score:
            scores[node.key] = scores.get(node.key, 0.0) + node.score
            first.setdefault(node.key, node)
    if not scores:
        return "", 0.0
    best = max(scores, key=scores.__getitem__)      # of equal ones the first in page order
    return path_of(first[best]), scores[best]


def _own(page: Page) -> dict[int, list[tuple[int, bool]]]:
    """The blocks that stand directly in each wrapper, with whether a header holds them."""
    own: dict[int, list[tuple[int, bool]]] = {}
    for i, holder in enumerate(page.holders):
        if not holder.dropped and (page.plain[i] or holder.tag in HEADING):
            own.setdefault(id(holder.wrapper), []).append((i, holder.header is not None))
    return own


def widened(page: Page, path: str) -> tuple[set[int], set[int]]:
    """(elements, blocks) of the article that the elements with the path are of."""
    key = path_key(path)
    found = [n for n in page.nodes if n.key == key and not n.dropped]
    elements, blocks = {id(n) for n in found}, set()
    if not found or not path:
        return elements, blocks
    own = _own(page)
    shared: dict[int, int] = {}
    for n in found:
        shared[id(n.parent)] = shared.get(id(n.parent), 0) + 1
    top_heads: set[int] = set()
    for h in page.holders:
        if h.tag == "h1" and not h.dropped:
            for n in _upward(h):
                if id(n) in top_heads:
                    break
                top_heads.add(id(n))
    titled = any(id(n) in top_heads for n in found)
    done: set[tuple[int, bool]] = set()
    for n in found:
        article = n.tag in ("article", "main")
        for node in _upward(n.parent):
            if (id(node), article) in done:   # decided for an element before
                break
            done.add((id(node), article))
            if node.tag not in WRAPPER or node.dropped:
                continue
            mine = own.get(id(node), [])
            if node.tag in ("html", "body"):
                if not article:
                    blocks.update(i for i, in_header in mine
                                  if not in_header or (page.holders[i].tag == "h1" and not titled))
            elif (node.tag == "article" or shared.get(id(node), 0) > 1
                  or any(node.tag == "main" or not in_header for _, in_header in mine)):
                elements.add(id(node))
                titled = titled or id(node) in top_heads
            elif not article and not titled:
                blocks.update(i for i, _ in mine if page.holders[i].tag == "h1")
            article = article or node.tag in ("article", "main")
    return elements, blocks


def _upward(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def text_at(page: Page, path: str) -> str:
    """The article text of and around all elements with the path."""
    main_headers = {id(h.header) for h in page.holders if h.tag == "h1" and h.header is not None}
    elements, blocks = widened(page, path)
    # of each element: whether it is in the article, and the innermost header between them
    within: dict[int, tuple[bool, Node | None]] = {}
    for node in page.nodes:      # parents first
        inside, header = within[id(node.parent)] if node.parent is not None else (False, None)
        if id(node) in elements:
            inside, header = True, None
        within[id(node)] = inside, node if node.tag == "header" else header
    out = []
    for i, (block, holder) in enumerate(zip(page.blocks, page.holders)):
        inside, header = within[id(holder)]
        if i in blocks or inside and (header is None or id(header) in main_headers):
            out.append(block)
    return " ".join(out)


def extract(html: str, path: str | None) -> str:
    """Text along the host's path, or along the page's own best one."""
    page = read_page(html)
    found = text_at(page, path) if path is not None else ""
    return found or text_at(page, best_container(page)[0])


def host_of(url: Column) -> Column:
    """Lower-case host of an address; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)),
                      F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the container path that a host's pages vote for."""
    @F.pandas_udf("path string, score double")
    def vote(pages_html: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in pages_html:
            yield pd.DataFrame([best_container(read_page(h)) for h in part], columns=["path", "score"])

    votes = (pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
             .select("host", vote("html").alias("vote")).select("host", "vote.path", "vote.score")
             .where("score > 0").groupBy("host", "path").agg(F.sum("score").alias("score")))
    first = Window.partitionBy("host").orderBy(F.desc("score"), "path")
    return votes.withColumn("n", F.row_number().over(first)).where("n = 1").select("host", "path")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row."""
    @F.pandas_udf("string")
    def along(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for html, path in frames:
            yield pd.Series([extract(h, p if isinstance(p, str) else None) for h, p in zip(html, path)],
                            dtype=object)

    paths, _ = materialize(host_paths(pages), "extract-paths")
    paths = paths.withColumnRenamed("host", "of")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    return rows.join(paths, F.col("host") == F.col("of"), "left").select(
        "page_id", "url", along("html", "path").alias("text"))


def op7_extract(spark, sf_dir: str) -> DataFrame:
    found = extract_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
