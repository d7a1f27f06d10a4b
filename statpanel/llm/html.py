"""Main text of web pages: removal of site templates, and rules for what is never text.

Pages are parsed into trees. Element subtrees of the whole tree are hashed as they stand; one that recurs on several different pages of a host
is part of the site's template, and goes before the main text is chosen. Blocks of prose count only where most pages of the host hold them,
and in an article only at its edges: a passage that articles share is still text. What by tag, role or class is a menu, header, footer,
notice, advert, form, code or comment goes as well, also from hosts of few pages; inside an article class names decide only
where all their words say so.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statpanel.llm.common import perhaps_among, written
from statpanel.llm.lexicon import chunks

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of prose, and what may hold the blocks at the edge of an article; most blocks of prose that are judged at an edge.
PROSE = (HEADINGS - {"h1"}) | frozenset("p li blockquote pre address dt dd center figcaption".split())
HOLDERS = frozenset("div section".split())
#: Blocks that articles repeat by chance, outside of articles too.
SMALL = PROSE | frozenset("td th caption summary legend".split())
EDGE = 3
#: Elements that a start tag ends, up to the element named last.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: What is never main text: by tag, by role, and by a word of the class or id.
NEVER = frozenset(
    """head script style noscript template iframe object embed svg math canvas audio video map select option datalist button input
    textarea form fieldset nav footer aside menu dialog title""".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status tablist tooltip".split()
)
WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos promoted
    promotion promotions banner banners cookie cookies consent gdpr ccpa notice notices notification notifications alert popup popover
    modal overlay lightbox newsletter subscribe subscription signup signin login register sidebar sidebars rail widget widgets nav
    navbar navigation menu menus submenu breadcrumb breadcrumbs footer foot header masthead topbar toolbar share sharing social
    socials related recommended recommendations recirculation trending popular comment comments commentlist disqus reply replies respond
    discussion pagination pager paginator skip paywall outbrain taboola copyright disclaimer form search searchbox""".split()
)
#: Words for what may hold articles of its own: reader comments and teasers.
ASIDE = frozenset(
    "comment comments commentlist disqus reply replies respond discussion related recommended recommendations trending popular".split()
)
#: Words for adverts, and words that say nothing of what an element holds.
ADS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors".split())
NEUTRAL = frozenset(
    """area bar block bottom box btn button buttons card col column container content div group icons inline inner item items left link
    links list main outer panel right row section slot text top unit wrap wrapper""".split()
)
CONTENT = frozenset("content article post entry story maincontent articlebody articletext".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


#: Elements by which a page names its main text.
NAMED = ("article", "main")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "gone", "holds", "prose")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.children, self.gone, self.prose = tag, attrs, parent, [], False, False
        self.holds: frozenset[str] = frozenset()


class _Path:
    """The open elements from the root down, with the places of each tag and of the blocks among them, so that none is searched for."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.blocks = [root], {}, []

    def open(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """End the element at this place, and all in it."""
        while len(self.nodes) > place:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            if node.tag in BLOCK:
                self.blocks.pop()

    def last(self, tag: str) -> int:
        """The place of the innermost open element of this tag; 0, that of the root, if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def first_after(self, tag: str, place: int) -> int:
        """The place of the outermost open element of this tag behind a place; past the end if there is none."""
        places = self.places.get(tag, [])
        at = bisect_right(places, place)
        return places[at] if at < len(places) else len(self.nodes)


def parse(page: str) -> Node:
    """A tree of elements and texts, in time that grows with the page. Unclosed, misnested and unknown tags are taken as browsers mostly do."""
    root = Node("#root", "", None)
    path = _Path(root)
    place, size = 0, len(page)
    while place < size:
        token = _TOKEN.match(page, place)
        place = token.end()
        text = token["text"]
        if text is not None:
            path.nodes[-1].children.append(html.unescape(text) if "&" in text else text)
            continue
        tag = token["tag"] or token["tag2"]
        if tag is None:
            if token["cdata"]:
                path.nodes[-1].children.append(token["cdata"])
            continue
        tag = tag.lower()
        if token["end"] or token["end2"]:
            at = path.last(tag)
            # The end of an inline element does not end the blocks around it.
            if at and (tag in BLOCK or not path.blocks or path.blocks[-1] < at):
                path.close(at)
            continue
        if tag in BLOCK and path.blocks and path.nodes[path.blocks[-1]].tag == "p":
            path.close(path.blocks[-1])
        if tag in ENDED_BY:
            ended, within = ENDED_BY[tag]
            limit = max(path.last(t) for t in within)
            path.close(min(path.first_after(t, limit) for t in ended))
        at = path.nodes[-1]
        new = Node(tag, token["attrs"] or token["attrs2"] or "", at)
        at.children.append(new)
        if tag in RAW:
            end = _raw_end(tag).search(page, place)
            place = end.end() if end else size
        elif tag not in VOID and not (new.attrs.endswith("/") and tag not in BLOCK and tag in ("svg", "path")):
            path.open(new)
    return root


@cache
def _raw_end(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I)


def _attributes(node: Node) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTR.findall(node.attrs):
        out.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return out


def _walk(node: Node):
    todo = [node]
    while todo:
        node = todo.pop()
        yield node
        todo += [c for c in reversed(node.children) if type(c) is Node]


def _note_holds(root: Node) -> None:
    """Note in each node which of the elements that say where the text is stand below it, and whether prose does."""
    for node in reversed(list(_walk(root))):
        if node.parent is not None:
            node.parent.prose |= node.prose or node.tag in PROSE
            below = node.holds | {node.tag} if node.tag in ("article", "main", "h1") else node.holds
            if not below <= node.parent.holds:
                node.parent.holds |= below


def mark(root: Node) -> None:
    """Mark what is never main text as gone, outside in."""
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, inside = todo.pop()
        node.gone = _never(node, inside)
        if not node.gone:
            inside = inside or node.tag in NAMED
            todo += [(c, inside) for c in node.children if type(c) is Node]


def _never(node: Node, inside: bool) -> bool:
    tag = node.tag
    if tag in NEVER:
        return True
    if tag == "header" and not inside:
        return not node.holds & {"article", "main"}
    if not node.attrs:
        return False
    attributes = _attributes(node)
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return True
    if tag in ("html", "body", "main", *HEADINGS):
        return False
    if attributes.get("role", "").lower() in ROLES:
        return True
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    named = {w.lower() for w in _WORD.findall(names)}
    if not named & WORDS:
        return False
    if inside:
        each = [{w.lower() for w in _WORD.findall(name)} for name in names.split()]
        named = set().union(*(words for words in each if words & WORDS and words <= WORDS | NEUTRAL))
        if not named or node.prose and not named & (ASIDE | ADS):
            return False
    if named & ASIDE and not node.holds & {"main", "h1"}:
        return True
    return tag != "article" and not node.holds


def _text(node: Node) -> str:
    out: list[str] = []
    todo: list = [node]
    while todo:
        node = todo.pop()
        if type(node) is str:
            out.append(node)
        elif not node.gone:
            if node.tag in BLOCK or node.tag == "br":
                out.append(" ")
                todo.append(" ")
            todo += reversed(node.children)
    return " ".join("".join(out).split())


def main_parts(root: Node) -> tuple[list[Node], list[Node]]:
    """The elements that hold the main text in page order, and those they were chosen from if the page names them itself.

    Articles; if one holds half of all their text, only that. Without one, the main element. Without that, the outermost element with
    a class for content that holds half of the page's text, or else the whole page.
    """
    live = [n for n in _live(root)]
    articles = [n for n in live if n.tag == "article" and not _within(n, lambda p: p.tag == "article")]
    if articles:
        sizes = [len(_text(a)) for a in articles]
        large = [a for a, s in zip(articles, sizes) if 2 * s > sum(sizes)]
        return large or articles, articles
    for chosen in ([n for n in live if n.tag == "main"], [n for n in live if "main" in n.attrs and _attributes(n).get("role") == "main"]):
        if chosen:
            ids = {id(n) for n in chosen}
            outer = [n for n in chosen if not _within(n, lambda p: id(p) in ids)]
            return outer, outer
    whole = len(_text(root))
    for node in live:
        if node.attrs and node.tag not in ("html", "body") and node.tag in BLOCK:
            attributes = _attributes(node)
            named = {w.lower() for w in _WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")}
            if named & CONTENT and 2 * len(_text(node)) > whole:
                return [node], []
    return [root], []


def _live(root: Node):
    todo = [root]
    while todo:
        node = todo.pop()
        if not node.gone:
            yield node
            todo += [c for c in reversed(node.children) if type(c) is Node]


def _within(node: Node, what) -> bool:
    node = node.parent
    while node is not None:
        if what(node):
            return True
        node = node.parent
    return False


def blocks(parts: list[Node]) -> list[str]:
    """The text of each block, white space made single; in an article's header only headings are text."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                out.append(text)

    todo: list = [(p, False) for p in reversed(parts)]
    while todo:
        item, bare = todo.pop()
        if item is None:
            flush()
        elif type(item) is str:
            if not bare:
                run.append(item)
        elif not item.gone:
            tag = item.tag
            if tag == "header":
                bare = True
            elif tag in HEADINGS:
                bare = False
            if tag in BLOCK:
                flush()
                todo.append((None, False))
            elif tag == "br":
                run.append(" ")
            todo += [(c, bare) for c in reversed(item.children)]
    flush()
    return out


def subtrees(root: Node) -> tuple[list[tuple[int, list[Node]]], dict[int, int]]:
    """Hash and nodes of all that may be part of a template, on the whole tree, and the hashes of all nodes with a text.

    Containers count everywhere, by an even hash. Blocks of prose count outside of what the page itself names as its article, by an
    odd one. Never what is, or holds, an article, a main element or an h1.
    """
    kinds = BLOCK - {"html", "body", "caption", "tr", "tbody", "thead", "tfoot", "h1", *NAMED}
    order: list[Node] = []
    inside: set[int] = set()
    for node in _walk(root):
        order.append(node)
        if node.tag in NAMED or node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
    # Children come before their parents when the walk is read backwards; each node is hashed once.
    hashes: dict[int, int] = {}
    out = []
    for node in reversed(order):
        inner = []
        for child in node.children:
            value = " ".join(child.split()) if type(child) is str else hashes.get(id(child))
            if value:
                inner.append(str(value))
        if not inner:
            continue
        value = hashes[id(node)] = xxhash.xxh64_intdigest("\0".join([node.tag, *inner]))
        if node.tag not in kinds or node.holds:
            continue
        if node.tag not in SMALL:
            out.append(((value & ~1) - (1 << 63), [node]))
        elif id(node) not in inside:
            out.append(((value | 1) - (1 << 63), [node]))
    return out, hashes


def _edges(part: Node, hashes: dict[int, int]) -> list[tuple[int, list[Node]]]:
    """Hash and nodes of the first and the last one, two, … EDGE blocks of prose of an article, behind its title."""
    out = []
    for side in ("first", "last"):
        at: Node | None = part
        while at is not None:
            run, holder = [], None
            for child in at.children if side == "first" else reversed(at.children):
                if type(child) is str:
                    if child.strip():
                        break
                    continue
                if child.gone or id(child) not in hashes or side == "first" and not run and child.tag in ("h1", "header"):
                    continue
                if child.tag not in PROSE or child.holds:
                    holder = child if not run and child.tag in HOLDERS else None
                    break
                run.append(child)
                value = xxhash.xxh64_intdigest("\0".join([side, *(str(hashes[id(n)]) for n in run)]))
                out.append(((value | 1) - (1 << 63), list(run)))
                if len(run) == EDGE:
                    break
            at = holder
    return out


def extract(page: str, template: frozenset[int] = frozenset()) -> tuple[str, list[int], list[int], int]:
    """The main text of a page without the given template subtrees, the hashes of all its subtrees, and of those that are part of what
    the main text is chosen from, so that the others change nothing if they go; and a hash that tells pages apart.

    Pages that name their article differ if their main text does, others if any text does that is not ruled out.
    """
    root = parse(page)
    _note_holds(root)
    found, hashes = subtrees(root)
    mark(root)
    parts, named = main_parts(root)
    if named:
        found += [run for part in parts for run in _edges(part, hashes)]
    whole = "" if named else _text(root)
    among = {id(n) for part in named or [root] for n in _live(part)}
    telling = {value for value, nodes in found if any(id(n) in among for n in nodes)}
    if not telling.isdisjoint(template):
        for value, nodes in found:
            if value in template:
                for node in nodes:
                    node.gone = True
        parts, _ = main_parts(root)
    text = "\n".join(blocks(parts))
    return text, sorted({value for value, _ in found}), sorted(telling), xxhash.xxh64_intdigest(whole or text) - (1 << 63)


def host_of(url):
    """The host of a url in lower case, without user, port and scheme; null and odd urls give the empty string."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    return F.lower(host)


def main_text(pages: DataFrame, least_pages: int = 5, least_share: float = 0.5) -> DataFrame:
    """(page_id, url, text) of every row of pages (page_id, url, html): the main text, blocks joined by one \\n.

    A container is a template of its host if it stands on at least `least_pages` pages of the host with different texts, however many
    pages the host has; copies of one page count once. A block of prose, or the first or last ones of an article, must also stand on
    `least_share` of the host's pages. Pages without a valid url share the host ''. Null html is empty, and an empty text is "". Very long pages
    are parsed whole, in time that grows with them. Rows that repeat are separate; other columns are ignored; an empty table gives an empty table.

    Each page is parsed once; only pages that hold a template subtree in what their main text is chosen from are parsed again.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "key": F.xxhash64("page_id", "url", "html")})

    def first(batches):
        for batch in batches:
            for part in chunks(batch, "html"):
                found = [extract(p) for p in part.column("html").to_pylist()]
                texts, all_, telling, contents = zip(*found) if found else [()] * 4
                new = [pa.array(texts, pa.string()), pa.array(contents, pa.int64())]
                new += [pa.array(hashes, pa.list_(pa.int64())) for hashes in (all_, telling)]
                kept = ["page_id", "url", "host", "key"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *new], [*kept, "text", "content", "subtrees", "telling"])

    schema = "page_id long, url string, host string, key long, text string, content long, subtrees array<long>, telling array<long>"
    found = written(rows.mapInArrow(first, schema), "html-pages")
    held = found.filter(F.size("subtrees") > 0)
    spread = held.select("host", "content", F.explode("subtrees").alias("h")).distinct().groupBy("host", "h")
    spread = spread.agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    hosts = found.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("all_pages"))
    prose = F.col("h").bitwiseAND(F.lit(1)) == 1
    enough = ~prose | (F.col("pages") >= F.col("all_pages") * F.lit(least_share))
    templates = spread.join(hosts, "host").filter(enough).select("host", "h")
    templates = written(templates, "html-templates")
    hit = held.select("host", "key", F.explode("telling").alias("h")).join(templates, ["host", "h"])
    hit = written(hit.groupBy("key").agg(F.collect_set("h").alias("template")), "html-hits")
    plain = found.join(hit, "key", "left_anti").select("page_id", "url", "text")

    def again(batches):
        for batch in batches:
            for part in chunks(batch, "html"):
                both = zip(part.column("html").to_pylist(), part.column("template").to_pylist())
                texts = pa.array([extract(p, frozenset(t))[0] for p, t in both], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], ["page_id", "url", "text"])

    changed = perhaps_among(rows, "key", hit.select("key")).join(hit, "key").select("page_id", "url", "html", "template")
    return plain.union(changed.mapInArrow(again, "page_id long, url string, text string"))
