"""Main text of web pages by wrapper induction.

Pages become trees in which children of one parent with the same signature
(tag and class) are one node, so lists and paragraphs of any number align.

1. Every page is parsed. Its blocks outside chrome (navigation, footers, adverts,
   forms, comments, ... and all inside them) are counted over all pages of the
   host, by place (path of nodes) and text, a page for each article: pages of a
   layout whose main text is the same but for digits are copies and count once.
   A block is template if most articles of the host, or of one layout of the
   host, hold it. A layout is the set of containers down to the main region.
2. The trees of up to EXEMPLARS pages with different articles are aligned by
   simple tree matching (the best order-preserving matching of children,
   recursively) and merged into the host's wrapper. This bounded sample only
   gives the shape: how much text a node held, how much of that in links, roles.
   Blocks of exemplars that differ in few words besides, revisions of one
   article, aren't template.
3. Every page is aligned with its host's wrapper in the same way. Kept are the
   varying blocks of the main region; template blocks and regions that are
   chrome by role or are link lists go. Nodes the wrapper lacks go by their own
   role and their parent's.

Null and empty pages have no text; pages without a host share the wrapper of
the empty host; every row is extracted by itself, so repeated rows and null
page_ids don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetally.session import store

EXEMPLARS = 8
#: Share of a host's or a layout's different articles, and their least number, that must hold a block for it to be template.
TEMPLATE_SHARE, TEMPLATE_LEAST = 0.6, 3
#: Groups of articles from which a host's exemplars are drawn, one of each at most.
SLOTS = 64
#: Tables of exemplars and wrappers are broadcast up to so many rows and characters, else joined by shuffle.
MOST_ROWS, MOST_CHARACTERS = 100_000, 32 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(?P<raw>script|style|template|noscript|iframe|svg|math|textarea|select|object|canvas|audio|video|title)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?P<inner>.*?)(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split())
#: Open elements that a start tag ends.
_ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
         "th": {"td", "th", "p"}, "option": {"option"}} | {tag: {"p"} for tag in _BLOCK - {"li", "dt", "dd", "tr", "td", "th", "html", "body", "head"}}
_FORMAT = frozenset("a abbr b bdi bdo big cite code del em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split())
_CHROME_TAGS = frozenset("head nav footer aside form button label fieldset dialog menu input option".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_CHROME_NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|adverts?|advert\w+|adbox|adslot|banners?|promo\w*|sponsor\w*|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|side|"
    r"widgets?|footer|header|masthead|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletter|subscribe|subscription|signup|"
    r"share|sharing|social|related|recommend\w*|comments?|commentlist|respond|repl(?:y|ies)|disqus|login|search|searchbox|pagination|pager|"
    r"toolbar|copyright|legal|disclaimer|skip)(?:[-_\s\d]|$)", re.I)
_MAIN_NAMES = re.compile(r"(?:^|[-_\s])(?:article|post|entry|story)(?:[-_]?(?:body|content|text))?(?:[-_\s\d]|$)|(?:^|\s)(?:content|main)(?:\s|$)", re.I)


class Node:
    """A node of a page's tree or of a wrapper."""

    __slots__ = ("name", "tag", "kids", "chrome", "main", "chars", "linked", "links", "pages")

    def __init__(self, name: str, tag: str, chrome: bool = False, main: bool = False):
        self.name, self.tag, self.chrome, self.main = name, tag, chrome, main
        self.kids: dict[str, Node] = {}
        self.chars = self.linked = self.links = self.pages = 0

    def as_list(self) -> list:
        return [self.name, self.tag, self.chrome, self.main, self.chars, self.linked, self.links, [k.as_list() for k in self.kids.values()]]

    @classmethod
    def of_list(cls, x: list) -> Node:
        node = cls(*x[:4])
        node.chars, node.linked, node.links = x[4:7]
        node.kids = {k[0]: cls.of_list(k) for k in x[7]}
        return node


class Wrapper:
    """The shape of a host's pages, and its template blocks by layout; those of layout 0 hold for all."""

    def __init__(self, tree: Node, constants: dict[int, set[int]]):
        self.tree, self.constants = tree, constants

    def as_json(self) -> str:
        return json.dumps([self.tree.as_list(), [[k, sorted(x)] for k, x in sorted(self.constants.items())]], separators=(",", ":"))

    @classmethod
    def of_json(cls, text: str | None) -> Wrapper:
        if not text:
            return cls(Node("", ""), {})
        tree, constants = json.loads(text)
        return cls(Node.of_list(tree), {k: set(x) for k, x in constants})

    def template(self, layout: int) -> set[int]:
        return self.constants.get(0, set()) | self.constants.get(layout, set())


def _child(parent: Node, tag: str, attributes: str) -> Node:
    found = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    classes = " ".join(sorted(found.get("class", "").split()))
    name = f"{tag}.{classes}" if classes else tag
    node = parent.kids.get(name)
    if node is None:
        names = f"{classes} {found.get('id', '')}"
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I)
        structural = tag in ("html", "body", "article", "main")
        chrome = bool(tag in _CHROME_TAGS or found.get("role", "").lower() in _CHROME_ROLES or hidden
                      or names != " " and _CHROME_NAMES.search(names) and not (structural and tag != "article"))
        main = not chrome and (tag in ("article", "main") or found.get("role") in ("main", "article") or tag in ("div", "section", "td") and bool(_MAIN_NAMES.search(names)))
        node = parent.kids[name] = Node(name, tag, chrome, main)
    return node


def parse(page: str) -> tuple[Node, list[tuple[Node, str, bool]]]:
    """The tree, and the blocks in page order: (node of the first text, text with white space as in the page, linked)."""
    root = Node("", "")
    stack, blocks = [root], []
    parts: list[str] = []
    holder, linked, anchors, at = root, 0, 0, 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            blocks.append((holder, text, linked >= len(text) * 0.8))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal holder, linked
        if text:
            if not parts or not text.isspace() and not any(map(str.strip, parts)):
                holder = stack[-1]
            parts.append(text)
            if anchors:
                linked += len(text)

    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            end_block()
        if m["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag in _FORMAT and stack[k].tag in _BLOCK:
                    break
            anchors = sum(node.tag == "a" for node in stack)
            continue
        ends = _ENDS.get(tag)
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    del stack[k:]
                    break
                if stack[k].tag in _BLOCK:
                    break
            anchors = sum(node.tag == "a" for node in stack)
        if tag == "br":
            parts.append(" ")
        elif tag not in _VOID:
            node = _child(stack[-1], tag, m["attrs"])
            if not m["attrs"].endswith("/") or tag in _BLOCK:
                stack.append(node)
                if tag == "a":
                    anchors += 1
                    node.links += 1
    rest = page[at:]
    add(rest)
    end_block()
    for node, text, is_link in blocks:
        node.chars += len(text)
        node.linked += len(text) * is_link
    return root, blocks


def matching(one: Node, two: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the number of matched nodes, and the pairs, of two trees whose roots match."""
    if not one.kids or not two.kids:
        return 1, [(one, two)]
    a, b = list(one.kids.values()), list(two.kids.values())
    if [x.name for x in a] == [x.name for x in b]:
        found = [matching(x, y) for x, y in zip(a, b, strict=True)]
        return 1 + sum(n for n, _ in found), [(one, two), *(p for _, pairs in found for p in pairs)]
    weight = {(i, j): matching(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if x.name == y.name}
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + weight[i, j][0] if (i, j) in weight else 0)
    pairs, i, j = [(one, two)], 0, 0
    while i < len(a) and j < len(b):
        if (i, j) in weight and best[i][j] == best[i + 1][j + 1] + weight[i, j][0]:
            pairs += weight[i, j][1]
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return 1 + best[0][0], pairs


_CONTAINERS = frozenset("html body div section main article aside nav header footer form table".split())
_DIGITS = re.compile(r"\d+")


def _outline(tree: Node) -> tuple[dict[int, tuple[int, bool, bool]], int]:
    """Path, whether in chrome and whether in a main region, by id of the node; and the layout."""
    places: dict[int, tuple[int, bool, bool]] = {}
    layout: list[int] = []
    stack = [(tree, 0, False, False)]
    while stack:
        x, path, chrome, main = stack.pop()
        path = xxhash.xxh64_intdigest(x.name, path)
        if x.tag in _CONTAINERS and not chrome and not main:
            layout.append(path)
        chrome, main = chrome or x.chrome, main or x.main
        places[id(x)] = (path, chrome, main)
        stack += [(kid, path, chrome, main) for kid in x.kids.values()]
    return places, _hash(repr(sorted(layout)))


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text, seed) >> 1


def outside_chrome(tree: Node, blocks: list[tuple[Node, str, bool]]) -> tuple[int, dict[int, str], dict[int, str]]:
    """The layout, the blocks outside chrome by hash of place and text, and those of them in the main region if it has any."""
    places, layout = _outline(tree)
    held: dict[int, str] = {}
    article: dict[int, str] = {}
    for node, text, _ in blocks:
        path, chrome, main = places[id(node)]
        if not chrome:
            key = _hash(text, path)
            held[key] = text
            if main:
                article[key] = text
    return layout, held, article or held


def _adopted(tree: Node, wrapper: Node) -> None:
    """Merges a page's tree into the wrapper: matched nodes add up, others are taken over."""
    matched = {id(x): y for x, y in matching(tree, wrapper)[1]}

    def walk(x: Node, y: Node) -> None:
        y.chars, y.linked, y.links, y.pages = y.chars + x.chars, y.linked + x.linked, y.links + x.links, y.pages + 1
        y.chrome, y.main = y.chrome or x.chrome, y.main or x.main
        for kid in x.kids.values():
            to = matched.get(id(kid)) or y.kids.get(kid.name)
            if to is None:
                to = y.kids[kid.name] = Node(kid.name, kid.tag, kid.chrome, kid.main)
            walk(kid, to)

    walk(tree, wrapper)


def induce(pages: list[str], constants: dict[int, set[int]]) -> Wrapper:
    """The wrapper of some pages of a host, from what is constant on all its pages."""
    wrapper = Wrapper(Node("", ""), constants)
    articles: list[set[str]] = []
    holders: dict[tuple[int, int], list[int]] = {}
    for page in pages:
        tree, blocks = parse(page)
        _adopted(tree, wrapper.tree)
        layout, held, article = outside_chrome(tree, blocks)
        template = wrapper.template(layout)
        words = {w for key, text in article.items() if key not in template for w in _DIGITS.sub("", text).split()}
        which = next((k for k, other in enumerate(articles) if 2 * len(words & other) >= len(words | other)), len(articles))
        if which == len(articles):
            articles.append(words)
        for scope in (0, layout):
            for key in constants.get(scope, set()) & held.keys():
                holders.setdefault((scope, key), []).append(which)
    revised = {x for x, of in holders.items() if len(of) > 1 and len(set(of)) == 1}
    everywhere = {key for key in constants.get(0, set()) if (0, key) not in revised}
    kept = {scope: {key for key in keys if (scope, key) not in revised} - (everywhere if scope else set()) for scope, keys in constants.items()}
    return Wrapper(wrapper.tree, {scope: keys for scope, keys in kept.items() if keys})


def _is_link_list(node: Node) -> bool:
    total, linked, links = 0, 0, 0
    stack = [node]
    while stack:
        x = stack.pop()
        total, linked, links = total + x.chars, linked + x.linked, links + x.links
        stack += x.kids.values()
    return links >= 3 and linked >= 0.9 * total > 0


def _regions(wrapper: Node) -> bool:
    """Whether some node that is no chrome, nor inside any, is marked as main."""
    stack = [wrapper]
    while stack:
        x = stack.pop()
        if x.main:
            return True
        stack += [k for k in x.kids.values() if not k.chrome]
    return False


def extract(page: str, wrapper: Wrapper) -> str:
    """The page's main text, blocks joined by a line end."""
    tree, blocks = parse(page)
    matched = {id(x): y for x, y in matching(tree, wrapper.tree)[1]}
    has_main = _regions(tree) or _regions(wrapper.tree)
    places, layout = _outline(tree)
    template = wrapper.template(layout)
    kept: dict[int, bool] = {}

    def walk(x: Node, y: Node | None, inside: bool, chrome: bool) -> None:
        chrome = chrome or x.chrome or y is not None and y.chrome
        chrome = chrome or x.tag == "header" and not inside or x.tag in ("ul", "ol", "table") and _is_link_list(y or x)
        inside = inside or x.main or y is not None and y.main
        kept[id(x)] = not chrome and (inside or not has_main)
        for kid in x.kids.values():
            walk(kid, matched.get(id(kid)), inside, chrome)

    walk(tree, wrapper.tree, False, False)
    return "\n".join(text for node, text, _ in blocks if kept[id(node)] and _hash(text, places[id(node)][0]) not in template)


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def articles(known: DataFrame) -> DataFrame:
    """host, layout, digest of the main text, page and its blocks outside chrome: a page for each article of a layout."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layouts, digests, held_by = [], [], []
            for page in batch["html"].to_pylist():
                layout, held, article = outside_chrome(*parse(page))
                layouts.append(layout)
                digests.append(_hash(_DIGITS.sub("", "\n".join(article.values()))))
                held_by.append(sorted(held))
            yield pa.RecordBatch.from_arrays([batch["host"], pa.array(layouts, pa.int64()), pa.array(digests, pa.int64()), batch["page"], pa.array(held_by, pa.list_(pa.int64()))],
                                             ["host", "layout", "digest", "page", "held"])

    rows = known.select("host", "page", "html").mapInArrow(run, "host string, layout long, digest long, page long, held array<long>")
    return rows.groupBy("host", "layout", "digest").agg(F.min(F.struct("page", "held")).alias("p")).select("host", "layout", "digest", "p.*")


def constants(different: DataFrame) -> DataFrame:
    """host, constants (layout, or 0 for all pages of the host, and block), counted over all articles."""
    spark = different.sparkSession
    scoped = different.where(F.size("held") > 0).withColumn("scope", F.explode(F.array(F.lit(0).cast("long"), "layout")))
    totals = store(spark, scoped.groupBy("host", "scope").agg(F.count("*").alias("all")).where(F.col("all") >= TEMPLATE_LEAST), "articles")
    counts = scoped.select("host", "scope", F.explode("held").alias("block")).groupBy("host", "scope", "block").agg(F.count("*").alias("n")).where(F.col("n") >= TEMPLATE_LEAST)
    most = counts.join(F.broadcast(totals) if totals.count() <= MOST_ROWS else totals, ["host", "scope"]).where(F.col("n") >= TEMPLATE_SHARE * F.col("all"))
    return most.groupBy("host").agg(F.collect_list(F.struct("scope", "block")).alias("constants"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of every host."""
    spark = pages.sparkSession
    known = pages.where("length(html) > 0").select(_host(F.col("url")).alias("host"), "html").withColumn("page", F.xxhash64("html"))
    different = store(spark, articles(known), "different")
    slot = different.groupBy("host", F.pmod("digest", F.lit(SLOTS)).alias("slot")).agg(F.min(F.struct("digest", "page")).alias("p"))
    some = F.slice(F.sort_array(F.collect_list("p")), 1, EXEMPLARS)  # of SLOTS rows of a host at most
    picked = store(spark, slot.groupBy("host").agg(some.alias("p")).select("host", F.explode("p.page").alias("page")), "exemplars")
    picked = F.broadcast(picked) if picked.count() <= MOST_ROWS else picked
    chosen = known.join(picked, ["host", "page"], "left_semi").dropDuplicates(["host", "page"])

    def learn(table: pa.Table) -> pa.Table:
        some = table.sort_by("page")
        found: dict[int, set[int]] = {}
        for x in some["constants"][0].as_py() or []:
            found.setdefault(x["scope"], set()).add(x["block"])
        return pa.table({"host": some["host"].slice(0, 1).cast(pa.string()), "wrapper": pa.array([induce(some["html"].to_pylist(), found).as_json()], pa.string())})

    with_constants = chosen.select("host", "page", "html").join(store(spark, constants(different), "constants"), "host", "left")
    return with_constants.groupBy("host").applyInArrow(learn, "host string, wrapper string")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row."""
    spark = pages.sparkSession
    learned = store(spark, wrappers(pages), "wrappers")
    if (learned.agg(F.sum(F.length("wrapper"))).first()[0] or 0) <= MOST_CHARACTERS:
        learned = F.broadcast(learned)
    rows = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host")).join(learned, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for page, host, wrapper in zip(batch["html"].to_pylist(), batch["host"].to_pylist(), batch["wrapper"].to_pylist(), strict=True):
                if host not in known:
                    known.clear() if len(known) > 2_000 else None
                    known[host] = Wrapper.of_json(wrapper)
                texts.append(extract(page or "", known[host]))
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return rows.select("page_id", "url", "html", "host", "wrapper").mapInArrow(run, "page_id long, url string, text string")
