"""Operator 10, main text of web pages by site style trees.

All pages of a host are merged into one tree of presentation nodes: a node
is the path of tags and classes that leads to an element. For every node the
pages give two distributions, of the layouts below it (sequences of child
tags) and of the texts in it. Their entropy, relative to the number of
elements seen, is the node's importance: near 0 if every page shows the
same, 1 if no two do. A parent's composite importance adds that of its
children. Branches of low importance are the site's furniture and are
removed from each page, together with the elements that HTML or their names
declare to be no article (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, comments). What remains of the page's article, or
else of its main part, or else of its body, is the text.

Names count as whole words of a class or id (``sidebar``), as the last word
of a class (``post-footer``, but not ``no-sidebar``) or with words that only
say what kind of box it is (``share-bar``). They do not speak for headings,
paragraphs and articles (but for comments and adverts made of articles), nor
for a box around the page's article, main part or (but for comments) most of
its text.

Inside an article or main part that the page declares nothing is removed for
low importance, so articles that a site shows on several pages stay whole.
In other pages a node whose elements hold more than half of the page's text
is never removed, nor are paragraphs, headings and list entries in the
innermost such box. Nodes seen fewer than ``MIN_SEEN`` times are kept.

Null and empty html give an empty text, null urls share one host. Broken
markup is read as far as it goes. Pages of a host with equal html count once
in the statistics. An empty table gives no rows. Work and memory for a page
grow with its length, however deeply its elements are nested.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import small_batches, table
from arrivo.session import cut_lineage

#: Importance below which a branch goes, decay of a node's own layout, and
#: elements that must be seen before a node is judged.
NOISE, GAMMA, MIN_SEEN = 0.3, 0.9, 8
COUNTER_ROWS = 200_000
#: Mean words of a link in a menu, at most.
MENU_WORDS = 4

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden|itemprop)(?=[\s=>/]|\Z)"
                  r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

# HTML's own lists of element names.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that end when another of the same list begins.
SIBLINGS = {t: frozenset(ts.split()) for ts in ("li", "dt dd", "td th", "tr", "option") for t in ts.split()}
ENDS_P = BLOCKS - {"body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SCOPE = frozenset("table ul ol dl td th article section div main body".split())
#: Elements that others end, and elements that end tags of others stop at.
ENDED = frozenset("p li dt dd tr option".split())
BARRIERS = frozenset("table article body".split())
CELLS = frozenset(["td", "th", "tr"])
#: Which of ENDED the beginning of an element ends.
ENDS = {t: SIBLINGS.get(t, frozenset()) | (frozenset(["p"]) if t in ENDS_P else frozenset())
        for t in {*SIBLINGS, *ENDS_P}}

# Elements and names that declare something other than an article.
NOISE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe svg canvas button select input textarea dialog "
    "menu object embed audio video map".split())
NOISE_NAMES = frozenset(
    "ad ads adbox adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu menus nav "
    "navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead topbar cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social "
    "related recommended recommendations comment comments commentlist disqus replies reply respond login search "
    "toolbar widget widgets pagination pager skip copyright disclaimer".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu".split())
#: Words that say where or what kind of box a compound name means, words that
#: say the box is somewhere else, and names of articles that are no article.
BOX_WORDS = frozenset(
    "site page main global primary secondary left right top bottom sticky js bar box block list link links button "
    "buttons icon icons area panel section container wrap wrapper inner outer item items row col column group unit "
    "slot strip zone form title header body posts articles stories".split())
NOT_HERE = frozenset("no not has have with without is hide hides hidden layout".split())
NO_ARTICLE = frozenset("ad ads advert advertisement comment comments reply replies".split())
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
UNNAMED_TAGS = frozenset("body html main p h1 h2 h3 h4 h5 h6".split())
HEADER = frozenset(["header", "site-header", "page-header"])
KEPT = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption".split())
NAME = re.compile(r"[a-z0-9]+")


def noise_name(name: str, is_id: bool, noise: frozenset = NOISE_NAMES) -> bool:
    """Whether a class or id names something other than an article."""
    words = NAME.findall(name)
    if not words or words[0] in NOT_HERE:
        return False
    kind = [w for w in words if w not in BOX_WORDS and not w.isdigit()]
    return bool(kind) and (all(w in noise for w in kind) or not is_id and words[-1] in noise)


def path_hash(above: int, label: str) -> int:
    return xxhash.xxh64_intdigest(f"{above}/{label}") >> 1


class Node:
    __slots__ = ("tag", "names", "noise", "named", "children", "parent", "depth", "barrier", "scope", "outermost", "path")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.names, self.noise, self.named = "", tag in NOISE_TAGS, False
        if attrs and not attrs.isspace():
            found = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTR.findall(attrs)}
            self.names = f"{found.get('class', '')} {found.get('id', '')}".strip().lower()
            role = found.get("role", "").lower()
            self.noise |= (role in NOISE_ROLES or "hidden" in found
                           or found.get("aria-hidden", "").lower() == "true"
                           or "display:none" in found.get("style", "").replace(" ", "").lower())
            if not self.noise and tag not in UNNAMED_TAGS:
                names = NO_ARTICLE if tag == "article" else NOISE_NAMES
                self.named = (any(noise_name(c, False, names) for c in found.get("class", "").lower().split())
                              or any(noise_name(c, True, names) for c in found.get("id", "").lower().split()))
                self.noise = self.named
            if role == "main" or found.get("itemprop", "").lower() == "articlebody":
                self.names += " main"
        if parent is None:
            self.path, self.depth, self.barrier, self.scope, self.outermost = path_hash(0, tag), 0, 0, self, {}
            return
        self.path = path_hash(parent.path, self.label)
        self.depth = depth = parent.depth + 1
        # depth of the innermost barrier and the innermost scope around (or
        # at) the element; the outermost elements of ENDED open inside that scope
        self.barrier = depth if tag in BARRIERS else parent.barrier
        if tag in SCOPE:
            self.scope, self.outermost = self, {}
        else:
            self.scope, self.outermost = parent.scope, parent.outermost
            if tag in ENDED and tag not in self.outermost:
                self.outermost = self.outermost | {tag: self}

    @property
    def label(self) -> str:
        """Tag and names, digits made alike so that numbered names merge."""
        return f"{self.tag}.{re.sub('[0-9]+', '0', self.names)}" if self.names else self.tag


def parse(text: str) -> Node:
    """Tree of elements; text nodes are plain strings. The work for a tag
    doesn't depend on the number of open elements."""
    root = here = Node("#root", "", None)
    opened: defaultdict[str, list[Node]] = defaultdict(list)  # open elements of each tag, outer ones first
    named = []

    def leave_to(ancestor: Node) -> Node:
        """End all elements below ``ancestor``."""
        at = here
        while at is not ancestor:
            opened[at.tag].pop()
            at = at.parent
        return at

    at, size = 0, len(text)
    while at < size:
        m = TOKEN.match(text, at)
        at = m.end()
        if m["text"]:
            here.children.append(m["text"])
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue  # a comment or declaration
        if m["end"] or m["end2"]:
            # the end of an inline element doesn't reach beyond a barrier
            if opened[tag] and (opened[tag][-1].depth >= here.barrier or tag in SCOPE or tag == "html"):
                here = leave_to(opened[tag][-1].parent)
            continue
        scope = here.scope
        if tag in CELLS and scope.tag in ("td", "th"):
            up = scope
            while up.parent is not None and up.tag not in ("tr", "table"):
                up = up.parent
            here = leave_to(up if tag != "tr" or up.tag != "tr" else up.parent)
        elif here.outermost and tag in ENDS:
            ended = [here.outermost[t] for t in ENDS[tag] if t in here.outermost]
            if ended:
                here = leave_to(min(ended, key=lambda n: n.depth).parent)
        node = Node(tag, m["attrs"] or m["attrs2"] or "", here)
        here.children.append(node)
        if node.named:
            named.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(text, at)
            at = end.start() if end else size
            if not end:
                continue
        elif tag in VOID or (m["attrs"] or "").endswith("/"):
            continue
        opened[tag].append(node)
        here = node
    _clear_names(root, [n for n in named if n.tag != "article" and any(
        not isinstance(c, str) and (c.tag in BLOCKS or c.tag == "br") for c in n.children)])
    return root


def _declares(node: Node) -> bool:
    return node.tag in ("article", "main") or node.names.endswith(" main")


def _held(root: Node, through: bool) -> dict[int, tuple[int, bool, bool]]:
    """For each element, by id: letters below it outside noise, and whether
    there is a main part and an article or main part; ``through``: boxes that
    only their names call noise count."""
    out: dict[int, tuple[int, bool, bool]] = {}
    sums = [(0, False, False)]  # of the elements being read
    stack: list = [root]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            sums[-1] = (sums[-1][0] + len(n.strip()), *sums[-1][1:])
        elif isinstance(n, tuple):
            node, own = n[0], sums.pop()
            out[id(node)] = own
            if (not node.noise or through and node.named and node.tag != "article") and node.tag not in RAW:
                size, main, declared = sums[-1]
                sums[-1] = (size + own[0], main or own[1] or _declares(node) and node.tag != "article",
                            declared or own[2] or _declares(node))
        else:
            sums.append((0, False, False))
            stack.append((n,))
            stack += n.children
    return out


def _clear_names(root: Node, named: list[Node]) -> None:
    """Boxes that only their names call noise, in order of the page, are no
    noise if they hold the main part, or the article of a page that has none
    outside of such boxes, or (like boxes of one parent together, and not
    if they are comments) more text than the page outside."""
    if not named:
        return
    # outer boxes come first, so what these say of a box still holds at its turn
    outside, through = _held(root, False), _held(root, True)
    rest, _, declared = outside[id(root)]
    groups: dict[tuple[int, str], list[Node]] = {}
    for node in named:
        groups.setdefault((id(node.parent), node.label), []).append(node)
    free = {id(root): True}  # whether an element is outside of all noise
    for nodes in groups.values():
        way, up = [], nodes[0].parent
        while id(up) not in free and not up.noise:
            way.append(up)
            up = up.parent
        clear = free.get(id(up), False)
        free.update((id(n), clear) for n in way)
        if not clear:
            continue  # inside other noise
        held = [through[id(n)] for n in nodes]
        much = sum(h[0] for h in held) > rest and not COMMENTS & set(NAME.findall(nodes[0].names))
        for node, (_, main, own) in zip(nodes, held):
            if much or main or own and not declared:
                node.noise = False
                rest += outside[id(node)][0]
        declared |= any(own and not n.noise for n, (_, _, own) in zip(nodes, held))


def text_of(node: Node) -> str:
    """Decoded text of the element itself and of inline elements below."""
    parts, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            parts.append(n)
        elif n.tag == "br":
            parts.append(" ")
        elif n is node or n.tag not in BLOCKS and not n.noise:
            stack += reversed(n.children)
    return " ".join(entities.unescape("".join(parts)).split())


def style_nodes(root: Node) -> Iterator[tuple[int, int, str, str]]:
    """(node, parent, layout, text) of every block element of a page."""
    stack = [root]
    while stack:
        node = stack.pop()
        below = [c for c in node.children if not isinstance(c, str)]
        if node.tag in BLOCKS:
            layout = []
            for c in below:
                if c.tag in BLOCKS and layout[-1:] != [c.label]:
                    layout.append(c.label)
            yield node.path, node.parent.path if node.parent else 0, " ".join(layout), text_of(node)
        stack += [c for c in below if c.tag not in RAW]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()

    def rows() -> pd.DataFrame:
        out = pd.DataFrame([(*k, n) for k, n in seen.items()],
                           columns=["host", "node", "parent", "layout", "value", "n"])
        seen.clear()
        return out

    for pdf in batches:
        for host, text, share in zip(pdf["host"], pdf["html"], pdf["share"]):
            for node, parent, layout, own in style_nodes(parse(text)):
                seen[host, node, parent, True, xxhash.xxh64_intdigest(layout) >> 1] += share
                if own:
                    seen[host, node, parent, False, xxhash.xxh64_intdigest(own) >> 1] += share
        if len(seen) > COUNTER_ROWS:
            yield rows()
    if seen:
        yield rows()


def _noisy(pdf: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one host whose composite importance is low."""
    own: dict[int, dict[bool, tuple[float, int]]] = {}
    parent = {}
    for node, above, layout, importance, seen in zip(
            pdf["node"], pdf["parent"], pdf["layout"], pdf["importance"], pdf["seen"]):
        own.setdefault(node, {})[layout] = (importance, seen)
        parent[node] = above
    children: dict[int, list[int]] = {}
    for node, above in parent.items():
        children.setdefault(above, []).append(node)
    composite: dict[int, float] = {}
    todo = [(n, False) for n in parent if parent[n] not in parent]
    while todo:
        node, ready = todo.pop()
        if not ready:
            todo.append((node, True))
            todo += [(c, False) for c in children.get(node, [])]
            continue
        parts = [(composite[c], own[c].get(True, (0, 1))[1]) for c in children.get(node, [])]
        parts += [own[node][False]] if False in own[node] else []
        layout = own[node].get(True, (1.0, 1))[0]
        if not parts:
            composite[node] = layout
            continue
        below = sum(v * n for v, n in parts) / sum(n for _, n in parts)
        kinds = len(children.get(node, []))
        composite[node] = (1 - GAMMA ** kinds) * layout + GAMMA ** kinds * below
    return pd.DataFrame({"host": pdf["host"].iloc[0], "noisy": [[n for n, v in composite.items() if v < NOISE]]})


def with_host(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and null html made empty."""
    host = F.regexp_extract(F.lower(F.coalesce(F.col("url"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return pages.withColumns({"host": host, "html": F.coalesce(F.col("html"), F.lit(""))})


def site_noise(pages: DataFrame) -> DataFrame:
    """(host, noisy): the low-importance nodes of each host's style tree.
    Layouts and texts are counted in the tasks, then over the whole table;
    one host's group holds one row for each node of its tree, however many
    pages it has. A page counts ``share`` times if there is such a column."""
    if "share" not in pages.columns:
        pages = pages.withColumn("share", F.lit(1.0))
    counts = with_host(pages).select("host", "html", "share").mapInPandas(
        _counted, "host string, node long, parent long, layout boolean, value long, n double")
    n = F.col("n")
    # the shares of a page's copies make a whole
    values = counts.groupBy("host", "node", "parent", "layout", "value").agg(F.round(F.sum("n")).alias("n"))
    nodes = values.groupBy("host", "node", "parent", "layout").agg(
        F.sum("n").alias("seen"), F.sum(n * F.log(n.cast("double"))).alias("s")).filter(F.col("seen") >= MIN_SEEN)
    seen = F.col("seen").cast("double")
    return nodes.withColumn("importance", 1 - F.col("s") / (seen * F.log(seen))).groupBy("host").applyInPandas(
        _noisy, "host string, noisy array<long>").filter(F.size("noisy") > 0)


def shared(pages: DataFrame) -> DataFrame:
    """host, url, html and share: one over the number of pages of the host
    with equal html. Only hashes are grouped; html moves only if so many
    contents are copied that Spark does not broadcast their hashes."""
    keyed = with_host(pages).select("host", "url", "html").withColumn("key", F.xxhash64("host", "html"))
    copies = cut_lineage(keyed.groupBy("key").agg(F.count("*").alias("copies")).filter("copies > 1"), "page-copies")
    return keyed.join(copies.withColumnRenamed("key", "of"), F.col("key") == F.col("of"), "left").select(
        "url", "html", (1 / F.coalesce("copies", F.lit(1))).alias("share"))


def _roots(tree: Node) -> list[Node]:
    """The page's articles, else its main parts, else its body or all. Of
    several articles, those that are links for the most part are teasers."""
    articles, mains, bodies = [], [], []
    stack = [(tree, False)]
    while stack:
        node, inside = stack.pop()
        if isinstance(node, str) or node.noise:
            continue
        if node.tag == "article":
            articles.append(node)
            continue
        if node.tag == "main" or node.names.endswith(" main"):
            if not inside:
                mains.append(node)
            inside = True
        if node.tag == "body":
            bodies.append(node)
        stack += [(c, inside) for c in reversed(node.children)]
    if len(articles) > 1:
        links = linked_text(tree)
        articles = [a for a in articles if not _is_teaser(links[id(a)])] or articles
    return articles or mains or bodies[:1] or [tree]


def linked_text(tree: Node) -> dict[int, tuple[int, int, int, int]]:
    """For each element, by id: its letters, and below it the links, the
    letters inside links and the words inside links."""
    out: dict[int, tuple[int, int, int, int]] = {}
    sums = [[0, 0, 0, 0, 0]]  # letters, words, links, letters and words in links, of the elements being read
    stack: list = [tree]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            sums[-1][0] += len(n.strip())
            sums[-1][1] += len(n.split())
        elif isinstance(n, tuple):
            node, own = n[0], sums.pop()
            out[id(node)] = (own[0], *own[2:])
            if node.tag == "a":
                own[2:] = own[2] + 1, own[0], own[1]
            sums[-1] = [a + b for a, b in zip(sums[-1], own)]
        else:
            sums.append([0, 0, 0, 0, 0])
            stack.append((n,))
            stack += n.children
    return out


def _is_teaser(held: tuple[int, int, int, int]) -> bool:
    total, links, linked, _ = held
    return links > 0 and linked >= 0.8 * total


def _mostly_links(held: tuple[int, int, int, int]) -> bool:
    """A list or box of at least two short links and little else; longer
    ones, as of a list of references, are left to the site's statistics."""
    total, links, linked, spaced = held
    return links >= 2 and linked >= 0.8 * total and spaced <= MENU_WORDS * links


def bulk(root: Node, skipped: Callable[[Node], bool]) -> tuple[set[int], int | None]:
    """Nodes below ``root`` whose elements together hold more than half of
    its text, and the innermost of them that is one box."""
    held: dict[int, int] = {}
    boxes: dict[int, int] = {}  # depth of each box
    times: Counter = Counter()
    sizes, stack = [0], [root]  # letters of the elements being read
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            sizes[-1] += len(node.strip())
        elif isinstance(node, tuple):
            size = sizes.pop()
            held[node[0].path] = held.get(node[0].path, 0) + size
            sizes[-1] += size
        elif node is root or not skipped(node):
            if node is not root and node.tag in BLOCKS:
                stack.append((node,))
                sizes.append(0)
                times[node.path] += 1
                if node.tag not in KEPT:
                    boxes[node.path] = len(sizes)
            stack += node.children
    most = {n for n, size in held.items() if 2 * size > sizes[0]}
    return most, max((n for n in most & boxes.keys() if times[n] == 1), key=boxes.get, default=None)


def main_text(html: str, noisy: frozenset[int] = frozenset()) -> str:
    """Text blocks of the page's article, joined by blank lines."""
    tree = parse(html)
    roots = _roots(tree)
    declared = roots[0].tag not in ("body", "#root")
    links = {} if declared else linked_text(tree)
    blocks, parts = [], []

    def flush() -> None:
        block = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if block:
            blocks.append(block)

    def skipped(node: Node) -> bool:
        return node.noise or node.tag in RAW or not declared and (
            node.tag == "header" or node.names in HEADER
            or node.tag in ("ul", "ol", "div", "table", "section") and _mostly_links(links[id(node)]))

    for root in roots:
        most, box = bulk(root, skipped) if noisy and not declared else (set(), None)
        stack: list = [(root, False)]
        while stack:
            node, inside = stack.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                parts.append(node)
            elif node.tag in ("br", "hr"):
                parts.append(" ")
            elif node is not root and skipped(node):
                if node.tag in BLOCKS:
                    flush()
            else:
                here = node.path
                if (not declared and node is not root and here in noisy and node.tag in BLOCKS and here not in most
                        and not (inside and node.tag in KEPT)):
                    flush()
                    continue
                if node.tag in BLOCKS:
                    flush()
                    stack.append((None, False))
                inside = inside or here == box
                stack += [(c, inside) for c in reversed(node.children)]
        flush()
    return "\n\n".join(blocks)


def extracted(html: Column, noisy: Column) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, nodes in batches:
            yield pd.Series([main_text(t, frozenset(map(int, n)) if isinstance(n, (list, np.ndarray)) else frozenset())
                             for t, n in zip(texts, nodes)], dtype="object")

    return run(html, noisy)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    small_batches(pages.sparkSession)
    noise = cut_lineage(site_noise(shared(pages)), "site-noise").withColumnRenamed("host", "of")
    # one row for each host with noise; Spark joins by its size on disk
    hosted = with_host(pages).select("page_id", "url", "html", "host")
    joined = hosted.join(noise, F.col("host") == F.col("of"), "left")
    return joined.select("page_id", "url", extracted(F.col("html"), F.col("noisy")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
