"""HTML extraction by wrapper induction.

Pages of one host are parsed to trees of their block elements (labels: tag, classes and
role). ``REFERENCES`` pages of a host, those of the lowest digests, give its reference
trees, and every page of the host is aligned with each of them by simple tree matching
(``alignment``). Spark counts, for each node of a reference tree, the pages that have it
and those that have it with the same text. Nodes that are the same on
``STEADY`` of their pages, and on ``LEAST_PAGES`` different ones, are the template. Pages
are aligned with their host's template again: a node that meets a constant one and has its
text goes, all others are content. What a page itself marks as its article is content at all
times. Navigation, adverts, forms and the like, by tag or by a whole class or role, are
template at all times if they lie outside the article and do not hold it; inside it,
those named by class or role go only where the template finds them constant. A ``main``
that holds an article is not the article.

The reference trees are a bounded sample: of a reference page ``REFERENCE_NODES`` nodes at most,
level by level, and of the neighbours with one label half of ``ALIKE`` from either end. Blocks that
none of them holds, or that meet another of their label, are found without them: Spark counts every
block of every page by its path of labels and its text, and one whose text stands on ``STEADY`` of the
pages with its path, and on ``LEAST_PAGES`` different ones, is template too (``steady_keys``). Trees
are walked with stacks of their own, so nesting may be of any depth.

Copies of a page count once for ``LEAST_PAGES``, so they don't turn their text into template.

Defined results: a null or empty html gives an empty text; a null or malformed url
belongs to the host with the empty name; repeated rows are pages of their own but
count once for a template; unclosed and stray tags are tolerated; very long pages are
read whole; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.alignment import Tree, bounded, matching, packed, unpacked
from tallywatch.session import written

LEAST_PAGES = 5
#: Share of the pages with a node that must have its text.
STEADY = 0.9
REFERENCES = 3
REFERENCE_NODES = 2000
ALIKE = 32
#: Bounds of what a task holds before it hands rows on.
HELD_BYTES = 64_000_000
HELD_NODES = 200_000
HELD_TREES = 1000

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea iframe svg annotation-xml annotation select title object".split()
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math semantics mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup "
    "munder mover munderover mmultiscripts mtable mtr mtd mspace".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_EDGE = {"ul", "ol", "dl", "table", "menu"}
LEFT_OUT = set("nav footer aside form button dialog menu head".split())
ARTICLE = {"article", "main"}
# Classes and roles that name parts beside an article.
NAMED = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside nav navbar navigation "
    "menu breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay comment comments "
    "disqus respond reply replies related recommended share sharing social newsletter subscribe subscription signup login search "
    "pagination pager toolbar widget complementary contentinfo dialog skip".split()
)
NAMED_OUTSIDE = {"header", "masthead", "topbar", "branding"}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
ATTR = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPLIT = re.compile(r"[^a-z]+")
#: Elements that may stand around the article of a page.
AROUND = {"form", "header"}


class Node:
    """``article``: 2 an article, 1 a main; ``beside``: tag or name says that it is no content; ``named``: a class or role does.

    ``settle`` fills in ``gone`` (left out) and ``fixed`` (no template applies to it).
    """

    __slots__ = ("article", "beside", "children", "fixed", "gone", "holds", "label", "named", "tag")

    def __init__(self, tag: str, label: str, article: int = 0, beside: bool = False, named: bool = False):
        self.tag, self.label, self.article, self.beside, self.named = tag, label, article, beside, named
        self.holds = self.gone = self.fixed = False
        self.children: list[Node | str] = []


def opened(tag: str, attrs: str) -> Node:
    said = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower().split()) for m in ATTR.finditer(attrs)] if attrs.strip() else []
    names = {w for kind, words in said if kind != "id" for w in words}
    marks = [set(SPLIT.split(w)) for _, words in said for w in words] if tag in ("div", "section") else []
    article = 2 if tag == "article" or any("article" in m and not m & NAMED for m in marks) else int(tag == "main")
    named = not article and tag not in ("html", "body") and bool(names & NAMED)
    beside = named or tag in LEFT_OUT or not article and tag not in ("html", "body") and (tag == "header" or bool(names & NAMED_OUTSIDE))
    words = {x for kind, values in said if kind != "id" for w in values for x in SPLIT.split(w) if x}
    return Node(tag, " ".join([tag, *sorted(words)]), article, beside, named)


def settle(root: Node) -> Node:
    """Decides for each element whether it is left out and whether it is a slot at all times."""
    order, stack = [], [(root, False)]
    free = False
    while stack:
        node, below = stack.pop()
        order.append(node)
        free = free or node.article > 0 and not below
        stack += [(c, below or node.beside) for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        node.holds = any(c.article or c.holds for c in node.children if isinstance(c, Node))
    # If every article lies in something that would go, its surroundings stay.
    stack = [(root, False, False, False)]
    while stack:
        node, gone, inside, slot = stack.pop()
        inside = inside or node.article == 2 or node.article == 1 and not node.holds
        slot = slot or node.article > 0
        around = node.holds and not free and (node.named or node.tag not in LEFT_OUT or node.tag in AROUND)
        if node.tag in LEFT_OUT:
            node.gone = gone or not around
        else:
            node.gone = gone or node.beside and not inside and not around
        if node.named and slot:
            slot = False
        node.fixed = slot
        stack += [(c, node.gone, inside, slot) for c in node.children if isinstance(c, Node)]
    return root


def parse(html: str) -> Node:
    """Tree of block elements; text stands between them as strings, references undecoded."""
    root = Node("", "")
    stack, at = [root], 0
    kept: list[int] = []

    def say(text: str) -> None:
        if text:
            stack[-1].children.append(text)

    for m in TAG.finditer(html):
        say(html[at : m.start()])
        at = m.end()
        tag = (m["name"] or "").lower()
        if not tag:
            continue
        # Inline elements are told by name only outside of articles and code.
        while kept and (kept[-1] >= len(stack)):
            kept.pop()
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr", "wbr", "img"):
                say("" if tag == "wbr" else " ")
                if tag == "hr":
                    stack[-1].children.append(Node("hr", "hr"))
            elif m["attrs"] and not m["end"] and tag not in VOID and not kept and opened(tag, m["attrs"]).named:
                stack.append(opened(tag, m["attrs"]))
                stack[-2].children.append(stack[-1])
            elif m["end"] and stack[-1].tag == tag:
                stack.pop()
            continue
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P and stack[-1].tag == "p":
            stack.pop()
        same = SAME_LEVEL.get(tag)
        if same:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in LIST_EDGE:
                    break
                if stack[k].tag in same:
                    del stack[k:]
                    break
        node = opened(tag, m["attrs"] or "")
        stack[-1].children.append(node)
        if not (m["attrs"] or "").endswith("/"):
            if node.article or tag == "pre":
                kept.append(len(stack))
            stack.append(node)
    say(html[at:])
    return settle(root)


def own_text(node: Node) -> str:
    return " ".join("".join(c for c in node.children if isinstance(c, str)).split())


def outline(root: Node) -> tuple[Tree, list[Node]]:
    """The nodes that a template may hold and those above them, level by level, with digests of their texts."""
    order = [root]
    for node in order:
        order += [c for c in node.children if isinstance(c, Node) and not c.gone]
    wanted = {id(root)}
    for node in reversed(order):
        if not node.fixed or any(id(c) in wanted for c in node.children):
            wanted.add(id(node))
    nodes = [n for n in order if id(n) in wanted]
    at = {id(n): k for k, n in enumerate(nodes)}
    children = [[at[id(c)] for c in n.children if id(c) in at] for n in nodes]
    return Tree([n.label for n in nodes], [text_digest(n) for n in nodes], children), nodes


def text_digest(node: Node) -> str:
    text = own_text(node)
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest() if text else ""


def page_digest(html: str) -> bytes:
    return hashlib.blake2b(html.encode("utf-8", "replace"), digest_size=12).digest()


def constant_nodes(root: Node, template: list[tuple[Tree, frozenset[int]]]) -> set[int]:
    """Identities of the nodes that meet a constant node of the template and have its text."""
    if not template:
        return set()
    tree, nodes = outline(root)
    met = ((one, b) for one, constant in template for a, b in matching(one, tree) if a in constant and one.texts[a] == tree.texts[b])
    return {id(nodes[b]) for _, b in met if not nodes[b].fixed}


def node_keys(root: Node) -> dict[int, bytes]:
    """Digests of path and text, eight bytes each, by the identity of each node that a template may hold."""
    found = {}
    stack = [(root, b"")]
    while stack:
        node, above = stack.pop()
        path = hashlib.blake2b(above + node.label.encode(), digest_size=8).digest()
        text = "" if node.fixed else text_digest(node)
        if text:
            found[id(node)] = path + bytes.fromhex(text)
        stack += [(c, path) for c in node.children if isinstance(c, Node) and not c.gone]
    return found


def content(root: Node, constant: set[int]) -> str:
    """Blocks of the nodes that vary, in page order."""
    blocks: list[str] = []

    def flush(parts: list[str]) -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            blocks.append(text)

    parts: list[str] = []
    stack = [(root, iter(root.children))]
    while stack:
        node, rest = stack[-1]
        for child in rest:
            if isinstance(child, str):
                if id(node) not in constant:
                    parts.append(child)
            elif child.gone:
                if child.tag not in INLINE:
                    flush(parts)
            else:
                flush(parts)
                stack.append((child, iter(child.children)))
                break
        else:
            flush(parts)
            stack.pop()
    return "\n\n".join(blocks)


def references(pages: DataFrame) -> DataFrame:
    """``host, trees``: outlines of the pages of the lowest digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowest: dict[str, dict[bytes, str]] = {}
        held = 0

        def rows() -> pa.RecordBatch:
            out = [(host, page, packed(bounded(outline(parse(html))[0], REFERENCE_NODES, ALIKE))) for host, own in lowest.items() for page, html in own.items()]
            lowest.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or [()] * 3, schema, strict=True)], schema=schema)

        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if not html:
                    continue
                own, page = lowest.setdefault(host, {}), page_digest(html)
                if page in own or len(own) == REFERENCES and page > max(own):
                    continue
                own[page] = html
                held += len(html)
                if len(own) > REFERENCES:
                    held -= len(own.pop(max(own)))
                if held > HELD_BYTES:
                    yield rows()
                    held = 0
        yield rows()

    schema = pa.schema([("host", pa.string()), ("page", pa.binary()), ("tree", pa.string())])
    found = pages.select("host", "html").mapInArrow(run, "host string, page binary, tree string").dropDuplicates(["host", "page"])
    ranked = found.withColumn("nth", F.row_number().over(Window.partitionBy("host").orderBy("page"))).filter(F.col("nth") <= REFERENCES)
    return ranked.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("nth", "tree"))).alias("refs")).select("host", F.col("refs.tree").alias("trees"))


def node_rows(pages: DataFrame) -> DataFrame:
    """``host, nth, node, page, met, same``: pages that meet a node of the host's nth tree, and that have its text.

    A task adds the digests of ``LEAST_PAGES`` pages a node at most, its sums on the first of these rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int, int], list] = {}
        trees: dict[str, Tree] = {}

        def rows() -> pa.RecordBatch:
            out = [(*key, page, 0 if k else met, 0 if k else same) for key, (met, same, own) in found.items() for k, page in enumerate(sorted(own) or [None])]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or [()] * 6, schema, strict=True)], schema=schema)

        for batch in batches:
            for host, html, said in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "trees")), strict=True):
                if not said or not html:
                    continue
                page, (tree, _) = page_digest(html), outline(parse(html))
                for nth, text in enumerate(said):
                    one = recalled(trees, text)
                    for a, b in matching(one, tree):
                        if one.texts[a]:
                            node = found.setdefault((host, nth, a), [0, 0, set()])
                            node[0] += 1
                            if one.texts[a] == tree.texts[b]:
                                node[1] += 1
                                if len(node[2]) < LEAST_PAGES:
                                    node[2].add(page)
                if len(found) > HELD_NODES:
                    yield rows()
        yield rows()

    schema = pa.schema([("host", pa.string()), ("nth", pa.int32()), ("node", pa.int32()), ("page", pa.binary()), ("met", pa.int64()), ("same", pa.int64())])
    return pages.select("host", "html", "trees").mapInArrow(run, "host string, nth int, node int, page binary, met long, same long")


def recalled(trees: dict[str, Tree], text: str) -> Tree:
    if text not in trees:
        if len(trees) >= HELD_TREES:
            trees.clear()
        trees[text] = unpacked(text)
    return trees[text]


def templates(pages: DataFrame) -> DataFrame:
    """``host, template``: reference trees and their nodes that are constant; hosts without such nodes are left out."""
    trees = written(references(pages), "page-references")
    by_page = node_rows(pages.join(trees, "host")).groupBy("host", "nth", "node", "page").agg(F.sum("met").alias("met"), F.sum("same").alias("same"))
    by_node = by_page.groupBy("host", "nth", "node").agg(F.count("page").alias("pages"), F.sum("met").alias("met"), F.sum("same").alias("same"))
    steady = by_node.filter((F.col("pages") >= LEAST_PAGES) & (F.col("same") >= STEADY * F.col("met")))
    by_tree = steady.groupBy("host", "nth").agg(F.sort_array(F.collect_list("node")).alias("constant"))
    named = by_tree.join(trees, "host").select("host", "nth", F.expr("trees[nth]").alias("tree"), "constant")
    return named.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("nth", "tree", "constant"))).alias("template"))


def steady_keys(pages: DataFrame) -> DataFrame:
    """``host, page, keys``: of each different page, the nodes (``node_keys``) whose text is constant on their path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sorted(set(node_keys(parse(html)).values())) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(keys, pa.list_(pa.binary()))], ["host", "page", "keys"])

    found = pages.filter(F.length("html") > 0).select("host", "page", "html").mapInArrow(run, "host string, page string, keys array<binary>")
    by_page = written(found.filter(F.size("keys") > 0).dropDuplicates(["host", "page"]), "page-keys")
    nodes = by_page.select("host", "page", F.explode("keys").alias("key")).withColumn("path", F.substring("key", 1, 8))
    met = nodes.select("host", "path", "page").distinct().groupBy("host", "path").agg(F.count("*").alias("met"))
    same = nodes.groupBy("host", "path", "key").agg(F.count("*").alias("same")).filter(F.col("same") >= LEAST_PAGES)
    steady = written(same.join(met, ["host", "path"]).filter(F.col("same") >= STEADY * F.col("met")).select("host", "key"), "page-steady")
    return nodes.join(steady, ["host", "key"]).groupBy("host", "page").agg(F.sort_array(F.collect_list("key")).alias("keys"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, and ``n_constant``, the elements that the host's template took from it."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    known = pages.select("page_id", "url", "html", host.alias("host"), F.md5("html").alias("page"))
    patterns = written(templates(known), "page-templates")
    steady = written(steady_keys(known), "page-constant")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Tree] = {}
        for batch in batches:
            texts, counts = [], []
            for html, template, keys in zip(*(batch.column(c).to_pylist() for c in ("html", "template", "keys")), strict=True):
                root = parse(html or "")
                constant = constant_nodes(root, [(recalled(trees, t["tree"]), frozenset(t["constant"])) for t in template or ()])
                if keys:
                    same = set(keys)
                    constant.update(node for node, key in node_keys(root).items() if key in same)
                texts.append(content(root, constant))
                counts.append(len(constant))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["page_id", "url", "text", "n_constant"])

    kind = dict(pages.dtypes)["page_id"]
    joined = known.join(steady, ["host", "page"], "left").join(patterns, "host", "left")
    texts = joined.select("page_id", "url", "html", "template", "keys").mapInArrow(run, f"page_id {kind}, url string, text string, n_constant long")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_constant")
