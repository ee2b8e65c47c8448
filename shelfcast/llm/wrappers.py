"""Main text of web pages, by wrappers inferred for each host.

A page becomes a stream of nested tags with text between them. Aligning the streams of a host
yields one union-free regular expression: neighbouring repeats of a tag become a repeated group,
tags that only some pages have an optional group, and differing texts a text slot (equal texts
stay part of the template). Tasks align the pages they see, host by host, and the few partial
wrappers of a host are aligned with each other, so no host's pages meet in one task.

A host's wrapper marks its article: the tags that name one, else the group that holds most text
outside of links. A page is aligned with its wrapper; texts in the article's slots remain.
Navigation, page headers and footers, sidebars, notices, adverts, forms, scripts, styles and
comments never are part of the article, and outside of named articles template texts are not.

Null and empty pages give an empty text. Pages without a wrapper's article (a broken or odd page)
are read as if they were alone on their host. Repeated rows are extracted alike. An empty table
gives an empty table. Broken markup ends at the end of the page. Columns named like results are
replaced.
"""

from __future__ import annotations

import html
import json
import re
import sys
import zlib
from collections import Counter
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import written

SALTS = 32  # parts into which pages of a host are dealt to meet their wrapper
LEAST_PAGES = 3  # distinct pages of equal text that make a text part of the template
SHARE = 20  # and so many percent of the host's distinct pages
DEEPEST = 100_000_000  # calls inside each other; a page's own length bounds its levels

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template svg iframe select".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split())
_NEVER = frozenset("nav footer aside form script style noscript template svg iframe select button textarea title head menu dialog object canvas".split())
_CLUTTER = frozenset(
    "ad ads adv advert adverts advertisement advertising promo promotion sponsor sponsored banner cookie cookies consent notice notices "
    "gdpr popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer comment comments commentlist reply replies disqus respond share sharing social related recommended recommendations widget "
    "toolbar pagination pager masthead alert complementary contentinfo search".split())
_ARTICLE = frozenset("article articlebody story post entry main".split())
_ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li".split())


class Node:
    """A tag with what it holds, of one page or of a wrapper. ``text``: checksum of the text it
    holds directly (None: none; -1: differs between pages), and on how many pages."""

    __slots__ = ("key", "children", "repeated", "optional", "text", "pages", "chars", "linked", "here")

    def __init__(self, key: str):
        self.key, self.children, self.repeated, self.optional = key, [], False, False
        self.text, self.pages, self.chars, self.linked = None, 0, 0, 0
        self.here: list[str] = []

    def dump(self) -> list:
        """The tree as a flat list of tags, each before what it holds, with the number of its children."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            out.append([node.key, node.repeated, node.optional, node.text, node.pages, node.chars, node.linked, len(node.children)])
            stack.extend(reversed(node.children))
        return out

    @staticmethod
    def read(parts: list) -> Node:
        root = Node("")
        waiting = [[root, 1]]  # tags with the number of children still to come
        for key, repeated, optional, text, pages, chars, linked, children in parts:
            node = Node(key)
            node.repeated, node.optional, node.text, node.pages, node.chars, node.linked = repeated, optional, text, pages, chars, linked
            while not waiting[-1][1]:
                waiting.pop()
            waiting[-1][0].children.append(node)
            waiting[-1][1] -= 1
            waiting.append([node, children])
        return root.children[0]

    @property
    def tag(self) -> str:
        return self.key.partition(".")[0]


def tag_key(tag: str, attributes: str) -> str:
    """The tag with the words that matter of its class, id and role."""
    if not attributes:
        return tag
    words = {w.lower() for m in _ATTRIBUTE.finditer(attributes) for w in _NAME.findall(m[2] or m[3] or m[4] or "")}
    marks = sorted(words & (_CLUTTER | _ARTICLE | {"header"}))
    joined = re.sub(r"[^a-z]", "", "".join(m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)).lower())
    if "articlebody" in joined:
        marks.append("articlebody")
    if _HIDDEN.search(attributes):
        marks.append("hidden")
    return ".".join([tag, *marks])


def clutter(key: str) -> bool:
    tag, *marks = key.split(".")
    return tag in _NEVER or any(m in _CLUTTER or m == "hidden" for m in marks)


def parse(page: str) -> tuple[Node, list[tuple[str, list[Node], bool]]]:
    """The tree of a page and its texts in order: (block text, tags around it)."""
    root = Node("")
    path, texts, pieces = [root], [], []
    opened: Counter[str] = Counter()  # tags on the path
    links, linked, at = 0, 0, 0
    muted, depth = "", 0  # an inline tag that is clutter, inside a block

    def end_block() -> None:
        nonlocal linked, muted
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            texts.append((text, path[-1:], 2 * linked > len(text)))
        pieces.clear()
        linked, muted = 0, ""

    def close() -> None:
        opened[path.pop().tag] -= 1

    def leave(tag: str) -> None:
        if opened[tag]:
            while path[-1].tag != tag:
                close()
            close()

    while at < len(page):
        m = _MARKUP.search(page, at)
        to = m.start() if m else len(page)
        if to > at and not muted:
            pieces.append(page[at:to])
            linked += (to - at) * (links > 0)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in _INLINE:
            if tag == muted:
                depth += -1 if m[1] else 1
                muted = muted if depth else ""
            elif not muted and not m[1] and m[3] and clutter(tag_key(tag, m[3])) and tag not in _VOID:
                muted, depth = tag, 1
            if tag == "a":
                links = max(0, links - 1) if m[1] else links + 1
            elif tag == "br":
                pieces.append(" ")
            continue
        end_block()
        links = 0
        if m[1]:
            leave(tag)
            continue
        if tag in _VOID:
            continue
        if tag in _RAW:
            if tag == "svg" and m[3].endswith("/"):  # a slash closes no other of these
                continue
            closing = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if tag in _ENDS_P and path[-1].tag == "p":
            close()
        if tag in ("li", "tr", "td", "th", "dt", "dd", "option") and path[-1].tag == tag:
            close()
        node = Node(tag_key(tag, m[3]))
        path[-1].children.append(node)
        path.append(node)
        opened[node.tag] += 1
    end_block()
    for text, around, link in texts:
        holder = around[-1]
        holder.pages, holder.chars, holder.linked = 1, holder.chars + len(text), holder.linked + len(text) * link
        holder.text = zlib.crc32(text.encode(), holder.text or 0)
    return root, texts


def groups(children: list[Node]) -> list[tuple[str, list[Node]]]:
    """Neighbours of the same tag as one group."""
    made: list[tuple[str, list[Node]]] = []
    for child in children:
        if made and made[-1][0] == child.key:
            made[-1][1].append(child)
        else:
            made.append((child.key, [child]))
    return made


def folded(node: Node) -> Node:
    """The expression of one page: neighbouring repeats of a tag become a repeated group."""
    out = Node(node.key)
    out.repeated, out.optional, out.text, out.pages, out.chars, out.linked = (
        node.repeated, node.optional, node.text, node.pages, node.chars, node.linked)
    for _, same in groups(node.children):
        first = folded(same[0])
        for other in same[1:]:
            first = aligned(first, folded(other), within=True)
            first.repeated = True
        out.children.append(first)
    return out


def prefix_lengths(x: list[str], y: list[str]) -> list[int]:
    """Length of a longest common subsequence of x and each beginning of y, with the rows of the
    table as bits of one number."""
    places: dict[str, int] = {}
    for j, key in enumerate(y):
        places[key] = places.get(key, 0) | 1 << j
    full = (1 << len(y)) - 1
    row = full
    for key in x:
        met = row & places.get(key, 0)
        row = (row + met | row - met) & full
    out = [0]
    for bit in reversed(format(row, f"0{len(y)}b")):
        out.append(out[-1] + (bit == "0"))
    return out


def longest(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; long lists are halved first, so the table is small."""
    if not x or not y:
        return []
    if len(x) * len(y) > 100_000 and len(x) > 1:
        half = len(x) // 2
        ahead, behind = prefix_lengths(x[:half], y), prefix_lengths(x[:half - 1:-1], y[::-1])
        cut = max(range(len(y) + 1), key=lambda j: ahead[j] + behind[len(y) - j])
        return longest(x[:half], y[:cut]) + [(half + i, cut + j) for i, j in longest(x[half:], y[cut:])]
    lengths = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            lengths[i][j] = lengths[i + 1][j + 1] + 1 if x[i] == y[j] else max(lengths[i + 1][j], lengths[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif lengths[i + 1][j] >= lengths[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a common subsequence: a longest one between what both begin and end with."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    pairs = [(k, k) for k in range(head)] + [(head + i, head + j) for i, j in longest(x, y)]
    return pairs + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def aligned(a: Node, b: Node, within: bool = False) -> Node:
    """The expression that covers both: tags that only one has become optional."""
    out = Node(a.key)
    out.repeated, out.optional = a.repeated or b.repeated, a.optional or b.optional
    out.text = b.text if a.text is None else a.text if b.text is None else a.text if a.text == b.text else -1
    out.pages = max(a.pages, b.pages) if within else a.pages + b.pages
    out.chars, out.linked = a.chars + b.chars, a.linked + b.linked
    i = j = 0
    for x, y in [*common([c.key for c in a.children], [c.key for c in b.children]), (len(a.children), len(b.children))]:
        for rest in (*a.children[i:x], *b.children[j:y]):
            rest.optional = True
            out.children.append(rest)
        if x < len(a.children):
            out.children.append(aligned(a.children[x], b.children[y], within))
        i, j = x + 1, y + 1
    return out


def expression(node: Node) -> str:
    """The wrapper as a regular expression over tags; #text is a slot."""
    inner = "" if node.text is None else "#text" if node.text == -1 else "'text'"
    for child in node.children:
        inner += expression(child)
    body = f"<{node.key}>{inner}</{node.key}>" if node.key else inner
    return f"({body})" + ("*" if node.optional else "+") if node.repeated else f"({body})?" if node.optional else body


def mark(root: Node, pages: int) -> None:
    """Set ``here`` of every tag of the article: to "keep" if its texts belong to it, else to
    "template"; "sure" is added where a tag names the article."""
    named: list[Node] = []
    best: tuple[int, Node | None] = (0, None)

    def template(node: Node) -> bool:
        return node.text not in (None, -1) and node.pages >= LEAST_PAGES and 100 * node.pages >= SHARE * pages

    def find(node: Node, inside: bool) -> int:
        nonlocal best
        if clutter(node.key) or node.tag == "header" and not inside:
            return 0
        words = node.key.split(".")
        name = words[0] in ("article", "main") or bool(_ARTICLE.intersection(words[1:]))
        if name and not inside:
            named.append(node)
        own = 0 if template(node) else node.chars - 2 * node.linked
        direct = own
        for child in node.children:
            found = find(child, inside or name)
            direct += found if child.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol", "li", "table", "tr", "td") else 0
        if direct > best[0]:
            best = direct, node
        return direct

    find(root, False)
    regions = [n for n in named if n.tag == "article"] or named
    regions = [n for n in regions if _chars(n)] or ([best[1]] if best[1] is not None else [])

    def keep(node: Node, inside: bool, sure: bool) -> None:
        if clutter(node.key) or node.tag == "header" and "header" in node.key.split(".")[1:] and not sure:
            return
        if inside:
            node.here = ["keep", "sure"] if sure else ["template"] if template(node) else ["keep"]
        for child in node.children:
            keep(child, inside, sure)

    for region in regions:
        keep(region, True, region in named)


def _chars(node: Node) -> int:
    total, stack = 0, [node]
    while stack:
        here = stack.pop()
        if not clutter(here.key):
            total += here.chars
            stack.extend(here.children)
    return total


def deep() -> None:
    """Let functions call themselves once for every level of the deepest page. Such calls take
    memory from the heap and none of the machine's stack."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), DEEPEST))


def extract(page: str, wrapper: Node | None) -> str:
    """The article of a page, by a marked wrapper or, without one or without its article, alone.
    Inside the article a tag that the wrapper does not match stays, unless it is clutter."""
    root, texts = parse(page)
    kept: set[int] = set()

    def take(node: Node, sure: bool) -> None:
        if clutter(node.key) or node.tag == "header" and "header" in node.key.split(".")[1:] and not sure:
            return
        kept.add(id(node))
        for child in node.children:
            take(child, sure)

    def match(node: Node, pattern: Node) -> None:
        # A text other than the template's is the page's own.
        if "keep" in pattern.here or pattern.here and node.text != pattern.text:
            kept.add(id(node))
        parts = groups(node.children)
        places = dict(common([key for key, _ in parts], [c.key for c in pattern.children]))
        for x, (_, same) in enumerate(parts):
            for child in same:
                if x in places:
                    match(child, pattern.children[places[x]])
                elif pattern.here:
                    take(child, "sure" in pattern.here)

    if wrapper is not None:
        match(root, wrapper)
    blocks = [text for text, around, _ in texts if id(around[-1]) in kept]
    if not blocks and texts:
        alone = folded(root)
        mark(alone, 1)
        match(root, alone)
        blocks = [text for text, around, _ in texts if id(around[-1]) in kept]
    return "\n\n".join(blocks)


@lru_cache(maxsize=256)
def marked(wrapper: str) -> Node:
    parts = json.loads(wrapper)
    root = Node.read(parts[1])
    mark(root, parts[0])
    return root


def host_of(url: str = "url"):
    """The host of a url, in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer(pages: DataFrame, url: str = "url", markup: str = "html") -> DataFrame:
    """(host, pages, wrapper, expression) of every host; copies of a page count as pages, but are
    aligned once."""
    def part(batches):
        deep()
        for batch in batches:
            held: dict[str, list] = {}
            for host, page, copies in zip(*(batch.column(k).to_pylist() for k in range(3))):
                tree = folded(parse(page)[0])
                known = held.get(host)
                held[host] = [1, tree, copies] if known is None else [known[0] + 1, aligned(known[1], tree), known[2] + copies]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([json.dumps([n, t.dump()]) for n, t, _ in held.values()], pa.string()),
                 pa.array([rows for *_, rows in held.values()], pa.int64())], names=["host", "wrapper", "rows"])

    def whole(key, pdf: pd.DataFrame) -> pd.DataFrame:
        # Partial wrappers are few: one for each batch of rows. Sorted, they give one result.
        deep()
        total, tree = 0, None
        for text in sorted(pdf["wrapper"]):
            n, parts = json.loads(text)
            node = Node.read(parts)
            total, tree = total + n, node if tree is None else aligned(tree, node)
        return pd.DataFrame({"host": [key[0]], "pages": [int(pdf["rows"].sum())], "wrapper": [json.dumps([total, tree.dump()])], "expression": [expression(tree)]})

    source = pages.select(host_of(url).alias("host"), F.coalesce(F.col(markup).cast("string"), F.lit("")).alias("page"))
    # Copies of a page say nothing about the host's template.
    distinct = source.groupBy("host", F.xxhash64("page").alias("digest")).agg(
        F.any_value("page").alias("page"), F.count("*").alias("rows")).select("host", "page", "rows")
    return distinct.mapInArrow(part, "host string, wrapper string, rows bigint").groupBy("host").applyInPandas(
        whole, "host string, pages bigint, wrapper string, expression string")


def main_text(pages: DataFrame, url: str = "url", markup: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``text``, the article, and ``n_chars``, its code points."""
    kept = [f for f in pages.schema.fields if (keep is None or f.name in keep) and f.name.lower() not in ("text", "n_chars")]
    names = [f"c{k}" for k in range(len(kept))]
    wrappers = written(infer(pages, url, markup).select("host", "wrapper"), "wrappers")
    salted = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    source = pages.select(
        *(F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names)), host_of(url).alias("host"),
        F.coalesce(F.col(markup).cast("string"), F.lit("")).alias("page")).withColumn(
            "salt", F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int"))
    together = source.join(salted, ["host", "salt"], "left").select(*names, "page", "wrapper")

    def run(batches):
        deep()
        for batch in batches:
            texts = [extract(p, None if w is None else marked(w)) for p, w in zip(*(batch.column(len(names) + k).to_pylist() for k in (0, 1)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(names))] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*names, "text", "n_chars"])

    made = together.mapInArrow(run, together.select(names).schema.add("text", "string").add("n_chars", "long"))
    return made.select(*(F.col(n).alias(f.name) for f, n in zip(kept, names)), "text", "n_chars")
