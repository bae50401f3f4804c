"""Main text of web pages, through wrappers inferred for every host.

A page is read as a stream of block tags and texts; inline tags belong to the
text. A wrapper is a regular expression over such streams without unions:
tags, texts, optional items and repeated groups. A page's own stream is the
first wrapper of it, with neighbouring repetitions folded into groups. Two
wrappers are aligned tag by tag along their longest common sequence: what only
one of them has becomes optional, what repeats becomes a group, and the parts
of matching tags are aligned in turn. A text stays literal while all pages have
it and becomes a slot where pages differ; of a repeated group, the literals
that every page has in it stay.

Pages of one shape are merged within their task, so a host with a third of all
pages sends each of its few layouts once per task. The layouts of a host are
aligned in parallel by salt and then together; literals are merged alike in any
order. If the pages of a host differ at all, its article is what varies: texts
that all pages have at the same place are template and left out, except
headings right before a varying text. Names only narrow this down, if slots lie
in what they name: an ``article`` or ``main`` element, which is kept whole, or
an element named like one, by the most slots. Where nothing tells template from
article (a single page, equal pages) names alone decide, and without names all
texts stay. Menus, headers, footers and the like are marked and left out.

Defined results: null and empty html, and a page without an article, give an
empty text. Pages without a readable host share the host ''. Rows are
independent, so repeated ids give repeated rows.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.plans.joins import lookup_join
from tasador.plans.workspace import materialize_measured

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^<>]*$", re.S
)
_ATTRIBUTE = re.compile(r"\s(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose content is no markup.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A start of one of these ends an open element of these kinds.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: Parts that are no article text: by tag, and by a word of class or id.
_ASIDE_TAGS = set(
    "nav header footer aside form menu head button select dialog object svg canvas".split()
) | _RAW
_ASIDE_WORDS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer form header masthead menu nav navbar navigation newsletter notice "
    "pagination popup promo promotion related replies share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)
_ARTICLE_WORDS = set("article content entry main post story".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Names of an article's own header, and words of names that speak of another element.
_TITLED = _ARTICLE_WORDS - {"main"}
_BESIDE = set("has no with without".split())


#: A wrapper has no elements below this depth, only their texts; extraction has no limit.
_DEEPEST = 150


class Node:
    """An element with its block elements and blocks, in order; a block is a list of pieces of text."""

    __slots__ = ("label", "tag", "parts")

    def __init__(self, label: str, tag: str = ""):
        self.label = label
        self.tag = tag
        self.parts: list[Node | list[str]] = []

    def add(self, piece: str):
        if self.parts and isinstance(self.parts[-1], list):
            self.parts[-1].append(piece)
        else:
            self.parts.append([piece])


def _label(tag: str, attributes: str) -> str:
    """Tag, and the words of class, id and role that tell elements apart."""
    known = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        for token in next((v for v in values if v), "").lower().split():
            words = set(re.split(r"[^a-z]+", token))
            if "header" in words and words & _TITLED:
                continue  # entry-header holds the article's title
            if words & _BESIDE or tag in ("html", "body"):
                words -= _ASIDE_WORDS  # with-sidebar tells about the rest of the page
            known |= words & (_ASIDE_WORDS | _ARTICLE_WORDS)
    return ".".join([tag, *sorted(known)])


def parse(page: str | None) -> Node:
    """The page as a tree of any depth. Missing end tags are put in; stray ones are dropped."""
    root = Node("")
    stack, opened, at, page = [root], Counter(), 0, page or ""

    def pop():
        opened[stack.pop().tag] -= 1

    for token in iter(lambda: _TOKEN.search(page, at), None):
        if token.start() > at:
            stack[-1].add(page[at : token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if tag in _RAW and not token[1]:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _INLINE:
            if tag == "br":
                stack[-1].add(" ")
            continue
        if token[1]:
            if opened[tag]:
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if stack[-1].tag == "p" or stack[-1].tag in _CLOSES.get(tag, ()):
            pop()  # a block element ends an open paragraph
        node = Node(_label(tag, token[3]), tag)
        stack[-1].parts.append(node)
        if tag not in _VOID:
            stack.append(node)
            opened[tag] += 1
    if at < len(page):
        stack[-1].add(page[at:])
    return root


def text_of(pieces: list[str]) -> str:
    """A block's text: references decoded, white space single, trimmed."""
    return " ".join("".join(entities.unescape(p) if "&" in p else p for p in pieces).split())


# --- Wrappers ---------------------------------------------------------------
# An item is [label, items, optional, repeated]; a group of several items has the
# label "()". A text has the label "#" and, as items, the numbers of its
# literals: positive if all pages have it here, negative if not, 0 for a slot.


def _key(item) -> str:
    return item[0] if item[0] != "()" else "(" + ",".join(_key(i) for i in item[1]) + ")"


def _literal(block: list[str]) -> int:
    """Number of a block's text, 0 of a blank one."""
    text = text_of(block)
    return 1 + int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=6).digest()) if text else 0


def _seen(literals: list[int]) -> tuple[set[int], set[int], bool]:
    """Literals of all pages, those of some, and whether the text is a slot."""
    every = {n for n in literals if n > 0}
    some = {-n for n in literals if n < 0} - every
    return every, some, 0 in literals or len(some) > 1


def _literals(every: set[int], some: set[int], slot: bool) -> list[int]:
    return sorted(every) + ([0] if slot or len(some) > 1 else [-n for n in some])


def wrapper_of(node: Node, number=_literal, depth: int = 0) -> list:
    """The stream below an element; ``number`` gives the number of a block, 0 if it is blank."""
    items: list[list] = []
    below = _outside(node) if depth == _DEEPEST else node.parts
    for part in below:
        if isinstance(part, list):
            if n := number(part):
                items.append(["#", [n], False, False])
        elif depth < _DEEPEST:
            items.append(wrapper_of(part, number, depth + 1))
    if depth == _DEEPEST and items:
        items = [["#", [i[1][0] for i in items], False, False]]
    return [node.label, fold(items), False, False]


def fold(items: list) -> list:
    """Neighbouring repetitions of up to three items become one repeated item."""
    for period in (1, 2, 3):
        out: list = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * period and all(
                _key(a) == _key(b) and a[0] != "#" or (period > 1 and _key(a) == _key(b))
                for a, b in zip(out[-2 * period : -period], out[-period:])
            ):
                pairs = [merge(a, b, False) for a, b in zip(out[-2 * period : -period], out[-period:])]
                del out[-2 * period :]
                out.append([*pairs[0][:3], True] if period == 1 else ["()", pairs, False, True])
            if period > 1 and len(out) > period and out[-period - 1][0] == "()" and all(
                _key(a) == _key(b) for a, b in zip(out[-period - 1][1], out[-period:])
            ) and len(out[-period - 1][1]) == period:
                group = out[-period - 1]
                group[1] = [merge(a, b, False) for a, b in zip(group[1], out[-period:])]
                del out[-period:]
        items = out
    return items


def merge(a: list, b: list, pages: bool = True) -> list:
    """The wrapper of what two items with one key match.

    They are of different ``pages``, or repetitions within the same ones."""
    if a[0] != "#":
        inner = align(a[1], b[1], pages)
    elif not pages:
        inner = a[1] + b[1]
    else:
        (p, q, s), (t, u, v) = _seen(a[1]), _seen(b[1])
        inner = _literals(p & t, (p | q | t | u) - (p & t), s or v)
    return [a[0], inner, a[2] or b[2], a[3] or b[3]]


def _missing(item: list) -> list:
    """The item without the claim that all pages have its literals."""
    if item[0] == "#":
        every, some, slot = _seen(item[1])
        return ["#", _literals(set(), every | some, slot), *item[2:]]
    return [item[0], [_missing(i) for i in item[1]], *item[2:]]


def _matched(a: list, b: list) -> Iterator[tuple[list | None, list | None]]:
    """Items of both along their longest common sequence of keys; None where one has no such item."""
    x, y = [_key(i) for i in a], [_key(i) for i in b]
    if x == y:
        yield from zip(a, b)
        return
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = (best[i + 1][j + 1] + 1 if x[i] == y[j]
                          else max(best[i + 1][j], best[i][j + 1]))
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            yield a[i], b[j]
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            yield a[i], None
            i += 1
        else:
            yield None, b[j]
            j += 1


def align(a: list, b: list, pages: bool = True) -> list:
    """One sequence for both: common items merged, the others optional."""
    out, equal = [], True
    for i, j in _matched(a, b):
        if i and j:
            out.append(merge(i, j, pages))
        else:
            one = _missing(i or j) if pages else i or j
            out.append([*one[:2], True, one[3]])
            equal = False
    return out if equal else fold(out)


def expression(item: list) -> str:
    """The wrapper as a regular expression over tags and slots."""
    label, items, optional, repeated = item
    inner = " ".join(expression(i) for i in items) if label != "#" else ""
    body = "#" if label == "#" else f"({inner})" if label == "()" else f"<{label}>{inner}</>"
    sign = "*" if optional and repeated else "?" if optional else "+" if repeated else ""
    return f"({body}){sign}" if sign and label != "()" else body + sign


def _aside(label: str) -> bool:
    tag, *words = label.split(".")
    return tag in _ASIDE_TAGS or (tag not in ("article", "main") and bool(_ASIDE_WORDS & set(words)))


def _rank(label: str) -> int:
    """How plainly a label names an article: 3, 2, 1 or 0."""
    tag, *words = label.split(".")
    if _ASIDE_WORDS & set(words):
        return 0
    return 3 if tag == "article" else 2 if tag == "main" else 1 if _ARTICLE_WORDS & set(words) else 0


def varies(wrapper: list) -> bool:
    """Whether the host's pages differ, so that its literals are template."""
    return _slots(wrapper, {}) > 0


def _slots(item: list, named: dict[str, int]) -> int:
    """Slots of an item outside asides, a repeated one twice; ``named`` gets those of every label that names an article."""
    label, items, _, repeated = item
    if label == "#":
        return int(_seen(items)[2])
    if _aside(label):
        return 0
    if _rank(label):
        named.setdefault(label, 0)
    slots = sum(_slots(i, named) for i in items) * (1 + repeated)
    if _rank(label):
        named[label] += slots
    return slots


def region(wrapper: list) -> str:
    """Label of the elements that hold the host's articles; '' if nothing names one.

    Where the host's pages differ, its elements must hold slots."""
    named: dict[str, int] = {}
    if _slots(wrapper, named):
        named = {label: n for label, n in named.items() if n}
    return max(named, key=lambda label: (_rank(label), named[label]), default="")


# --- Extraction -------------------------------------------------------------


def _outside(node: Node) -> Iterator[Node | list[str]]:
    """The parts below an element in page order, without asides."""
    stack = list(reversed(node.parts))
    while stack:
        part = stack.pop()
        if isinstance(part, list):
            yield part
        elif not _aside(part.label):
            yield part
            stack.extend(reversed(part.parts))


def _blocks(node: Node, template: set[int]) -> list[str]:
    """Texts of an element's blocks in page order, without asides and the host's template."""
    texts = (text_of(p) for p in _outside(node) if isinstance(p, list) and id(p) not in template)
    return [text for text in texts if text]


def _named(root: Node) -> str:
    """Label of the first of the elements that name an article most plainly; '' if none does."""
    labels = [part.label for part in _outside(root) if isinstance(part, Node)]
    best = max(labels, key=_rank, default="")
    return best if _rank(best) else ""


def _find(node: Node, label: str) -> list[Node]:
    """Topmost elements with a label, outside asides."""
    found, stack = [], [node]
    while stack:
        here = stack.pop()
        if here.label == label and here is not node:
            found.append(here)
        elif not _aside(here.label):
            stack.extend(p for p in reversed(here.parts) if isinstance(p, Node))
    return found


def _template(own: list, host: list, literals: list[int]) -> Iterator[int]:
    """Numbers of a page's blocks whose literal all pages of the host have at the same place."""
    if own[0] == "#":
        every = _seen(host[1])[0]
        yield from (n for n in own[1] if literals[n] in every)
        return
    for mine, theirs in _matched(own[1], host[1]):
        if mine and theirs:
            yield from _template(mine, theirs, literals)


def _template_blocks(root: Node, wrapper: list) -> set[int]:
    """Identities of the blocks that belong to the host's template, but for the article's headings."""
    blocks, literals = [root], [0]

    def number(block: list[str]) -> int:
        if not (literal := _literal(block)):
            return 0
        blocks.append(block)
        literals.append(literal)
        return len(blocks) - 1

    template = {id(blocks[n]) for n in _template(wrapper_of(root, number), wrapper, literals)}
    heading, follows, kept = None, False, set()
    order: list[tuple[int, bool]] = []
    for part in _outside(root):
        if isinstance(part, Node):
            heading = part if part.tag in _HEADINGS else None
        elif text_of(part):
            order.append((id(part), heading is not None and any(p is part for p in heading.parts)))
    for block, headed in reversed(order):
        follows = block not in template or (headed and follows)
        if follows:
            kept.add(block)
    return template - kept


def main_text(page: str | None, label: str, wrapper: list | None = None) -> str:
    """Blocks of the page's article, one to a line.

    ``label`` comes from its host's wrapper, which is given if it tells template from article."""
    root = parse(page)
    nodes = _find(root, label) if label else []
    if not nodes and (label or not wrapper):
        label = _named(root)
        nodes = _find(root, label) if label else []
    if not wrapper or _rank(label) > 1 and nodes:
        template = set()
    else:
        template = _template_blocks(root, wrapper)
    return "\n".join(text for node in nodes or [root] for text in _blocks(node, template))


# --- The operator -----------------------------------------------------------

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_SALTS = 16
#: Characters of pages whose layouts a task holds to merge those of one shape, and of layouts it keeps read.
_HELD = 32_000_000
_LAYOUT = pa.schema([("host", pa.string()), ("shape", pa.string()), ("layout", pa.string())])


def _dump(wrapper: list) -> str:
    return json.dumps(wrapper, separators=(",", ":"))


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], list] = {}
    size = 0

    def flush():
        rows = [(host, shape, _dump(wrapper)) for (host, shape), wrapper in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in zip(*rows)], schema=_LAYOUT)

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            wrapper = wrapper_of(parse(page))
            shape = expression(wrapper)
            key = host, f"{len(shape):09d}{blake2b(shape.encode('utf-8', 'surrogatepass'), digest_size=12).hexdigest()}"
            if key in held:
                held[key] = merge(held[key], wrapper)
                continue
            held[key] = wrapper
            size += len(page or "")
            if size > _HELD:
                yield flush()
                size = 0
    if held:
        yield flush()


def _aligned(table: pa.Table) -> pa.Table:
    wrapper = None
    # Shapes are aligned in a fixed order, so that results don't depend on the partitioning.
    rows = sorted(zip(table.column("shape").to_pylist(), table.column("layout").to_pylist()))
    for _, layout in rows:
        other = json.loads(layout)
        wrapper = other if wrapper is None else merge(wrapper, other)
    return pa.table([[table.column("host")[0].as_py()], [rows[0][0]], [_dump(wrapper)]], schema=_LAYOUT)


def infer(pages: DataFrame) -> DataFrame:
    """``host`` and ``layout``, the wrapper of all the host's pages as JSON."""
    kind = "host string, shape string, layout string"
    shapes = pages.mapInArrow(_layouts, kind).groupBy("host", "shape").applyInArrow(_aligned, kind)
    salt = F.pmod(F.xxhash64("shape"), F.lit(_SALTS))
    some = shapes.withColumn("salt", salt).groupBy("host", "salt")
    return some.applyInArrow(_aligned, kind).groupBy("host").applyInArrow(_aligned, kind).drop("shape")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[str, list | None]] = {}
    size = 0
    for batch in batches:
        texts = []
        for page, layout in zip(batch.column("html").to_pylist(), batch.column("layout").to_pylist()):
            if layout not in known:
                if size > _HELD // 8:
                    known.clear()
                    size = 0
                wrapper = json.loads(layout) if layout else None
                known[layout] = (region(wrapper) if wrapper else "",
                                 wrapper if wrapper and varies(wrapper) else None)
                size += len(layout or "")
            texts.append(main_text(page, *known[layout]))
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    host = F.lower(F.coalesce(F.regexp_extract("url", _HOST, 1), F.lit("")))
    hosted = pages.select("page_id", "url", "html", host.alias("host"))
    wrappers, size = materialize_measured(infer(hosted.select("host", "html")), "wrappers")
    joined = lookup_join(hosted, wrappers, ["host"], ["page_id", "url"], lookup_bytes=size)
    return joined.select("page_id", "url", "html", "layout").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
