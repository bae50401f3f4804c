"""Elements and text of stored HTML, as expressions on a string column.

``Element`` names an element by tag and attribute. Attributes follow HTML's
grammar: white space, a name, and optionally a value in double quotes, in
single quotes or bare, so a ``>`` inside quotes ends no tag. An element's end
is found by counting the tags of its kind, to any depth: running sums give the
level of every tag, and the next tag of the same level is found by sorting. A
list item without an end tag ends with the next item or its list. Where none of
its own kind is inside, a plain pattern finds an element's end. Repetitions are
possessive or run over attributes, and neither backtrack nor recurse on long
pages. No array grows tag by tag.
"""

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)"
_ATTRIBUTE = rf"\s++[^\s\"'>=/]++(?:\s*+=\s*+{_VALUE})?+"
#: The rest of a tag.
_REST = "(?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*+>"
_VOID = "(?i:area|br|col|hr|img|input|link|meta|source|wbr)"


def has_attribute(tag: str, name: str, quoted: str, bare: str) -> str:
    """Pattern of an opening tag with an attribute whose value, quoted or bare, matches."""
    value = f"(?:\"{quoted.replace('QUOTE', '"')}\"|'{quoted.replace('QUOTE', "'")}'|{bare})"
    return f"<{tag}(?:{_ATTRIBUTE})*?\\s++(?i:{name})\\s*+=\\s*+{value}(?=[\\s/>]){_REST}"


def attribute_contains(tag: str, name: str, part: str) -> str:
    """The same for a value that contains a text, in any case."""
    return has_attribute(
        f"(?i:{tag})", name, f"[^QUOTE]*(?i:{part})[^QUOTE]*", f"[^\\s\"'>]*(?i:{part})[^\\s\"'>]*"
    )


def _listed(value: str) -> tuple[str, str]:
    """Quoted and bare pattern of a list of names that holds one."""
    name = re.escape(value)
    return f"(?:[^QUOTE]*\\s)?{name}(?:\\s[^QUOTE]*)?", name


@dataclass(frozen=True)
class Element:
    """``tag[attribute="value"]``; ``class`` compares one of the class names.

    ``child`` demands that the element is the first or the second child of its
    parent.
    """

    tag: str
    value: str | None = None
    attribute: str = "class"
    child: int | None = None

    @property
    def opening(self) -> str:
        if self.value is None:
            return f"<(?i:{self.tag})(?=[\\s/>]){_REST}"
        name = re.escape(self.value)
        value = _listed(self.value) if self.attribute == "class" else (name, name)
        return has_attribute(f"(?i:{self.tag})", self.attribute, *value)

    @property
    def own_tags(self) -> str:
        """Opening and closing tags of the element's kind."""
        return f"(?s)</?(?i:{self.tag})(?=[\\s/>]){_REST}"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    Written out, a regular expression would run again for every use.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def some(text: Column) -> Column:
    """The text, or null when it is empty."""
    return let(text, lambda t: F.when(t != "", t))


def without_code(html: Column) -> Column:
    """The page without comments, scripts and styles, which hold no elements."""
    return F.regexp_replace(
        html, r"(?is)<(?:!--.*?--|(script|style)\b[^>]*>.*?</\1\s*)>", ""
    )


#: Elements that end where the next one of their container begins, or the container ends.
_CONTAINERS = {
    "li": "ul|ol|menu", "dt": "dl", "dd": "dl", "option": "select", "tr": "table",
}


def _places(items: Column, test: Callable[[Column], Column]) -> Column:
    """Numbers (from 0) of the items that pass a test."""
    numbered = F.transform(items, lambda item, i: F.when(test(item), i))
    return F.filter(numbered, lambda i: i.isNotNull())


def _closes(tag: Column) -> Column:
    return tag.startswith("</")


def _opens(tag: Column) -> Column:
    return ~tag.startswith("</")


def _depths(tags: Column, places: Column) -> Column:
    """``m, depth, at, closes`` of the tags at some places: how many are open after the m-th.

    The k-th opening tag among them has k opening ones before it, so its number
    tells how many closing ones there are, and no sum has to be carried along.
    """
    def tag_at(i):
        return F.get(tags, F.get(places, i))

    def node(m, depth, closes):
        return F.struct(m.alias("m"), depth.alias("depth"), F.get(places, m).alias("at"),
                        F.lit(closes).alias("closes"))

    numbers = F.transform(places, lambda _, m: m)
    opening = F.transform(_places(numbers, lambda m: _opens(tag_at(m))),
                          lambda m, k: node(m, (k + 1) * 2 - (m + 1), False))
    closing = F.transform(_places(numbers, lambda m: _closes(tag_at(m))),
                          lambda m, k: node(m, (m + 1) - (k + 1) * 2, True))
    return F.sort_array(F.concat(opening, closing))


def _event(level: Column, at: Column, wanted: Column) -> Column:
    return F.struct(level.alias("level"), at.alias("at"), wanted.alias("wanted"))


def _spans(tags: Column, element: Element) -> Column:
    """First and last tag of every wanted element, in the order of the page.

    An element ends with the next event of its level: its end tag, as often as
    elements of its kind are open; for list items and the like, also the next
    one's tag and the end of the list. Without one it reaches to the end.
    """
    def wanted(place):
        tag = F.get(tags, place)
        return _opens(tag) & tag.rlike(f"(?s)^{element.opening}")

    def events(depths, own):
        """Ends of containers, and the element's tags by how many containers are open."""
        ends = F.transform(F.filter(depths, lambda d: d["closes"]),
                           lambda d: _event(d["depth"] + 1, d["at"], F.lit(False)))
        if own is None:
            starts = F.transform(F.filter(depths, lambda d: ~d["closes"]),
                                 lambda d: _event(d["depth"], d["at"], wanted(d["at"])))
            return F.concat(starts, ends)
        items = F.transform(own, lambda at, i: _event(
            F.coalesce(F.get(depths, at - i - 1)["depth"], F.lit(0)), at, wanted(at)
        ))
        return F.concat(items, ends)

    def paired(found):
        def span(e, i):
            after = F.get(found, i + 1)
            return F.when(e["wanted"], F.struct(e["at"].alias("at"), F.coalesce(
                F.when(after["level"] == e["level"], after["at"]), F.size(tags)
            ).alias("last")))

        return F.sort_array(F.filter(F.transform(found, span), lambda s: s.isNotNull()))

    if element.tag.lower() in _CONTAINERS:
        kind = f"^</?(?i:{element.tag})(?=[\\s/>])"
        own = _places(tags, lambda tag: tag.rlike(kind))
        others = _places(tags, lambda tag: ~tag.rlike(kind))
        depths = let(others, lambda places: _depths(tags, places))
    else:
        own, depths = None, let(F.transform(tags, lambda _, i: i), lambda places: _depths(tags, places))
    return let(let(depths, lambda d: F.sort_array(events(d, own))), paired)


def _cut(pieces: Column, first: Column, last: Column) -> Column:
    """Texts and tags after the tag number ``first`` (from 0) up to the tag ``last``.

    They are taken one by one: a slice would copy the whole array first.
    """
    places = F.sequence(first * 2 + 2, last * 2)
    return F.array_join(F.transform(places, lambda i: F.get(pieces, i)), "")


def _tokens(html: Column, pattern: str, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of the matches of a pattern, and of texts and matches in turn."""
    parts = F.struct(
        F.regexp_extract_all(html, F.lit(pattern), F.lit(0)).alias("tags"),
        F.split(html, pattern, -1).alias("texts"),
    )

    def joined(p):
        pieces = F.flatten(F.zip_with(p["texts"], p["tags"], lambda text, tag: F.array(text, tag)))
        return let(pieces, lambda whole: use(p["tags"], whole))

    return let(parts, joined)


def elements(html: Column, element: Element) -> Column:
    """Opening tags and contents of all such elements, as an array of their markup."""
    def cut(tags, pieces):
        return F.transform(_spans(tags, element), lambda s: F.concat(
            F.get(tags, s["at"]), _cut(pieces, s["at"], s["last"])
        ))

    container = _CONTAINERS.get(element.tag.lower())
    kinds = f"{element.tag}|{container}" if container else element.tag
    present = html.rlike(f"(?s){element.opening}")
    return F.when(present, _tokens(html, f"(?s)</?(?i:{kinds})(?=[\\s/>]){_REST}", cut)).otherwise(
        F.array().cast("array<string>")
    )


def _first_content(html: Column, element: Element) -> Column:
    """What the first such element holds, read on from its opening tag."""
    kind = f"(?i:{element.tag})"
    flat = f"(?:[^<]++|<(?!/?{kind}[\\s/>]))*+"
    # One of both groups: without an element of its kind inside, or all that follows.
    either = f"(?s){element.opening}(?:({flat})</{kind}(?=[\\s/>])|(.*)$)"

    def nested(text):
        def cut(tags, pieces):
            # The first end tag with as many end tags as opening ones before it.
            ends = F.transform(_places(tags, _closes), lambda at, i: F.when(at == i * 2, at))
            end = F.array_min(ends)
            return let(F.coalesce(end, F.size(tags)), lambda last: _cut(pieces, F.lit(-1), last))

        return _tokens(text, element.own_tags, cut)

    def content(plain):
        rest = F.regexp_extract(html, either, 2)
        return F.when(plain != "", plain).otherwise(
            let(rest, lambda text: F.when(text != "", nested(text)).otherwise(F.lit("")))
        )

    return let(F.regexp_extract(html, either, 1), content)


_NODE = "struct<tag:string,children:int>"
_FOUND = "struct<at:int,depth:int,last:int>"
_ANY_TAG = f"(?s)</?[a-zA-Z][^\\s/>]*+{_REST}|<!--.*?-->"


def child_contents(html: Column, wanted: list[Element]) -> Column:
    """Contents of the first element of each kind that is such a child, as an array of the
    kinds; empty texts where there is none. The markup is read once for all of them.

    An end tag closes the innermost open element of its name and all inside that.
    The pass keeps the open elements alone, so it costs the number of tags times
    the depth.
    """
    def step(state, tag):
        at, open_ = state["at"], state["open"]
        depth = F.size(open_)
        name = F.lower(F.regexp_extract(tag, "^</?([a-zA-Z][^\\s/>]*)", 1))
        ends, comment = tag.startswith("</"), tag.startswith("<!")
        parent = F.element_at(open_, -1)
        number = parent["children"] + 1
        counted = F.concat(F.slice(open_, 1, depth - 1), F.array(
            F.struct(parent["tag"], number).cast(_NODE)
        ))
        back = F.array_position(F.reverse(open_["tag"]), name).cast("int")
        starts = ~ends & ~comment
        found = [
            F.when(
                state["found"][k].isNull() & starts & (number == e.child)
                & tag.rlike(f"(?s)^{e.opening}"),
                F.struct(at, depth, F.lit(None)).cast(_FOUND),
            ).when(
                ends & (back > 0) & state["found"][k]["last"].isNull()
                & (depth - back <= state["found"][k]["depth"]),
                F.struct(state["found"][k]["at"], state["found"][k]["depth"], at).cast(_FOUND),
            ).otherwise(state["found"][k])
            for k, e in enumerate(wanted)
        ]
        return F.struct(
            (at + 1).alias("at"),
            F.when(comment, open_)
            .when(ends & (back > 0), F.slice(open_, 1, depth - back))
            .when(ends, open_)
            .when(tag.rlike(f"^<{_VOID}(?=[\\s/>])"), counted)
            .otherwise(F.concat(counted, F.array(F.struct(name, F.lit(0)).cast(_NODE))))
            .alias("open"),
            F.array(*found).alias("found"),
        )

    # The markup is the content of one more element, which is no child itself.
    start = F.struct(
        F.lit(0).alias("at"), F.array(F.struct(F.lit(""), F.lit(0)).cast(_NODE)).alias("open"),
        F.array(*[F.lit(None).cast(_FOUND) for _ in wanted]).alias("found"),
    )

    def cut(tags, pieces):
        return F.transform(
            F.aggregate(tags, start, step, lambda state: state["found"]),
            lambda s: F.coalesce(
                _cut(pieces, s["at"], F.coalesce(s["last"], F.size(tags))), F.lit("")
            ),
        )

    present = F.lit(False)
    for e in wanted:
        present = present | html.rlike(f"(?s){e.opening}")
    return F.when(present, _tokens(html, _ANY_TAG, cut)).otherwise(
        F.array(*[F.lit("") for _ in wanted])
    )


def opening_tag(html: Column, element: Element) -> Column:
    """The opening tag of the first such element; null without one."""
    return some(F.regexp_extract(html, f"(?s){element.opening}", 0))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of an opening tag; empty when absent."""
    found = F.regexp_extract(
        tag, f"(?s)^<[a-zA-Z][^\\s/>]*+(?:{_ATTRIBUTE})*?\\s++(?i:{name})\\s*+=\\s*+({_VALUE})", 1
    )
    return decode_entities(F.regexp_replace(found, "(?s)^[\"']|[\"']$", ""))


_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITESPACE))


def text_content(markup: Column) -> Column:
    """The text of a piece of markup, without tags and with entities decoded."""
    return decode_entities(F.regexp_replace(
        markup, f"(?s)<!--.*?-->|</?[a-zA-Z][^\\s/>]*+{_REST}|<[^>]*>", ""
    ))


def element_markup(html: Column, element: Element) -> Column:
    """What the first such element holds; empty when there is none."""
    if element.child is None:
        return _first_content(html, element)
    return F.get(child_contents(html, [element]), F.lit(0))


def clean_text(markup: Column) -> Column:
    """Stripped text of a piece of markup; null when there is none."""
    return some(strip(text_content(markup)))


# Named entities: those of the standard library's table that end with a semicolon, as one
# literal, which is read once for a whole query.
_NAMED = json.dumps({name[:-1]: text for name, text in html5.items() if name.endswith(";")})
#: References that texts are full of; ``amp`` comes last.
_COMMON = {"lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "amp": "&"}
_RARE = f"&(?!(?:{'|'.join(_COMMON)});)(?:#[xX]?[0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);"
_REFERENCE = "^(#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);"


def _numbered(digits: Column) -> Column:
    """Character of ``233`` or ``xe9``; null when there is none of that number."""
    bare = F.regexp_replace(digits, "^[xX]?0*+(?=.)", "")
    hexadecimal = F.lower(digits).startswith("x")
    point = F.when(F.length(bare) <= 8, F.when(
        hexadecimal, F.conv(bare, 16, 10)
    ).otherwise(bare)).try_cast("int")

    def character(p):
        known = p.between(1, 0x10FFFF) & ~p.between(0xD800, 0xDFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(p), 8, "0")), "UTF-32"))

    return let(point, character)


def decode_entities(text: Column) -> Column:
    """Named and numeric character references that end with a semicolon, decoded."""
    named = F.from_json(F.lit(_NAMED), "map<string,string>")

    def character(reference):
        chain = F.when(reference.startswith("#"), _numbered(F.substring(reference, 2, 1 << 30)))
        for name, sign in _COMMON.items():
            chain = chain.when(reference == name, F.lit(sign))
        return chain.when(reference != "", F.try_element_at(named, reference))

    def piece(part, position):
        char = let(F.regexp_extract(part, _REFERENCE, 1), character)
        rest = F.regexp_replace(part, "^[^;]*;", "")
        return F.when(position == 0, part).otherwise(
            F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part))
        )

    def decoded(whole):
        return F.array_join(F.transform(F.split(whole, "&"), piece), "")

    def common(whole):
        for name, sign in _COMMON.items():
            whole = F.replace(whole, F.lit(f"&{name};"), F.lit(sign))
        return whole

    return let(text, lambda t: F.when(~t.contains("&"), t).when(
        t.rlike(_RARE), decoded(t)
    ).otherwise(common(t)))
