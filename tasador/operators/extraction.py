"""Listings, links and block notices from stored pages (``page_id``, ``url``, ``html``)."""

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions import markup as M
from tasador.functions.markup import Element
from tasador.functions.parsing import absolute_url, default_date, split_location, utc_now

# Fixed value: the title of a card that has none.
NO_TITLE = "Sin título"


@dataclass(frozen=True)
class Portal:
    """Where a portal puts its values. Of several elements the first found counts."""

    source: str
    host: str
    cards: tuple[Element, ...]
    link: tuple[Element, ...]
    title: tuple[Element, ...] = ()
    price: tuple[Element, ...] = ()
    area: tuple[Element, ...] = ()
    rooms: tuple[Element, ...] = ()
    location: tuple[Element, ...] = ()
    next_page: tuple[Element, ...] = ()

    @property
    def children(self) -> list[Element]:
        """Elements of a card that count by their place among their parent's children."""
        fields = (*self.title, *self.price, *self.area, *self.rooms, *self.location)
        return [e for e in fields if e.child is not None]


# The markup of the two portals.
IDEALISTA = Portal(
    source="idealista",
    host="https://www.idealista.com",
    cards=(Element("article", "item"),),
    link=(Element("a", "item-link"),),
    title=(Element("a", "item-link"),),
    price=(Element("span", "item-price"),),
    area=(Element("span", "item-detail", child=1),),
    rooms=(Element("span", "item-detail", child=2),),
    location=(Element("span", "item-detail-location"),),
    next_page=(Element("a", "icon-arrow-right-after"),),
)
FOTOCASA = Portal(
    source="fotocasa",
    host="https://www.fotocasa.es",
    cards=(
        Element("article", "re-SearchPropertyCard", "data-testid"),
        Element("li", "re-SearchResult-item"),
    ),
    link=(Element("a", "re-CardPackPremium"), Element("a")),
    title=(Element("span", "re-CardPackPremium-title"),),
    price=(Element("span", "re-CardPackPrimary-price"),),
    area=(Element("li", "re-CardFeatures-feature", "data-testid", child=1),),
    rooms=(Element("li", "re-CardFeatures-feature", "data-testid", child=2),),
    location=(Element("span", "re-CardPackPrimary-location"),),
    next_page=(
        Element("a", "re-Pagination-nextPage", "data-testid"),
        Element("a", "sui-AtomButton--end"),
    ),
)

_portals: dict[str, Portal] = {}


def register(portal: Portal) -> None:
    """Make a portal available under its source name, in any case."""
    if not isinstance(portal, Portal):
        raise TypeError(f"{portal!r} is not a Portal")
    _portals[portal.source.lower().strip()] = portal


def available_sources() -> list[str]:
    return sorted(_portals)


def portal(source: str | Portal) -> Portal:
    if isinstance(source, Portal):
        return source
    try:
        return _portals[source.lower().strip()]
    except KeyError:
        raise ValueError(
            f"unknown source '{source}', available: {available_sources()}"
        ) from None


register(IDEALISTA)
register(FOTOCASA)


def first_found(candidates: Iterable[Element], find: Callable[[Element], Column]) -> Column:
    """The first non-null result of ``find``; null for no candidates."""
    return F.coalesce(F.lit(None).cast("string"), *[find(c) for c in candidates])


def cards(html: Column, candidates: tuple[Element, ...]) -> Column:
    """Cards of a page: of the first kind of element that occurs at all."""
    found = M.elements(html, candidates[0])
    if len(candidates) == 1:
        return found
    others = cards(html, candidates[1:])
    return M.let(found, lambda first: F.when(F.size(first) > 0, first).otherwise(others))


def _per_source(portals: list[Portal], of: Callable[[Portal], Column]) -> Column:
    """A value by the page's source, so that pages are read once for all portals."""
    chain = F
    for p in portals:
        chain = chain.when(F.col("source") == p.source.lower().strip(), of(p))
    return chain


def _by_known_source(pages: DataFrame) -> DataFrame:
    return pages.withColumn("source", F.lower(F.trim("source")))


def unknown_sources(pages: DataFrame, sources: list[str | Portal] | None = None) -> DataFrame:
    """Pages whose source no portal is known for, with ``available``: the known names."""
    known = [portal(s).source.lower() for s in (available_sources() if sources is None else sources)]
    return _by_known_source(pages).filter(
        ~F.coalesce(F.col("source").isin(known), F.lit(False))
    ).withColumn("available", F.lit(", ".join(sorted(known))))


def _refuse_unknown(pages: DataFrame, portals: list[Portal]) -> DataFrame:
    """Fails on a page whose source is not among the portals."""
    known = [p.source.lower().strip() for p in portals]
    message = F.concat(
        F.lit("unknown source '"), F.coalesce("source", F.lit("null")),
        F.lit(f"', available: {sorted(known)}"),
    )
    return pages.withColumn("source", F.when(
        F.col("source").isin(known), F.col("source")
    ).otherwise(F.raise_error(message).cast("string")))


def extract_cards(
    pages: DataFrame, sources: list[str | Portal] | None = None,
    scraped_at: Column | None = None,
) -> DataFrame:
    """Raw records of all cards that have a link.

    ``pages`` carries the ``source`` of each page. Of named ``sources``, only those
    give records; without any, all registered portals do, and a page of another
    source fails the query (``unknown_sources`` finds them before).
    ``page_id`` and ``position`` tell where a
    record comes from.
    """
    portals = [portal(s) for s in (available_sources() if sources is None else sources)]
    scraped_at = utc_now() if scraped_at is None else scraped_at

    def entries(html, p):
        """Position, markup and opening link tag of each card that has a link."""
        found = F.transform(cards(html, p.cards), lambda card, i: F.struct(
            i.alias("position"), card.alias("card"),
            first_found(p.link, lambda e: M.opening_tag(card, e)).alias("link"),
        ))
        return F.filter(found, lambda entry: entry["link"].isNotNull())

    def markup(p, e):
        if e.child is not None:
            return F.get(F.col("_children"), F.lit(p.children.index(e)))
        return M.element_markup(F.col("_card"), e)

    def text(kind):
        return _per_source(portals, lambda p: first_found(
            getattr(p, kind), lambda e: M.clean_text(markup(p, e))
        ))

    def children(p):
        if not p.children:
            return F.lit(None).cast("array<string>")
        return M.child_contents(F.col("_card"), p.children)

    named = _by_known_source(pages)
    linked = (_refuse_unknown(named, portals) if sources is None else named).select(
        "page_id", "source", scraped_at.alias("scraped_at"),
        F.inline(M.let(
            M.without_code(F.col("html")),
            lambda html: _per_source(portals, lambda p: entries(html, p)),
        )).alias("position", "_card", "_link"),
    )
    read = linked.withColumn("_children", _per_source(portals, children)).withColumn(
        "_location", F.coalesce(text("location"), F.lit(""))
    )
    neighborhood, district = split_location(F.col("_location"))
    no_place = F.lit(None).cast("double")
    return read.select(
        "page_id", "position", "source",
        M.let(
            M.attribute(F.col("_link"), "href"),
            lambda href: absolute_url(href, _per_source(portals, lambda p: F.lit(p.host))),
        ).alias("url"),
        F.coalesce(text("title"), F.lit(NO_TITLE)).alias("title"),
        F.coalesce(text("price"), F.lit("")).alias("raw_price"),
        F.coalesce(text("area"), F.lit("")).alias("raw_area"),
        text("rooms").alias("raw_rooms"),
        neighborhood.alias("neighborhood"),
        district.alias("district"),
        no_place.alias("latitude"),
        no_place.alias("longitude"),
        "scraped_at",
        default_date(F.lit(""), F.col("scraped_at")).alias("scrape_date"),
    )


def next_page(pages: DataFrame, sources: list[str | Portal] | None = None) -> DataFrame:
    """Add ``next_url``: the absolute link to the next page, or null."""
    portals = [portal(s) for s in (available_sources() if sources is None else sources)]

    def tag(html):
        return _per_source(portals, lambda p: first_found(
            p.next_page, lambda e: M.opening_tag(html, e)
        ))

    host = _per_source(portals, lambda p: F.lit(p.host))
    tagged = _by_known_source(pages).withColumn(
        "_next", M.let(M.without_code(F.col("html")), tag)
    )
    return tagged.withColumn("next_url", M.let(
        M.attribute(F.col("_next"), "href"),
        lambda href: F.when(href != "", absolute_url(href, host)),
    )).drop("_next")


def union_records(*batches: DataFrame) -> DataFrame:
    """All records of several batches; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


_ANY = r"[a-zA-Z][^\s/>]*+"
# Signs of a challenge, in order, with the text of each selector, its pattern and
# a text that markup with the sign has in any case.
CAPTCHA_SIGNS = (
    ("iframe[src*='captcha']", M.attribute_contains("iframe", "src", "captcha"), "captcha"),
    ("iframe[src*='recaptcha']", M.attribute_contains("iframe", "src", "recaptcha"), "captcha"),
    ("iframe[src*='hcaptcha']", M.attribute_contains("iframe", "src", "hcaptcha"), "captcha"),
    ("div[class*='captcha']", M.attribute_contains("div", "class", "captcha"), "captcha"),
    ("div[id*='captcha']", M.attribute_contains("div", "id", "captcha"), "captcha"),
    ("#challenge-running", M.has_attribute(_ANY, "id", "challenge-running", "challenge-running"), "challenge-"),
    ("#challenge-form", M.has_attribute(_ANY, "id", "challenge-form", "challenge-form"), "challenge-"),
    (".cf-turnstile", M.has_attribute(
        _ANY, "class", r"(?:[^QUOTE]*\s)?cf-turnstile(?:\s[^QUOTE]*)?", "cf-turnstile"
    ), "cf-turnstile"),
)
# Texts of block pages, compared without case.
BLOCK_TEXTS = (
    "Access Denied", "Access denied", "acceso denegado", "has sido bloqueado",
    "you have been blocked", "too many requests", "demasiadas solicitudes",
    "Error 403", "Error 429", "rate limit", "please verify you are a human",
    "verifica que eres humano",
)
# Parts of titles of block pages.
BLOCK_TITLES = ("403", "429", "Access Denied", "Blocked")


def body_text(html: Column) -> Column:
    """Text of the body, up to the end of a page that is cut off; without a body tag, all
    text after the head."""
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)$", 1)
    bare = F.regexp_replace(html, r"(?is)^.*?</head\s*>|<title\b[^>]*>.*?</title\s*>", "")
    whole = F.when(html.rlike(r"(?i)<body\b"), body).otherwise(bare)
    return M.text_content(F.regexp_replace(whole, r"(?is)</body\s*>.*$", ""))


def page_title(html: Column) -> Column:
    text = M.decode_entities(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))
    return M.strip(F.regexp_replace(text, r"\s+", " "))


def readable(pages: DataFrame, **signs) -> DataFrame:
    """Pages without a block notice: the filter before cards are extracted."""
    return detect_blocking(pages, **signs).filter(~F.col("blocked")).drop("blocked", "reason")


def detect_blocking(
    pages: DataFrame,
    captcha_signs=CAPTCHA_SIGNS,
    texts=BLOCK_TEXTS,
    titles=BLOCK_TITLES,
) -> DataFrame:
    """Add ``blocked`` and ``reason``: challenge markup, then body text, then title.

    A sign is a selector's name, its pattern and, optionally, a text in lower
    case that pages with the sign hold. Patterns are only tried on pages with
    such a text: a page without any is read once for each text, not parsed for each pattern.
    """
    signs = [(*sign, None)[:3] for sign in captcha_signs]
    needles = sorted({needle for _, _, needle in signs if needle})
    staged = pages.withColumn("_lower", F.lower("html")).withColumns({
        "_hints": F.array(*[F.when(F.col("_lower").contains(n), F.lit(n)) for n in needles]),
    }).withColumns({
        "_hinted": F.exists("_hints", lambda n: n.isNotNull()) | F.lit(any(not n for _, _, n in signs)),
    }).withColumns({
        "_markup": F.when(F.col("_hinted"), M.without_code(F.col("html"))),
        "_text": F.lower(body_text(F.col("html"))),
        "_title": page_title(F.col("html")),
    })
    tests = [
        F.when(F.col("_markup").rlike(pattern), F.lit(f"CAPTCHA detected: {name}"))
        for name, pattern, _ in signs
    ]
    challenge = F.when(F.col("_hinted"), F.coalesce(*tests)) if tests else F.lit(None).cast("string")
    notices = [
        F.when(F.col("_text").contains(text.lower()), F.lit(f"Block text detected: '{text}'"))
        for text in texts
    ]
    headed = F.lit(None).cast("string")
    if titles:
        hit = reduce(lambda a, b: a | b, [F.col("_title").contains(t) for t in titles])
        headed = F.when(hit, F.concat(F.lit("Block page title: '"), F.col("_title"), F.lit("'")))
    reason = F.coalesce(challenge, *notices, headed, F.lit(""))
    return staged.withColumn("reason", reason).withColumn(
        "blocked", F.col("reason") != ""
    ).drop("_lower", "_hints", "_hinted", "_markup", "_text", "_title")
