"""Stored pages: cards, links, entities, block notices and the registry."""

import pytest
from pyspark.sql import functions as F

from tasador.functions import markup as M
from tasador.functions.markup import Element
from tasador.operators import extraction as X


def pages(spark, source, *htmls):
    return spark.createDataFrame(
        [(i, source, h) for i, h in enumerate(htmls)], "page_id int, source string, html string"
    )


CARD = """<ARTICLE CLASS="item item-multimedia" data-x='1'>
 <a class="item-link extra" href="/inmueble/1/?a=1&amp;b=2"> &Aacute;tico <b>en</b> Sol </a>
 <span class="item-price">350.000<span>&euro;</span></span>
 <div><span class="item-detail">85 m&#178;</span><!-- x --> <span class="item-detail">3 hab.</span></div>
 <span class="item-detail-location">Sol, Centro</span></ARTICLE>"""


def test_card_fields(spark):
    row = X.extract_cards(pages(spark, " Idealista", CARD), ["IDEALISTA"]).first()
    assert row.asDict() == {
        "page_id": 0, "position": 0, "source": "idealista",
        "url": "https://www.idealista.com/inmueble/1/?a=1&b=2", "title": "Ático en Sol",
        "raw_price": "350.000€", "raw_area": "85 m²", "raw_rooms": "3 hab.",
        "neighborhood": "Sol", "district": "Centro", "latitude": None, "longitude": None,
        "scraped_at": row.scraped_at, "scrape_date": row.scraped_at.strftime("%Y-%m-%d"),
    }


def test_missing_fields_and_links(spark):
    html = (
        '<article class="item"><span class="item-price">1</span></article>'
        '<article class="items"><a class="item-link" href="/no">x</a></article>'
        '<article class="item"><a class="item-link"></a></article>'
        '<script>"<article class=\'item\'><a class=\'item-link\'>s</a></article>"</script>'
        '<!-- <article class="item"><a class="item-link">c</a></article> -->'
    )
    rows = X.extract_cards(pages(spark, "idealista", html), ["idealista"]).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.position, row.url, row.title, row.raw_price, row.raw_area, row.raw_rooms) == (
        1, "", "Sin título", "", "", None
    )
    assert (row.neighborhood, row.district) == ("Desconocido", "Desconocido")


def test_child_positions(spark):
    details = [
        '<div><b>x</b><span class="item-detail">A</span></div>',
        '<div>text <span class="item-detail">A</span><br><span class="item-detail">B</span></div>',
        '<div><i>x</i><span class="item-detail">A</span></div><p><span class="item-detail">B</span></p>',
    ]
    first, second = [Element("span", "item-detail", child=c) for c in (1, 2)]
    rows = spark.createDataFrame([(d,) for d in details], "h string").coalesce(1).select(*[
        M.clean_text(M.element_markup(F.col("h"), e)) for e in (first, second)
    ]).collect()
    assert [tuple(r) for r in rows] == [(None, "A"), ("A", None), ("B", "A")]


def test_fallbacks(spark):
    modern = '<article data-testid="re-SearchPropertyCard"><a href="/m">m</a></article>'
    old = '<li class="re-SearchResult-item"><ul><li>1</li><li>2</li></ul><a class="re-CardPackPremium" href="https://x/o">o</a><span class="re-CardPackPremium-title">T</span></li>'
    rows = X.extract_cards(
        pages(spark, "fotocasa", modern + old, old + old), ["fotocasa"]
    ).orderBy("page_id", "position").collect()
    assert [(r.page_id, r.url, r.title) for r in rows] == [
        (0, "https://www.fotocasa.es/m", "Sin título"), (1, "https://x/o", "T"), (1, "https://x/o", "T")
    ]


def test_next_page(spark):
    htmls = [
        '<a data-testid="re-Pagination-nextPage" href="/l/2">x</a>',
        '<a class="sui-AtomButton--end" href="https://x/3">x</a>', "<a href='/4'>x</a>",
    ]
    rows = X.next_page(pages(spark, "fotocasa", *htmls)).orderBy("page_id").collect()
    assert [r.next_url for r in rows] == ["https://www.fotocasa.es/l/2", "https://x/3", None]


@pytest.mark.parametrize("text, expected", [
    ("a &amp; b", "a & b"), ("&eacute;&#233;&#xE9;", "ééé"), ("&unknown; & &#0; &#xD800;", "&unknown; & &#0; &#xD800;"),
    ("&amp;lt;", "&lt;"), ("plain", "plain"), ("", ""), ("&nbsp;x", " x"), ("AT&T; x;", "AT&T; x;"),
])
def test_entities(spark, text, expected):
    assert spark.range(1).select(M.decode_entities(F.lit(text))).first()[0] == expected


def test_long_unclosed_markup(spark):
    html = "<article class='item'>" + "<b>x" * 200_000
    assert X.extract_cards(pages(spark, "idealista", html), ["idealista"]).count() == 0
    closed = "<article class='item'>" + "<p>x</p>" * 100_000 + "<a class='item-link' href='/z'>z</a></article>"
    assert X.extract_cards(pages(spark, "idealista", closed), ["idealista"]).count() == 1


@pytest.mark.parametrize("html, reason", [
    ('<body><iframe src="https://x/recaptcha/api"></iframe>Access denied</body>', "CAPTCHA detected: iframe[src*='captcha']"),
    ('<body><form id="challenge-form"></form></body>', "CAPTCHA detected: #challenge-form"),
    ('<body><div class="a cf-turnstile b"></div></body>', "CAPTCHA detected: .cf-turnstile"),
    ("<body><p>Has sido <b>BLOQUEADO</b></p>", "Block text detected: 'has sido bloqueado'"),
    ("<body>ACCESS DENIED</body>", "Block text detected: 'Access Denied'"),
    ("<title> 403\n Forbidden </title><body>x</body>", "Block page title: '403 Forbidden'"),
    ("<title>Pisos</title><!-- <div class='captcha'> --><body>rate  limits</body>", ""),
])
def test_blocking(spark, html, reason):
    row = X.detect_blocking(pages(spark, "s", html)).first()
    assert (row.reason, row.blocked) == (reason, reason != "")


def test_registry():
    assert X.portal(" IDEALISTA ") is X.IDEALISTA
    with pytest.raises(ValueError, match="available: .*fotocasa.*idealista"):
        X.portal("nowhere")
    with pytest.raises(TypeError):
        X.register("nowhere")


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "y")], "x int, y string")
    assert sorted(tuple(r) for r in X.union_records(a, b).collect()) == [(1, None), (2, "y")]


def nested(depth, inner):
    return "<article>" * depth + inner + "</article>" * depth


def test_markup_of_any_depth_and_quoting(spark):
    link = '<a class="item-link" href="/a">T</a>'
    htmls = [
        f'<article class="item">{nested(40, "x")}{link}</article>',
        '<article class="item"><a title="a>b" class="item-link" href="/a">T</a></article>',
        "<article data-class='x>' class=item><a class=item-link href=/a>T</a></article>",
        f'<article data-class="item">{link}</article>',
        f'<article class="item">{link}<div><span class="item-detail"><span>80</span> m²</span>'
        '<span class="item-detail">3 hab.</span></div></article>',
        f'<article class="item">{link}<article class="item">{link}</article></article>',
        f'<article class="item">{link}',
    ]
    rows = X.extract_cards(pages(spark, "idealista", *htmls), ["idealista"]).collect()
    found = {}
    for r in rows:
        found.setdefault(r.page_id, []).append((r.url, r.title, r.raw_area, r.raw_rooms))
    plain = ("https://www.idealista.com/a", "T", "", None)
    assert found == {
        0: [plain], 1: [plain], 2: [plain],
        4: [("https://www.idealista.com/a", "T", "80 m²", "3 hab.")], 5: [plain, plain], 6: [plain],
    }


@pytest.mark.parametrize("text, expected", [
    ("&#000000233;&#xE9;&#128512;&#x1F600;", "éé😀😀"), ("L&apos;H &amp;amp; &notin;&Aacute;", "L'H &amp; ∉Á"),
    ("&#0;&#xD800;&#1114112;&#99999999999;&nope;&amp", "&#0;&#xD800;&#1114112;&#99999999999;&nope;&amp"),
])
def test_references(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(M.decode_entities(F.col("t"))).first()[0] == expected


def test_block_notices_without_body_and_quotes(spark):
    htmls = [
        "<h1>Access Denied</h1>", "<iframe src=//x/recaptcha/a></iframe><body>x</body>",
        '<body><iframe data-src="//x/captcha.js"></iframe></body>',
        "<head><title>403</title></head>nothing", "<body><p id=challenge-form></p></body>",
    ]
    rows = X.detect_blocking(pages(spark, "s", *htmls)).orderBy("page_id").collect()
    assert [r.reason for r in rows] == [
        "Block text detected: 'Access Denied'", "CAPTCHA detected: iframe[src*='captcha']", "",
        "Block page title: '403'", "CAPTCHA detected: #challenge-form",
    ]


LISTED = X.Portal(source="list", host="https://x", cards=(Element("li"),), link=(Element("a"),),
                  title=(Element("a"),), price=(Element("b", child=1),), rooms=(Element("b", child=2),))


@pytest.mark.parametrize("html, titles", [
    ("<ul><li><a>1</a><li><a>2</a></ul><a>out</a>", ["1", "2"]),
    ("<ul><li><a>1</a><ul><li><a>2</a><li>none</ul><li><a>3</a></li></ul>", ["1", "2", "3"]),
    ("<ol><li>x<ul><li><a>in</a></ul></ol><ul><li>none</ul><a>out</a>", ["in", "in"]),
    ("<li><a>1</a></li><li><a>2</a>", ["1", "2"]),
    ("</ul></li><ul><li><a>1</a></li></ul></ul><li><a>2</a>", ["1", "2"]),
    ("<UL><LI CLASS=x><A>1</A><lid><li\n><a>2</a></UL>", ["1", "2"]),
])
def test_list_items_end_where_the_next_begins(spark, html, titles):
    rows = X.extract_cards(pages(spark, "list", html), [LISTED]).orderBy("position").collect()
    assert [r.title for r in rows] == titles


@pytest.mark.parametrize("card, price, rooms", [
    ("<p><b>1</b><b>2</b></p>", "1", "2"), ("<p>x<br><b>2</b></p>", "", "2"),
    ("<p><i>a<b>1</b></i><b>2</b></p>", "1", "2"), ("<p><b>1<i>x</i></p><q><i></i><b>2</b></q>", "1x", "2"),
    ("<b>1</b><!-- <b> --><b>2", "", "1"), ("</p></b><q><b><b>2</b>1</b></q>", "21", None),
])
def test_children_by_place(spark, card, price, rooms):
    row = X.extract_cards(pages(spark, "list", f"<li><a href=x>t</a>{card}"), [LISTED]).first()
    assert (row.raw_price, row.raw_rooms) == (price, rooms)


def test_elements_equal_a_stack(spark):
    """Spans of divs in random markup against a plain stack."""
    import random

    draw = random.Random(5)
    htmls = []
    for _ in range(60):
        htmls.append("".join(
            draw.choice(["<div class=a>", "<div>", "</div>", "x", "<p>"]) + str(i)
            for i in range(draw.randrange(0, 40))
        ))

    def plain(html):
        import re

        tags = list(re.finditer(r"</?div[^>]*>", html))
        open_, spans = [], []
        for tag in tags:
            if tag[0].startswith("</"):
                if open_:
                    start = open_.pop()
                    spans.append((start.start(), html[start.start():tag.start()], start[0]))
            else:
                open_.append(tag)
        spans += [(t.start(), html[t.start():], t[0]) for t in open_]
        return [text for _, text, tag in sorted(spans) if "class=a" in tag]

    rows = spark.createDataFrame(list(enumerate(htmls)), "i int, h string").select(
        "i", M.elements(F.col("h"), Element("div", "a")).alias("e")).collect()
    assert all(r.e == plain(htmls[r.i]) for r in rows) and sum(len(r.e) for r in rows) > 100


@pytest.mark.parametrize("item", ["<li><a href=/z>z</a>", "<li><a href=/z>z</a></li>"])
def test_work_grows_with_the_page(spark, item):
    """A hundred thousand items, closed or not, and each one a card of its own."""
    found = X.extract_cards(pages(spark, "list", "<ul>" + item * 100_000), [LISTED])
    assert found.agg(F.count("*"), F.max("position"), F.min("title"), F.max("title")).first()[:] == (
        100_000, 99_999, "z", "z")
