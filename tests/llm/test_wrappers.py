import html
import re

import pytest

from tasador.llm import wrappers as W

SCHEMA = "page_id long, url string, html string"


def plain(page):
    """The article of the given pages, by plain patterns."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    expected = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    found = W.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in found} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in found)


@pytest.mark.parametrize("page, text", [
    ("<div class=menu>m</div><main><h1>T &amp; U</h1><p>a <b>b</b>\n c<p>d</main>", "T & U\na b c\nd"),
    ("<nav>n</nav><div id='content'><ul><li>1<li>2</ul><div class='comments'>no</div></div>", "1\n2"),
    ("<article><p title='a>b'>x<!-- <p>no</p> -->y<script>var t='</p>'</script></article>", "xy"),
    ("<article><p>one<form>no</form><aside>no</aside><p>&#128512;&eacute;&ampx</article>", "one\n😀é&x"),
    ("<div><div><p>long text of the page, much of it</p><p>and more</p></div><footer>f</footer></div>",
     "long text of the page, much of it\nand more"),
    ("plain", "plain"), ("", ""), (None, ""), ("<p", ""), ("<article></article>", ""),
    ("<article>" + "<div>" * 5_000 + "deep<p>er" + "</div>" * 5_000 + "</article>", "deep\ner"),
])
def test_main_text(page, text):
    assert W.main_text(page, "") == text


def layout(page):
    return W.wrapper_of(W.parse(page))


def test_alignment_makes_optional_and_repeated_items():
    a = layout("<article><h1>t</h1><p>a</p><p>b</p></article>")
    b = layout("<article><h1>t</h1><figure>f</figure><p>a</p></article><div class=ad>x</div>")
    both = W.merge(a, b)
    assert W.expression(both) == "<><article><h1>#</> (<figure>#</>)? (<p>#</>)+</> (<div.ad>#</>)?</>"
    assert W.region(both) == "article"
    pairs = layout("<dl>" + "<dt>a</dt><dd>b</dd>" * 3 + "</dl>")
    assert W.expression(pairs) == "<><dl>(<dt>#</> <dd>#</>)+</></>"
    assert W.merge(both, both) == both


def test_one_wrapper_for_a_host(spark):
    rows = [(i, f"http://u@h.example:80/{i}", f"<main>{'<p>x</p>' * (i % 5)}<h2>y</h2></main>") for i in range(60)]
    rows += [(100, None, None), (101, "no host", "<article>z</article>"), (5, rows[5][1], rows[5][2])]
    table = spark.createDataFrame(rows, SCHEMA)
    found = W.extract(table).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[100] == "" and texts[101] == "z" and texts[3] == "x\nx\nx\ny"
    assert W.extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<div class='main-menu'>m</div><div class='content'><p>a</p></div>", "a"),
    ("<div id=content><p>a</p><div class='post-comments'>no</div><div class='content-sidebar'>no</div></div>", "a"),
    ("<main class='main-menu'><p>a</p><div class='post-navigation'>no</div></main>", "a"),
    ("<body class='post has-sidebar'><div class='entry-header'><h1>t</h1></div>"
     "<div class='content with-sidebar'>a</div></body>", "t\na"),
])
def test_aside_words_win_over_article_words(page, text):
    assert W.main_text(page, "") == text
    if "main-menu" in page and "content" in page:
        assert W.region(layout(page)) == "div.content"


@pytest.mark.parametrize("depth", [10, 200, 5_000])
def test_deep_elements_end_nothing_else_and_keep_their_asides_out(depth):
    down, up = "<div>" * depth, "</div>" * depth
    page = f"<div><article>{down}deep<nav>no<p>no</p></nav><div class=comments>no</div>er{up}<p>after</p></article></div>x"
    assert W.main_text(page, "") == W.main_text(page, "article") == "deep\ner\nafter"
    assert W.main_text(f"{down}<nav>no</nav><article>a</article>{up}<footer>no</footer>", "") == "a"
    assert W.expression(layout(page))


def test_unclosed_tags_and_stray_end_tags_cost_no_search():
    page = "<div>" * 30_000 + "</section>" * 30_000 + "<nav>no</nav><p>a"
    assert W.main_text(page, "") == "a"


def host(*pages):
    """Texts of the pages of a host."""
    wrapper = None
    for page in pages:
        wrapper = layout(page) if wrapper is None else W.merge(wrapper, layout(page))
    return [W.main_text(p, W.region(wrapper), wrapper if W.varies(wrapper) else None) for p in pages]


def unnamed(i, n=3):
    menu = "<div><ul><li>Home</li><li>News</li><li>About us</li></ul></div>"
    paragraphs = "".join(f"<p>par {i}.{k}</p>" for k in range(n))
    return (f"<body>{menu}<h1>title {i}</h1><div>{paragraphs}<h2>More</h2></div>"
            f"<div><p>last {i}</p><p>Write to us</p></div><div>All rights</div></body>")


def test_unnamed_articles_are_what_varies():
    page = "<h1>h</h1><div><p>A</p><p>B</p></div><div><p>C</p></div>"
    assert W.main_text(page, "") == "h\nA\nB\nC"
    found = host(*[unnamed(i, 2 + i % 3) for i in range(5)])
    for i, text in enumerate(found):
        own = [f"par {i}.{k}" for k in range(2 + i % 3)]
        assert text.split("\n") == [f"title {i}", *own, "More", f"last {i}"]
    # Equal pages, a single one, and texts of some pages only tell no template.
    assert host(page, page) == ["h\nA\nB\nC"] * 2
    assert host("<p>a1</p><div>x</div>", "<p>a2</p><div>x</div>", "<p>a3</p>")[0] == "a1\nx"


def test_names_count_only_where_pages_differ():
    pages = [f"<div class=content>Welcome</div><div class=story><p>text {i}</p></div>" for i in range(3)]
    assert host(*pages) == [f"text {i}" for i in range(3)]
    pages = [f"<div class=content>Welcome</div><div><p>text {i}</p></div>" for i in range(3)]
    assert host(*pages) == [f"text {i}" for i in range(3)]
    pages = [f"<div>menu</div><article><p>t{i}</p><p>same</p></article>" for i in range(3)]
    assert host(*pages) == [f"t{i}\nsame" for i in range(3)]


def test_literals_merge_alike_in_any_order():
    pages = [layout(unnamed(i, 2 + i % 2)) for i in range(4)]
    whole = W.merge(W.merge(pages[0], pages[1]), W.merge(pages[2], pages[3]))
    assert whole == W.merge(pages[3], W.merge(pages[1], W.merge(pages[2], pages[0])))
    assert W.merge(whole, whole) == whole


def test_unnamed_host_by_the_operator(spark):
    rows = [(i, f"http://h.example/{i}", unnamed(i, 2 + i % 3)) for i in range(40)]
    table = spark.createDataFrame(rows, SCHEMA)
    expected = dict(enumerate(host(*[r[2] for r in rows])))
    for parts in (1, 7):
        found = W.extract(table.repartition(parts)).collect()
        assert {r["page_id"]: r["text"] for r in found} == expected
