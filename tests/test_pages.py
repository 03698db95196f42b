import pytest
from pyspark.sql import functions as F

from orgloom.operators import extract
from orgloom.operators.nodes import node_table, with_nodes
from orgloom.schemas import ExtractionSpec

SPEC = ExtractionSpec()
TITLE, HEADER, BAR, CATEGORY = SPEC.title_class, SPEC.header_class, SPEC.bar_class, SPEC.category_class


def parsed(spark, html, **options):
    pages = spark.createDataFrame([("u", html)], "requested_url string, html string")
    return with_nodes(pages, SPEC, **options)


def value(spark, html, fn):
    return parsed(spark, html).select(fn(F.col("page")).alias("v")).collect()[0].v


def elements(spark, html, *columns):
    rows = node_table(parsed(spark, html, all_tags=True)).orderBy("node_id").collect()
    return [tuple(r[c] for c in columns) for r in rows]


def test_tree_without_implied_end_tags(spark):
    rows = elements(spark, "<ul><li>a<li>b</ul><p>c", "tag", "node_id", "parent_id", "last_desc_id")
    assert rows == [("ul", 0, -1, 2), ("li", 1, 0, 2), ("li", 2, 1, 2), ("p", 3, -1, 3)]


def test_stray_end_tags_and_void_elements(spark):
    rows = elements(spark, "<div></p><br>x</br><span/>y</div></div><b>z", "tag", "parent_id", "n_inner")
    assert rows == [("div", -1, 2), ("br", 0, 0), ("span", 0, 0), ("b", -1, 0)]


def test_end_tag_closes_back_to_its_match(spark):
    rows = elements(spark, "<div><span><b>x</div><i>y</i>", "tag", "parent_id", "last_desc_id")
    assert rows == [("div", -1, 2), ("span", 0, 2), ("b", 1, 2), ("i", -1, 3)]


def test_names_classes_and_attributes(spark):
    rows = elements(spark, '<DIV Class="a  b\n c" DATA-x="1&amp;2" hidden>', "tag", "classes", "attrs")
    assert rows == [("div", ["a", "b", "c"], {"class": "a  b\n c", "data-x": "1&2", "hidden": ""})]


@pytest.mark.parametrize(
    "html, raw, stripped",
    [
        ("<h1> A <b> B</b>\n</h1>", " A  B\n", "AB"),
        ("<h1>a<!-- c --> b</h1>", "a b", "ab"),
        ("<h1>a<script>x</script><style>y</style>b</h1>", "ab", "ab"),
        ("<h1>a<template><i>x</i></template>b</h1>", "ab", "ab"),
        ("<h1>a<b>   </b>c<i> \n </i>d</h1>", "a c\nd", "acd"),
        ("<h1>x &amp; y &#8211; &#x41; &#150; &nosuch; &copy</h1>", "x & y – A – &nosuch; ©", "x & y – A – &nosuch; ©"),
        ("<h1> a&nbsp;</h1>", " a ", "a"),
        ("<h1>open <i>end", "open end", "openend"),
        ("<h1><![CDATA[x]]>y</h1>", "xy", "xy"),
    ],
)
def test_text_modes(spark, html, raw, stripped):
    node = node_table(parsed(spark, html)).filter("tag = 'h1'").collect()[0]
    # an unknown entity loses its semicolon
    assert (node.text_raw, node.text_stripped) == (raw.replace("&nosuch;", "&nosuch"), stripped.replace("&nosuch;", "&nosuch"))


def test_the_short_cut_for_usual_tags_changes_nothing():
    import random
    from html.parser import HTMLParser

    from orgloom.operators.tokenizer import Pages, PageTokenizer

    class Plain(PageTokenizer):
        parse_starttag, parse_endtag = HTMLParser.parse_starttag, HTMLParser.parse_endtag

    rng = random.Random(3)
    pieces = [
        '<div class="a b">', "<DIV>", "</div>", "</DIV >", "<p", ">", '"', "'", "=", "<b a=1>", "<b a='1'>", "</b", "</>",
        '<a href="x>y" b="1\n2">', '<a href="x&amp;y">', "<br/>", "<br>", '<i a="1"b="2">', '<i a="1"/>', "< i>", "<1>",
        "<script>", "</script>", "</p>", "<style>", "</style>", "text ", "&amp;", "&am", "&#65", "<!-- c -->", "<!doctype x>",
        "<title>", "</title>", "<textarea>", "</textarea>", "<!", "<?pi>", "\n", "<i a>", '<i a = "1">', '<i A-b="1" >',
        "<a:b>", "<x-y>", "</x-y>", '<span\tid="1">', "<span\n>",
    ]
    both = [c(None, frozenset(), frozenset(), frozenset({"div", "a", "b", "i"})) for c in (PageTokenizer, Plain)]
    for _ in range(20_000):
        html = "".join(rng.choices(pieces, k=rng.randint(1, 12)))
        results = []
        for tokenizer in both:
            pages = Pages()
            try:
                tokenizer.read(html, pages)
                results.append((pages.nodes, pages.texts))
            except AssertionError as error:  # raised by the standard library for some broken declarations
                results.append(str(error))
        assert results[0] == results[1], html


def test_missing_source_and_bad_pages_are_rows(spark):
    rows = parsed(spark, None).collect()
    assert (rows[0].page.nodes, rows[0].page.texts, rows[0].parse_error) == (None, None, "no page source")


def test_a_page_that_cannot_be_parsed_does_not_disturb_the_others(spark):
    good = "<h1>a<b>c</b></h1>"
    rows = [("1", good), ("2", f"<h1>x<![bad {good}"), ("3", None), ("4", good)]
    pages = spark.createDataFrame(rows, "requested_url string, html string").coalesce(1)
    found = {r.requested_url: r for r in with_nodes(pages, SPEC).collect()}
    assert found["1"].page == found["4"].page and found["1"].page.texts == ["a", "c"]
    for bad in ("2", "3"):
        assert found[bad].page.nodes is None and found[bad].page.texts is None
    assert found["2"].parse_error.startswith("AssertionError") and found["1"].parse_error is None


def test_batches_are_cut_without_losing_rows(spark):
    from orgloom.operators import tokenizer

    import pyarrow as pa

    run = tokenizer.batch_tokenizer(None, frozenset(), frozenset(), frozenset({"b"}), max_chars=10)
    batch = pa.record_batch({"id": list(range(7)), "html": ["<b>12</b>", None, "<b>3</b>"] * 2 + [""]})
    out = list(run([batch]))
    assert len(out) > 1
    assert [i for b in out for i in b.column("id").to_pylist()] == list(range(7))


def test_a_worker_holds_the_elements_of_little_text_at_once():
    import tracemalloc

    import pyarrow as pa

    from orgloom.operators import nodes, tokenizer

    html = '<div class="a b"><p id="x">some words</p><br></div>' * 200
    batch = pa.record_batch({"id": list(range(400)), "html": [html] * 400})  # 4 MB
    run = tokenizer.batch_tokenizer(None, frozenset(), frozenset(), None, max_chars=nodes.BATCH_CHARS)
    tracemalloc.start()
    try:
        ids = [i for made in run([batch]) for i in made.column("id").to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert ids == list(range(400))
    assert peak < 60 * 1024 * 1024, peak


def test_only_kept_elements_leave_the_parser(spark):
    html = f'<div><p>x</p><div class="{HEADER}"><h2>1</h2></div><li {SPEC.item_attr}="0"><a>y</a></li></div>'
    tags = [n["tag"] for n in parsed(spark, html).collect()[0].page.nodes]
    assert tags == ["div", "h2", "li"]


def test_headings(spark):
    html = f'<h1> first </h1><h1 class="x {TITLE}"> A <b> B </b></h1><h1 class="{TITLE}">later</h1>'
    assert value(spark, html, extract.first_heading) == "first"
    assert value(spark, html, lambda n: extract.page_title(n, SPEC)) == "AB"
    assert value(spark, "<h1></h1>", extract.first_heading) == ""
    assert value(spark, "<h2>x</h2>", extract.first_heading) is None


def pairs(spark, html):
    return [(p["heading"], p["dd"], p["next_dd"]) for p in value(spark, html, extract.dt_dd_pairs)]


def test_pairs_skip_other_elements_and_share_a_following_dd(spark):
    html = "<dl><dt>A</dt><p></p><dd>1</dd><dt>B</dt><dt>C</dt><span></span><dd>2</dd><dt>D</dt></dl>"
    assert pairs(spark, html) == [("A", "1", "2"), ("B", "2", None), ("C", "2", None), ("D", None, None)]


def test_pairs_stay_among_siblings(spark):
    html = "<dl><dt>A</dt><div><dt>B</dt><dd>b</dd></div><dd>a<dl><dt>C</dt></dl></dd></dl><dl><dd>other</dd></dl>"
    found = {heading: (dd, following) for heading, dd, following in pairs(spark, html)}
    assert found == {"A": ("aC", None), "B": ("b", None), "C": (None, None)}


def test_unclosed_items_nest(spark):
    assert pairs(spark, "<dl><dt>A<dd>1<dt>B<dd>2</dl>") == [("A1B2", None, None), ("B2", None, None)]


def profile(spark, html):
    def fields(nodes):
        return extract.profile_fields(extract.profile_values(extract.dt_dd_pairs(nodes)), SPEC)

    return {k: v for k, v in value(spark, html, fields).asDict().items() if v != "-"}


def test_pairs_of_wanted_headings_only(spark):
    html = "<dl><dt>A</dt><dd>1</dd><dt>B</dt><dt>C</dt><dd>2</dd></dl><dl><dt>B</dt><dd>3</dd></dl>"
    found = value(spark, html, lambda page: extract.dt_dd_pairs(page, ["B"]))
    assert [(p.heading, p.dd, p.next_dd) for p in found] == [("B", "2", None), ("B", "3", None)]


def test_profile_takes_the_last_value_and_known_headings_only(spark):
    html = "<dl><dt>Industry</dt><dd>a</dd><dt> Industry </dt><dd> b <i> c</i></dd><dt>Phone</dt><dd>1</dd><dt>Industry</dt></dl>"
    assert profile(spark, html) == {"industry": "bc"}


def test_an_empty_value_is_a_value(spark):
    assert profile(spark, "<dl><dt>Website</dt><dd></dd></dl>") == {"website": ""}


def test_company_size_and_members(spark):
    html = "<dl><dt>Company size</dt><dd>51-200 employees</dd><dd> 1,077 associated members </dd></dl>"
    assert profile(spark, html) == {"company_size": "'51-200", "members": "1,077"}
    # the members count may sit behind another heading
    html = "<dl><dt>Company size</dt><dd>Self-employed</dd><dt>Founded</dt><dd>5 associated members</dd></dl>"
    assert profile(spark, html) == {"founded": "5 associated members", "members": "5"}
    # a later own heading wins over the count, and the other way round
    own = "<dt>No. of associated members</dt><dd>many</dd>"
    size = "<dt>Company size</dt><dd>1 employees</dd><dd>9 associated members</dd>"
    assert profile(spark, f"<dl>{size}{own}</dl>")["members"] == "many"
    assert profile(spark, f"<dl>{own}{size}</dl>")["members"] == "9"


def test_members_in_the_header(spark):
    def members(html):
        return value(spark, html, lambda n: extract.header_members(n, SPEC))

    good = f'<div class="a {HEADER}"><p><h2> 2,345 associated members</h2></p><h2>1 associated member</h2></div>'
    assert members(good) == "2,345"
    assert members("<div><h2>2 associated members</h2></div>") is None
    assert members(f'<div class="{HEADER}"></div><h2>2 associated members</h2>') is None
    assert members(f'<div class="{HEADER}"></div>' + good) is None


def bar(content):
    return f'<button class="x {BAR}">{content}</button>'


def test_bars_in_document_order_of_the_first_list_item(spark):
    label = '<span class="y">no</span><div><span class="{c}"> {l} </span></div>'
    html = (
        f'<li>plain</li><li class="x">plain</li><li {SPEC.item_attr}="2">other</li><li {SPEC.item_attr}="0"><ul><li {SPEC.item_attr}="0">'
        + bar(f"<b><strong> 1,5 </strong></b><strong>9</strong>{label.format(c=CATEGORY, l='Berlin')}")
        + "<button><strong>7</strong></button>"
        + bar(f"{label.format(c=CATEGORY, l='A &amp; B')}")
        + bar("<strong>3</strong>")
        + f'</li></ul></li><li {SPEC.item_attr}="0">{bar("<strong>8</strong>")}</li>'
    )
    bars = value(spark, html, lambda n: extract.facet_bars(n, "0", SPEC))
    assert [tuple(b) for b in bars] == [("Berlin", "1,5"), ("A & B", "-"), ("-", "3")]
    assert value(spark, html, lambda n: extract.facet_bars(n, "2", SPEC)) == []
    assert value(spark, html, lambda n: extract.facet_bars(n, "1", SPEC)) == []


def test_a_bar_with_spans_but_no_category(spark):
    html = f'<li {SPEC.item_attr}="0">{bar("<span>x</span>")}</li>'

    def bad(nodes):
        return extract.has_unlabelled_bar(extract.facet_bars(nodes, "0", SPEC))

    assert value(spark, html, bad) is True
    assert value(spark, html, lambda n: extract.has_class(n, BAR)) is True
    assert value(spark, "<p></p>", lambda n: extract.has_class(n, BAR)) is False


def test_deep_nesting_does_not_multiply_the_text(spark):
    n = 5000
    page = parsed(spark, "<span>some text" * n).collect()[0].page
    assert len(page.nodes) == n and page.texts == ["some text"] * n
    assert page.nodes[0].text_count == n and page.nodes[-1].text_count == 1


def test_a_page_with_very_many_elements(spark):
    n = 20_000
    items = "".join(f"<dt>Industry</dt><dd>v{i}</dd>" for i in range(n))
    buttons = "".join(bar(f'<strong>{i}</strong><span class="{CATEGORY}">l{i}</span>') for i in range(n))
    html = f'<dl>{items}</dl><li {SPEC.item_attr}="0">{buttons}</li>'
    assert profile(spark, html) == {"industry": f"v{n - 1}"}
    bars = value(spark, html, lambda x: extract.facet_bars(x, "0", SPEC))
    assert len(bars) == n and tuple(bars[-1]) == (f"l{n - 1}", str(n - 1))


def test_every_element_has_the_text_inside_it(spark):
    html = "<article id='x'>a <p>b<b> c </b><ul><li>d</li></ul></p><nav><x-y>e</x-y></nav></article>"
    pages = spark.createDataFrame([("u", html)], "requested_url string, html string")
    rows = node_table(with_nodes(pages, ExtractionSpec(), all_tags=True, all_texts=True)).collect()
    assert {r.tag: (r.text_raw, r.text_stripped) for r in rows} == {
        "article": ("a b c de", "abcde"), "p": ("b c d", "bcd"), "b": (" c ", "c"), "ul": ("d", "d"),
        "li": ("d", "d"), "nav": ("e", "e"), "x-y": ("e", "e"),
    }
