from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import html_text as H


@pytest.mark.parametrize(
    "html,want",
    [
        ("<title>no</title>a <b>b</b>c  d<br>e", "a bc d\ne"),
        ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
        ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>f", "- a\n- b\n  3. c\n  4. d\n- e\n\nf"),
        ("<ul><li><p>x<p>y</ul>", "- x\n\n  y"),
        ("<head><style>p{}</style><p>shown", "shown"),
        ("<div hidden>a</div><p style='color:red;DISPLAY : none'>b</p><i style=visibility:hidden>c</i><!-- d --><template>e</template>f", "f"),
        ("<script>if (a < b) '<p>'</script>x<noscript>y</noscript>", "x"),
        ("<pre> a\n  b\n\nc</pre>d", " a\n  b\n\nc\n\nd"),
        ("<table><tr><th>name<th>n<tr><td>apple pie<td>1</table>", "name       n\napple pie  1"),
        ("<table><td>a<td>b</table>", "a  b"),
        ("<table><tr><td rowspan=2>r<td>x<tr><td>y</table>", "r  x\n   y"),
        ("<table><caption>C</caption><tr><td colspan=2>w<td>z<tr><td>aaa<td>bbb<td>c</table>", "C\nw         z\naaa  bbb  c"),
        ("<table><tr><td><table><tr><td>in<td>side</table><td>out</table>", "in  side  out"),
        ("<p>a</p><!--><p>b</p><!---><p>c</p><!--x--!><p>d</p><!-- - -- > --><p>e", "a\n\nb\n\nc\n\nd\n\ne"),
        ("<p>pick <select><option>one<option selected>two</select> now", "pick two now"),
        ("<select><option disabled>choose<optgroup label=g><option label=L>one</select>", "L"),
        ("<select multiple><optgroup label=g><option>a<option>b</select>", "g\na\nb"),
        ("<input type=submit value=Send> <input value='my text'> <input placeholder=name> <input type=checkbox value=on>", "Send my text name"),
        ("<svg><title>t</title><defs><text>d</text></defs><text>one</text><text>two <tspan>three</tspan></text></svg>x", "one\ntwo three\nx"),
        ("<svg><title/><g/><style/></svg>x", "x"),
        ("a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> b", "a x=1 b"),
        ("<svg><text>a<p>b</svg>c", "a\n\nbc"),
        ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c<ul><li>d</ul></div>e", "b\n\ne"),
        ("<table style='visibility:hidden'><tr><td>a<td style='visibility:visible'>b</table>", "  b"),
        ("<details>a<summary>s</summary>b</details><details open><summary>t</summary>c</details><dialog>d</dialog><dialog open>e</dialog>", "s\nt\nc\ne"),
        ("<table><tr><td><p>a<p>b<td><ul><li>c<li>d</ul><td>e</table>", "a  - c  e\n   - d\nb"),
        ("<table><tr><td>x<td><pre>1\n  2</pre><tr><td>long one<td>y</table>", "x         1\n            2\nlong one  y"),
        ("<table><tr><td>" + "w" * 45 + "<td>b<tr><td>a<td>c</table>", "w" * 45 + "  b\na" + " " * 46 + "c"),
        ("<table><tr><td><table><tr><td>a<td>b<tr><td>cc<td>d</table><td>e<tr><td>f<td>g</table>", "a   b  e\ncc  d\nf      g"),
        ("<table><tbody><tr><td rowspan=0>r<td>x<tr><td>y<tbody><tr><td>z<td>u</table>", "r  x\n   y\nz  u"),
        ("<table><tr><td>one<tr><td><p>two<p>three</table>", "one\n\ntwo\n\nthree"),
        ("<a title=\"'q'\">x</a>", "x"),
        ("&lt;b&gt; &amp;&nbsp;&#233;&bogus; &am", "<b> &\xa0é&bogus; &am"),
        ("a<a title='x > y'>b</a><br/>c<input type=hidden value=v><option>o<option>p", "ab\nc\no\np"),
        ("</p></div>x</li>y", "xy"),
        ("text <unclosed", "text"),
        ("a < b and 1<2", "a < b and 1<2"),
        (None, ""),
        ("", ""),
    ],
)
def test_layout(html, want):
    assert H.render(html)[0] == want


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<>/=\"' abp!-&;\n")) | st.lists(st.sampled_from(["<p>", "<li>", "</ul>", "<ul>", "<td>", "<table>", "</table>", "x", "<tr>", "<b>", "</b>"])).map("".join))
def test_any_text_is_a_page(html):
    H.render(html)


SHOWN = sorted((H.BLOCK | set("a b i em span svg math text mi button label td th foreignobject g textarea q sub".split())) - {"dialog", "details", "html"})
PIECES = [f"<{t}>" for t in SHOWN] + [f"</{t}>" for t in SHOWN] + ["<!-->", "<!--->", "<!-- w -->", "<!--w--!>", "<br>", "<option>", "<p hidden>w</p>"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, *(["word "] * 40)]), max_size=40))
def test_no_visible_word_is_lost(parts):
    """Over all elements that show their text, in any order, closed or not."""
    words = [f" w{i} " if part == "word " else part for i, part in enumerate(parts)]
    raw = False  # tags in a text area are its text
    for part in parts:
        raw = part == "<textarea>" or (raw and part != "</textarea>")
        if raw and part == "<p hidden>w</p>":
            return
    html = "".join(words)
    assert sorted(re.findall(r"w\d+", H.render(html)[0])) == sorted(re.findall(r"w\d+", html))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.lists(st.integers(1, 60), min_size=1, max_size=3), min_size=2, max_size=4), min_size=1, max_size=6))
def test_columns_are_in_line(table):
    """Any line of any cell starts at its column, however wide the cells are."""
    html = "<table>" + "".join(
        "<tr>" + "".join("<td>" + "<br>".join(f"{chr(97 + c)}" * n for n in cell) for c, cell in enumerate(row)) for row in table
    )
    text = H.render(html)[0].split("\n")
    for c in range(4):
        places = {line.index(chr(97 + c)) for line in text if chr(97 + c) in line}
        assert len(places) <= 1
    assert sum(len(line.replace(" ", "")) for line in text) == sum(n for row in table for cell in row for n in cell)


def test_one_long_cell_does_not_pad_a_long_table():
    html = "<table><tr><td>" + "word " * 20_000 + "<td>z" + "<tr><td>a<td>b" * 5_000
    text = H.render(html)[0]
    assert len(text) < 3_000_000 and len({line.index("b") for line in text.split("\n") if "b" in line}) == 1


def test_deep_and_long_pages():
    assert H.render("<div>" * 50_000 + "x")[0] == "x"
    assert H.render("<table><tr><td>" * 500 + "x")[0] == "x"
    assert H.render("<table><tr><td>a<td>" * 5_000)[0].count("a") == 5_000
    assert H.render("<table>" * 5_000 + "x")[0] == "x"
    assert H.render("<a b='" * 20_000)[0] == ""
    assert H.render("<p>word " * 50_000)[0].count("word") == 50_000


def test_rows(spark, sf_dir):
    rows = [(1, "<li>a<table><tr><td>b</table>"), (2, None), (None, "x"), (1, "<li>a<table><tr><td>b</table>")]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_items, r.n_tables, r.n_rows) for r in H.extract_text(frame).collect())
    assert got == [(0, "x", 0, 0, 0), (1, "- a\n\n  b", 1, 1, 1), (1, "- a\n\n  b", 1, 1, 1), (2, "", 0, 0, 0)]
    assert H.extract_text(frame.limit(0)).collect() == []
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = {r.page_id: r.text for r in H.op4_html_extraction(spark, sf_dir).collect()}
    assert len(texts) == pages.count() and all("<p>" not in t and "track(" not in t for t in texts.values())
