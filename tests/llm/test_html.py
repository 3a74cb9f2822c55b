import re
import unicodedata
from html import unescape

import pytest
from hypothesis import given
from hypothesis import strategies as st

from factspark.llm.html import extract, op3_html_text, render

GOLDEN = [
    ("a <b>b</b>\n c", "a b c"),
    ("<p>One<p>Two<div>Three</div>Four", "One\n\nTwo\n\nThree\nFour"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<h1>T</h1>x", "T\n\nx"),
    ("<ul><li>a<li>b</ul>c", "- a\n- b\n\nc"),
    ("<ol start=9><li>a<li value=20>b<li>c</ol>", "9. a\n20. b\n21. c"),
    ("<ol reversed start=3><li>a<li>b</ol>", "3. a\n2. b"),
    ("<ul><li>a<ul><li>b<p>c</ul><li>d</ul>", "- a\n  - b\n\n    c\n\n- d"),
    ("<ul><li>long<br>second</ul>", "- long\n  second"),
    ("<ul><li><ul><li>x</ul></ul>", "-\n  - x"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
    ("<table><tr><td rowspan=2>r<td>x<tr><td>y</table>", "r  x\n   y"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>1<td>2<td>3</table>", "wide  z\n1  2  3"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td><table><tr><td>i<td>j</table><td>k</table>", "i  j  k"),
    ("<table><caption>C</caption><thead><tr><th>h</thead><tbody><tr><td>v</table>", "C\nh\nv"),
    ("<pre>\n a\n\n  b</pre>", " a\n\n  b"),
    ("<blockquote>q</blockquote>r", "    q\n\nr"),
    ("<style>.x,#y{display:none} p{margin:0}</style><p class='z x'>no<p id=y>no<p>yes", "yes"),
    ("<p hidden>no<p style='display: none'>no<p>yes<template>no</template><noscript>no</noscript>", "yes"),
    ("<span style='visibility:hidden'>a<b style='visibility:visible'>b</b></span>", "b"),
    ("<details><summary>s</summary>no<p>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("<script>var a='<p>'</script>x<!-- c --><!DOCTYPE html>y<textarea>a\n <b></textarea>", "xya\n <b>"),
    ("<title>t</title>body", "body"),
    ("<head><meta charset=x><title>t</title>text<p>p", "text\n\np"),
    ("1 < 2 &amp; 3&nbsp;4 &lt;p&gt; <3", "1 < 2 & 3 4 <p> <3"),
    ("</p>a</div></table>b<td>c", "abc"),
    ("<a title='>'>x</a><a title=\"unclosed>y</a>z", "xyz"),
    ("<p>a<b>b<p>c</b>d", "ab\n\ncd"),
    ("<script>never closed <p>x", ""),
    ("<select><option>one<option>two</select>", "one\ntwo"),
    ("﻿<p>x", "x"),
    ("", ""),
    ("<", "<"),
]


@pytest.mark.parametrize(("html", "text"), GOLDEN)
def test_golden(html, text):
    assert render(html) == text


def test_every_visible_word_of_every_page_in_order(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op3_html_text(spark, sf).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        bare = re.sub(r"(?s)<script>.*?</script>|<style>.*?</style>|<title>.*?</title>|<!--.*?-->", "", pages[r.page_id])
        bare = unescape(re.sub(r"<[^>]*>", lambda m: "" if re.match(r"</?[ab]\b", m[0]) else " ", bare))
        assert re.sub(r"(?m)^- ", "", r.text).split() == bare.split()


def test_nesting_without_end_and_long_pages():
    assert render("<div>" * 20_000 + "x") == "x"
    assert render("<ul><li>" * 300 + "x").count("x") == 1
    assert render("<table><tr><td>" * 200 + "x") == "x"
    assert len(render("<p>word " * 50_000).split()) == 50_000
    assert render("<td colspan=99999999 rowspan=-5>x") == "x"
    assert render('<a "' * 100_000) != ""
    assert render('<a "' * 100_000 + ">") == ""
    assert render("x<p>y <!-- never closed <b") == "x\n\ny"


def test_edges(spark):
    df = spark.createDataFrame([(1, "<p>a", "t"), (1, "<p>a", None), (2, None, None), (3, "", None), (None, "x", None)], "page_id long, html string, text string")
    assert sorted(map(tuple, extract(df).collect()), key=str) == sorted([(1, "a"), (1, "a"), (2, None), (3, ""), (None, "x")], key=str)
    assert extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(("html", "text"), [
    ("<style>@media print{.nav,.body{display:none}}</style><p class=nav>n<p class=body>b", "n\n\nb"),
    ("<style>@media (max-width:600px){.x{display:none}}</style><p class=x>a", "a"),
    ("<style media=print>.x{display:none}</style><p class=x>a", "a"),
    ("<style>@media screen{.x{display:none}}@media not print{.y{display:none}}</style><p class=x>a<p class=y>b<p>c", "c"),
    ("<style>.x{display:none} @media (min-width:600px){.x{display:block}}</style><p class=x>a", "a"),
    ("<style>.x{display:none} @media print{.x{display:block}}</style><p class=x>a<p>b", "b"),
    ("<style>.x{display:none} .x{display:block}</style><p class=x>a", "a"),
    ("<style>.x{display:none}</style><style>.x{display:flex}</style><p class=x>a", "a"),
    ("<style>.x{display:none!important} .x{display:block}</style><p class=x>a<p>b", "b"),
    ("<style>#i{display:block} p{display:none} .x{display:none}</style><p class=x id=i>a<p>b", "a"),
    ("<style>.x{display:none}</style><p class=x style='display:block'>a", "a"),
    ("<style>@import 'a';@font-face{src:url(x)}@keyframes k{p{display:none}}.x{content:'}';display:none}</style><p>a<p class=x>b", "a"),
    ("<style>.c{p{display:none}} .d{color:red;@media print{display:none}}</style><p class=d>a", "a"),
    ("a <math><mfrac><mn>1</mn><mn>2</mn></mfrac> <mo>=</mo> <mi>x</mi><annotation>tex</annotation></math> b", "a 1 2=x b"),
    ("<svg><title>t</title><defs/><g> junk <text x=1>One <tspan>two</tspan></text><text>three</text></g></svg>", "One two\nthree"),
    ("<svg><path d='M0'/><rect/></svg>a<svg><p>b", "a\n\nb"),
])
def test_media_later_rules_and_foreign_content(html, text):
    assert render(html) == text


def test_long_style_sheets():
    assert render("<style>" + "@media print{" * 50_000 + ".x{display:none}" + "</style><p class=x>a") == "a"
    assert render("<style>" + "\"'/{;" * 50_000 + "</style><p>a") == "a"
    assert render("<style>" + "; " * 200_000 + "</style><p>a") == "a"


def plain_layout(html):
    """The layout of a page of paragraphs, headings and flat lists, by markers in its text instead of boxes."""
    bare = re.sub(r"(?s)<(script|style|title|head)\b.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>|</?(a|b|meta|head)\b[^>]*>", "", html)
    block = r"</?(?:p|h1|ul|li|html|body|nav|div|article|footer)\b"
    bare = re.sub(rf"(?s)(<p\b[^>]*>(?:(?!{block}).)*)(?=<(?!/p\b))", r"\1</p>", bare)  # the end that is left out
    marks = [(r"</?(p|h1|ul)\b[^>]*>", "\x01"), (r"<li\b[^>]*>", "\x02\x03"), (r"</?(li|html|body|nav|div|article|footer)\b[^>]*>", "\x02"), (r"<br\s*/?>", "\x04")]
    for tag, mark in marks:
        bare = re.sub(tag, mark, bare)
    out = ""
    for part in re.split(r"([\x01-\x04])", re.sub(r"[ \t\n\r\f]+", " ", unescape(bare))):
        if part in ("\x01", "\x02", "\x04"):
            out = out.rstrip(" ") + part
        elif part == "\x03" or part.strip(" "):
            out += "- " if part == "\x03" else part.lstrip(" ") if not out or out[-1] in "\x01\x02\x04" or out.endswith("\x02- ") else part
        elif out and out[-1] not in " \x01\x02\x04":
            out += part
    gap = lambda m: "\n" * max(m[0].count("\x04"), 2 if "\x01" in m[0] else 1)
    return re.sub(r"[\x01\x02\x04]+", gap, out.strip(" \x01\x02\x04"))


@pytest.mark.parametrize("sf", ["sf0.01", "check_s"])
def test_the_layout_of_every_page(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    if {"table", "ol", "pre"} & {m for r in pages.limit(200).collect() for m in re.findall(r"<(table|ol|pre)\b", r.html or "")}:
        pytest.skip("the check knows paragraphs and flat lists only")
    text = {r.page_id: r.text for r in op3_html_text(spark, f"/root/testdata/{sf}").collect()}
    wrong = [r.page_id for r in pages.collect() if r.html is not None and plain_layout(r.html) != text[r.page_id]]
    assert not wrong, wrong[:5]


word = st.text("abcxyzäß漢", min_size=1, max_size=7)
items = st.recursive(st.lists(st.tuples(word, st.none()), min_size=1, max_size=4), lambda inner: st.lists(st.tuples(word, st.none() | st.tuples(st.booleans(), inner)), min_size=1, max_size=4), max_leaves=12)


def list_html(numbered, rows):
    tag = "ol" if numbered else "ul"
    return f"<{tag}>" + "".join(f"<li> {w} " + (list_html(*below) if below else "") for w, below in rows) + f"</{tag}>"


def list_lines(numbered, rows):
    out = []
    for k, (w, below) in enumerate(rows, 1):
        marker = f"{k}. " if numbered else "- "
        out.append(marker + w)
        if below:
            out += [" " * len(marker) + x for x in list_lines(*below)]
    return out


@given(st.booleans(), items)
def test_lists_of_any_shape(numbered, rows):
    assert render(f"x{list_html(numbered, rows)}y").split("\n") == ["x", "", *list_lines(numbered, rows), "", "y"]


@given(st.integers(1, 4).flatmap(lambda n: st.lists(st.lists(st.lists(word, max_size=3), min_size=n, max_size=n), min_size=1, max_size=5)), st.booleans())
def test_tables_of_any_size_are_aligned(rows, closed):
    """Cells of several lines, empty ones too: every column begins at one place, two blanks after the widest cell before it."""
    html = "<table>" + "".join("<tr>" + "".join(f"<td>{'<br>'.join(cell)}" + "</td>" * closed for cell in row) for row in rows) + "</table>"
    wide = lambda w: sum(1 + (unicodedata.east_asian_width(c) in "WF") for c in w)
    got = render(html)
    for measure in (len, wide):
        widths = [max((measure(w) for row in rows for w in row[k]), default=0) for k in range(len(rows[0]))]
        want = []
        for row in rows:
            for line in range(max(map(len, row))):
                cells = [cell[line] if line < len(cell) else "" for cell in row]
                out, at = "", 0
                for k, w in enumerate(cells):
                    if widths[k]:
                        out += " " * (at - measure(out)) + w if w else ""
                        at += widths[k] + 2
                want.append(out)
        if got.strip("\n").split("\n") == "\n".join(want).strip("\n").split("\n"):
            return
    raise AssertionError((html, got, want))
