"""Inline rendering, ordered passes and whole documents."""

import os
import re
from pathlib import Path

import numpy as np
import pytest

from quire.functions import latex, markdown, words
from quire.functions import tables as T
from quire.operators import folds as S
from quire.plans import document as D

P = lambda *texts: [f"<p>{t}</p>" for t in texts]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("cost $5 and $6", "cost $5 and $6"), ("$x^2$", "<em>x</em>²"), ("10 $^{\\circ}$C", "10°C"), ("$\\alpha$-helix", "α-helix"), ("K$_m$", "K<sub>m</sub>"),
        ("$n = 3$", "<em>n</em> = 3"), ("$95\\%$", "$95\\%$".replace("$", "").replace("\\%", "\\%")), ("$12.5$", "12.5"), ("$\\S4$ Fig", "S4 Fig"), ("§ 4 x", "S4 x"), ("$(R)$", "(<em>R</em>)"),
        ("$\\unknown$", "\\unknown"), ("$a^{q}$", "<em>a</em><sup>q</sup>"), ("$5 mM$", "$5 mM$"), ("$\\text{Zn}^{2+}$", "Zn²⁺"), ("\\$x\\$", "\\$x\\$"),
    ],
)
def test_latex(source, want):
    assert latex.to_html(source) == want


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("**b** *i* ***x***", "<strong>b</strong> <em>i</em> <em><strong>x</strong></em>"), ("a_b_c _d_", "a_b_c <em>d</em>"), ("5 < 6 & 7", "5 &lt; 6 &amp; 7"),
        ("<sup>1</sup> &amp; \\*", "<sup>1</sup> &amp; *"), ("**a", "**a"), ("`x` [y](z)", "`x` [y](z)"), ("a  \nb\nc", "a<br />\nb\nc"), ("*a **b** c*", "<em>a <strong>b</strong> c</em>"),
    ],
)
def test_inline(source, want):
    assert markdown.inline(source) == want


def test_blocks():
    md = "# T\n\ntext\nmore\n\n1. a\n2. b\n\n- x\n- y\n\n***\n\n| h | k |\n|---|:-:|\n| 1 | 2 |\n\n<table><tr><td>**b**</td></tr></table>\n\n> q\n\n```\nc<\n```"
    out = markdown.html_blocks(md)
    assert out[:4] == ["<h1>T</h1>", "<p>text more</p>", "<ol>\n<li>a</li>\n<li>b</li>\n</ol>", "<ul>\n<li>x</li>\n<li>y</li>\n</ul>"]
    assert 'text-align:center">2</td>' in out[4] and out[5] == "<table><tr><td><strong>b</strong></td></tr></table>"
    assert out[6:] == ["<blockquote>\n<p>q</p>\n</blockquote>", "<pre><code>c&lt;\n</code></pre>"]
    assert markdown.html_blocks("3. a\n\n4. b") == ['<ol start="3">\n<li>\n<p>a</p>\n</li>\n<li>\n<p>b</p>\n</li>\n</ol>']


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ('[foo]\n\n[foo]: /u "T"', ['<p><a href="/u" title="T">foo</a></p>']),
        ("[a *b*][Foo], ![x][foo], [foo][], [no]\n\n> [FOO]: <u é>", ['<p><a href="u%20%C3%A9">a <em>b</em></a>, <img src="u%20%C3%A9" alt="x" />, <a href="u%20%C3%A9">foo</a>, [no]</p>', "<blockquote>\n</blockquote>"]),
        ("[foo]: /a\n[foo]: /b\ntext [foo]", ['<p>text <a href="/a">foo</a></p>']),  # the first counts
        ("[foo][bar][baz]\n\n[baz]: /z\n'ti\ntle'\n\n[foo]: /f", ['<p>[foo]<a href="/z" title="ti\ntle">bar</a></p>']),
        ("[1]: Smith J. Title\n[2]: next one", ["<p>[1]: Smith J. Title\n[2]: next one</p>"]),  # no definitions
        ("text\n[foo]: /a\n\n[ ]: /u", ["<p>text\n[foo]: /a</p>", "<p>[ ]: /u</p>"]),
        ("[a](/100%\\_%41)", ['<p><a href="/100%25_%41">a</a></p>']),
        ("    code *x*\n\n      more <b>\n\ntext\n    on", ["<pre><code>code *x*\n\n  more &lt;b&gt;\n</code></pre>", "<p>text\non</p>"]),
        ("- a\n\n      code\n- b", ["<ul>\n<li>\n<p>a</p>\n<pre><code>code\n</code></pre>\n</li>\n<li>\n<p>b</p>\n</li>\n</ul>"]),
    ],
)
def test_references_and_indented_code(source, want):
    assert markdown.elements(source) == want


def test_reflow_and_hyphens():
    assert markdown.reflow("one two three four five\nsix done.\nNext para begins here and") == ["one two three four five six done.", "Next para begins here and"]
    assert markdown.reflow("a para-\ngraph") == ["a paragraph"]
    known = words.dictionary(["well", "known", "coworker"])
    assert words.join_lines("well-", "known") == "wellknown" and words.join_lines("well-", "known", known) == "well-known"
    assert words.join_lines("co-", "worker", known) == "coworker" and words.join_lines("Mac-", "Donald") == "Mac-Donald" and words.join_lines("3-", "fold") == "3-fold"
    assert words.join_lines("a ", " b") == "a b"


def test_tables():
    row = "<tr><td>1</td></tr>"
    assert T.collapsed(f"<table>{row * 3}</table>") == f"<table>{row * 3}</table>"
    assert T.collapsed(f"<table>{row * 4}\n{row.replace('1', '2')}</table>") == f"<table>{row}\n{row.replace('1', '2')}</table>"
    assert T.columns('<table><tr><td colspan="2">a</td><td>b</td></tr><tr><td>c</td></tr></table>') == 3 and T.columns("") == 1
    assert T.closed("<table><table></table>") == "<table><table></table></table>"
    assert [r.tables for r in T.regions("a<table>1</table> \n<table>2</table>b<table>3</table>")] == [("<table>1</table>", "<table>2</table>"), ("<table>3</table>",)]
    assert T.extracted("## Head\n<table><tr><td>1</td></tr></table>") == ['<table><thead><tr><th colspan="1">Head</th></tr></thead><tr><td>1</td></tr></table>']
    assert T.hoisted('<table><thead><tr><th colspan="3">Table 1. X</th></tr></thead><tr><td>1</td></tr></table>') == "<table><caption>Table 1. X</caption><tr><td>1</td></tr></table>"


def test_merging_follows_the_current_neighbours():
    fig = "<figure>x</figure>"
    a, b, c, d = P("one and", "two and", "three and", "four.")
    assert S.merge([a, fig, fig, b, fig, fig, c]) == [*P("one and two and"), *[fig] * 4, c]
    assert S.merge([a, fig, fig, b, c, fig, fig, d]) == [*P("one and two and three and four."), *[fig] * 4]
    assert S.merge(P("ends with the", "Capital word")) == P("ends with the", "Capital word")
    assert S.merge(P("ends with the", "mRNA word")) == P("ends with the mRNA word")
    assert S.merge(["<h2>References</h2>", *P("Smith J, and", "Roe A.")]) == ["<h2>References</h2>", *P("Smith J, and", "Roe A.")]
    assert S.merge(P("cut exam-", "ple here.")) == P("cut example here.")
    for lead in ("1. item", "<strong>Note:</strong> x", "Table 1. X", "* note", "(a) x"):
        assert len(S.merge(P("open", lead))) == 2


def test_captions_and_notes():
    t = "<table><tr><td>1<sup>a</sup></td></tr></table>"
    assert S.place_captions([*P("Table 1. A"), t, t, *P("Table 2. B")]) == [t.replace("<tr>", "<caption>Table 1. A</caption><tr>", 1), t.replace("<tr>", "<caption>Table 2. B</caption><tr>", 1)]
    assert S.place_captions([t, *P("Table 1. A"), t]) == [t, t.replace("<tr>", "<caption>Table 1. A</caption><tr>", 1)]
    note = '<p class="footnote"><sup>a</sup> n</p>'
    assert S.place_notes([t, *P("<sup>a</sup> n", "text")]) == [t + note, *P("text")]
    assert S.place_notes([t, *P("lead", "<sup>a</sup> n")]) == [t + '<p class="footnote">lead</p>' + note]
    assert S.place_notes([t, *P("lead", "Source: x")]) == [t, *P("lead", "Source: x")]
    assert S.place_notes([t, *P("<sup>b</sup> n")]) == [t, *P("<sup>b</sup> n")]
    assert S.join_caption_labels(P("Table 1", "Table 2", "Values")) == P("Table 1", "Table 2 Values")
    assert len(S.fuse_panels(["<table><th>A. x</th></table>", "<table><th>B. y</th></table>", "<table><th>D. z</th></table>"])) == 2


def test_classification():
    s = S.classify(["<h1>PLOS ONE</h1>", "<h2>RESEARCH ARTICLE</h2>", "<h1>A Title</h1>", *P("Ann Lee, Bo Ray"), "<h2>Abstract</h2>", *P("Abs.", "<strong>Keywords:</strong> k"), "<h1>1. Introduction</h1>",
                    *P("<sup>a</sup> foot", "¹http://x", "wall " * 9, "body.")])
    assert (s.title, s.byline, s.abstract) == ("A Title", "Ann Lee, Bo Ray", P("Abs."))
    assert s.body == [*P("<strong>Keywords:</strong> k"), "<h2>1. Introduction</h2>", *P("body.")]
    assert s.footnotes == ['<p class="footnote"><sup>a</sup> foot</p>', '<p class="footnote">¹http://x</p>']
    assert S.classify(P("<strong>OPEN ACCESS</strong>", "x")).body == P("x")
    assert S.classify(P("<strong>ABSTRACT:</strong> one", "two")).abstract == P("one", "two")


def test_front_matter_abstract_levels_references():
    front = P("<strong>Keywords:</strong> k")
    assert S.split_front_matter(front) == ([], front)
    assert S.split_front_matter([*front, "<h2>Methods</h2>"]) == (front, ["<h2>Methods</h2>"])
    prose = P("long " * 30 + "end.")
    assert S.split_unlabelled_abstract([*prose, "<h2>x</h2>"]) == (prose, ["<h2>x</h2>"]) and S.split_unlabelled_abstract(prose) == ([], prose)
    assert S.heading_levels(["<h1>2.1. X</h1>", "<h4>Conclusions</h4>", "<h3>Other</h3>"]) == ["<h3>2.1. X</h3>", "<h2>Conclusions</h2>", "<h3>Other</h3>"]
    refs = ["<h2>References</h2>", *P("1. A b.", "2. C d", "lower tail")]
    assert S.gather_references(refs)[1:] == ['<ol start="1">\n<li>\n<p>A b.</p>\n</li>\n<li>\n<p>C d lower tail</p>\n</li>\n</ol>']
    assert S.place_footnotes(refs, ["f"])[0] == "f" and S.place_footnotes(P("x", "[1] a"), ["f"])[1] == "f" and S.place_footnotes(P("x"), ["f"])[-1] == "f"
    assert S.split_citation(P("Text here. © 2018 J, 4, 2019.")) == (P("Text here."), P("© 2018 J, 4, 2019."))
    assert S.contribution_marker(P("Ann*†, Bo*, Cy†, Di†")) == "†"


def test_furniture():
    parts = [*P("Journal of X 1", "text one and", "Journal of X 2", "same."), "<h2>Purification</h2>", *P("same.", "7"), "<h2>Purification</h2>", *P("Journal of X 3")]
    assert S.without_furniture(parts) == [*P("text one and", "same."), "<h2>Purification</h2>", *P("same."), "<h2>Purification</h2>"]


PAGES = ["# Cover\n\n![a](b)", "# A Study of Things\n\nAnn Lee, Bo Ray\n\n## Abstract\n\nWe did.\n\n## 1. Introduction\n\nThis goes on to the\n\n![i](i.png)100,100,500,400\n\nFig. 1. Growth", "next page. See 10.1234/x.\n\n<table><tr><td>1</td></tr>"]


def test_document(spark):
    image = np.full((400, 300, 3), 255, np.uint8)
    image[60:140, 50:120] = 0
    rows = [("d", i, md, "", 300, 400, image.tobytes()) for i, md in enumerate(PAGES)] + [("e", 0, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "doc_id string, page_no int, md string, layer string, width int, height int, pixels binary").repartition(3)
    got = {r["doc_id"]: r for r in D.parse_documents(pages).collect()}
    d = got["d"]
    assert (d["title"], d["byline"]) == ("A Study of Things", "Ann Lee, Bo Ray")
    assert "<p>This goes on to the next page. See 10.1234/x.</p>" in d["html"] and "Cover" not in d["html"]
    assert d["html"].count("data:image/png;base64,") == 1 and "<figcaption>Fig. 1. Growth</figcaption>" in d["html"]
    assert d["html"].count("<table") == d["html"].count("</table>") == 1 and d["html"].count("<h1>") == 1
    assert got["e"]["title"] == "" and "Untitled" in got["e"]["html"] and got["e"]["doi"] is None
    assert D.parse_documents(pages.limit(0)).count() == 0


@pytest.mark.skipif("QUIRE_TRANSCRIPTS" not in os.environ, reason="a folder of recorded transcripts")
def test_transcripts(spark):
    from quire.sources.transcripts import read_transcripts

    for r in D.parse_documents(read_transcripts(spark, Path(os.environ["QUIRE_TRANSCRIPTS"]).as_uri())).collect():
        assert r["title"] and "<section class='abstract'>" in r["html"] and "<details class='metadata'>" in r["html"]
        assert r["html"].count("<h1>") == 1 and r["html"].count("<table") == r["html"].count("</table>")
        assert not re.search(r"§\s?\d", r["html"])
