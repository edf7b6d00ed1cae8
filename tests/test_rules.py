"""Rules against plain statements of what they mean, and in all three engines."""

import duckdb
import pytest

from quire import queries as Q
from quire.functions import blocks as B


@pytest.mark.parametrize(
    ("rule", "yes", "no"),
    [
        (B.is_plain_paragraph, ["<p>a</p>", "<p></p>"], ["<p class='x'>a</p>", "<p>a</p><p>b</p>", "<h1>a</h1>", "<p>a", ""]),
        (B.is_heading, ["<h1>a</h1>", "<h6>a\nb</h6>"], ["<h1>a</h2>", "<h1 id='x'>a</h1>", "<h7>a</h7>"]),
        (B.ends_sentence, ["a.", "a? ", "a:", "humans.<sup>15–18</sup>", "software.³²", "a;"], ["a", "Mg²⁺", "a,", "x<sup>2</sup>"]),
        (B.line_ends_sentence, ["a.", "a.)", 'a!"'], ["a;", "a:", "a"]),
        (B.opens_caption, ["Fig. 2 x", "**Table 1** x", "<strong>Figure</strong> 3", "Scheme 1", "Supplementary"], ["Configure", "A table"]),
        (B.opens_table_caption, ["Table 1. X", "TABLE 2 | Kinetics", "Table 3 Values", "Table 4", "Supplementary Table 5: x", "Table S1."], ["Table 1 summarizes", "Tables", "Table 1 | 2 | 3"]),
        (B.is_affiliation, ["Department of Biology, University of X, Springfield", "a, b, Germany 69117", "School of Physics, 12 Road, Town 12345"], ["Paris, France", "a, b, France.", "one, two, three"]),
        (B.is_masthead, ["PLOS ONE", "A B C D"], ["PLOS", "Plos One", "A B C D E", "12 34"]),
        (B.is_title, ["A real title"], ["Abstract", "1. Introduction", "RESEARCH ARTICLE", "Review"]),
        (B.is_name_list, ["Ann Lee, Bo Ray", "Ann Lee and Bo Ray; Cy Fox"], ["Ann Lee", "ann, bo", "Ann Lee 2, Bo", "One Two Three Four Five Six, Bo"]),
        (B.is_personal_name, ["Daniel D. Clark", "Al B. C. Doe"], ["Jane Doe", "U.S. Army Corps", "daniel D. Clark", "D. Clark"]),
        (B.is_byline, ["Jane Doe<sup>1</sup>", "Ann Lee, Bo Ray", "Ann Lee*"], ["It was done.", "<strong>Note:</strong> Ann*", "", "a" * 400 + "*"]),
        (B.is_stray_metadata, ["<p>Received May 25, 2019</p>", "<p><strong>Funding:</strong> x</p>", "<p>a@b.org, tel 5</p>", "<p>X contributed equally to this work.</p>"],
         ["<p>May 5, 2019 and 6 May 2020</p>", "<p>Published May 25, 2019 in a journal</p>", "<h2>Funding</h2>", "<p>they contributed equally to it all</p>"]),
        (B.is_front_matter, ["<p><strong>Keywords:</strong> x</p>", "<p>¹ Somewhere</p>", "<p>Received 5</p>"], ["<p>Published reports agree.</p>", "<p>text</p>"]),
        (B.opens_sup_digits, ["¹http://x", "¹ Dept", "¹²³ x", "¹x"], ["²H NMR", "¹²³⁴ x", "x", "ⁱx"]),
        (B.is_source_note, ["<p>Source: x</p>", "<p>Data adapted from X</p>", "<p>Reprinted from X</p>"], ["<p>Resources: x</p>", "<p>We adapted from X</p>"]),
        (B.is_license_footer, ["<p>© 2019 A. Open access</p>", "<p>© 2020 B under CC BY</p>"], ["<p>© 2019 A</p>", "<p>open access © 2019</p>"]),
        (B.is_legend, ["<p>ATP: x, NADH: y</p>"], ["<p>ATP: x</p>", "<p>" + "ATP: x, NADH: y " * 20 + "</p>"]),
        (B.ends_function_word, ["of the", "revealed that,", "WAS"], ["at the end", "of,", "the cat"]),
        (B.is_placeholder, ["![a](b)", "![](x)1,2,3,4", " ![a](b) 1 , 2,3,4 "], ["![a](b)1,2", "x ![a](b)"]),
        (B.is_bare_figure_label, ["Fig. 2", "**Figure 3a.**", "FIG 4:"], ["Fig. 2 Growth", "Figure"]),
        (B.is_panel_label, ["A", "(B)", "C.", "D:"], ["a", "AB", "(A) x"]),
        (B.is_caption_continuation, ["words", "a\nb"], ["", "# h", "a\n| b", "x\n<tr>", "Fig. 2 x", "a\n![b](c)"]),
        (B.is_article_page, ["# Abstract", "x\n## 1. Introduction\ny", "### **x**\n# <b>Abstract</b>"], ["Abstract", "# Abstracted", "#Abstract"]),
        (B.is_page_number, ["<p>12</p>", "<h2> 1234 </h2>"], ["<p>12345</p>", "<p>p. 1</p>"]),
    ],
)
def test_rule(rule, yes, no):
    assert [x for x in yes if not rule(x)] == []
    assert [x for x in no if rule(x)] == []


def test_nulls():
    assert B.visible(None) is None and B.is_plain_paragraph(None) is False and B.plain_paragraph("<h1>x</h1>") is None
    assert B.is_legend("<h1>ATP: x, NADH: y</h1>") is False


def test_dois():
    assert B.doi("see https://doi.org/10.1234/ab.c(5).") == "10.1234/ab.c(5)"
    assert B.doi("(doi:10.1234/ab).") == "10.1234/ab"
    assert B.doi("10.1234/a(b(c)).)).,") == "10.1234/a(b(c))" and B.doi("10.1234/ab)))))") == "10.1234/ab" and B.doi("10.1234/(a.).;") == "10.1234/(a.)"
    assert B.doi("110.1234/ab") is None and B.doi("10.12/ab") is None


def test_furniture_keys():
    assert B.furniture_candidate("<p>Journal of Things 601</p>") == B.furniture_candidate("<h3>Journal of Things, 12</h3>") == "journal of things"
    assert B.furniture_candidate("<p>Fig 1</p>") is None and B.furniture_candidate("<p>Clark</p>") == "clark"
    assert B.furniture_candidate("<p>" + "x" * 257 + "</p>") is None


def test_bylines_keep_markers():
    assert B.byline_html("<em>Ann Lee*</em>, Bo Ray**") == "Ann Lee<sup>*</sup>, Bo Ray<sup>*</sup>"
    assert B.byline_html("Ann**, Bo*<br/>Cy") == "Ann<sup>**</sup>, Bo<sup>*</sup>; Cy"
    assert B.byline_html("Ann<sup>1,*</sup>, Bo*") == "Ann<sup>1,*</sup>, Bo*"


def test_odd_letters_and_spaces_as_in_sql(spark):
    """Words that open within a word of other letters, vertical tabs, line ends that only Java knows."""
    lines = ["fue ción ciónído", "chllaía", "Ñdo", "el niño", "of the", "of the\x0b", "who\x0b,", "\x0b(a) x", "12.\x0bSmith", "1. Smith\x0b", "éATP: x, éNADH: y", "ATP:\x0bx, NADH:\x0by"]
    lines += ["a.\x0b", "a\u2028the", "the\u2028", "the\x85", "© 2020\u2028 cc by", "© 2020 ñcc by", "hôtel 5, fax 6", "Fig\x0b2", "Abstracté", "x\rthe", "", " "]
    blocks = [t for x in lines for t in (x, f"<p>{x}</p>", f"<h2>{x}</h2>")]
    rules = [B.is_legend, B.is_open_fragment, B.ends_function_word.of(B.visible), B.opens_enumeration.of(B.visible), B.opens_identifier.of(B.visible)]
    rules += [B.opens_numbered_reference.of(B.visible), B.may_continue.of(B.paragraph_or_heading), B.is_license_footer, B.visible.strip(), B.ends_sentence, B.is_abstract_title]
    rows = spark.createDataFrame(list(enumerate(blocks)), "i int, html string")
    got = [tuple(r) for r in rows.select("i", *[r.col(rows.html).alias(f"r{k}") for k, r in enumerate(rules)]).orderBy("i").collect()]
    con = duckdb.connect()
    con.sql("CREATE TABLE t (i INTEGER, html VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(blocks)))
    want = con.sql(f"SELECT i, {', '.join(r.sql('html') for r in rules)} FROM t ORDER BY i").fetchall()
    assert got == want


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "events", "orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = Q.queries()[name](spark, sf)
    names = sorted(df.columns)
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(map(text, r)) for r in df.select(names).collect())
    want = sorted(tuple(map(text, r)) for r in con.sql(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({Q.oracle_sql()[name]})").fetchall())
    assert got == want
