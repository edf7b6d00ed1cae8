"""Queries of the document-cleaning engine, by name, with their DuckDB SQL.

``source`` stands for a document, ``doc_id`` for its pages and lines for blocks
where an operator needs the whole of a document; operators that the tables have
no rows for run over the hand-written blocks of ``samples``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import blocks as B
from .functions.rule import Rule, quoted
from .operators import relations as R
from .samples import BLOCKS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with its SQL if it has one."""

    def wrap(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over all cores if they come from fewer files: a small table in
    one file would otherwise be one task. Large inputs have files enough and are
    left alone."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if len(rows.inputFiles()) < cores else rows


def values(spark: SparkSession, ddl: str, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), ddl)


def sql_values(name: str, columns: str, rows: Sequence[tuple]) -> str:
    cell = lambda v: "NULL" if v is None else quoted(v) if isinstance(v, str) else str(v)
    return f"{name}({columns}) AS (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)})"


def stream(spark: SparkSession, sf_dir: str, name: str, kinds: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """``doc, seq, <name>``: a document for each user of ``events``, a block for
    each event, its text one of ``kinds`` by the event's numbers; and ``rows``."""
    place = F.expr("event_id * 31 + user_id * 17 + event_id div 7 + event_id div 50").cast("long") % len(kinds)
    kind = F.element_at(F.array(*map(F.lit, kinds)), (place + 1).cast("int"))
    made = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doc"), F.col("event_id").cast("long").alias("seq"), kind.alias(name))
    return made.unionByName(values(spark, f"doc string, seq bigint, {name} string", rows))


def sql_stream(name: str, kinds: Sequence[str], rows: Sequence[tuple]) -> str:
    """The same as a table expression ``s``."""
    return f"""{sql_values('given', f'doc, seq, {name}', rows)}, s AS (
  SELECT user_id::VARCHAR AS doc, event_id::BIGINT AS seq, ([{', '.join(map(quoted, kinds))}])[((event_id * 31 + user_id * 17 + event_id // 7 + event_id // 50) % {len(kinds)} + 1)::INTEGER] AS {name} FROM events
  UNION ALL SELECT * FROM given)"""


# ---- rules, by family, over all lines of all documents and the samples
_SAMPLES = tuple((-1 - i, b) for i, b in enumerate(BLOCKS))
_LINES_SQL = "SELECT source AS doc, doc_id AS page, unnest(range(0, len(string_split(text, chr(10)))))::INTEGER AS block_no, unnest(string_split(text, chr(10))) AS line FROM documents"
_BLOCKS_SQL = f"""samples(page, html) AS (VALUES {', '.join(f"({i}, {quoted(b)})" for i, b in _SAMPLES)}),
blocks AS (
  SELECT page, block_no, '<p>' || line || '</p>' AS html FROM ({_LINES_SQL})
  UNION ALL SELECT page, 0, html FROM samples
)"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = R.as_paragraphs(R.split_lines(spread(table(spark, sf_dir, "documents").select("source", "doc_id", "text")), "source", "doc_id"))
    made = values(spark, "page bigint, html string", _SAMPLES).select("page", F.lit(0).alias("block_no"), "html")
    return lines.select("page", "block_no", "html").unionByName(made)


def _family(name: str, rules: dict[str, Rule]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _blocks(spark, sf_dir).select("page", "block_no", *[r.col(F.col("html")).alias(n) for n, r in rules.items()])

    run.__name__ = name
    QUERIES[name] = run
    SQL[name] = f"WITH {_BLOCKS_SQL} SELECT page, block_no, " + ", ".join(f"{r.sql('html')} AS {n}" for n, r in rules.items()) + " FROM blocks"


_inner = B.paragraph_or_heading
_family("rules_text", {
    "visible": B.visible, "folded": B.folded, "paragraph": B.plain_paragraph, "heading": B.heading_inner, "level": B.heading_level, "title": B.heading_title,
    "ends_sentence": B.ends_sentence.of(_inner), "line_ends": B.line_ends_sentence.of(B.visible), "bold_label": B.bold_label.of(_inner), "label_name": B.label_name.of(_inner),
})
_family("rules_captions", {
    "opens_caption": B.opens_caption, "figure_caption": B.is_figure_caption, "table_caption_text": B.opens_table_caption, "bare_table": B.bare_table_label,
    "table_caption": B.table_caption, "has_table_tag": B.has_table_tag, "is_table": B.is_table, "is_figure": B.is_figure, "is_float": B.is_float,
})
_family("rules_affiliations", {
    "place_tail": B.has_place_tail.of(B.visible), "country": B.ends_with_country.of(B.visible), "institution": B.has_institution.of(B.visible),
    "postal": B.has_postal_tail.of(B.visible), "affiliation": B.is_affiliation.of(B.visible),
})
_family("rules_titles", {
    "document_type": B.is_document_type.of(_inner), "title": B.is_title.of(_inner), "masthead": B.is_masthead.of(_inner), "abstract": B.is_abstract_title.of(_inner),
    "metadata_heading": B.is_metadata_heading, "named_heading": B.is_named_heading, "publication_heading": B.is_publication_heading, "value_heading": B.is_value_heading,
    "section_number": B.section_number.of(_inner), "top_section": B.is_top_section.of(_inner), "reference_heading": B.is_reference_heading, "opens_references": B.opens_references,
})
_family("rules_bylines", {
    "byline_html": B.byline_html.of(_inner), "byline_text": B.byline_text.of(_inner), "marker": B.has_author_marker.of(_inner), "name_list": B.is_name_list.of(B.visible),
    "personal_name": B.is_personal_name.of(B.visible), "byline": B.is_byline.of(_inner),
})
_family("rules_metadata", {
    "dates": B.date_tokens.of(B.visible), "tokens": B.metadata_tokens.of(B.visible), "phrase": B.is_metadata_phrase.of(B.visible), "equal": B.is_equal_contribution.of(B.visible),
    "publication_label": B.is_publication_label.of(_inner), "glossary_label": B.is_glossary_label.of(_inner), "front_label": B.is_front_label.of(_inner),
    "front_matter": B.is_front_matter, "front_matter_loose": B.is_front_matter_loose, "body_prose": B.is_body_prose, "list_like": B.is_list_like, "stray": B.is_stray_metadata,
    "banner": B.opens_banner.of(_inner), "inline_abstract": B.opens_inline_abstract.of(_inner),
})
_family("rules_footnotes", {
    "short_sup": B.opens_short_sup.of(_inner), "sup_digits": B.opens_sup_digits.of(_inner), "late_footnote": B.is_late_footnote.of(_inner),
    "leading_sup": B.leading_sup.of(_inner), "source_note": B.is_source_note, "license": B.is_license_footer,
})
_family("rules_furniture", {"key": B.furniture_key.of(_inner), "candidate": B.furniture_candidate, "sentence": B.furniture_sentence, "page_number": B.is_page_number})
_family("rules_merging", {
    "legend": B.is_legend, "open_fragment": B.is_open_fragment, "function_word": B.ends_function_word.of(B.visible), "enumeration": B.opens_enumeration.of(B.visible),
    "identifier": B.opens_identifier.of(B.visible), "numbered": B.opens_numbered_reference.of(B.visible), "may_continue": B.may_continue.of(_inner),
})
_family("rules_references", {
    "numbered": B.is_numbered_reference, "number": B.reference_number, "text": B.reference_text, "ordered_list": B.is_ordered_list, "tail": B.is_reference_tail,
})
_family("rules_markdown", {
    "placeholder": B.is_placeholder, "starts_figure": B.starts_figure, "x0": B.placeholder_box[0], "y1": B.placeholder_box[3], "bare_figure": B.is_bare_figure_label,
    "panel": B.is_panel_label, "opens_panel": B.opens_panel, "continuation": B.is_caption_continuation, "title_only": B.is_title_only_caption,
    "legend": B.is_legend_continuation, "panel_continuation": B.opens_panel_continuation, "table_block": B.is_table_block, "table_caption": B.is_table_caption_block,
    "article_page": B.is_article_page, "figure_number": B.figure_number, "recoverable": B.is_recoverable, "boilerplate": B.has_boilerplate, "trivial": B.is_trivial_layer,
})
_family("doi_extract", {"has_doi": B.has_doi.of(B.visible), "doi": B.doi.of(B.visible)})


# ---- blocks and furniture
@query(f"SELECT page, block_no, line, length(line) AS n_chars FROM ({_LINES_SQL})")
def split_blocks(spark, sf_dir):
    lines = R.split_lines(table(spark, sf_dir, "documents"), "source", "doc_id")
    return lines.select("page", "block_no", "line", F.length("line").cast("long").alias("n_chars"))


_PARAGRAPHS_SQL = f"paragraphs AS (SELECT doc, page, block_no, '<p>' || line || '</p>' AS html FROM ({_LINES_SQL}))"
_KEYS_SQL = f"""{_PARAGRAPHS_SQL}, seen AS (
  SELECT *, {B.furniture_candidate.sql('html')} AS key, {B.furniture_verbatim.sql('html')} AS verbatim,
    {B.is_plain_paragraph.sql('html')} AS prose, NOT {B.furniture_sentence.sql('html')} AS loose FROM paragraphs
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY doc, verbatim) AS nv FROM seen WHERE key IS NOT NULL
), running AS (
  SELECT doc, key FROM counted GROUP BY doc, key
  HAVING count(*) > 1 AND (bool_or(prose) OR bool_or(nv > 1 AND regexp_matches(verbatim, '\\d'))) AND (bool_or(loose) OR count(*) >= 3)
)"""


def _paragraphs(spark, sf_dir):
    return R.as_paragraphs(R.split_lines(spread(table(spark, sf_dir, "documents").select("source", "doc_id", "text")), "source", "doc_id"))


@query(f"WITH {_KEYS_SQL} SELECT doc, key FROM running")
def running_furniture(spark, sf_dir):
    return R.furniture(_paragraphs(spark, sf_dir))


@query(
    f"WITH {_KEYS_SQL} SELECT s.doc, s.page, s.block_no, s.html FROM seen s LEFT JOIN running r ON s.doc = r.doc AND s.key = r.key "
    f"WHERE r.key IS NULL AND NOT {B.is_page_number.sql('s.html')}"
)
def strip_furniture(spark, sf_dir):
    return R.without_furniture(_paragraphs(spark, sf_dir))


@query(
    f"WITH {_PARAGRAPHS_SQL} SELECT doc, arg_min(html, (page, block_no)) AS html FROM paragraphs "
    "WHERE regexp_matches(html, '(?i)licensed under') GROUP BY doc HAVING count(*) > 1"
)
def license_lines(spark, sf_dir):
    rows = _paragraphs(spark, sf_dir).where(F.col("html").rlike("(?i)licensed under"))
    return rows.groupBy("doc").agg(F.min_by("html", F.struct("page", "block_no")).alias("html"), F.count("*").alias("n")).where("n > 1").select("doc", "html")


_FOOTERS = tuple((d, i, h) for d, hs in (("a", BLOCKS[:3] + (BLOCKS[72], "<p>x</p>", BLOCKS[72])), ("b", (BLOCKS[72], BLOCKS[73])), ("c", ("<p>© 2020 A. Licensed under X</p>", "<p>© 2021 B. creative commons</p>"))) for i, h in enumerate(hs))


_FOOTER_KINDS = (*BLOCKS[72:74], "<p>© 2020 A. Licensed under X</p>", "<p>© 2021 B. creative commons</p>", *BLOCKS[:40], "<p>2021 C. Creative Commons</p>")


@query(f"WITH {sql_stream('html', _FOOTER_KINDS, _FOOTERS)} SELECT doc, arg_min(html, seq) AS html FROM s WHERE {B.is_license_footer.sql('html')} GROUP BY doc HAVING count(*) > 1")
def license_footer(spark, sf_dir):
    return R.license_footers(stream(spark, sf_dir, "html", _FOOTER_KINDS, _FOOTERS), "seq")


def _masked(text: str) -> str:
    for pattern, to in (("<[^>]+>", " "), ("[*_`#>|]+", " "), ("[‐-―−]", "-"), (r"\d+", "#"), (r"\s+", " ")):
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(to)}, 'g')"
    return f"lower(trim({text}))"


@query(f"SELECT doc, key, count(*) AS n FROM (SELECT DISTINCT doc, page, {_masked('line')} AS key FROM ({_LINES_SQL})) WHERE length(key) >= 6 GROUP BY doc, key HAVING count(*) >= 3")
def recurring_lines(spark, sf_dir):
    return R.recurring_lines(R.split_lines(spread(table(spark, sf_dir, "documents").select("source", "doc_id", "text")), "source", "doc_id"))


@query(
    "WITH w AS (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, '<[^>]+>', '', 'g'), '[\\p{L}\\p{N}_]+')) AS word FROM documents), "
    "c AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY ALL) "
    "SELECT doc_id, sum(n)::BIGINT AS words, max(n) AS top, sum(n) >= 8 AND max(n) >= 0.6 * sum(n) AS degenerate FROM c GROUP BY doc_id"
)
def token_mode_share(spark, sf_dir):
    return R.mode_share(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id")


_P, _H1 = r"(?is)<p\b[^>]*>(.*?)</p>", r"(?is)<h1\b[^>]*>(.*?)</h1>"


@query(f"SELECT page_id, i AS n, {B.visible.sql('p[i]')} AS visible, {B.ends_sentence.sql('p[i]')} AS ends FROM (SELECT page_id, regexp_extract_all(html, {quoted(_P)}, 1) AS p FROM pages), unnest(range(1, len(p) + 1)) AS r(i)")
def page_paragraphs(spark, sf_dir):
    found = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(_P), F.lit(1))).alias("n", "p"))
    return found.select("page_id", (F.col("n") + 1).cast("long").alias("n"), B.visible.col(F.col("p")).alias("visible"), B.ends_sentence.col(F.col("p")).alias("ends"))


@query(f"SELECT page_id, {B.visible.strip().sql('h')} AS title, {B.is_title.sql('h')} AS is_title, {B.is_masthead.sql('h')} AS masthead FROM (SELECT page_id, regexp_extract(html, {quoted(_H1)}, 1) AS h FROM pages)")
def page_titles(spark, sf_dir):
    h = F.regexp_extract("html", _H1, 1)
    return table(spark, sf_dir, "pages").select("page_id", B.visible.strip().col(h).alias("title"), B.is_title.col(h).alias("is_title"), B.is_masthead.col(h).alias("masthead"))


@query("SELECT page_id, len(regexp_extract_all(html, '(?i)<p\\b')) - len(regexp_extract_all(html, '(?i)</p\\s*>')) AS unclosed FROM pages")
def unclosed_paragraphs(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", (F.regexp_count("html", F.lit(r"(?i)<p\b")) - F.regexp_count("html", F.lit(r"(?i)</p\s*>"))).cast("long").alias("unclosed"))


@query("SELECT source, coalesce(min(doc_id) FILTER (NOT (len(regexp_extract_all(text, '[\\p{L}\\p{N}]')) < 32)), 0) AS first FROM documents GROUP BY source")
def leading_pages(spark, sf_dir):
    return R.first_where(table(spark, sf_dir, "documents"), "source", "doc_id", ~B.is_trivial_layer.col(F.col("text")))


_STARTS = tuple((d, i, md) for d, mds in (("a", ("# Cover", "## Abstract\nx", "## Introduction")), ("b", ("x", "y")), ("c", ("# 1. Introduction",)), ("d", ("", "text", "### Introduction and aims"))) for i, md in enumerate(mds))


_START_KINDS = ("# Cover", "## Abstract\nx", "text", "### Introduction and aims", "## <b>Abstract</b>", "Abstract", "# 1. Introduction", *["words"] * 60)


@query(f"WITH {sql_stream('md', _START_KINDS, _STARTS)} SELECT doc, coalesce(min(seq) FILTER ({B.is_article_page.sql('md')}), 0) AS first FROM s GROUP BY doc")
def article_start(spark, sf_dir):
    return R.first_where(stream(spark, sf_dir, "md", _START_KINDS, _STARTS), "doc", "seq", B.is_article_page.col(F.col("md")))


# ---- neighbours, islands, computed order
_STREAM = tuple((d, i, h) for d, hs in (
    ("a", ("<p>Table 1</p>", "<p>Values of things</p>", "<table><tr><th>A. x</th></tr></table>", "<table><tr><th>B. y</th></tr></table>", "<p>text</p>")),
    ("b", ("<p>Table 1</p>", "<p>Table 2</p>", "<h2>Table 3</h2>", "<p>after three</p>", "<figure>f</figure>", "<table><tr><td>1</td></tr></table>")),
    ("c", ("<p>Table 5. Title</p>", "<figure>f</figure>", "<table><tr><td>1</td></tr></table>", "<table><tr><td>2</td></tr></table>", "<figure>g</figure>", "<p>Table 6. Other</p>")),
    ("d", ("<h2>References</h2>", "<p>1. Smith J. One.</p>", "<p>2. Roe A. Two.</p>", "<p>words between</p>", "<p>3. Lee B. Three.</p>")),
    ("e", ("<p>1. Not a reference</p>", "<p>[1] Smith</p>", "<p>x</p>")),
) for i, h in enumerate(hs))
_STREAM_KINDS = (
    "<p>Table 1</p>", "<p>Values of things</p>", "<table><tr><th>A. x</th></tr></table>", "<p>Table 2</p>", "<figure>f</figure>", "<p>Table 5. Title</p>", "<p>text</p>",
    "<table><caption>Table 9</caption><tr><td>x</td></tr></table>", "<p>1. Smith J. One.</p>", "<p>12. Roe A. Two.</p>", "<p>[3] Lee B. Three.</p>", "<h2>Table 3</h2>",
    "<table><tr><td>1</td></tr></table>", "<h2>References</h2>", "<p>[1] Smith</p>", "<p>words between</p>", "<p>4. Poe D. Four.</p>",
)


@query(
    f"""WITH {sql_stream('html', _STREAM_KINDS, _STREAM)}, n AS (
  SELECT *, lead(html) OVER w AS after FROM s WINDOW w AS (PARTITION BY doc ORDER BY seq)
), t AS (
  SELECT *, {B.bare_table_label.sql('html')} IS NOT NULL AND coalesce({B.plain_paragraph.sql('after')} IS NOT NULL AND NOT {B.opens_caption.of(B.plain_paragraph).sql('after')}, false) AS takes FROM n
), r AS (
  SELECT *, sum(CASE WHEN takes THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY seq) AS run FROM t
), k AS (
  SELECT *, takes AND row_number() OVER (PARTITION BY doc, run, takes ORDER BY seq) % 2 = 1 AS tk FROM r
), g AS (SELECT *, coalesce(lag(tk) OVER (PARTITION BY doc ORDER BY seq), false) AS taken FROM k)
SELECT doc, seq, CASE WHEN tk THEN '<p>' || regexp_replace({B.bare_table_label.sql('html')}, '\\s+\\z', '', 'g') || ' ' || regexp_replace({B.plain_paragraph.sql('after')}, '^\\s+', '', 'g') || '</p>' ELSE html END AS html
FROM g WHERE NOT taken"""
)
def caption_labels(spark, sf_dir):
    return R.joined_labels(stream(spark, sf_dir, "html", _STREAM_KINDS, _STREAM))


@query(
    f"""WITH {sql_stream('html', _STREAM_KINDS, _STREAM)}, k AS (
  SELECT doc, seq, CASE WHEN {B.is_table_caption.sql('html')} THEN 'caption' WHEN {B.is_figure.sql('html')} THEN 'figure'
    WHEN {B.is_table.sql('html')} AND NOT {B.has_caption_tag.sql('html')} THEN 'table' ELSE 'other' END AS kind FROM s
), b AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY seq) AS place FROM k WHERE kind <> 'figure')
SELECT t.doc, t.seq, CASE WHEN p.kind = 'caption' THEN p.seq END AS before, CASE WHEN n.kind = 'caption' THEN n.seq END AS after
FROM b t LEFT JOIN b p ON p.doc = t.doc AND p.place = t.place - 1 LEFT JOIN b n ON n.doc = t.doc AND n.place = t.place + 1 WHERE t.kind = 'table'"""
)
def caption_asof(spark, sf_dir):
    return R.nearest_captions(stream(spark, sf_dir, "html", _STREAM_KINDS, _STREAM))


@query(
    """WITH r AS (SELECT o_custkey AS doc, o_orderkey AS seq, chr(65 + (o_orderkey % 7)::INTEGER) AS letter FROM orders),
b AS (SELECT *, CASE WHEN coalesce(ascii(letter) = lag(ascii(letter)) OVER (PARTITION BY doc ORDER BY seq) + 1, false) THEN 0 ELSE 1 END AS s FROM r),
g AS (SELECT *, sum(s) OVER (PARTITION BY doc ORDER BY seq) AS run FROM b)
SELECT doc, min(seq) AS seq, string_agg(letter, '' ORDER BY seq) AS letters FROM g GROUP BY doc, run"""
)
def panel_fusion(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("seq"), F.char((F.lit(65) + F.col("o_orderkey") % 7).cast("int")).alias("letter"))
    return R.fused_letters(rows)


@query(
    f"""WITH {sql_stream('html', _STREAM_KINDS, _STREAM)}, i AS (
  SELECT *, coalesce(bool_or({B.is_reference_heading.sql('html')}) OVER (PARTITION BY doc ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AND {B.is_numbered_reference.sql('html')} AS item FROM s
), r AS (SELECT *, sum(CASE WHEN item THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY seq) AS run FROM i)
SELECT doc, min(seq) AS seq, arg_min({B.reference_number.sql('html')}, seq) AS start, string_agg({B.reference_text.sql('html')}, ' / ' ORDER BY seq) AS items FROM r WHERE item GROUP BY doc, run"""
)
def numbered_references(spark, sf_dir):
    return R.gathered_references(stream(spark, sf_dir, "html", _STREAM_KINDS, _STREAM))


_NOTED = _STREAM + tuple((d, 90 + k, f'<p class="footnote">{d}{k}</p>') for d in "ade" for k in range(2))
_NOTED_KINDS = ('<p class="footnote">n</p>', "<p>[1] Smith</p>", *_STREAM_KINDS, *["<p>words</p>"] * 30)
_NOTE = "<p class=%"


@query(
    f"""WITH {sql_stream('html', _NOTED_KINDS, _NOTED)}, m AS (SELECT *, html LIKE '{_NOTE}' AS note FROM s), a AS (
  SELECT *, coalesce(min(seq) FILTER (NOT note AND {B.is_reference_heading.sql('html')}) OVER (PARTITION BY doc),
    min(seq) FILTER (NOT note AND {B.opens_references.sql('html')}) OVER (PARTITION BY doc), max(seq) OVER (PARTITION BY doc) + 1) AS spot FROM m)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN note THEN spot ELSE seq END, CASE WHEN note THEN 0 ELSE 1 END, seq)::INTEGER AS place, html FROM a"""
)
def footnotes_before_references(spark, sf_dir):
    return R.footnotes_before_references(stream(spark, sf_dir, "html", _NOTED_KINDS, _NOTED).withColumn("note", F.col("html").like(_NOTE)))


@query(
    f"""WITH l AS (SELECT page AS doc, block_no, trim({B.visible.sql('line')}) AS seen FROM ({_LINES_SQL})), b AS (
  SELECT *, coalesce({B.line_ends_sentence.sql('seen')} AND length(seen) + 1 + length(string_split(lead(seen) OVER (PARTITION BY doc ORDER BY block_no), ' ')[1]) <= max(length(seen)) OVER (PARTITION BY doc), false)::INTEGER AS br FROM l
), p AS (SELECT *, coalesce(sum(br) OVER (PARTITION BY doc ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS paragraph FROM b)
SELECT doc, paragraph, min(block_no) AS first_line, count(*) AS n_lines FROM p GROUP BY doc, paragraph"""
)
def reflow_lines(spark, sf_dir):
    lines = R.split_lines(table(spark, sf_dir, "documents"), "source", "doc_id")
    return R.reflow_breaks(lines.select(F.col("page").alias("doc"), "block_no", "line"))


_MARKED = "translate(CAST(o_orderkey * 7919 + o_custkey AS VARCHAR(30)), '0123456789', '*†‡§¶*†A B')"
_BYLINES = ((1, "Ann Lee*†, Bo Ray*, Cy Fox†"), (2, "Ann Lee†, Bo Ray*, Cy Fox*, Di Poe†"), (3, "Ann Lee*"), (4, "No marks"), (5, "A‡ B‡ C‡ D* E*"))


@query(
    f"""WITH {sql_values('given', 'id, text', _BYLINES)}, b AS (SELECT * FROM given UNION ALL SELECT 10 + o_orderkey, {_MARKED} FROM orders), c AS (SELECT id, text[i] AS ch, i AS pos FROM b, unnest(range(1, length(text) + 1)) AS r(i)),
n AS (SELECT id, ch, count(*) AS n, min(pos) AS first FROM c WHERE ch IN ('*', '†', '‡', '§', '¶') GROUP BY id, ch HAVING count(*) >= 2)
SELECT id, arg_min(ch, (-n, first)) AS marker FROM n GROUP BY id"""
)
def contribution_markers(spark, sf_dir):
    marked = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 10).cast("long").alias("id"), F.expr(_MARKED).alias("text"))
    return R.contribution_markers(marked.unionByName(values(spark, "id bigint, text string", _BYLINES)), "id", "text")


# ---- tables made of order lines
_TABLES_SQL = """tabled AS (SELECT l_orderkey AS id, '<table><thead><tr><th colspan="' || count(*) || '">Order</th></tr></thead>' ||
  string_agg('<tr><td>' || l_returnflag || '</td><td><b>' || l_linestatus || '</b></td><td> </td></tr>', '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS html FROM lineitem GROUP BY l_orderkey)"""


def _tables(spark, sf_dir):
    row = F.concat(F.lit("<tr><td>"), "l_returnflag", F.lit("</td><td><b>"), "l_linestatus", F.lit("</b></td><td> </td></tr>"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", row.alias("row")))).alias("rows"))
    head = F.concat(F.lit('<table><thead><tr><th colspan="'), F.col("n").cast("string"), F.lit('">Order</th></tr></thead>'))
    return rows.select("id", F.concat(head, F.array_join(F.transform("rows", lambda r: r["row"]), "")).alias("html"))


@query(
    f"""WITH {_TABLES_SQL}, c AS (SELECT id, list_filter(list_transform(regexp_extract_all(html, '(?is)<t[dh]\\b[^>]*>(.*?)</t[dh]>', 1), lambda x: trim(regexp_replace(x, '<[^>]+>', '', 'g'))), lambda x: x <> '') AS cells FROM tabled)
SELECT id, len(cells) AS n_cells, array_to_string(cells, '|') AS cells FROM c"""
)
def table_cells(spark, sf_dir):
    found = _tables(spark, sf_dir).select("id", R.cells(F.col("html")).alias("cells"))
    return found.select("id", F.size("cells").cast("long").alias("n_cells"), F.array_join("cells", "|").alias("cells"))


@query(f"WITH {_TABLES_SQL}, n AS (SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY 1) SELECT id, greatest(n, 3)::INTEGER AS columns, html || '</table>' AS closed FROM tabled JOIN n USING (id)")
def table_columns(spark, sf_dir):
    return _tables(spark, sf_dir).select("id", R.columns(F.col("html")).alias("columns"), R.closed(F.col("html")).alias("closed"))


@query(
    """WITH e AS (SELECT user_id AS g, event_id AS k, event_type AS v FROM events), i AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY k) - row_number() OVER (PARTITION BY g, v ORDER BY k) AS island FROM e
), n AS (SELECT *, count(*) OVER (PARTITION BY g, v, island) AS c, row_number() OVER (PARTITION BY g, v, island ORDER BY k) AS p FROM i)
SELECT g, k, v FROM n WHERE c <= 2 OR p = 1"""
)
def row_collapse(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("g"), F.col("event_id").alias("k"), F.col("event_type").alias("v"))
    return R.collapsed_runs(rows, "g", ["k"], "v", most=2)


# ---- boxes and glyphs made of order lines
_BOXES_SQL = "SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)::INTEGER AS k, (l_partkey % 700)::INTEGER AS x0, (l_suppkey * 37 % 600)::INTEGER AS y0, (l_partkey % 700 + l_quantity * 4)::INTEGER AS x1, (l_suppkey * 37 % 600 + 40 + l_linenumber * 20)::INTEGER AS y1 FROM lineitem"


def _boxes(spark, sf_dir):
    x, y = F.col("l_partkey") % 700, F.col("l_suppkey") * 37 % 600
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")).alias("k"), x.cast("int").alias("x0"), y.cast("int").alias("y0"),
        (x + F.col("l_quantity") * 4).cast("int").alias("x1"), (y + 40 + F.col("l_linenumber") * 20).cast("int").alias("y1"))


@query(f"SELECT page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM ({_BOXES_SQL}) GROUP BY page")
def box_union(spark, sf_dir):
    return _boxes(spark, sf_dir).groupBy("page").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query(f"SELECT page, k, round_even(x0 / 1000.0::DOUBLE * 1540, 0)::INTEGER AS px0, round_even(y0 / 1000.0::DOUBLE * 1995, 0)::INTEGER AS py0, round_even(x1 / 1000.0::DOUBLE * 1540, 0)::INTEGER AS px1, round_even(y1 / 1000.0::DOUBLE * 1995, 0)::INTEGER AS py1 FROM ({_BOXES_SQL})")
def box_denorm(spark, sf_dir):
    px = R.to_pixels([F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")], F.lit(1540), F.lit(1995))
    return _boxes(spark, sf_dir).select("page", "k", *[c.alias(n) for c, n in zip(px, ("px0", "py0", "px1", "py1"))])


@query(
    f"""WITH RECURSIVE b AS ({_BOXES_SQL}), u AS (SELECT DISTINCT * FROM b), e AS (
  SELECT p.page, p.k AS a, q.k AS b FROM u p JOIN u q ON p.page = q.page AND p.k <> q.k
  WHERE least(p.x1, q.x1) - greatest(p.x0, q.x0) >= 0.5 * least(p.x1 - p.x0, q.x1 - q.x0) AND greatest(p.y0, q.y0) - least(p.y1, q.y1) <= 30
), reach AS (SELECT page, k AS a, k AS b FROM u UNION SELECT r.page, r.a, e.b FROM reach r JOIN e ON e.page = r.page AND e.a = r.b)
SELECT page, a AS k, min(b) AS cluster FROM reach GROUP BY page, a"""
)
def box_cluster(spark, sf_dir):
    import pyarrow as pa

    from .functions import pixels

    def one(t: pa.Table) -> pa.Table:
        rows = sorted({tuple(r[c] for c in ("k", "x0", "y0", "x1", "y1")) for r in t.to_pylist()})
        out = {}
        for group in pixels.clusters([r[1:] for r in rows], 30):
            for g in group:
                out[rows[g][0]] = min(out.get(rows[g][0], 10**9), min(rows[i][0] for i in group))
        return pa.table({"page": pa.array([t.column("page")[0].as_py()] * len(out), pa.int64()), "k": pa.array(list(out), pa.int32()), "cluster": pa.array(list(out.values()), pa.int32())})

    return _boxes(spark, sf_dir).groupBy("page").applyInArrow(one, "page bigint, k int, cluster int")


_GLYPHS_SQL = "SELECT l_orderkey AS page, l_linenumber AS pos, l_returnflag AS ch, (l_partkey % 500)::DOUBLE AS l, (l_suppkey % 90 * 8)::DOUBLE AS b, (l_partkey % 500 + 6)::DOUBLE AS r, (l_suppkey % 90 * 8 + 10)::DOUBLE AS t, (l_linenumber % 3 * 90)::INTEGER AS turn FROM lineitem"


def _glyphs(spark, sf_dir):
    x, y = F.col("l_partkey") % 500, F.col("l_suppkey") % 90 * 8
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("ch"), x.cast("double").alias("l"), y.cast("double").alias("b"),
        (x + 6).cast("double").alias("r"), (y + 10).cast("double").alias("t"), (F.col("l_linenumber") % 3 * 90).cast("int").alias("turn"))


_GLYPH_LINES_SQL = f"""g AS ({_GLYPHS_SQL}), m AS (
  SELECT *, CASE WHEN coalesce(t <= min(b) OVER (PARTITION BY page ORDER BY t DESC, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS nw FROM g
), i AS (SELECT *, sum(nw) OVER (PARTITION BY page ORDER BY t DESC, pos)::BIGINT AS line FROM m),
lines AS (SELECT page, line, min(l) AS l, min(b) AS b, max(r) AS r, max(t) AS t, count(*) AS n FROM i GROUP BY page, line)"""


@query(f"WITH {_GLYPH_LINES_SQL} SELECT * FROM lines")
def glyph_lines(spark, sf_dir):
    return R.glyph_lines(_glyphs(spark, sf_dir))


@query(f"WITH {_GLYPH_LINES_SQL}, q AS (SELECT page, b - lead(t) OVER (PARTITION BY page ORDER BY line) AS gap FROM lines) SELECT page, median(gap) AS spacing FROM q WHERE gap IS NOT NULL GROUP BY page")
def line_spacing(spark, sf_dir):
    return R.line_spacing(R.glyph_lines(_glyphs(spark, sf_dir)))


@query(
    f"WITH g AS ({_GLYPHS_SQL}), x AS (SELECT o_orderkey AS page, 1 AS box, 100.0 AS x0, 0.0 AS y0, 400.0 AS x1, 500.0 AS y1 FROM orders) "
    "SELECT page, box, string_agg(ch, '' ORDER BY pos, ch) AS text FROM g JOIN x USING (page) WHERE (l + r) / 2 BETWEEN x0 AND x1 AND (b + t) / 2 BETWEEN y0 AND y1 GROUP BY page, box"
)
def glyphs_in_box(spark, sf_dir):
    boxes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), F.lit(1).alias("box"), *[F.lit(float(v)).alias(n) for n, v in (("x0", 100), ("y0", 0), ("x1", 400), ("y1", 500))])
    return R.glyphs_in_boxes(_glyphs(spark, sf_dir), boxes)


@query(f"WITH n AS (SELECT page, turn, count(*) AS n FROM ({_GLYPHS_SQL}) GROUP BY ALL) SELECT page, arg_min(turn, (-n, turn <> 0, turn)) AS turn FROM n GROUP BY page")
def main_turns(spark, sf_dir):
    return R.main_turns(_glyphs(spark, sf_dir))


_LAYER = ((1, 0, "Figure 1. One\nFig. 2 (A) two"), (1, 3, "Fig. 2 | again\nfig 3"), (2, 0, "no figures 4. here"), (2, 1, "  FIGURE 5: five\r\ntext"), (3, 1, "Figure 7"))
_MD = ((1, 0, "**Figure 1.** One"), (2, 1, "as Fig. 5 shows"), (3, 2, "Figure 7"))


def _numbers_sql(name: str) -> str:
    return f"SELECT doc, page, unnest(regexp_extract_all(text, '(?im)^[ \\t]*(?:\\*{{1,2}}[ \\t]*)?fig(?:ure|\\.)?\\.?[ \\t]*(\\d+)(?:[ \\t]*\\r?$|[ \\t]*[.:|)]|[ \\t]+[A-Z(])', 1))::INTEGER AS number FROM {name}"


@query(
    f"WITH {sql_values('l', 'doc, page, text', _LAYER)}, {sql_values('m', 'doc, page, text', _MD)}, a AS ({_numbers_sql('l')}), e AS ({_numbers_sql('m')}) "
    "SELECT doc, number, string_agg(DISTINCT page::VARCHAR, ',' ORDER BY page::VARCHAR) AS pages FROM a WHERE (doc, number) NOT IN (SELECT doc, number FROM e) GROUP BY doc, number"
)
def missing_figures(spark, sf_dir):
    ddl = "doc int, page int, text string"
    return R.missing_figures(R.figure_numbers(values(spark, ddl, _LAYER), "doc", "page"), R.figure_numbers(values(spark, ddl, _MD), "doc", "page"))


# ---- whole documents
def _as_pages(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(0).alias("page_no"), F.col("text").alias("md"))


@query()
def parse_documents(spark, sf_dir):
    """Every document as one page: its HTML, title, byline and DOI."""
    from .plans.document import parse_documents as parse

    return parse(_as_pages(spark, sf_dir))


@query()
def html_blocks(spark, sf_dir):
    """Every document's HTML blocks."""
    from .plans.document import html_blocks as blocks

    return blocks(_as_pages(spark, sf_dir))


@query()
def merge_paragraphs(spark, sf_dir):
    """The lines of every document with cut paragraphs merged."""
    import pyarrow as pa

    from .operators import folds

    rows = _paragraphs(spark, sf_dir)

    def one(t: pa.Table) -> pa.Table:
        own = sorted((r["block_no"], r["html"]) for r in t.select(["block_no", "html"]).to_pylist())
        out = folds.merge([h for _, h in own])
        return pa.table({"page": pa.array([t.column("page")[0].as_py()] * len(out), pa.int64()), "seq": pa.array(range(len(out)), pa.int32()), "html": out})

    return rows.groupBy("page").applyInArrow(one, "page bigint, seq int, html string")


@query()
def render_inline(spark, sf_dir):
    """Every line of every document with its math and inline markdown rendered."""
    import pyarrow as pa

    from .functions import markdown

    lines = R.split_lines(table(spark, sf_dir, "documents"), "source", "doc_id").select("page", "block_no", "line")

    def run(batches):
        for b in batches:
            yield b.set_column(2, "line", pa.array(list(map(markdown.render_inline, b.column(2).to_pylist())), pa.string()))

    return lines.mapInArrow(run, "page bigint, block_no int, line string")


@query()
def reconcile_pages(spark, sf_dir):
    """Every document as a page whose odd blocks lost their last three words,
    put back from the whole text."""
    import pyarrow as pa

    from .functions import layout

    cut = lambda b, i: F.when(i % 2 == 1, F.regexp_replace(b, r"(?:\s+\S+){3}\z", "")).otherwise(b)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n"), cut), "\n\n").alias("md"), "text")

    def run(batches):
        for b in batches:
            done = [layout.reconciled(md, text, set()) for md, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done), pa.array([len(d) for d in done], pa.int64())], names=["doc_id", "md", "n_chars"])

    return rows.mapInArrow(run, "doc_id bigint, md string, n_chars bigint")


#: A box grows back to the edges of what was drawn, 5 pixels away, where enough
#: blank pixels follow on the page (and within a tenth of it) to tell; else it stays.
_CROPS_SQL = f"""
WITH b AS (SELECT *, least(x1, 800) AS xe, least(x1 - 5, 800) AS r, least(y1 - 5, 800) AS e, CASE WHEN k % 2 = 1 THEN 6 ELSE 10 END AS gap FROM ({_BOXES_SQL})),
g AS (
  SELECT page, k, r - (x0 + 5) AS w, e - (y0 + 5) AS h,
    CASE WHEN least(80, x0 + 5) - 5 >= 10 THEN x0 ELSE x0 + 5 END AS gl, CASE WHEN least(80, y0 + 5) - 5 >= 10 THEN y0 ELSE y0 + 5 END AS gt,
    CASE WHEN xe >= r AND least(800, r + 80) - xe >= 10 THEN xe ELSE r END AS gr, CASE WHEN least(800, e + 80) - y1 >= gap THEN y1 ELSE e END AS gb
  FROM b
)
SELECT page, k, CASE WHEN least(w, h) < 50 THEN 0 ELSE gr - gl END AS width, CASE WHEN least(w, h) < 50 THEN 0 ELSE gb - gt END AS height FROM g
"""


@query(_CROPS_SQL)
def figure_crops(spark, sf_dir):
    """Figures drawn from order lines, each on a page of its own, every other one
    with a caption: how large their crops are, 0 by 0 if too small."""
    import numpy as np
    import pyarrow as pa

    from .functions import pixels

    def run(batches):
        for b in batches:
            sizes = []
            for r in b.to_pylist():
                page = np.full((800, 800), 255, np.uint8)
                page[r["y0"] : r["y1"], r["x0"] : r["x1"]] = 0
                crop = pixels.cropped(page, (r["x0"] + 5, r["y0"] + 5, r["x1"] - 5, r["y1"] - 5), "Fig. 1. Drawn" if r["k"] % 2 else None)
                sizes.append((0, 0) if crop is None else crop.shape)
            yield pa.RecordBatch.from_arrays([b.column("page"), b.column("k"), *(pa.array([s[i] for s in sizes], pa.int32()) for i in (1, 0))], names=["page", "k", "width", "height"])

    return _boxes(spark, sf_dir).mapInArrow(run, "page bigint, k int, width int, height int")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's lines without running headers, footers and page numbers."""
    return strip_furniture(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
