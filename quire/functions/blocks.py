"""Rules over one block: an HTML element as text, or a markdown block."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import vocabulary as V
from .rule import TEXT, WS, Rule, either, every
from .vocabulary import (
    BANNER_LABELS,
    COUNTRIES,
    DOCUMENT_TYPES,
    FRONT_MATTER_LABELS,
    GLOSSARY_LABELS,
    MARKERS,
    NOTE_SYMBOLS,
    PUBLICATION_LABELS,
    SUP_DIGITS,
    TOP_SECTIONS,
)


def _any(parts) -> str:
    """One of the phrases, for use in a pattern; any white space parts their words."""
    literal = lambda p: p.replace(".", r"\.").replace(" ", WS + "+")
    return f"(?:{'|'.join(literal(p) for p in sorted(parts, key=lambda p: (-len(p), p)))})"


#: A text as one line: lower case, single spaces.
flat = TEXT.sub(rf"{WS}+", " ").strip().lower()


# ---- visible text, paragraphs, headings
visible = TEXT.sub("<[^>]+>")
folded = visible.strip().lower()
is_plain_paragraph = every(TEXT.has(r"^<p>"), TEXT.has(r"</p>\z"), TEXT.count("</p>").is_(1))
plain_paragraph = TEXT.sub(r"^<p>|</p>\z").where(is_plain_paragraph)
_H = r"(?s)^<h([1-6])>(.*)</h([1-6])>\n?\z"
is_heading = TEXT.has(_H) & TEXT.extract(_H, 1).same(TEXT.extract(_H, 3))
heading_level = TEXT.extract(_H, 1).where(is_heading)
heading_inner = TEXT.extract(_H, 2).strip().where(is_heading)
paragraph_or_heading = plain_paragraph.otherwise(heading_inner)
heading_title = folded.sub(rf"^\d+(?:[.)]\d*)*[.)]?{WS}+").of(heading_inner)

_SENTENCE_END = rf"[.!?;:]{WS}*\z"
#: On inner HTML: terminal punctuation, looking past trailing citation superscripts.
ends_sentence = (
    TEXT.sub(rf"(?:{WS}*<sup>[\d\s,–—-]+</sup>)+{WS}*\z").sub("<[^>]+>").sub(rf"{WS}+\z").sub(rf"[{SUP_DIGITS}]+{WS}*\z").has(_SENTENCE_END)
)
line_ends_sentence = TEXT.has(r"""[.!?][)\]"'»]*\z""")
bold_label = TEXT.has(r"^<strong>[^<]+:</strong>")
_LABEL_IN, _LABEL_OUT = r"^<strong>([^<]+):</strong>", rf"^<strong>([^<]+)</strong>{WS}*:"
#: The name of a leading bold label, the colon inside or outside the bold.
any_bold_label = TEXT.has(_LABEL_IN) | TEXT.has(_LABEL_OUT)
label_name = TEXT.extract(_LABEL_IN).where(TEXT.has(_LABEL_IN)).otherwise(TEXT.extract(_LABEL_OUT).where(TEXT.has(_LABEL_OUT))).strip().lower()

# ---- captions
opens_caption = visible.sub(rf"^{WS}+").has(rf"(?i)^\*{{0,2}}(?:{_any(V.FIGURE_WORDS + V.OTHER_CAPTIONS)}|fig\b)")
is_figure_caption = TEXT.strip().has(rf"(?i)^\*{{0,2}}(?:{_any(V.FIGURE_WORDS)}|fig\b)")
_TABLE = rf"^\*{{0,2}}{WS}*(?i:supp(?:l(?:ementary)?)?\.?{WS}+)?(?i:table)\b{WS}*"
_TABLE_CAPTION = _TABLE + rf"[\p{{L}}\p{{N}}_]+(?:{WS}*[.:)–—-]|{WS}*\|{WS}*[A-Z(]|{WS}+[A-Z(]|{WS}*\*{{0,2}}{WS}*\z)"
opens_table_caption = visible.sub(rf"^{WS}+").has(_TABLE_CAPTION)
_bare_table = visible.strip().has(_TABLE + rf"[\p{{L}}\p{{N}}_]+{WS}*[.:]?{WS}*\*{{0,2}}{WS}*\z")
bare_table_label = paragraph_or_heading.where(_bare_table.of(paragraph_or_heading))
_numbered_table = visible.sub(rf"^{WS}+").has(_TABLE + "[0-9A-Z(]")
table_caption = plain_paragraph.where(opens_table_caption.of(plain_paragraph)).otherwise(
    heading_inner.where((opens_table_caption & _numbered_table).of(heading_inner))
)
is_table_caption = table_caption.exists()
has_table_tag = TEXT.has(rf"(?i)</?{_any(V.TABLE_TAGS)}\b")
starts_table_tag = TEXT.sub(rf"^{WS}+").has(rf"(?i)^</?{_any(V.TABLE_TAGS)}\b")
is_table = TEXT.has(r"(?i)^<table[\s>]")
is_figure = TEXT.has(r"(?i)^<figure[\s>]")
is_float = TEXT.has(r"(?i)^<(?:table|figure)[\s>]")
has_caption_tag = TEXT.lower().has("<caption")

# ---- affiliations (on visible text)
_last = TEXT.extract(r"(?s)^(?:.*,)?([^,]*)\z")
has_place_tail = _last.has(rf"^{WS}*\p{{Lu}}\S*(?:{WS}+(?:\p{{Lu}}\S*|[oO][fF])){{0,3}}{WS}*\z")
ends_with_country = _last.sub(r"\b\d[\d-]*\b").strip().lower().isin(COUNTRIES)
_STEM = rf"{_any(V.INSTITUTION_STEMS)}[\p{{L}}\p{{N}}_]*"
has_institution = TEXT.has(rf"(?i)\b(?:{_any(V.INSTITUTIONS)}|{_STEM})\b")
opens_institution = flat.sub("^the ").has(rf"^(?:{_any(V.INSTITUTIONS + V.INSTITUTION_OPENERS)}|{_STEM})\b")
has_postal_tail = TEXT.extract(r"(?s)^(?:.*,)?([^,]*,[^,]*)\z").has(r"\b\d{4,6}\b")
is_affiliation = every(
    TEXT.length() <= 300,
    TEXT.count(",") >= 2,
    ~TEXT.has(_SENTENCE_END),
    ends_with_country | (has_institution & ((opens_institution & has_place_tail) | has_postal_tail)),
)

# ---- titles and headings (on a heading's inner HTML)
_ARTICLE = rf"(?i)^\s*(?:\d+[.)]?\s+)?{_any(V.ARTICLE_TITLES)}\b"
is_document_type = folded.isin(DOCUMENT_TYPES)
is_title = ~is_document_type & ~folded.has(_ARTICLE)
is_masthead = every(
    visible.strip().has(rf"^\S+(?:{WS}+\S+){{1,3}}\z"),
    visible.strip().has(r"\p{Lu}"),
    ~visible.strip().has(r"\p{Ll}"),
)
is_abstract_title = visible.has(r"(?i)^\s*abstract\b")
opens_article = TEXT.has(_ARTICLE)
is_metadata_heading = heading_title.isin(FRONT_MATTER_LABELS + DOCUMENT_TYPES)
is_named_heading = heading_title.isin(FRONT_MATTER_LABELS)
is_publication_heading = heading_title.isin(PUBLICATION_LABELS)
is_value_heading = heading_title.isin(tuple(x for x in PUBLICATION_LABELS if x not in BANNER_LABELS))
_NUMBER = r"^\(?([1-9]\d?(?:\.\d{1,2})*)[.)]\s+\S"
section_number = visible.strip().extract(_NUMBER)
is_top_section = folded.sub(rf"^\d+(?:[.)]\d*)*[.)]?{WS}+").isin(TOP_SECTIONS)
_untagged = flat.of(visible)
is_reference_heading = TEXT.has(r"(?i)^<h\d") & _untagged.sub(r"^\d+\.? ").has(rf"^{_any(V.REFERENCE_TITLES)}\b")
opens_references = (TEXT.has(r"(?i)^<h\d") & _untagged.is_("references")) | TEXT.has(r"(?i)^<p>\[1\]")

# ---- bylines (on a paragraph's inner HTML)
_SEGMENT = rf"\p{{Lu}}[^\s\d,;]*(?:{WS}+[^\s\d,;]+){{0,4}}"
byline = (
    TEXT.sub(r"<br\s*/?>", "; ").strip().sub(r"</?(?:strong|em)>")
)
_star_byline = byline.sub(r"\*+\z", "*").sub(r"(\*+)", r"<sup>\1</sup>")
byline_html = byline.where(byline.has("<sup>")).otherwise(_star_byline)
byline_text = visible.strip().of(byline_html)
has_author_marker = TEXT.has(rf"<sup>|[{SUP_DIGITS}{MARKERS.replace('¶', '')}]")
# "and" is turned into a comma first; then two or more capitalised, digit-free segments
_listed = TEXT.sub(rf"{WS}and{WS}", " , ").sub(rf"{WS}*[,;][,;\s]*", ",").sub(r"^,|,\z")
is_name_list = _listed.has(r",") & _listed.has(rf"^{WS}*[A-Z][^\s\d,]*(?:{WS}+[^\s\d,]+){{0,4}}{WS}*(?:,{WS}*[A-Z][^\s\d,]*(?:{WS}+[^\s\d,]+){{0,4}}{WS}*)+\z")
_NAME = r"[A-Z][a-z’'-]+"
_INITIAL = r"(?:[A-Z]\.){1,3}"
_ANY = rf"(?:[A-Z]\.?|{_NAME}|(?:[A-Z]\.){{2,}})"
is_personal_name = every(
    TEXT.strip().has(rf"^{_NAME}(?:{WS}+{_ANY}){{0,3}}{WS}+{_NAME}\z"),
    TEXT.strip().has(rf"^\S+(?:{WS}+\S+)*{WS}+{_INITIAL}{WS}+(?:\S+{WS}+)*\S+\z"),
)
is_byline = every(
    byline_text.length() >= 1,
    ~(byline_text.length() >= 400),
    ~byline_text.has(_SENTENCE_END),
    ~bold_label,
    has_author_marker | is_name_list.of(byline_text) | is_personal_name.of(byline_text),
)

# ---- front matter and stray metadata
# months by their names, or what these begin with
_MONTH = rf"{_any({*V.MONTHS, *(m[:3] for m in V.MONTHS), 'sept'})}\.?"
DATE = rf"\b(?:\d{{1,2}}\s+{_MONTH}|{_MONTH}\s+\d{{1,2}},?)\s+\d{{4}}\b"
_EMAIL, _LINKED, _CALL = r"[^\s@]@[^\s@]+\.[^\s@]", rf"{_any(('http://', 'https://'))}|doi:\s*10\.\d{{4}}", rf"\b{_any(V.PHONE_LABELS)}\b"
_OTHER_TOKEN = f"{_EMAIL}|{_LINKED}|{_CALL}"
date_tokens = TEXT.count(rf"(?i){DATE}")
metadata_tokens = TEXT.count(rf"(?i){_OTHER_TOKEN}|{DATE}")
has_non_date_token = TEXT.has(rf"(?i){_OTHER_TOKEN}")
opens_metadata = TEXT.has(rf"(?i)^{_any(V.FRONT_OPENERS)}\b")
is_affected = TEXT.has(rf"^[{SUP_DIGITS}{MARKERS.replace('¶', '')}]")
# authors contributed equally: the last words, or all but what they contributed to
_shared = flat.sub(r"[ .]+\z")
is_equal_contribution = _shared.has(r"contributed equally\z") | every(
    _shared.has("contributed equally to th"),
    _shared.extract("contributed equally to (?:this|the) ([a-z]+)\\z").isin(V.SHARED_WORK),
)
_dated = flat.extract(r"^([a-z]+\b ?:? ?)")  # a label that opens the line
is_metadata_phrase = either(
    flat.has(_any(V.SUPPORT_NOTES)),
    flat.sub(r"^doi ?:? ?").has(r"^10\.\d") & flat.has("^doi"),
    flat.has(r"^published online\b"),
    flat.has(rf"^{_any(V.VOLUME_LABELS)} ?\d") & flat.has(rf"\b{_any(V.PAGE_LABELS)} ?\d"),
    # a label and a date that ends its entry
    _dated.sub(r"[ :]+\z").isin(V.HISTORY_OPENERS) & TEXT.has(rf"(?i)^\s*[a-z]+\s*:?\s*{DATE}[ \t]*(?:\n|;|\z)"),
    is_equal_contribution,
)
is_publication_label = label_name.isin(PUBLICATION_LABELS)
is_glossary_label = label_name.isin(GLOSSARY_LABELS)
is_front_label = label_name.isin(FRONT_MATTER_LABELS)
_opening = visible.sub(rf"^{WS}+")
_front = lambda loose: plain_paragraph.exists() & either(
    bold_label, is_affected.of(_opening), is_affiliation.of(_opening), opens_metadata.of(_opening) & (~ends_sentence | has_non_date_or_date.of(_opening) if loose else ~ends_sentence)
).of(plain_paragraph)
has_non_date_or_date = TEXT.has(rf"(?i){_OTHER_TOKEN}|{DATE}")
is_front_matter = _front(False)
is_front_matter_loose = _front(True)
is_body_prose = ((visible.length() > 80) & ends_sentence).of(plain_paragraph)
is_list_like = (visible.count(";") >= 2).of(plain_paragraph)
is_stray_metadata = either(
    is_publication_label,
    is_glossary_label,
    is_affiliation.of(visible),
    (visible.length() <= 400) & (is_metadata_phrase.of(visible) | ((metadata_tokens.of(visible) >= 2) & has_non_date_token.of(visible))),
).of(plain_paragraph)
opens_banner = TEXT.has(rf"(?i)^<strong>\s*(?:{'|'.join(BANNER_LABELS)})\s*</strong>\s*")
without_banner = TEXT.sub(rf"(?i)^<strong>\s*(?:{'|'.join(BANNER_LABELS)})\s*</strong>\s*")
_INLINE_ABSTRACT = r"(?i)^<strong>\s*abstract\s*(?::\s*</strong>|</strong>\s*:)\s*"
opens_inline_abstract = TEXT.has(_INLINE_ABSTRACT)
without_abstract_label = TEXT.sub(_INLINE_ABSTRACT)

# ---- footnotes
opens_short_sup = TEXT.has(r"^<sup>[^<]{1,3}</sup>")
# one to three superscript digits, then white space or anything but a capital
opens_sup_digits = TEXT.has(rf"^[{SUP_DIGITS}]{{1,3}}(?:{WS}+\S|[^{SUP_DIGITS}A-Z\s])")
is_late_footnote = opens_sup_digits & ~is_affiliation.of(visible.strip())
leading_sup = TEXT.extract(r"^<sup>([^<]{1,3})</sup>").strip().where(opens_short_sup)
is_note_label = TEXT.has(rf"[\p{{L}}{NOTE_SYMBOLS}]")
# a note's first words say where data are from, with or without a verb
_stated = flat.sub(rf"^({_any(V.SOURCE_NOUNS)}) (?:is|are|was|were) ", r"\1 ")
_origin = either(
    _stated.has("^sources? ?:"),
    _stated.has(rf"^(?:{_any(V.SOURCE_NOUNS)} )?{_any(V.ATTRIBUTIONS)} from\b"),
    _stated.has(rf"^{_any(V.SOURCE_NOUNS)} (?:{_any(V.DERIVATIONS)} )?from\b"),
)
is_source_note = ((visible.strip().length() <= 200) & _origin.of(visible)).of(plain_paragraph)

# ---- furniture
furniture_key = visible.sub(r"\d+").sub(r"[^\p{L}\p{N}_\s]").sub(rf"{WS}+", " ").strip().lower()
_has_digit = visible.has(r"\d")
_candidate = (visible.length() <= 256) & ((_has_digit & (furniture_key.length() >= 12)) | (~_has_digit & (furniture_key.length() >= 3)))
furniture_candidate = furniture_key.of(paragraph_or_heading).where(_candidate.of(paragraph_or_heading))
furniture_sentence = ends_sentence.of(paragraph_or_heading)
furniture_verbatim = visible.strip().of(paragraph_or_heading)
is_page_number = visible.strip().has(r"^\d{1,4}\z").of(paragraph_or_heading)
_licensed = _untagged.extract(r"© ?\d{4}\b(.*)")  # what stands behind the year
is_license_footer = (_licensed.has(_any(V.LICENSE_TERMS)) | _licensed.has(r"\bcc by\b")).of(plain_paragraph)

# ---- merging
is_legend = ((visible.strip().length() <= 200) & (visible.strip().count(r"\b[A-Z][A-Za-z0-9]{1,4}:\s") >= 2)).of(plain_paragraph)
is_open_fragment = every(
    every(~ends_sentence.of(TEXT.sub(rf"{WS}+\z")), ~bold_label, ~opens_caption, ~is_affected.of(_opening)).of(plain_paragraph),
    ~is_stray_metadata,
    ~is_legend,
    plain_paragraph.exists(),
)
ends_function_word = TEXT.has(rf"(?i)\b{_any(V.FUNCTION_WORDS)}\s*\z") | TEXT.has(rf"(?i)\b{_any(V.CLAUSE_WORDS)}[\s,;]*\z")
opens_enumeration = TEXT.has(r"(?i)^\s*(?:\d+[.)]\s|\[\d|[•\-]\s|\([a-z0-9ivx]+\)\s)")
opens_upper = TEXT.has(r"^\p{Lu}")
opens_identifier = TEXT.has(r"^[A-Za-z][A-Za-z0-9]*[A-Z]")
opens_numbered_reference = TEXT.has(r"^\[?\d{1,3}[.)\]]?\s+[A-Z]")
opens_note_symbol = TEXT.has(rf"^[{NOTE_SYMBOLS}]")
#: A lead that may continue a fragment, whatever the fragment is.
may_continue = every(~opens_enumeration, ~bold_label, ~opens_caption, ~opens_sup_digits.of(_opening), ~opens_note_symbol.of(_opening))

# ---- references
_entry, _nothing = plain_paragraph.strip(), TEXT.sub(r"(?s).+")
_MARK = r"^\d{1,3}[.)\]]?\s+"
is_numbered_reference = _entry.has(_MARK + "[A-Z]")
reference_number = _entry.extract(r"^(\d+)").where(is_numbered_reference).otherwise(_nothing)
reference_text = _entry.sub(_MARK).where(is_numbered_reference).otherwise(_nothing)
is_ordered_list = TEXT.has(r"(?is)^<ol\b[^>]*>.*</ol>\n?\z")
is_reference_tail = plain_paragraph.exists() & ~is_numbered_reference & _opening.of(plain_paragraph).has(r"^\p{Ll}")

# ---- markdown blocks and figures
_PLACEHOLDER = r"^!\[[^\]]*\]\([^)]*\)(?:\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+))?\s*\z"
_first_line = TEXT.strip().extract(r"^([^\n]*)")
is_placeholder = TEXT.strip().has(_PLACEHOLDER)
starts_figure = _first_line.has(_PLACEHOLDER)
placeholder_box = [TEXT.strip().extract(_PLACEHOLDER, k) for k in range(1, 5)]
is_bare_figure_label = TEXT.strip().has(r"(?i)^\*{0,2}\s*fig(?:ure|\.|\b)\s*\.?\s*\d+[a-z]?\s*[.:]?\s*\*{0,2}\s*\z")
is_panel_label = TEXT.strip().has(r"^\(?[A-Z]\)?[.:]?\z")
opens_panel = TEXT.strip().has(r"^\([A-Z]\)\s")
is_caption_continuation = every(
    TEXT.strip().length() >= 1,
    ~TEXT.has(r"(?m)^[ \t]*[#|]"),
    ~TEXT.has(rf"(?im)^[ \t]*</?{_any(V.TABLE_TAGS)}\b"),
    ~TEXT.has(r"(?m)^[ \t]*!\[[^\]]*\]\([^)]*\)(?:[ \t]*\d+[ \t]*,[ \t]*\d+[ \t]*,[ \t]*\d+[ \t]*,[ \t]*\d+)?[ \t]*$"),
    ~opens_caption.of(TEXT.strip()),
)
is_title_only_caption = TEXT.sub(rf"[*\s]+\z").has(r"[\p{L}\p{N}]\z")
is_figure_note = TEXT.has(r"(?i)doi\.org|https?://")
is_legend_continuation = is_caption_continuation & ~either(opens_sup_digits.of(TEXT.strip()), TEXT.strip().has(r"^[†‡§¶]"), is_figure_note)
opens_panel_continuation = opens_panel & is_caption_continuation
is_table_block = starts_table_tag
is_table_caption_block = ~starts_table_tag & opens_table_caption
is_article_page = TEXT.has(r"(?im)^[ \t]*#{1,6}[ \t]+(?:<[^>]+>|\s)*(?:\d+[.)]?\s+)?" + _any(V.ARTICLE_TITLES) + r"\b")
_FIGURE_LABEL = r"(?im)^[ \t]*(?:\*{1,2}[ \t]*)?fig(?:ure|\.)?\.?[ \t]*(\d+)(?:[ \t]*\r?$|[ \t]*[.:|)]|[ \t]+[A-Z(])"
figure_number = TEXT.extract(_FIGURE_LABEL)
opens_section = TEXT.sub(rf"^{WS}+").has(r"^(?:#|\||<table)") | TEXT.sub(rf"^{WS}+").has(_FIGURE_LABEL.replace("(?im)", "(?i)").replace("^[ ", "^[ "))
is_trivial_layer = ~(TEXT.count(r"[\p{L}\p{N}]") >= 32)

# ---- text-layer reconciliation
_label = r"(?i)^(?:Fig(?:ure)?|Table|Scheme)\b"
is_recoverable = every(~TEXT.has(r"^(?:!\[|\|)"), ~has_table_tag, ~TEXT.sub(r"[*_`#>|]+", " ").strip().has(_label), ~is_figure_caption)
starts_label = TEXT.has(_label)
has_boilerplate = TEXT.has(f"(?i){_any(V.BOILERPLATE)}")

# ---- DOIs
_DOI = r"(?i)(?:^|\D)(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)"
has_doi = TEXT.has(_DOI)
# punctuation at the end goes, and so do closing brackets beyond those that are open
_found = TEXT.extract(_DOI)
_core = _found.sub(r"[).,;:]+\z")
_tail = _found.extract(r"([).,;:]*)\z")
_open, _shut = _core.count(r"\("), _core.count(r"\)")


def _brackets_col(c):
    kept = F.greatest(F.least(_open.col(c) - _shut.col(c), _tail.count(r"\)").col(c)), F.lit(0)).cast("int")
    return F.concat(_core.col(c), F.when(kept > 0, F.concat(F.call_function("substring_index", _tail.col(c), F.lit(")"), kept), F.lit(")"))).otherwise(""))


def _brackets_sql(s):
    tail = _tail.sql(s)
    kept = f"greatest(least({_open.sql(s)} - {_shut.sql(s)}, {_tail.count(chr(92) + ')').sql(s)}), 0)"
    return f"{_core.sql(s)} || CASE WHEN {kept} > 0 THEN array_to_string(list_slice(string_split({tail}, ')'), 1, {kept}), ')') || ')' ELSE '' END"


def _brackets_py(text):
    if text is None:
        return None
    parts = _tail(text).split(")")
    kept = max(0, min(_open(text) - _shut(text), len(parts) - 1))
    return _core(text) + (")".join(parts[:kept]) + ")" if kept else "")


doi = Rule(_brackets_col, _brackets_sql, _brackets_py).where(has_doi)
