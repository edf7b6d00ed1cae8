"""Ordered passes over one document's blocks.

These are the operators whose outcome for a block depends on what the pass has
already done to the blocks before it (joins that consume blocks, claims that
use captions up, a window that closes), which no window function can express.
Each works on the list of one document's HTML blocks; ``plans.document`` runs
them in a grouped map, one document at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from ..functions import blocks as B
from ..functions import tables as T
from ..functions.vocabulary import MARKERS
from ..functions.words import Dictionary, join_lines, no_words

#: Floats between a fragment and its continuation; plain notes before a table's marked ones.
MAX_FLOATS, MAX_LEAD_NOTES = 3, 1
Blocks = list[str]


# ---- table captions and notes
def join_caption_labels(parts: Sequence[str]) -> Blocks:
    """A lone ``Table 1`` label takes in the paragraph behind it."""
    out: Blocks = []
    todo = list(reversed(parts))
    while todo:
        part = todo.pop()
        label = B.bare_table_label(part)
        title = B.plain_paragraph(todo[-1]) if todo else None
        if label is not None and title is not None and not B.opens_caption(title):
            todo.pop()
            part = f"<p>{label.rstrip()} {title.lstrip()}</p>"
        out.append(part)
    return out


def fuse_panels(parts: Sequence[str]) -> Blocks:
    """Neighbouring tables without captions, lettered on from each other, are one."""
    out: Blocks = []
    expected = None
    for part in parts:
        letter = T.panel_letter(part) if B.is_table(part) and not B.has_caption_tag(part) else None
        if letter is not None and letter == expected:
            out[-1] = T.fused(out[-1], part)
        else:
            out.append(part)
        expected = chr(ord(letter) + 1) if letter else None
    return out


def place_captions(parts: Sequence[str]) -> Blocks:
    """Free captions move into their tables: first every table, in order, claims
    the nearest unused caption before it, then those still without one the
    nearest behind; only figures may lie between."""
    parts = [T.hoisted(p) if B.is_table(p) else p for p in parts]
    free = {i for i, p in enumerate(parts) if B.is_table_caption(p)}
    bare = [i for i, p in enumerate(parts) if B.is_table(p) and not B.has_caption_tag(p)]
    claims: dict[int, int] = {}
    for step in (-1, 1):
        for t in bare:
            k = t + step
            while 0 <= k < len(parts) and k not in free and B.is_figure(parts[k]):
                k += step
            if t not in claims and k in free:
                free.discard(k)
                claims[t] = k
    used = set(claims.values())
    return [T.with_caption(p, B.table_caption(parts[claims[i]])) if i in claims else p for i, p in enumerate(parts) if i not in used]


def place_notes(parts: Sequence[str]) -> Blocks:
    """Notes behind a table move to it: at most one plain lead, then paragraphs
    whose superscript occurs in the table, then source notes. Without a marked
    note only source notes move, and only if nothing plain precedes them."""
    out: Blocks = []
    i = 0
    while i < len(parts):
        part = parts[i]
        i += 1
        if not B.is_table(part):
            out.append(part)
            continue
        labels = T.note_labels(part)

        def run(at: int, fits, most: int = len(parts)) -> int:
            end = at
            while end < len(parts) and end - at < most and (inner := B.plain_paragraph(parts[end])) is not None and fits(parts[end], inner):
                end += 1
            return end

        lead = run(i, lambda p, inner: B.leading_sup(inner) is None and not B.is_source_note(p), MAX_LEAD_NOTES)
        marked = run(lead, lambda p, inner: B.leading_sup(inner) in labels)  # noqa: B023
        source = run(marked, lambda p, inner: B.is_source_note(p))
        moves = marked > lead or (source > marked and lead == i)
        end = source if moves else i
        out.append(part + "".join(map(T.as_note, parts[i:end])))
        i = end
    return out


# ---- paragraphs cut by columns and pages
def continues(fragment: str, lead: str, in_references: bool) -> bool:
    """Whether paragraph ``lead`` (inner HTML) goes on where ``fragment`` stops."""
    if not B.may_continue(lead):
        return False
    head, seen = B.visible(lead).lstrip(), B.visible(fragment).rstrip()
    if B.ends_function_word(seen) and B.opens_upper(head) and not B.opens_identifier(head):
        return False
    return not (in_references and (B.opens_upper(head) or B.opens_numbered_reference(head)))


def merge_once(parts: Sequence[str], known: Dictionary = no_words) -> Blocks:
    """One pass: an open paragraph takes in its continuation, over at most three
    floats and any legends, which then follow the joined paragraph."""
    references = next((i for i, p in enumerate(parts) if B.is_reference_heading(p)), len(parts))
    out: Blocks = []
    i = 0
    while i < len(parts):
        part, here = parts[i], i
        out.append(part)
        i += 1
        if not B.is_open_fragment(part):
            continue
        j, floats = i, 0
        while j < len(parts):
            if not B.is_legend(parts[j]):
                if not B.is_float(parts[j]) or floats == MAX_FLOATS:
                    break
                floats += 1
            j += 1
        lead = B.plain_paragraph(parts[j]) if j < len(parts) else None
        inner = B.plain_paragraph(part).rstrip()
        if lead is not None and continues(inner, lead, here >= references):
            out[-1] = f"<p>{join_lines(inner, lead, known)}</p>"
            out += parts[i:j]
            i = j + 1
    return out


def merge(parts: Sequence[str], known: Dictionary = no_words) -> Blocks:
    """Passes until nothing changes."""
    now = list(parts)
    while (after := merge_once(now, known)) != now:
        now = after
    return now


# ---- sections of the document
@dataclass
class Sections:
    """A document's blocks by where they belong."""

    title: str = ""
    byline: str = ""
    abstract: Blocks = field(default_factory=list)
    body: Blocks = field(default_factory=list)
    footnotes: Blocks = field(default_factory=list)


def is_degenerate(text: str) -> bool:
    """Eight or more words, six in ten of them the same."""
    words = re.findall(r"\w+", B.visible(text))
    return len(words) >= 8 and Counter(words).most_common(1)[0][1] >= 0.6 * len(words)


def _title_follows(parts: Sequence[str]) -> bool:
    """Whether a run of headings, mastheads and document types skipped, has a title."""
    for part in parts:
        inner = B.heading_inner(part)
        if inner is None:
            return False
        if not (B.is_masthead(inner) or B.is_document_type(inner)):
            return B.is_title(inner)
    return False


def classify(parts: Sequence[str]) -> Sections:
    """Title, byline, abstract, body and footnotes, in one pass."""
    out = Sections()
    byline_next = in_abstract = in_body = False
    for i, part in enumerate(parts):
        inner = B.heading_inner(part)
        if inner is not None:
            if not out.title and B.is_masthead(inner) and _title_follows(parts[i + 1 :]):
                continue
            if not out.title and B.is_title(inner):
                out.title, byline_next = inner, True
                continue
            byline_next = False
            if B.is_abstract_title(inner):
                in_abstract = True
            elif not B.is_document_type(inner):
                in_abstract = False
                in_body = in_body or not (B.is_named_heading(part) or B.is_publication_heading(part))
                out.body.append(f"<h2>{inner}</h2>" if out.title and B.heading_level(part) == "1" else part)
            continue
        text = B.plain_paragraph(part)
        if text is not None and B.opens_banner(text):
            text = B.without_banner(text).lstrip()
            if not text:
                continue
            part = f"<p>{text}</p>"
        if byline_next:
            byline_next = False
            if text is not None and B.is_byline(text):
                out.byline = B.byline_html(text)
                continue
        if text is None:
            in_abstract = False
            out.body.append(part)
        elif B.opens_inline_abstract(text):
            in_abstract = True
            if rest := B.without_abstract_label(text).lstrip():
                out.abstract.append(f"<p>{rest}</p>")
        elif in_abstract and not B.any_bold_label(text):
            out.abstract.append(part)
        else:
            in_abstract = False
            if B.opens_short_sup(text) or (in_body and B.is_late_footnote(text)):
                out.footnotes.append(f'<p class="footnote">{text}</p>')
            elif not is_degenerate(text):
                out.body.append(part)
    return out


def front_length(body: Sequence[str]) -> int:
    """Blocks of the leading front-matter run. Behind a metadata heading only
    prose that is neither a list nor front matter ends it."""
    under_heading = False
    for i, part in enumerate(body):
        if B.is_heading(part):
            if not B.is_metadata_heading(part):
                return i
            under_heading = True
        elif under_heading:
            if B.is_body_prose(part) and not B.is_front_matter_loose(part) and not B.is_list_like(part):
                return i
        elif not B.is_front_matter(part):
            return i
    return len(body)


def split_front_matter(body: Sequence[str]) -> tuple[Blocks, Blocks]:
    """Front matter and the rest; labelled lines before the first heading of the
    rest belong to it, too. Nothing is taken if it were the whole body."""
    n = front_length(body)
    if n == len(body):
        return [], list(body)
    first = next((i for i in range(n, len(body)) if B.is_heading(body[i])), len(body))
    labelled = lambda p: (inner := B.plain_paragraph(p)) is not None and (B.is_front_label(inner) or B.is_publication_label(inner))
    moved = {i for i in range(n, first) if labelled(body[i])}
    return [*body[:n], *(body[i] for i in sorted(moved))], [p for i, p in enumerate(body) if i >= n and i not in moved]


def split_unlabelled_abstract(body: Sequence[str]) -> tuple[Blocks, Blocks]:
    """Leading prose right before a heading is an abstract without its heading."""
    n = 0
    while n < len(body) and B.is_body_prose(body[n]) and not B.is_front_matter_loose(body[n]) and not B.is_list_like(body[n]):
        n += 1
    if 0 < n < len(body) and B.is_heading(body[n]):
        return list(body[:n]), list(body[n:])
    return [], list(body)


def split_citation(abstract: Sequence[str]) -> tuple[Blocks, Blocks]:
    """The last ``© year ...`` tail of the last abstract paragraph, if prose precedes it."""
    m = re.match(r"(?is)^(<p[^>]*>)(.*)(\s*©\s*\d{4}\b.*?)(</p>)\s*$", abstract[-1]) if abstract else None
    if m is None or not m[2].strip():
        return list(abstract), []
    return [*abstract[:-1], m[1] + m[2].rstrip() + m[4]], [f"<p>{m[3].strip()}</p>"]


def take_metadata_sections(parts: Sequence[str]) -> tuple[Blocks, Blocks]:
    """Glossary sections and publication sidebars of a first page, and the rest."""
    taken: Blocks = []
    rest: Blocks = []
    i = 0
    while i < len(parts):
        j = i + 1
        if B.is_named_heading(parts[i]):
            while j < len(parts) and (B.is_front_matter_loose(parts[j]) or B.is_list_like(parts[j])):
                j += 1
            j = j if j > i + 1 else i  # a heading alone stays
        else:
            j = i
        if j == i and B.is_publication_heading(parts[i]):
            j = i + 1
            while j < len(parts) and (
                B.is_publication_heading(parts[j])
                or (not B.is_heading(parts[j]) and B.is_plain_paragraph(parts[j]) and (B.is_value_heading(parts[j - 1]) or B.is_front_matter_loose(parts[j])))
            ):
                j += 1
        if j > i:
            taken += parts[i:j]
            i = j
        else:
            rest.append(parts[i])
            i += 1
    return taken, rest


def contribution_marker(parts: Sequence[str]) -> str | None:
    """The symbol that most authors of the first byline share, twice at least."""
    for part in parts:
        inner = B.plain_paragraph(part)
        if inner is not None and B.is_byline(inner):
            counts = Counter(c for c in B.visible(inner) if c in MARKERS)  # in order of appearance
            mark, n = counts.most_common(1)[0] if counts else ("", 0)
            return mark if n >= 2 else None
    return None


def take_stray_metadata(parts: Sequence[str]) -> tuple[Blocks, Blocks]:
    """Metadata lines of a first page wherever they stand, and the rest. A note
    on equal contributions that lost its symbol gets the byline's."""
    mark = contribution_marker(parts)
    taken: Blocks = []
    for part in filter(B.is_stray_metadata, parts):
        seen = B.visible(B.plain_paragraph(part))
        marked = seen.lstrip()[:1] in tuple(MARKERS)
        taken.append(f"<p>{mark}{B.plain_paragraph(part)}</p>" if mark and B.is_equal_contribution(seen) and not marked else part)
    return taken, [p for p in parts if not B.is_stray_metadata(p)]


def heading_levels(body: Sequence[str]) -> Blocks:
    """Levels by section numbers, top sections at 2."""
    out: Blocks = []
    for part in body:
        inner = B.heading_inner(part)
        if inner is not None:
            number = B.section_number(inner)
            level = min(2 + number.count("."), 4) if number else 2 if B.is_top_section(inner) else int(B.heading_level(part))
            if str(level) != B.heading_level(part):
                part = f"<h{level}>{inner}</h{level}>"
        out.append(part)
    return out


# ---- furniture, references, footnotes
def license_footer(parts: Sequence[str]) -> str | None:
    """The first of two or more license footers."""
    found = [p for p in parts if B.is_license_footer(p)]
    return found[0] if len(found) > 1 else None


def without_furniture(parts: Sequence[str]) -> Blocks:
    """Blocks that neither recur as running headers nor are bare page numbers;
    ``operators.furniture`` does the same over a relation of blocks."""
    seen = [(k, p) for p in parts if (k := B.furniture_candidate(p)) is not None]
    count = Counter(k for k, _ in seen)
    verbatim = Counter(B.furniture_verbatim(p) for _, p in seen)
    prose = {k for k, p in seen if B.is_plain_paragraph(p)} | {k for k, p in seen if re.search(r"\d", v := B.furniture_verbatim(p)) and verbatim[v] > 1}
    loose = {k for k, p in seen if not B.furniture_sentence(p)}
    running = {k for k, n in count.items() if n > 1 and k in prose and (k in loose or n >= 3)}
    return [p for p in parts if B.furniture_candidate(p) not in running and not B.is_page_number(p)]


def gather_references(parts: Sequence[str]) -> Blocks:
    """Behind the references heading, numbered paragraphs become list items, and
    lower-case paragraphs behind a list go on in its last item."""
    start = next((i for i, p in enumerate(parts) if B.is_reference_heading(p)), len(parts))
    out = list(parts[: start + 1])
    for part in parts[start + 1 :]:
        listed = bool(out) and B.is_ordered_list(out[-1])
        if listed and B.is_reference_tail(part):
            head, cut, tail = out[-1].rpartition("</p>")
            # a list without paragraphs takes the text before its last character
            out[-1] = f"{head} {B.plain_paragraph(part)}{cut}{tail}" if cut else f"{out[-1][:-1]} {B.plain_paragraph(part)}{out[-1][-1]}"
        elif B.is_numbered_reference(part):
            item = f"<li>\n<p>{B.reference_text(part)}</p>\n</li>"
            if listed:
                head = out[-1][: out[-1].rfind("</ol>")]
                out[-1] = head + ("" if head.endswith("\n") else "\n") + item + "\n</ol>"
            else:
                out.append(f'<ol start="{B.reference_number(part)}">\n{item}\n</ol>')
        else:
            out.append(part)
    return out


def place_footnotes(body: Sequence[str], footnotes: Sequence[str]) -> Blocks:
    """Footnotes go before the references heading, else before the first ``[1]``
    paragraph, else to the end."""
    find = lambda test: next((i for i, p in enumerate(body) if test(p)), None)
    at = find(B.is_reference_heading)
    at = find(B.opens_references) if at is None else at
    at = len(body) if at is None else at
    return [*body[:at], *footnotes, *body[at:]]
