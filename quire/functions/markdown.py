"""The markdown that page transcripts use, as HTML blocks.

A subset of CommonMark with pipe tables: ATX headings, paragraphs, bullet and
numbered lists, block quotes, fenced and indented code, rules, raw HTML; inline
emphasis by the delimiter rules, escapes, entities, raw tags, breaks, links and
images, in place or by reference.
"""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache
from urllib.parse import quote

from . import blocks as B
from . import latex
from .words import Dictionary, join_lines, no_words

_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
_TAG = re.compile(r"""<(?:/[A-Za-z][\w-]*\s*|[A-Za-z][\w-]*(?:\s+[A-Za-z_:][\w.:-]*(?:\s*=\s*(?:[^\s"'=<>`]+|'[^']*'|"[^"]*"))?)*\s*/?|!--.*?--|![A-Z][^>]*|\?.*?\?)>""", re.DOTALL)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")


_LABEL = r"\[((?:[^\[\]\\]|\\.)*)\]"
_REFERENCE = re.compile(rf"(!?){_LABEL}(?:{_LABEL})?", re.DOTALL)
_TITLE = r"""(?:"((?:[^"\\]|\\.)*)"|'((?:[^'\\]|\\.)*)'|\(((?:[^()\\]|\\.)*)\))"""
_DEFINITION = re.compile(rf"{_LABEL}:[ ]*\n?[ ]*(?:<([^<>\n]*)>|([^\s<]\S*))(?:(?:[ ]+|[ ]*\n[ ]*){_TITLE})?[ ]*(?:\n|$)")
#: Label, as ``_label`` gives it -> where a reference leads, and its title.
References = dict[str, tuple[str, str]]


def _label(text: str) -> str:
    return " ".join(text.split()).casefold()


def _without_definitions(body: str, refs: References) -> str:
    """A paragraph behind the definitions at its beginning, which go to
    ``refs``; of one label the first counts."""
    at = 0
    while (m := _DEFINITION.match(body, at)) and _label(m[1]):
        refs.setdefault(_label(m[1]), (m[2] if m[2] is not None else m[3], m[4] or m[5] or m[6] or ""))
        at = m.end()
    return body[at:]


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _flank(before: str, after: str) -> tuple[bool, bool]:
    """Whether a run of delimiters opens from the left, and closes to the right."""
    space = lambda c: not c or c.isspace()
    mark = lambda c: bool(c) and (c in _PUNCTUATION or unicodedata.category(c)[0] in "PS")
    left = not space(after) and (not mark(after) or space(before) or mark(before))
    right = not space(before) and (not mark(before) or space(after) or mark(after))
    return left, right


def _linked(image: str, inner: str, to: str, title: str, refs: References) -> str:
    plain = lambda x: html.unescape(re.sub(rf"\\([{re.escape(_PUNCTUATION)}])", r"\1", x))
    title = f' title="{_escape(plain(title))}"' if title else ""
    to = re.sub(r"%(?![0-9A-Fa-f]{2})", "%25", quote(plain(to), safe=";/?:@&=+$,-_.!~*'()#%"))
    if image:
        return f'<img src="{_escape(to)}" alt="{_escape(inner)}"{title} />'
    return f'<a href="{_escape(to)}"{title}>{inline(inner, full=True, refs=refs)}</a>'


def inline(text: str, *, full: bool = False, refs: References | None = None) -> str:
    """Inline markdown as HTML. Without ``full``, code spans, links, images and
    autolinks are ordinary text; so are references that ``refs`` doesn't have."""
    refs = refs or {}
    out: list = []  # strings, and delimiter runs as [char, count, opens, closes]
    i = 0
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text) and text[i + 1] in _PUNCTUATION:
            out.append(_escape(text[i + 1]))
            i += 2
        elif c == "\\" and text[i + 1 : i + 2] == "\n":
            out.append("<br />\n")
            i += 2
        elif c == "<" and (m := _TAG.match(text, i)):
            out.append(m[0])
            i = m.end()
        elif full and c == "<" and (m := re.match(r"<([A-Za-z][A-Za-z0-9+.-]{1,31}:[^\s<>]*)>", text[i:])):
            out.append(f'<a href="{_escape(m[1])}">{_escape(m[1])}</a>')
            i += m.end()
        elif c == "&" and (m := _ENTITY.match(text, i)):
            out.append(_escape(html.unescape(m[0])))
            i = m.end()
        elif full and c == "`" and (m := re.match(r"(`+)(?!`)(.*?[^`])\1(?!`)", text[i:], re.DOTALL)):
            code = m[2].replace("\n", " ")
            code = code[1:-1] if code.strip() and code[0] == code[-1] == " " else code
            out.append(f"<code>{_escape(code)}</code>")
            i += m.end()
        elif full and c in "![" and (m := re.match(r'(!?)\[((?:[^\[\]\\]|\\.)*)\]\(\s*<?([^\s<>()]*)>?(?:\s+"([^"]*)")?\s*\)', text[i:])):
            out.append(_linked(m[1], m[2], m[3], m[4] or "", refs))
            i += m.end()
        elif full and refs and c in "![" and (m := _REFERENCE.match(text, i)) and (to := refs.get(_label(m[3] or m[2]))):
            out.append(_linked(m[1], m[2], *to, refs))
            i = m.end()
        elif c in "*_":
            j = i
            while j < len(text) and text[j] == c:
                j += 1
            before, after = text[i - 1] if i else "", text[j] if j < len(text) else ""
            left, right = _flank(before, after)
            if c == "_":
                left, right = left and (not right or not (before.isalnum() or before == "_")), right and (not left or not (after.isalnum() or after == "_"))
            out.append([c, j - i, left, right, j - i])
            i = j
        elif c == "\n":
            while out and isinstance(out[-1], str) and out[-1] == " ":
                out.pop()
            spaces = len(text[:i]) - len(text[:i].rstrip(" "))
            out.append("<br />\n" if spaces >= 2 else "\n")
            i += 1
            while i < len(text) and text[i] == " ":
                i += 1
        else:
            out.append(_escape(c))
            i += 1
    return _emphasised(out).strip()


def _emphasised(out: list) -> str:
    """Pair the delimiter runs, innermost first, and write the rest literally."""
    k = 0
    while k < len(out):
        closer = out[k]
        if not isinstance(closer, list) or not closer[3] or not closer[1]:
            k += 1
            continue
        opener = None
        for j in range(k - 1, -1, -1):
            o = out[j]
            if isinstance(o, list) and o[0] == closer[0] and o[1] and o[2]:
                odd = (o[3] or closer[2]) and (o[4] + closer[4]) % 3 == 0 and not (o[4] % 3 == 0 and closer[4] % 3 == 0)
                if not odd:
                    opener = j
                    break
        if opener is None:
            k += 1
            continue
        o = out[opener]
        two = o[1] >= 2 and closer[1] >= 2
        tag = "strong" if two else "em"
        inner = "".join(x if isinstance(x, str) else x[0] * x[1] for x in out[opener + 1 : k])
        o[1] -= 2 if two else 1
        closer[1] -= 2 if two else 1
        out[opener + 1 : k] = [f"<{tag}>{inner}</{tag}>"]
        k = opener + 2
    return "".join(x if isinstance(x, str) else x[0] * x[1] for x in out)


def render_inline(text: str) -> str:
    """Math, then inline markdown."""
    return inline(latex.to_html(text))


def caption(text: str) -> str:
    """A caption's HTML: a break behind its bold title if a legend follows."""
    out = inline(text)
    m = re.match(r"(?s)^(<strong>.*?</strong>(?:\s+<strong>.*?</strong>)*)\s+((?!<strong>)\S.*)$", out)
    return f"{m[1]}<br>{m[2]}" if m and B.opens_caption(m[1]) else out


def render_cells(table: str) -> str:
    return re.sub(r"(?is)(<t[dh]\b[^>]*>)(.*?)(</t[dh]>)", lambda m: m[1] + render_inline(m[2]) + m[3], table)


def reflow(inner: str, known: Dictionary = no_words) -> list[str]:
    """Paragraphs of a soft-wrapped block: a line that ends a sentence, though
    the next line's first word would have fitted on it, ends a paragraph."""
    if "\n" not in inner or "<br" in inner:
        return [inner]
    lines = inner.split("\n")
    seen = [B.visible(x).strip() for x in lines]
    width = max(map(len, seen))
    out = [lines[0]]
    for i in range(1, len(lines)):
        roomy = len(seen[i - 1]) + 1 + len(seen[i].split(" ", 1)[0]) <= width
        if roomy and B.line_ends_sentence(seen[i - 1]):
            out.append(lines[i])
        else:
            out[-1] = join_lines(out[-1], lines[i], known)
    return out


_HTML_BLOCK = r"(?i)^ {0,3}(?:</?(?:address|article|aside|blockquote|body|br|caption|center|col|colgroup|dd|details|dialog|dir|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|iframe|legend|li|link|main|menu|nav|ol|option|p|param|section|summary|table|tbody|td|tfoot|th|thead|title|tr|ul)(?:\s|/?>|$)|<!--|<(?:script|pre|style|textarea)(?:\s|>|$))"
_ITEM = re.compile(r"^( {0,3})([-+*]|\d{1,9}[.)])( +|$)(.*)$")
_RULE = re.compile(r"^ {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$")
_ALIGN = re.compile(r"^\s*\|?\s*:?-+:?\s*(?:\|\s*:?-+:?\s*)*\|?\s*$")


def _row(line: str) -> list[str]:
    line = line.strip()
    line = line.removeprefix("|")
    if line.endswith("|") and not line.endswith("\\|"):
        line = line[:-1]
    return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line)]


def _table(lines: list[str], refs: References) -> str:
    head = _row(lines[0])
    style = [("center" if c[0] == c[-1] == ":" and len(c) > 1 else "left" if c[0] == ":" else "right" if c[-1] == ":" else "") for c in _row(lines[1])]
    attr = lambda k: f' style="text-align:{style[k]}"' if style[k] else ""
    cells = lambda row, tag: "\n".join(f"<{tag}{attr(k)}>{inline(row[k], full=True, refs=refs) if k < len(row) else ''}</{tag}>" for k in range(len(head)))
    out = f"<table>\n<thead>\n<tr>\n{cells(head, 'th')}\n</tr>\n</thead>\n"
    if len(lines) > 2:
        out += "<tbody>\n" + "\n".join(f"<tr>\n{cells(_row(x), 'td')}\n</tr>" for x in lines[2:]) + "\n</tbody>\n"
    return out + "</table>"


def _list(items: list[list[str]], marker: str, loose: bool, refs: References) -> str:
    tag = "ol" if marker[0].isdigit() else "ul"
    number = int(marker[:-1]) if tag == "ol" else 1
    start = f' start="{number}"' if tag == "ol" and number != 1 else ""
    body = []
    for item in items:
        inner = _elements("\n".join(item), refs)
        if loose:
            body.append("<li>\n" + "\n".join(inner) + "\n</li>")
        else:
            text = "\n".join(B.plain_paragraph(x) if B.is_plain_paragraph(x) else x for x in inner)
            body.append(f"<li>{text}{chr(10) if inner and not B.is_plain_paragraph(inner[-1]) else ''}</li>")
    return f"<{tag}{start}>\n" + "\n".join(body) + f"\n</{tag}>"


def elements(text: str) -> list[str]:
    """Top-level elements of a markdown text, rules included. A reference may
    stand before its definition, so texts with definitions are passed twice."""
    refs: References = {}
    out = _elements(text, refs)
    return _elements(text, refs) if refs else out


def _elements(text: str, refs: References) -> list[str]:
    lines = text.expandtabs(4).split("\n")
    out: list[str] = []
    i = 0
    while i < len(lines):
        line = lines[i]
        if not line.strip():
            i += 1
        elif line.startswith("    "):
            j = i
            while j < len(lines) and (lines[j].startswith("    ") or not lines[j].strip()):
                j += 1
            code = [x[4:] for x in lines[i:j]]
            while not code[-1].strip():
                code.pop()
            out.append("<pre><code>" + "".join(_escape(x) + "\n" for x in code) + "</code></pre>")
            i = j
        elif m := re.match(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$", line):
            out.append(f"<h{len(m[1])}>{inline(m[2] or '', full=True, refs=refs)}</h{len(m[1])}>")
            i += 1
        elif m := re.match(r"^ {0,3}(`{3,}|~{3,})\s*([^`\s]*)[^`]*$", line):
            j = i + 1
            while j < len(lines) and not re.match(rf"^ {{0,3}}{m[1][0]}{{{len(m[1])},}}\s*$", lines[j]):
                j += 1
            kind = f' class="language-{_escape(m[2])}"' if m[2] else ""
            out.append(f"<pre><code{kind}>" + "".join(_escape(x) + "\n" for x in lines[i + 1 : j]) + "</code></pre>")
            i = j + 1
        elif _RULE.match(line):
            out.append("<hr />")
            i += 1
        elif re.match(_HTML_BLOCK, line):
            j = i
            while j < len(lines) and lines[j].strip():
                j += 1
            out.append("\n".join(lines[i:j]).strip())
            i = j
        elif line.lstrip().startswith(">") and len(line) - len(line.lstrip()) < 4:
            j = i
            while j < len(lines) and lines[j].strip():
                j += 1
            inner = "\n".join(re.sub(r"^ {0,3}> ?", "", x) for x in lines[i:j])
            out.append("\n".join(["<blockquote>", *_elements(inner, refs), "</blockquote>"]))
            i = j
        elif (m := _ITEM.match(line)) and m[4]:
            i = _take_list(lines, i, m, out, refs)
        elif "|" in line and i + 1 < len(lines) and _ALIGN.match(lines[i + 1]) and "|" in lines[i + 1] and len(_row(line)) == len(_row(lines[i + 1])):
            j = i + 2
            while j < len(lines) and lines[j].strip() and not re.match(_HTML_BLOCK, lines[j]):
                j += 1
            out.append(_table(lines[i:j], refs))
            i = j
        else:
            j = i + 1
            while j < len(lines) and lines[j].strip() and not _interrupts(lines[j]):
                if re.match(r"^ {0,3}(?:=+|-+)[ \t]*$", lines[j]):
                    break
                j += 1
            body = "\n".join(x.strip(" ") if k == j - 1 else x.lstrip(" ") for k, x in enumerate(lines[i:j], i))
            body = _without_definitions(body, refs) if body.startswith("[") else body
            if not body:
                i = j
                continue
            if j < len(lines) and (m := re.match(r"^ {0,3}(=+|-+)[ \t]*$", lines[j])):
                level = 1 if m[1][0] == "=" else 2
                out.append(f"<h{level}>{inline(body, full=True, refs=refs)}</h{level}>")
                j += 1
            else:
                out.append(f"<p>{inline(body, full=True, refs=refs)}</p>")
            i = j
    return out


def _interrupts(line: str) -> bool:
    item = _ITEM.match(line)
    return bool(
        re.match(r"^ {0,3}#{1,6}(?:[ \t]|$)", line)
        or re.match(r"^ {0,3}(?:`{3,}|~{3,})", line)
        or (_RULE.match(line) and not re.match(r"^ {0,3}-+[ \t]*$", line))
        or re.match(_HTML_BLOCK, line)
        or re.match(r"^ {0,3}>", line)
        or (item and item[4] and (not item[2][0].isdigit() or item[2][:-1] == "1"))
    )


def _take_list(lines: list[str], i: int, m, out: list[str], refs: References) -> int:
    kind = lambda marker: marker[-1] if marker[0].isdigit() else marker
    first, items, loose = m[2], [], False
    while i < len(lines) and (m := _ITEM.match(lines[i])) and m[4] and kind(m[2]) == kind(first):
        indent = len(m[1]) + len(m[2]) + len(m[3])
        item = [m[4]]
        i += 1
        while i < len(lines):
            line = lines[i]
            deep = len(line) - len(line.lstrip(" ")) >= indent
            if not line.strip():
                j = i
                while j < len(lines) and not lines[j].strip():
                    j += 1
                inside = j < len(lines) and len(lines[j]) - len(lines[j].lstrip(" ")) >= indent
                another = j < len(lines) and (n := _ITEM.match(lines[j])) and n[4] and kind(n[2]) == kind(first)
                if not inside:
                    loose = loose or bool(another)
                    i = j
                    break
                loose = True
                item += [""] * (j - i)
                i = j
            elif deep:
                item.append(line[indent:])
                i += 1
            elif _ITEM.match(line) or _interrupts(line):
                break
            else:
                item.append(line.lstrip(" "))
                i += 1
        items.append(item)
    out.append(_list(items, first, loose, refs))
    return i


@lru_cache(maxsize=4096)
def _page(text: str) -> tuple[str, ...]:
    return tuple(elements(latex.to_html(text)))


def html_blocks(text: str, known: Dictionary = no_words) -> list[str]:
    """A page's markdown as top-level HTML blocks: rules are dropped, cells are
    rendered, and soft-wrapped paragraphs are set as their paragraphs."""
    out: list[str] = []
    for block in _page(text):
        if block.startswith("<hr"):
            continue
        if "<td" in block or "<th" in block:
            out.append(render_cells(block))
        elif B.is_plain_paragraph(block):
            out += [f"<p>{p}</p>" for p in reflow(B.plain_paragraph(block), known)]
        else:
            out.append(block)
    return out
