"""From pages to documents.

Pages are repaired and split into HTML blocks one page at a time, in place;
then the pages of a document meet once, by its id, for the passes that need the
whole of it.  A document is small, and there are many: the shuffle spreads them
evenly, and no step needs two documents together.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import blocks as B
from ..functions import latex, markdown, pixels
from ..functions import layout as L
from ..functions import tables as T
from ..functions.words import Dictionary, no_words
from ..operators import folds

#: (png bytes, mime type, number of the figure in the document) -> what its img points to.
Sink = Callable[[bytes, str, int], str]
STYLE = "body{max-width:56rem;margin:2rem auto;padding:0 1.5rem;font:1rem/1.6 serif}table{border-collapse:collapse}td,th{border:1px solid #bbb;padding:.2rem .5rem}img{max-width:100%}.footnote{font-size:.9em}.abstract{margin:1rem 2rem}"


def inline_sink(data: bytes, mime: str, number: int) -> str:
    return pixels.data_uri(data, mime)


@dataclass
class Block:
    """A markdown block, or a figure with its box in thousandths and caption."""

    text: str | None = None
    box: tuple[int, ...] | None = None
    caption: str | None = None

    @property
    def is_figure(self) -> bool:
        return self.text is None


def _strip_echo(caption: str, following: str) -> str:
    """The caption without a last clause that repeats the next heading."""
    heading = re.match(r"^#{1,6}\s+(.*)$", following.strip())
    tail = re.search(r"[.!?]\s+([^.!?]+?)\s*$", caption.rstrip())
    if not heading or not tail:
        return caption
    said, head = (set(re.findall(r"\w+", x.lower())) for x in (tail[1], heading[1]))
    return caption.rstrip()[: tail.start(1)].rstrip() if len(said) >= 3 and len(said - head) <= 1 else caption


def page_blocks(md: str) -> list[Block]:
    """A page's blocks. A figure takes its caption from its own block or the
    next; a bare label the text behind it; then panels; a title-only caption one
    legend. Lone panel letters beside figures go."""
    raw = [b.strip() for b in L.split_blocks(md)]
    out: list[Block] = []
    k = 0
    following = lambda: raw[k] if k < len(raw) else ""
    while k < len(raw):
        block = raw[k]
        k += 1
        if not B.starts_figure(block):
            if not (B.is_panel_label(block) and (B.starts_figure(following()) or (out and out[-1].is_figure))):
                out.append(Block(block))
            continue
        first, _, rest = block.partition("\n")
        box = [r(first) for r in B.placeholder_box]
        caption = rest.strip() or None
        if caption is None and B.is_figure_caption(following()):
            caption, k = following(), k + 1
        if caption is not None:
            if B.is_bare_figure_label(caption) and B.is_caption_continuation(following()):
                caption, k = f"{caption} {following()}", k + 1
            while k < len(raw) and B.opens_panel_continuation(following()):
                caption, k = f"{caption} {following()}", k + 1
            if B.is_figure_caption(caption) and B.is_title_only_caption(caption) and k < len(raw) and B.is_legend_continuation(following()):
                caption, k = f"{caption} {following()}", k + 1
            caption = _strip_echo(caption, following())
        out.append(Block(box=tuple(map(int, box)) if all(box) else None, caption=caption))
    return out


def without_table_figures(blocks: Sequence[Block]) -> list[Block]:
    """Figures that are pictures of the table behind them go: ones whose caption
    is the table's (it is kept as text), or without one before a table caption."""
    out: list[Block] = []
    for i, b in enumerate(blocks):
        if b.is_figure:
            rest = blocks[i + 1 : i + 3]
            labelled = bool(rest) and not rest[0].is_figure and B.is_table_caption_block(rest[0].text)
            table = rest[1:] if labelled else rest
            baked = b.caption is not None and B.opens_table_caption(b.caption)
            if table and not table[0].is_figure and B.is_table_block(table[0].text) and (baked or (labelled and b.caption is None)):
                out += [Block(b.caption)] if baked else []
                continue
        out.append(b)
    return out


def joined_figures(blocks: Sequence[Block], shape: tuple[int, int]) -> tuple[dict[int, pixels.Box], dict[int, str | None], set[int]]:
    """Boxes (on a page of that height and width) and captions by the first
    block of each cluster of boxes, and the blocks that a cluster absorbs."""
    boxed = [i for i, b in enumerate(blocks) if b.is_figure and b.box]
    boxes = [pixels.to_pixels(blocks[i].box, shape) for i in boxed]
    at: dict[int, pixels.Box] = {}
    captions: dict[int, str | None] = {}
    gone: set[int] = set()
    for group in pixels.clusters(boxes, pixels.MERGE_GAP * shape[0]):
        first, *others = (boxed[g] for g in group)
        at[first] = pixels.union([boxes[g] for g in group])
        captions[first] = next((c for g in group if (c := blocks[boxed[g]].caption)), None)
        gone.update(others)
    return at, captions, gone


def _blocks(md: str) -> list[Block]:
    return without_table_figures(page_blocks(T.collapsed_page(T.closed(md))))


def page_crops(md: str, image: np.ndarray, read: pixels.Reader | None = None) -> dict[int, bytes]:
    """A page's figures as PNG, by the place of their first block."""
    blocks = _blocks(md)
    at, captions, _ = joined_figures(blocks, image.shape[:2])
    crops = {i: pixels.cropped(image, box, captions[i], read) for i, box in at.items()}
    return {i: pixels.png(c) for i, c in crops.items() if c is not None}


def page_html(md: str, shape: tuple[int, int] | None = None, crops: dict[int, bytes] | None = None, sink: Sink = inline_sink, known: Dictionary = no_words, number: int = 0) -> list[str]:
    """A page's HTML blocks, figures among them. ``shape`` is the height and
    width of its raster, ``crops`` what ``page_crops`` gave; without them a
    figure is its caption. ``number`` is the last figure's of the pages before."""
    blocks = _blocks(md)
    _, captions, gone = joined_figures(blocks, shape) if shape else ({}, {}, set())
    out: list[str] = []
    prose: list[str] = []
    for i, b in enumerate([*blocks, Block(box=())]):
        if not b.is_figure:
            prose.append(b.text)
            continue
        out += markdown.html_blocks("\n\n".join(prose), known) if prose else []
        prose = []
        if i in gone or i == len(blocks):
            continue
        caption = captions.get(i, b.caption)
        inner = f"<figcaption>{markdown.caption(latex.to_html(caption))}</figcaption>" if caption else ""
        if crops and i in crops:
            number += 1
            out.append(f'<figure><img src="{sink(crops[i], "image/png", number)}" alt="">{inner}</figure>')
        elif inner:
            out.append(f"<figure>{inner}</figure>")
    return out


def article_start(pages: Sequence[str]) -> int:
    """The first page with an abstract or introduction heading, else 0."""
    return next((i for i, md in enumerate(pages) if B.is_article_page(md)), 0)


@dataclass
class Document:
    title: str = ""
    byline: str = ""
    html: str = ""
    abstract: list[str] = field(default_factory=list)
    metadata: list[str] = field(default_factory=list)
    body: list[str] = field(default_factory=list)


def assemble(pages: Sequence[Sequence[str]], known: Dictionary = no_words) -> Document:
    """The document of its pages' HTML blocks, from the article's first page on."""
    pages = [list(p) for p in pages]
    named, stray = [], []
    if pages:
        named, rest = folds.take_metadata_sections(pages[0])
        stray, pages[0] = folds.take_stray_metadata(rest)
    parts = [p for page in pages for p in page]
    for step in (folds.join_caption_labels, folds.fuse_panels, folds.place_captions, folds.place_notes):
        parts = step(parts)
    found = folds.classify(parts)
    abstract = folds.merge(found.abstract, known)
    footer = folds.license_footer(found.body)
    body = folds.without_furniture(found.body)
    footer = None if footer in body else footer
    body = folds.place_footnotes(folds.gather_references(folds.merge(body, known)), found.footnotes)
    front, body = folds.split_front_matter(body)
    if not abstract:
        abstract, body = folds.split_unlabelled_abstract(body)
    body = folds.heading_levels(body)
    abstract, citation = folds.split_citation(abstract)
    metadata = [*front, *named, *stray, *citation, *([footer] if footer else [])]
    text = lambda x: html.unescape(B.visible(x)).strip()
    out = Document(text(found.title), text(found.byline), "", abstract, metadata, body)
    out.html = shell(found.title or "Untitled", found.byline, abstract, metadata, body)
    return out


def shell(title: str, byline: str, abstract: Sequence[str], metadata: Sequence[str], body: Sequence[str]) -> str:
    """A self-contained HTML page."""
    section = "<section class='abstract'>\n" + "\n".join(abstract) + "\n</section>" if abstract else ""
    panel = "<details class='metadata'>\n<summary>Metadata</summary>\n" + "\n".join(metadata) + "\n</details>" if metadata else ""
    name = html.escape(html.unescape(B.visible(title)))
    return (
        f'<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="utf-8">\n<title>{name}</title>\n<style>{STYLE}</style>\n</head>\n<body>\n'
        f"<header>\n<h1>{title}</h1>\n<p>{byline}</p>\n</header>\n{section}\n{panel}\n<main>\n" + "\n".join(body) + "\n</main>\n</body>\n</html>\n"
    )


def document_doi(layer: str | None, md: str | None) -> str | None:
    """The first DOI of the article's first page: its text layer's, else the transcript's."""
    return B.doi(layer or "") or B.doi(md or "")


def with_crops(pages: DataFrame, connect: Callable[[], pixels.Reader] | None = None) -> DataFrame:
    """``doc_id, page_no, md, layer, width, height, crops``: rasters (``pixels``)
    replaced by the figures cut from them, in place, so that rasters are never
    shuffled. ``connect`` makes a reader of regions, for captions that were
    drawn into figures; without it their run lengths decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = connect() if connect else None
        for batch in batches:
            crops = []
            for r in batch.select(["md", "width", "height", "pixels"]).to_pylist():
                image = np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"], -1) if r["pixels"] else None
                crops.append([] if image is None else [{"place": k, "png": v} for k, v in page_crops(r["md"], image, read).items()])
            kind = pa.list_(pa.struct([("place", pa.int32()), ("png", pa.binary())]))
            kept = ["doc_id", "page_no", "md", "layer", "width", "height"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(crops, kind)], names=[*kept, "crops"])

    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    return pages.mapInArrow(run, "doc_id string, page_no int, md string, layer string, width int, height int, crops array<struct<place:int,png:binary>>")


def parse_documents(pages: DataFrame, known: Dictionary = no_words, *, sink: Sink = inline_sink, connect: Callable[[], pixels.Reader] | None = None) -> DataFrame:
    """``doc_id, html, title, byline, doi`` for a relation of pages: ``doc_id,
    page_no, md`` and, where there are any, ``layer`` (embedded text) and
    ``width, height, pixels`` (the raster, for figures; see ``with_crops`` for
    ``connect``) or ``width, height, crops`` (what ``with_crops`` gives). A sink
    with ``for_document`` is asked for one of each document. Null markdown is an empty page; extra columns are ignored; a
    document without text is empty."""
    cut = "array<struct<place:int,png:binary>>"
    optional = {"layer": "string", "width": "int", "height": "int", "pixels": "binary", "crops": cut}
    have = {c: F.col(c) if c in pages.columns else F.lit(None) for c in optional}
    rows = pages.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page_no").cast("int").alias("page_no"), F.coalesce("md", F.lit("")).alias("md"), *[have[c].cast(t).alias(c) for c, t in optional.items()])
    rows = with_crops(rows.drop("crops"), connect) if "pixels" in pages.columns and "crops" not in pages.columns else rows.drop("pixels")

    def one(table: pa.Table) -> pa.Table:
        own = sorted(table.to_pylist(), key=lambda r: (r["page_no"] is not None, r["page_no"], r["md"]))
        layers = [r["layer"] or "" for r in own]
        running = L.recurring_lines(layers)
        mds = [L.reconciled(r["md"], x, running) for r, x in zip(own, layers, strict=True)]
        start = article_start(mds)
        put = sink.for_document(own[0]["doc_id"] or "") if hasattr(sink, "for_document") else sink
        blocks: list[list[str]] = []
        for r, md in list(zip(own, mds, strict=True))[start:]:
            drawn = sum(b.startswith("<figure><img") for p in blocks for b in p)
            crops = {c["place"]: c["png"] for c in r["crops"] or []}
            blocks.append(page_html(md, (r["height"], r["width"]) if r["height"] else None, crops, put, known, drawn))
        done = assemble(blocks, known)
        doi = document_doi(layers[start], mds[start])
        return pa.table({"doc_id": [own[0]["doc_id"]], "html": [done.html], "title": [done.title], "byline": [done.byline], "doi": pa.array([doi], pa.string())})

    return rows.groupBy("doc_id").applyInArrow(one, "doc_id string, html string, title string, byline string, doi string")


def html_blocks(pages: DataFrame, known: Dictionary = no_words) -> DataFrame:
    """``doc_id, page_no, block_no, html``: each page's blocks, in place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, mds = (batch.column(c).to_pylist() for c in ("doc_id", "page_no", "md"))
            rows = [(i, n, k, h) for i, n, md in zip(ids, numbers, mds, strict=True) for k, h in enumerate(page_html(md or "", known=known))]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "page_no", "block_no", "html"])

    rows = pages.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page_no").cast("int").alias("page_no"), "md")
    return rows.mapInArrow(run, "doc_id string, page_no int, block_no int, html string")
