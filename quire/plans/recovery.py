"""Putting back what a transcript lost, from the page's own glyphs.

Order: tables read anew from crops, two-column tables rebuilt, bold cells,
missing figures, dropped tails (in ``plans.document``), DOI.  Steps on a page
run in place; only the search for missing figures compares the pages of a
document, and does so on figure numbers, not on pages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blocks as B
from ..functions import layout as L
from ..functions import pixels
from ..functions import tables as T
from ..operators import relations as R

#: Makes a function that reads an image as markdown, once per Python worker.
Connect = Callable[[], Callable[[np.ndarray], str]]
#: Renders a region of a row's page; null where it can't.
Region = Callable[[dict, L.Box], np.ndarray | None]
GLYPHS = ("text", "boxes", "turns", "weights", "page_width", "page_height")


def pages_to_read(pages: DataFrame) -> DataFrame:
    """``pages`` (``doc_id, page_no, text``) from the first one on that has a
    text layer to speak of; all of them if none has. What is before is covers,
    and is not worth reading."""
    first = R.first_where(pages.select("doc_id", "page_no", "text"), "doc_id", "page_no", ~B.is_trivial_layer.col(F.coalesce("text", F.lit(""))))
    return pages.join(first, "doc_id").where("page_no >= first").drop("first")


def layer_of(row: dict) -> L.Layer:
    """The glyph layer of a page row; without glyphs an empty one."""
    n = len(row["text"] or "")
    boxes = [tuple(b) if b else None for b in row["boxes"] or [None] * n]
    return L.Layer(row["text"] or "", boxes, row["turns"] or [None] * n, row["weights"] or [None] * n, (row["page_width"] or 0.0, row["page_height"] or 0.0))


def crop(row: dict, box: L.Box, turn: int = 0, region: Region | None = None) -> np.ndarray | None:
    """A region of the page, turned upright: as ``region`` renders it, else its
    part of the page's raster; null without both."""
    part = region(row, box) if region else None
    if part is not None:
        return np.rot90(part, turn // 90) if turn else part
    if not row.get("pixels") or not row["page_width"]:
        return None
    image = np.frombuffer(row["pixels"], np.uint8).reshape(row["height"], row["width"], -1)
    scale = row["width"] / row["page_width"]
    x0, x1 = (int(round(v * scale)) for v in (box[0], box[2]))
    y0, y1 = (int(round((row["page_height"] - v) * scale)) for v in (box[3], box[1]))
    part = image[max(0, y0) : y1, max(0, x0) : x1]
    return np.rot90(part, turn // 90) if turn else part


def repaired_page(row: dict, read: Callable[[np.ndarray], str] | None = None, region: Region | None = None) -> str:
    """A page's markdown with its tables completed."""
    md = row["md"] or ""
    if "<table" not in md.lower():
        return md
    layer = layer_of(row)
    md = T.closed(md)
    if read is not None:
        crops = [(p, crop(row, p.box, p.turn, region)) for p in L.plans(md, layer)]
        md = L.with_crops(md, [(p, text) for p, image in crops if image is not None and image.size and (text := pixels.attempted(read, image)) is not None])
    return L.bolded(L.repaired(md, layer), layer)


def repair_tables(pages: DataFrame, connect: Connect | None = None, region: Region | None = None) -> DataFrame:
    """``pages`` with the tables in ``md`` completed from their glyphs, and from
    crops where a reader is given. In place; pages without a table pass through
    outside of Python."""
    with_table = F.coalesce(F.lower("md").contains("<table"), F.lit(False))
    names = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = connect() if connect else None
        for batch in batches:
            mds = [repaired_page(row, read, region) for row in batch.to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("md"), "md", pa.array(mds, pa.string()))

    done = pages.where(with_table).select(names).mapInArrow(run, pages.schema)
    return done.unionByName(pages.where(~with_table))


def recover_figures(pages: DataFrame, connect: Connect, region: Region | None = None) -> DataFrame:
    """``pages`` with the figures that their text layers caption and no page of
    the document emits: each is looked for on its captioned pages, from the
    article's first on, and taken from the first that yields it."""
    lines = pages.select("doc_id", "page_no", F.coalesce("md", F.lit("")).alias("md"), F.coalesce("text", F.lit("")).alias("text"))
    emitted = R.figure_numbers(lines, "doc_id", text="md").distinct()
    captioned = R.figure_numbers(lines, "doc_id", "page_no").distinct()
    start = R.first_where(lines, "doc_id", "page_no", B.is_article_page.col(F.col("md")))
    wanted = captioned.join(emitted, ["doc_id", "number"], "left_anti").join(start, "doc_id").where("page_no >= first").drop("first")
    wanted = wanted.groupBy("doc_id", "page_no").agg(F.sort_array(F.collect_set("number")).alias("numbers"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = connect()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                layer = layer_of(row)
                for n in row["numbers"]:
                    place = L.figure_region(layer, n)
                    image = crop(row, place[0], region=region) if place else None
                    text = pixels.attempted(read, image) if image is not None and image.size else None
                    got = L.recovered(text, n) if text is not None else None
                    if got:
                        caption = "" if L.has_caption(got[1], row["md"] or "") else got[1]
                        out.append((row["doc_id"], row["page_no"], n, place[1], L.figure_block(L.to_page(got[0], place[0], layer.size), caption)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "page_no", "number", "top", "block"])

    found = pages.join(wanted, ["doc_id", "page_no"]).mapInArrow(search, "doc_id string, page_no int, number int, top double, block string")
    place = F.row_number().over(Window.partitionBy("doc_id", "number").orderBy("page_no"))
    found = found.withColumn("place", place).where("place = 1")
    found = found.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("number", "top", "block"))).alias("__figures"))  # of one page
    names = pages.columns

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            mds = [L.with_figures(r["md"] or "", [(f["top"], f["block"]) for f in r["__figures"]], r["page_height"]) for r in rows]
            batch = batch.set_column(batch.schema.get_field_index("md"), "md", pa.array(mds, pa.string()))
            yield batch.select(names)

    joined = pages.join(found, ["doc_id", "page_no"], "left").select(*names, "__figures")
    done = joined.where("__figures is not null").mapInArrow(splice, pages.schema)
    return done.unionByName(joined.where("__figures is null").select(names))
