"""From page images with glyphs to documents, each page read once.

One pass over the pages, in place: a page is read, its tables are completed and
its figures cut, all while its raster is at hand.  What comes out is stored
without rasters, but for pages whose text layer captions a figure that they
don't show: only for these can the search for missing figures, which compares
the pages of a document, need them again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.words import Dictionary, no_words
from ..sources import reader
from ..storage import drop_stored, stored
from .document import Sink, inline_sink, page_crops, parse_documents
from .recovery import Region, recover_figures, repaired_page

_CROPS = pa.list_(pa.struct([("place", pa.int32()), ("png", pa.binary())]))
_PAGES = pa.schema(
    [("doc_id", pa.string()), ("page_no", pa.int32()), ("md", pa.string()), ("error", pa.string()), ("disposition", pa.string()), ("text", pa.string()),
     ("width", pa.int32()), ("height", pa.int32()), ("page_width", pa.float64()), ("page_height", pa.float64()), ("crops", _CROPS), ("pixels", pa.binary()),
     ("boxes", pa.list_(pa.list_(pa.float64()))), ("turns", pa.list_(pa.int32())), ("weights", pa.list_(pa.int32()))]
)
_DDL = (
    "doc_id string, page_no int, md string, error string, disposition string, text string, width int, height int, page_width double, page_height double, "
    "crops array<struct<place:int,png:binary>>, pixels binary, boxes array<array<double>>, turns array<int>, weights array<int>"
)
_LAYER = ("pixels", "boxes", "turns", "weights")
Connect = Callable[[], reader.Reader]


def _crops(row: dict, read: Callable[[np.ndarray], str]) -> list[dict]:
    image = reader.as_image(row["pixels"], row["width"], row["height"])
    return [{"place": k, "png": v} for k, v in page_crops(row["md"] or "", image, read).items()]


def read_and_repair(source: DataFrame, connect: Connect, region: Region | None = None) -> DataFrame:
    """The pages of ``source`` (the schema of ``quire_pdf``) as markdown with
    completed tables, ``crops``, and ``error, disposition`` of pages that could
    not be read. A page is one request, beside those for its crops, which
    ``region`` renders (else they are parts of the page's raster)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            rows = batch.to_pylist()
            try:
                made = made or connect()
                results = made.read_each(reader.as_image(r["pixels"], r["width"], r["height"]) for r in rows)
            except reader.ConversionError as e:
                results = [e] * len(rows)
            for row, result in zip(rows, results, strict=True):
                row |= reader.outcome(result) | {"crops": []}
                if row["md"] is not None:
                    row["md"] = repaired_page(row, made.read, region)
                    row["crops"] = _crops(row, made.read)
                if row["md"] is None or not L.figure_numbers(row["text"] or "") - L.figure_numbers(row["md"]):
                    row |= dict.fromkeys(_LAYER)
            yield pa.RecordBatch.from_pylist(rows, schema=_PAGES)

    source.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return source.mapInArrow(run, _DDL)


def _cut_anew(pages: DataFrame, connect: Connect) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            made = made or connect()
            crops = [_crops(row, made.read) for row in batch.to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("crops"), "crops", pa.array(crops, _CROPS))

    return pages.mapInArrow(run, pages.schema)


def convert(source: DataFrame, connect: Connect, known: Dictionary = no_words, *, sink: Sink = inline_sink, region: Region | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents (see ``parse_documents``) and failures (``doc_id, page_no,
    error, disposition``). A document of which a page failed is not made. An
    empty source gives neither; page numbers may have gaps. ``region`` renders
    what is read again (``pdf.Regions`` of the path that was loaded)."""
    pages = stored(read_and_repair(source, connect, region), "pages")
    failures = pages.where("error is not null").select("doc_id", "page_no", "error", "disposition")
    whole = pages
    if failures.limit(1).count():
        whole = pages.join(stored(failures.select("doc_id").distinct(), "failed"), "doc_id", "left_anti").select(pages.columns)
    if whole.where("pixels is not null").limit(1).count():
        found = stored(recover_figures(whole, lambda: connect().read, region), "pages")
        anew = F.col("pixels").isNotNull()
        whole = stored(_cut_anew(found.where(anew), connect).unionByName(found.where(~anew)), "pages")
        drop_stored(found)
    return parse_documents(whole.select("doc_id", "page_no", "md", F.col("text").alias("layer"), "width", "height", "crops"), known, sink=sink), failures
