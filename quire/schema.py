"""Schemas of the engine's relations."""

from __future__ import annotations

from pyspark.sql import types as T

#: One page of one document: markdown as read, and the page's embedded text.
PAGES = "doc_id string, page_no int, md string, layer string"
#: One page's glyphs as parallel arrays.
GLYPHS = "doc_id string, page_no int, text string, boxes array<array<double>>, turns array<int>, weights array<int>, width double, height double"
#: One page's raster: 8-bit RGB, row by row.
IMAGES = "doc_id string, page_no int, width int, height int, pixels binary"
#: Blocks in reading order.
BLOCKS = "doc_id string, page_no int, block_no int, html string"
#: The product: null doi where none was found, empty texts where nothing was.
DOCUMENT = "doc_id string, html string, title string, byline string, doi string"
#: What could not be converted, and whether to try again: retry, retry_capped or fail.
FAILURES = "doc_id string, page_no int, error string, disposition string"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(ddl)
