"""PDF pages and glyphs as Spark data sources, where a PDF library is installed.

``format("quire_pdf")`` gives one row per page with its raster and glyph layer;
partitions are files.  ``option("glyphs", "false")`` reads the text only, and
``option("pixels", "false")`` renders nothing;
``option("skipcovers", "true")`` leaves out the pages before the first that has
a text layer to speak of.  The library is optional and is
looked for only when a file is read.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import BadInput
from ..functions.blocks import is_trivial_layer
from ..functions.layout import Box, crop_scale, snapped
from ..functions.pixels import fitted, render_scale

NAME = "quire_pdf"
_log = logging.getLogger(__name__)
SCHEMA = (
    "doc_id string, page_no int, width int, height int, pixels binary, text string, "
    "boxes array<array<double>>, turns array<int>, weights array<int>, page_width double, page_height double"
)
_ARROW = pa.schema(
    [("doc_id", pa.string()), ("page_no", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.binary()), ("text", pa.string()),
     ("boxes", pa.list_(pa.list_(pa.float64()))), ("turns", pa.list_(pa.int32())), ("weights", pa.list_(pa.int32())), ("page_width", pa.float64()), ("page_height", pa.float64())]
)


def library():
    try:
        import pypdfium2
    except ImportError as e:
        raise BadInput("no PDF library is installed on this worker") from e
    return pypdfium2


def text_of(page) -> str:
    text = page.get_textpage()
    try:
        return str(text.get_text_range())
    finally:
        text.close()


def glyphs(page) -> tuple[str, list, list, list]:
    """Characters, boxes (null if empty), quarter turns and weights of a page;
    a glyph of several characters gives each its values."""
    raw = library().raw
    text = page.get_textpage()
    chars, boxes, turns, weights = [], [], [], []
    try:
        for i in range(text.count_chars()):
            char = text.get_text_range(i, 1)
            try:
                left, bottom, right, top = text.get_charbox(i)
                box = [left, bottom, right, top] if right > left and top > bottom else None
            except Exception:
                box = None
            angle, weight = raw.FPDFText_GetCharAngle(text.raw, i), raw.FPDFText_GetFontWeight(text.raw, i)
            chars.append(char)
            boxes += [box] * len(char)
            turns += [snapped(math.degrees(angle)) if angle >= 0 else None] * len(char)
            weights += [weight if weight >= 0 else None] * len(char)
    finally:
        text.close()
    return "".join(chars), boxes, turns, weights


class PdfFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PdfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.skip_covers = str(options.get("skipcovers", "false")).lower() == "true"
        self.glyphs, self.pixels = (str(options.get(k, "true")).lower() != "false" for k in ("glyphs", "pixels"))

    def partitions(self):
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        return [PdfFile(f.path) for f in found if f.type == pafs.FileType.File and f.path.lower().endswith(".pdf")] or [PdfFile("")]

    def read(self, partition: PdfFile) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_file(partition.path) as f:
            data = f.read()
        _, root = pafs.FileSystem.from_uri(self.path)
        name = partition.path.removeprefix(root.rstrip("/") + "/") if partition.path != root else root.rpartition("/")[2]
        name = name.removesuffix(".pdf")
        try:
            pdf = library().PdfDocument(data)
        except BadInput:
            raise
        except Exception as e:
            raise BadInput(f"could not open {partition.path}") from e
        try:
            first = next((n for n, page in enumerate(pdf) if not is_trivial_layer(text_of(page))), 0) if self.skip_covers else 0
            for n, page in enumerate(pdf):
                if n < first:
                    continue  # neither rendered nor read
                yield pa.RecordBatch.from_pylist([self.row(name, n, page)], schema=_ARROW)
        finally:
            pdf.close()

    def row(self, name: str, n: int, page) -> dict:
        width, height = page.get_size()
        row = dict.fromkeys(_ARROW.names) | {"doc_id": name, "page_no": n, "page_width": width, "page_height": height}
        if self.pixels:
            try:
                image = page.render(scale=render_scale(width, height)).to_pil().convert("RGB")
                image = image.resize(fitted(*image.size))
            except Exception as e:
                raise BadInput(f"could not render page {n} of {name}") from e
            row |= {"width": image.width, "height": image.height, "pixels": image.tobytes()}
        if self.glyphs:
            row["text"], row["boxes"], row["turns"], row["weights"] = glyphs(page)
        else:
            row["text"] = text_of(page)
        return row


class Regions:
    """Renders a region of a page of the PDFs at ``path`` (what was loaded) anew,
    at a scale that suits the region. Goes to Python workers as it is; a worker
    holds the PDF it used last."""

    def __init__(self, path: str):
        self.path, self.held = path, ("", None)

    def __getstate__(self) -> dict:
        return {"path": self.path, "held": ("", None)}

    def opened(self, doc_id: str):
        if self.held[1] is None or self.held[0] != doc_id:
            if self.held[1] is not None:
                self.held[1].close()
            self.held = ("", None)
            fs, root = pafs.FileSystem.from_uri(self.path)
            if fs.get_file_info(root).type != pafs.FileType.File:
                root = f"{root.rstrip('/')}/{doc_id}"
                if not root.lower().endswith(".pdf") or fs.get_file_info(f"{root}.pdf").type == pafs.FileType.File:
                    root += ".pdf"
            with fs.open_input_file(root) as f:
                self.held = doc_id, library().PdfDocument(f.read())
        return self.held[1]

    def __call__(self, row: dict, box: Box) -> np.ndarray | None:
        """Null (with a warning) where the region can't be rendered: its part of
        the page's raster must do."""
        x0, y0, x1, y1 = box
        try:
            page = self.opened(row["doc_id"])[row["page_no"]]
            image = page.render(scale=crop_scale(box), crop=(x0, y0, row["page_width"] - x1, row["page_height"] - y1)).to_pil().convert("RGB")
            return np.asarray(image.resize(fitted(*image.size)))
        except BadInput:
            raise
        except Exception as e:
            _log.warning("could not render a region of page %s of %s: %s", row["page_no"], row["doc_id"], e)
            return None


class PdfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PdfReader:
        return PdfReader(dict(self.options.items()))


def register(spark) -> None:
    spark.dataSource.register(PdfSource)
