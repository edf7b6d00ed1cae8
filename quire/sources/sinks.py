"""Where documents and their figures go."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_name(text: str) -> str:
    """A file name of its own for every text: characters that a name can't have
    become ``_``, and where any did, a hash tells such names apart."""
    clean = re.sub(r"[^A-Za-z0-9_.-]", "_", text)
    return clean if clean == text else f"{clean}-{hashlib.sha1(text.encode()).hexdigest()[:12]}"


@dataclass(frozen=True)
class FolderSink:
    """Figures as ``fig_001.png``, ... in a folder that all workers share; an
    img points to them by ``link``. A figure that is written twice is the same
    file. Of several documents, each has a folder of its own below."""

    folder: str
    link: str

    def __call__(self, data: bytes, mime: str, number: int) -> str:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(root, recursive=True)
        file = f"fig_{number:03d}.png"
        with fs.open_output_stream(f"{root}/{file}") as out:
            out.write(data)
        return f"{self.link}/{file}"

    def for_document(self, doc_id: str) -> FolderSink:
        name = file_name(doc_id)
        return FolderSink(f"{self.folder}/{name}", f"{self.link}/{name}")


def folder_sink(folder: str) -> FolderSink:
    """A sink to a folder, linked to by the folder's own name."""
    folder = folder.rstrip("/")
    return FolderSink(folder, folder.rpartition("/")[2])


def write_html(documents: DataFrame, folder: str, *, name: str = "doc_id") -> DataFrame:
    """Write each document's ``html`` to ``folder/<name>.html`` (see
    ``file_name``), UTF-8, when the result (``doc_id, path``) is consumed. A
    retried task writes the same files again."""
    rows = documents.select(F.col(name).cast("string").alias("doc_id"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            paths = []
            for row in batch.to_pylist():
                paths.append(f"{root}/{file_name(row['doc_id'] or '')}.html")
                with fs.open_output_stream(paths[-1]) as out:
                    out.write(row["html"].encode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(paths)], names=["doc_id", "path"])

    return rows.mapInArrow(run, "doc_id string, path string")
