"""Recorded page transcripts, and glyph layers, as relations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = r"===== PAGE \d+ ====="


def document_id(spark: SparkSession, path: str) -> Column:
    """The id of a file read from ``path``: its own path below the folder, or
    before the first wildcard, without the suffix ``.md``. Files of one name in
    two folders are two documents."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    plain = lambda uri: re.sub("^file:/+", "/", uri)
    whole = plain(fs.makeQualified(jpath).toString())
    fixed = re.split(r"[*?\[{]", whole)[0]
    single = fixed == whole and fs.exists(jpath) and fs.getFileStatus(jpath).isFile()
    root = f"{whole}/" if fixed == whole and not single else fixed[: fixed.rfind("/") + 1]
    own = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    below = F.when(own.startswith(root), F.substr(own, F.lit(len(root) + 1))).otherwise(own)
    return F.regexp_replace(below, r"\.md\z", "")


def pages_of(files: DataFrame) -> DataFrame:
    """``doc_id, page_no, md`` of whole transcript files (``doc_id, value``)."""
    parts = F.split("value", rf"(?m)^{MARK}[ \t]*\r?$", -1)
    pages = files.select("doc_id", F.posexplode(parts).alias("n", "md")).where("n > 0")
    return pages.select("doc_id", (F.col("n") - 1).cast("int").alias("page_no"), F.regexp_replace("md", r"^[\r\n]+|[\r\n]+\z", "").alias("md"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, page_no, md`` of text files that mark pages by lines like
    ``===== PAGE 1 =====``. What precedes the first mark is dropped; pages count
    from 0 in the order of their marks; blank lines at a page's ends go."""
    return pages_of(spark.read.text(path, wholetext=True).select(document_id(spark, path).alias("doc_id"), "value"))


def glyph_rows(layers: DataFrame) -> DataFrame:
    """One row per glyph: ``doc_id, page_no, pos, ch, l, b, r, t, turn, weight``;
    nulls where the layer has none."""
    at = lambda a, i: F.get(a, i)
    chars = F.split(F.col("text"), "")
    rows = layers.select("doc_id", "page_no", "boxes", "turns", "weights", F.posexplode(chars).alias("pos", "ch")).where("ch <> ''")
    box = at(F.col("boxes"), F.col("pos"))
    return rows.select(
        "doc_id", "page_no", "pos", "ch",
        *[at(box, F.lit(i)).alias(n) for i, n in enumerate("lbrt")],
        at(F.col("turns"), F.col("pos")).alias("turn"), at(F.col("weights"), F.col("pos")).alias("weight"),
    )
