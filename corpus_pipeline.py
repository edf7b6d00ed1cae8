"""A training corpus from ``documents``, in five stages.

Each stage works on all that its predecessor kept, written as Parquet to the
shared folder and read again.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import bpe, mixing, neardup, quality_cnn, secrets
from quire.llm.common import drop_stored, stored, table

STAGES = [
    ("quality_classifier", quality_cnn.stage),
    ("minhash_near_dedup", neardup.stage),
    ("secret_scan", secrets.stage),
    ("source_mixing", mixing.stage),
    ("byte_bpe", bpe.stage),
]

#: The trained classifier and the signatures have no SQL; the pipeline is
#: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the corpus: all stages over ``documents``.

    Null, empty and very long texts, repeated rows and empty tables go through
    as each stage's docstring says; columns that ``documents`` has beyond its
    own pass the stages unchanged. What a stage wrote is deleted when the next
    one has read it, but for the last.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        drop_stored(before)
    return STAGES[-1][1](spark, docs, sf_dir)
