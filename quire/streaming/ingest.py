"""Continuous conversion: transcripts that arrive as files become documents.

An extension of the batch engine: the file source finds new transcripts, each
micro-batch is parsed like a batch, and the checkpoint makes a restart neither
skip nor repeat one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.document import parse_documents
from ..sources.transcripts import document_id, pages_of


def ingest(spark: SparkSession, incoming: str, documents: str, checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Start converting: documents are appended to the Parquet table at
    ``documents``. With ``once``, what is there is converted, then it stops. A
    batch that runs twice overwrites its own partition."""
    files = spark.readStream.format("text").option("wholetext", "true").load(incoming)
    files = files.select(document_id(spark, incoming).alias("doc_id"), "value")

    def write(batch: DataFrame, number: int) -> None:
        parse_documents(pages_of(batch)).write.mode("overwrite").parquet(f"{documents}/batch={number}")

    writer = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()
