"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop_stored, new_path, shared_dir, stored  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text"):
    """The text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def arrow_batches(spark: SparkSession, rows: int = 400, megabytes: int = 16) -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes:
    texts can be long, and two workers share an executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")
