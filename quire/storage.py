"""Tables that a job needs more than once, in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session has none, a temporary one is set on a single machine; on a
    cluster that is an error, as each executor would write to its own disk.
    """
    found = spark.conf.get(SETTING, None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{SETTING} must name a folder that all machines of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set(SETTING, found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/quire/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *, rows: int | None = None, each: int = 250_000) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there,
    so a lost executor costs a reread, not a recomputation.

    ``rows``: how many it has at most, if that is known. Then it goes to files
    of about ``each`` rows, or to two for each core if that is more: small
    tables of many partitions would be a file for each.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-rows // each)))
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote for them; later reads of it would fail."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            spark = df.sparkSession
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
