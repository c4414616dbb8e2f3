"""Helpers that the text operators share: cutting lineage in the cluster's shared folder,
Arrow batches of bounded size, and reading one column of a batch."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of an Arrow batch. Texts can be megabytes long, so rows alone bound nothing.
BATCH_ROWS, BATCH_BYTES = 256, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once (settings of the session; one row may still be larger)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir. Where that is unset, a temporary one if all runs in
    this process (tests); on a cluster that raises, as executors wouldn't see each other's files."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
    known = spark.conf.get("spark.tidemark.dir", None)
    if not known:
        known = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.tidemark.dir", known)
    return known


def settle(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder and read it back: the lineage ends there, and a
    lost executor costs no more than reading the file again. Returns the frame and its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a settled table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def of_kind(kind: str):
    """The test, for F.filter, whether a struct's field `kind` has this value."""
    return lambda x: x["kind"] == kind
