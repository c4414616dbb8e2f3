"""Intermediate tables in the folder that all executors share: a plan that starts from one is short, and a lost executor
costs no more than reading the file again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a temporary folder if all runs in this process, else an error."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
    known = spark.conf.get("spark.tidemark.tables", None)
    if not known:
        known = "file://" + tempfile.mkdtemp(prefix="tidemark-tables-")
        spark.conf.set("spark.tidemark.tables", known)
    return known


def settle(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
