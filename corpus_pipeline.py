"""A training corpus from raw documents: five stages, each over all that the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, langid, secrets_scan, set_join
from tidemark.llm.common import settle
from tidemark.llm.queries import table, vocabulary

#: Mean probability below which a document has no sure language.
LANGUAGE_SCORE = 0.4
#: Words of a shingle. Near copies have a Jaccard index of their shingle sets of 0.8 or more.
SHINGLE = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or of no sure language go."""
    net = langid.fit(docs)
    return langid.identify(docs, net, reject=LANGUAGE_SCORE).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that of the least id (rows without one come last), and of the texts of that id
    within the group the one of the least hash. Rows are judged one by one: an id whose texts are in
    different groups can stay more than once. Of rows of the same id and text the least stays. Only rows that a bitmap takes for ones
    that go, or are listed more than once, are moved."""
    key = ["k", "text_hash"]
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    found = set_join.similar_groups(docs, SHINGLE).select(order.alias("k"), "text_hash", "root")
    rows = found.groupBy("root", *key).agg(F.count("*").alias("copies"))
    stays = rows.groupBy("root").agg(F.min(F.struct(*key)).alias("row"))
    judged = rows.join(stays, "root").select(*key, "copies", (F.struct(*key) == F.col("row")).alias("stays")).where("not stays or copies > 1")
    judged, _ = settle(judged.withColumn("at", F.xxhash64(*key)), "judged")
    named = docs.select(order.alias("k"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.struct(*docs.columns).alias("row"))
    bits, _ = settle(set_join.bitmap(judged.select("at")), "bitmap")
    named = set_join.maybe_in(named.withColumn("at", F.xxhash64(*key)), "at", bits)
    seen = named.where("maybe").join(judged.select(*key, "stays"), key, "left").where("stays is null or stays")
    once = seen.where("stays").groupBy(*key).agg(F.min("row").alias("row"))
    return named.where("not maybe").select("row.*").union(seen.where("stays is null").select("row.*")).union(once.select("row.*"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced, and n_chars follows the text."""
    return secrets_scan.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes."""
    return bpe.round_trip(docs, vocabulary())


STAGES = [("language", language), ("near_dedup", near_dedup_stage), ("decontaminate", decontaminate_stage), ("secrets", secrets_stage), ("encode", encode_stage)]

#: A trained network and alignments aren't expressible in SQL: the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
