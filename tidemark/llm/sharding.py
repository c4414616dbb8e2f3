"""Balanced contiguous shards by global byte-size prefix sums. DataFrame functions only.

Rows are ordered by the MD5 of their text, that of their doc_id, and doc_id itself, so equal texts lie together. Bytes and
rows are counted for each text and salt, their prefix sums taken inside each of 16 ** RANGE_DIGITS ranges of
the hash, and those of the ranges over one small table. The sums alone decide: a text lies in the shard in which the middle
of all its copies falls, so each cut at an equal target goes to the nearest edge of a text, and a shard is off its target by
no more than the bytes of the largest text's copies. Only a text whose copies exceed a whole shard is cut, between rows. Rows of
one text are numbered within salts of their doc_id whose counts are summed the same way, so a text that fills
a third of the table is numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from .common import settle

#: Leading hexadecimal digits of the hash that name a range: 16 ** RANGE_DIGITS rows at most are summed by one task, whatever the input.
RANGE_DIGITS = 3
#: Salts of rows without an id, after the 256 of ids.
NULL_SALTS = 64


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1; null counts as none), text_crc32, key (MD5 of the text), id_key (of the
    decimal doc_id), salt (its first two digits as a number; any of NULL_SALTS further ones without an id)."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), lit("")), "utf-8")
    rows = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("key"))
    rows = rows.withColumn("id_key", F.md5(F.col("doc_id").cast("string")))
    any_null = lit(256) + F.monotonically_increasing_id() % NULL_SALTS
    return rows.withColumn("salt", F.coalesce(F.conv(F.substring("id_key", 1, 2), 16, 10).cast("int"), any_null.cast("int")))


def shards(docs: DataFrame, count: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard (0 to count - 1), slot (gapless from 0 in each
    shard), grown_shard (null: this law keeps no row in place when shards are added). One row per row of docs,
    repeated rows and null ids (last among the rows of a text) included; an empty table gives none. Rows of one text share a shard
    unless they are more than a whole one. Columns of docs other than doc_id and text aren't read. Twice the bytes times
    count must stay below 2 ** 63."""
    rows, _ = settle(sized(docs), "sizes")
    parts = rows.groupBy("key", "salt").agg(F.count("*").alias("n"), F.first("size").alias("size"))
    texts = parts.groupBy("key").agg(F.sum("n").alias("n"), F.first("size").alias("size"))
    texts = texts.select("key", "n", (F.col("n") * F.col("size")).alias("bytes"), F.substring("key", 1, RANGE_DIGITS).alias("range"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # 16 ** RANGE_DIGITS rows at most
    totals = texts.groupBy("range").agg(F.sum("bytes").alias("b"), F.sum("n").alias("r"))
    begun = totals.select(
        "range", F.coalesce(F.sum("b").over(before), lit(0)).alias("range_bytes"), F.coalesce(F.sum("r").over(before), lit(0)).alias("range_rows"),
        F.sum("b").over(before.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("total"),
    )
    inside = W.partitionBy("range").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    begins = texts.join(F.broadcast(begun), "range").select(
        "key", "bytes", "total",
        (F.col("range_bytes") + F.coalesce(F.sum("bytes").over(inside), lit(0))).alias("text_bytes"),
        (F.col("range_rows") + F.coalesce(F.sum("n").over(inside), lit(0))).alias("text_row"),
    )
    by_salt = W.partitionBy("key").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)  # 256 + NULL_SALTS rows at most
    offsets = parts.select("key", "salt", F.coalesce(F.sum("n").over(by_salt), lit(0)).alias("part_rows")).join(begins, "key")
    numbered = rows.withColumn("nth", F.row_number().over(W.partitionBy("key", "salt").orderBy("id_key", "doc_id")) - 1)
    index = F.col("part_rows") + F.col("nth")
    # twice the middle of what must stay together: all copies of a text, or one row of a text larger than a shard
    whole = F.col("bytes") * count <= F.col("total")
    twice = 2 * F.col("text_bytes") + F.when(whole, F.col("bytes")).otherwise((2 * index + 1) * F.col("size"))
    placed = numbered.join(offsets, ["key", "salt"]).select("doc_id", "size", "text_crc32", (twice * count).alias("twice"), (2 * F.col("total")).alias("double_total"), (F.col("text_row") + index).alias("row"))
    out, _ = settle(placed.select("doc_id", "size", "text_crc32", F.expr("int(twice div double_total)").alias("shard"), "row"), "shards")
    starts = out.groupBy("shard").agg(F.min("row").alias("first_row"))  # count rows
    return out.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first_row")).alias("slot"), lit(None).cast("int").alias("grown_shard"))
