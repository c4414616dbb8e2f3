"""The thin queries over the driver's tables: each derives its columns from an operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import lit

from .common import of_kind, settle
from . import bpe, chat, decontaminate, divergence, fingerprint, html_text, langid, merkle, near_dedup, pii, quality_rules, secrets_scan, sharding, statements

#: Key of the pseudonyms in the registered query; a deployment passes its own.
DEMO_KEY = "demonstration key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs)
    found = langid.identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", F.coalesce(langid.remainder(F.col("doc_id")) == 1, lit(False)).alias("held_out"), "lang_pred", "score")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 16)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows become records of two layouts (lists of messages; conversation -1 a prompt and
    response), which the operator maps to turns and formats; all columns are read back from its output."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", lit("")).alias("role"), F.coalesce("text", lit("")).alias("text"))
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    kind = "struct<messages: array<struct<role: string, content: string>>, prompt: string, response: string>"
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    records = listed.select("conv_id", F.struct(messages.alias("messages"), lit(None).cast("string").alias("prompt"), lit(None).cast("string").alias("response")).cast(kind).alias("record"))
    odd = "</s>[INST] ok [/INST]"
    none = F.expr("cast(null as array<struct<role: string, content: string>>)")
    extra = spark.range(1).select(lit(-1).cast("long").alias("conv_id"), F.struct(none.alias("messages"), lit(odd).alias("prompt"), lit(odd).alias("response")).cast(kind).alias("record"))
    made = chat.format_chat(chat.canonical_turns(records.union(extra), "conv_id"))
    read = made.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.masked(F.col("formatted"), F.col("loss")).alias("masked"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], lit("\n"), t["text"], lit("\n"))), ""), 256)
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose doc_id is divisible by 50 are searched among the fingerprints of all rows by the block tables."""
    rows, _ = settle(fingerprint.beside_next(table(spark, sf_dir, "documents")), "beside-next")
    return fingerprint.with_close(rows, F.col("doc_id") % 50 == 0)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), DEMO_KEY)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.find_secrets(table(spark, sf_dir, "documents"))

    def joined(spans) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides the crc32 of the doc_id, the fold starts from a row whose n_chars is one more."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = merkle.leaf(*[F.col(f) + 1 if f == "n_chars" else F.col(f) for f in fields])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, changed)
    made = merkle.manifest(docs, fields, "lang", "doc_id", {"doc_id": F.col("doc_id").cast("long"), "tampered": tampered})
    made = made.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("before"), F.col("after")))
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("before"), F.col("after")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules.cascade(table(spark, sf_dir, "documents").select("doc_id", "text"), report=counts)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "quality.*").select("doc_id", *counts, base_failed.alias("base_failed"), "kept")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_language_id, op3_html_extraction, op4_sharding, op5_chat_formatting, op6_benchmark_decontamination,
        op7_document_fingerprints, op8_pii, op9_secret_scans, op10_byte_bpe, op11_merkle_manifest, op12_quality_rules, op13_source_divergence, pipeline,
    )
}

#: DuckDB's statement of what SQL can express. Turns, digests and lengths of op5 follow from the table and the
#: template alone; the other operators need hashes, models, alignments or vocabularies that it lacks.
ORACLE: dict[str, str] = {
    "op4_sharding": statements.SHARDING,
    "op5_chat_formatting": r"""WITH rows_ AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
named AS (SELECT conv_id, turn, CASE WHEN role = 'human' THEN 'user' WHEN role IN ('gpt', 'bot', 'model') THEN 'assistant' ELSE role END AS role, role AS first, text FROM rows_),
sized AS (SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<', '<\'), '[', '[\')) AS role_chars, length(replace(replace(text, '<', '<\'), '[', '[\')) AS text_chars FROM named)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, first, text)) AS turns_sha256,
  CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn, first, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(SUM(length('<|turn|>') + role_chars + 1 + text_chars + length('<|end|>') + 1) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op11_merkle_manifest": statements.MANIFEST,
    "op12_quality_rules": statements.QUALITY,
    "op13_source_divergence": statements.DIVERGENCE,
}
