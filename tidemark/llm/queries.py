"""The operators on their whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, leaks, lexical, licenses, lines, minhash, oracles, personal, pieces, prefixes, quality, secret_scan, setjoin, simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op3_chat_formatting", r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|><|text|><|end|>')
    + length(replace(replace(role, '\', '\\'), '<|', '\<|'))
    + length(replace(replace(text, '\', '\\'), '<|', '\<|'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.conversation_digests(chat.format_chat(turns))


@query("op10_document_fingerprints")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.compare_with_next(table(spark, folder, "documents"))


@query("op4_secret_scan", oracles.SECRETS)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find_secrets(table(spark, folder, "documents")))


@query("op7_personal_data")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return personal.digests(personal.find_personal_data(table(spark, folder, "documents")))


@query("op6_license_scan", oracles.LICENSES)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality.classify(docs.select("doc_id", "text"), table(spark, folder, "labels"))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op1_sentencepiece")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode_pieces(docs, check=True).select(
        "doc_id", "piece_ids", F.size("piece_ids").cast("bigint").alias("n_pieces"), "lossless")


@query("op2_line_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed_blocks", F.lit(0).cast("bigint"), lambda a, r: a + r["last"] - r["first"] + 1)
    return done.select("doc_id", "n_lines", gone.alias("n_removed"), F.array_join(F.transform(
        "removed_blocks", lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string"))), ",").alias("removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


@query("op5_ngram_jaccard_join", oracles.JACCARD)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return setjoin.similar_components(table(spark, folder, "documents"))


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op11_prefix_trie", oracles.TRIE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.conversation_trie(table(spark, folder, "conversations"))


@query("op12_lexical_search", oracles.SEARCH)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
