"""Registered queries of the training-data operators: ``QUERIES[name](spark, sf_dir)`` and DuckDB SQL.

Each query applies its operator with production parameters to the whole table and derives
the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksignal.llm import (
    byte_bpe,
    conversations,
    line_dedup,
    packing,
    pieces,
    quality,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
    topk,
    whitening,
)
from sparksignal.llm.chunks import write_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, u.line AS line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents) u),
hot AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.*, h.keeper IS NOT NULL AND h.keeper <> l.doc_id AS gone FROM lines l LEFT JOIN hot h ON l.k = h.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op3_line_dedup", LINE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_secret_scans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    names = F.transform("found", lambda x: x["kind"])
    kinds = [(F.size("found") - F.size(F.array_remove(names, k))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    text = secrets.joined(F.col("found"))
    return out.select("row.doc_id", *kinds, F.sha2(text.cast("binary"), 256).alias("base_sha256"), text.alias("spans"))


@query("op8_external_shuffle")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffled_shards(documents(spark, sf_dir).select("doc_id", "text"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return out.select("row.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    stats = write_table(quality.statistics(docs).drop("text"), "statistics")
    rules = quality.learn(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.assess(stats, rules).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                               "n_repeat_words", "base_failed", "kept", "rule")


@query("op7_exact_top_k")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.token_counts(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("row.doc_id", "n_words", "n_tokens", "n_unknown")


@query("op10_sentence_pieces")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode(documents(spark, sf_dir).select("doc_id", "text"), model)
    out = pieces.decode(coded.select("row.doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), "ids"), model)
    return out.select("row.doc_id", "row.n_pieces", "row.ids_crc32",
                      F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    out = byte_bpe.decode(coded.select("row.doc_id", "n_tokens", F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), "ids"), ranks)
    return out.select("row.doc_id", "row.n_tokens", "row.ids_sha256", F.sha2("data", 256).alias("decoded_sha256"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    out = whitening.whiten(vectors, model).select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(x)) for x in model.explained]) if model and len(model.explained) else F.array().cast("array<double>")
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
                      "whitened", F.get(shares, F.col("at")).alias("explained"),
                      F.lit(model.identity_error if model else 0.0).alias("identity_error"))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    damaged = conversations.damage(rows)
    done = conversations.repair(damaged)[0].withColumnRenamed("conv", "conv_id")
    left = damaged.select("conv_id", F.lit(True).alias("left")).unionByName(rows.select("conv_id", F.lit(False).alias("left")))
    gone = left.groupBy("conv_id").agg(F.max("left").alias("left")).where(~F.col("left"))
    nothing = gone.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in conversations.COUNTS], F.lit("").alias("audit"),
                          F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    return done.unionByName(nothing)
