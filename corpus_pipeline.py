"""The corpus pipeline: five stages, each on all that the one before kept of ``documents``.

Quality rules reject documents, line dedup drops shared lines, SimHash near-dedup keeps one document
of each group, secret scans mask what they find, and packing turns the documents left into
token sequences.  Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``documents``, with ``n_chars`` following the text.

Cases, in every stage: a null text counts as an empty one (line dedup and packing give an empty text for it, the other stages
leave it null); an empty text has no words, so quality rules reject it; of repeated rows and of ties near-dedup keeps the smallest
id, then the first row; a null id is an id; very long texts are processed whole; an empty table gives an empty one (and no rules
are learned); other columns, of any name, come back as they were.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksignal.llm import chunks, line_dedup, packing, quality, secrets, simhash

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _columns(out: DataFrame, docs: DataFrame, text) -> DataFrame:
    """The documents' columns from ``row`` and the new text."""
    cols = [text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    out = out.select(*cols)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule (under 50 words, or too many repeated) or a learned rule go; texts stay as they are."""
    stats = chunks.write_table(quality.statistics(docs), "statistics")
    rules = quality.learn(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(quality.assess(stats, rules).where("kept"), docs, F.col("text"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the largest id only; a document of such lines alone keeps its row, with an empty text."""
    return _columns(line_dedup.dedup_lines(docs), docs, F.col("text"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest id, nulls last.  Documents without words are one group."""
    return simhash.one_of_each(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; overlapping ones share a mask, a document without any is untouched."""
    return _columns(secrets.scan(docs), docs, secrets.masked(F.col("text"), F.col("found")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces with their sequence and place; a document without text is one piece, its end id."""
    return packing.packed(docs, TOKENIZER)


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("simhash near-dedup", near_dedup_stage),
          ("secret scans", secret_stage), ("best-fit packing", packing_stage)]
ORACLE_SQL = None  # learned rules, XXH64, tokens and packing have no SQL form; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again, so a lost executor repeats one stage at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = chunks.write_table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
