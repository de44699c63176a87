"""Cleaning of a document table for training, stage by stage.

Every stage takes ``documents`` (doc_id, text, lang, source, n_chars; more columns may be
there) as the stage before has written it, and works on all of it.  Null texts go
with the first stage; rows with a null ``doc_id`` pass the stages that compare
documents; rows that repeat a ``doc_id`` are treated as one document there.  Benchmark
items are looked for in every text, also under null and repeated ids.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import byte_bpe, decontaminate, language_id, line_dedup, ngram_join
from ledgermill.llm.storage import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a learned language is found; there is none without letters or below the fitted score."""
    model = language_id.learn(docs)
    least = language_id.threshold(docs, model)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")  # kept from names that are added
    judged = language_id.predict(docs.select(others, "text"), model)
    found = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least))
    return found.select(*["text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match earlier ones; a document that loses all its words goes."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")  # kept from names that are added
    rows = line_dedup.dedup(docs.select(others, "doc_id", "text")).where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))

    def column(name: str) -> Column:
        if name == "n_chars":
            return F.length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col("text") if name == "text" else F.col("row")[name].alias(name)

    return rows.select(*[column(c) for c in docs.columns])


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return ngram_join.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, each text judged by itself, whatever its ``doc_id``."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = docs.select(F.md5("text").alias("doc_id"), "text")
    found = stored(decontaminate.contaminated(texts, benchmark).select(F.col("doc_id").alias("text_md5")).distinct(), "contaminated")
    return docs.join(found, F.md5(docs["text"]) == found["text_md5"], "left_anti").select(*[f"`{c}`" for c in docs.columns])


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, as little-endian unsigned 32-bit integers."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids"
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_join", join_ngrams),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode_bpe),
]

#: Most stages are no SQL expressions; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
