"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order; each result is written and read again, so a
stage starts from stored rows and a lost executor costs one stage at most.  All
stages but the last return the columns of ``documents``; ``n_chars`` follows the
text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.golay_dedup import keep_one
from tidemark.llm.language_id import identify_language, train_language_model
from tidemark.llm.line_dedup import drop_shared_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.sampling import held_out
from tidemark.session import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, the character count taken anew."""
    out = changed.select(*(f"`{c}`" for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language is not recognised; null texts go too."""
    labelled = docs.where(~held_out("doc_id")).select("doc_id", "text", "lang")
    found = identify_language(docs, train_language_model(labelled), prefix="__lid_")
    return found.where(~F.col("__lid_rejected")).select(*(f"`{c}`" for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that at least 10 documents share."""
    return _as_documents(drop_shared_lines(docs, counted=("__lines", "__dropped")), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: 4-word shingles, at most 4 bits."""
    return keep_one(docs, words=4, bits=4)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove every byte covered by a 200-byte string that also starts elsewhere."""
    added = ("__bytes", "__removed", "__spans_gone", "__sha")
    return _as_documents(remove_repeats(docs, length=200, added=added), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 4096 tokens."""
    return pack_documents(docs.select("doc_id", "text"), TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

# Trained models, XXH64 fingerprints and tokenisation have no SQL form; tests/llm compares
# the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
