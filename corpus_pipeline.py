"""From raw documents to token ids: five stages, each one operator over all that its predecessor kept.

All stages read whole texts, however long, give an empty table for an empty one, treat repeated rows one by one
where nothing else is said, and let further columns pass as they are, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import decontamination, language_id, secret_scan, sentencepiece_codec, simhash
from shopgrain.llm.common import columns_of, free_name, learned_from, table, text_or_empty
from shopgrain.llm.queries import MODEL, SIMHASH_WORDS
from shopgrain.operators.checkpoints import materialise, new_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter, or far from every language, go.

    A null or empty text has no letter and goes. A row with a null id counts as one to learn from; a null
    language teaches nothing. Of equally near languages the first by name counts.
    """
    model = language_id.fit(docs, learned_from("doc_id", 3))
    found = free_name(docs, "language")
    marked = language_id.identify(docs, model, to=found)
    return marked.where(~F.col(found)["rejected"]).select(*columns_of(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the least id.

    Null and empty texts have the fingerprint zero and are a group like any other. Rows that share the least id
    of a group are one document; one of them stays.
    """
    return simhash.keep_one(docs, SIMHASH_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark.

    A null or empty text contains none and stays; an item without words is in no document.
    """
    return decontamination.without(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark; n_chars is that of the new text.

    Null texts stay null; of secrets that overlap the whole stretch becomes one mark.
    """
    found = secret_scan.scan_versions(docs, new_path(spark, "ledger"))
    spans = F.col(free_name(docs, "findings"))
    text = F.when(F.size(spans) > 0, secret_scan.redact(F.col("text").cast("string"), spans)).otherwise(F.col("text"))
    out = found.withColumn("text", text).select(*columns_of(docs), spans)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*columns_of(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and whether they decode to its text again.

    A null text counts as empty and has the end id only. Further columns end here.
    """
    model = public_tokenizers.path(MODEL)
    texts = docs.select("doc_id", text_or_empty("text").alias("text"))
    coded = sentencepiece_codec.encode(texts, model, decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("lossless")
    )


STAGES = [
    ("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("secrets", secrets), ("encode", encode),
]

#: Learned languages, hashes over words and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
