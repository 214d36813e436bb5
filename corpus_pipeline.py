"""From raw documents to packed training sequences: five stages over the whole documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents, with `n_chars` kept in
step with `text`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import langid, linededup, packing, secrets, simhash
from touchline.sources.scratch import materialize

# A document is rejected if its text has no letter, or no language reaches this probability.
LEAST_SCORE = 0.3
SHINGLE, RADIUS = 3, 3
CAPACITY, END_ID = 2048, 1
TOKENIZER = "byte_bpe_50k.json"


def _shape(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs; the length follows the text."""
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return rows.select(*[f"`{name}`" for name in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; what has none goes."""
    model = langid.train(docs.where(~langid.held_out("doc_id")))
    named = langid.predict(docs, model, lang="_lang_pred", score="_lang_score")
    kept = named.where((F.col("_lang_pred") != langid.UNDETERMINED) & (F.col("_lang_score") >= LEAST_SCORE))
    return kept.select(*[f"`{name}`" for name in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are deleted."""
    return _shape(linededup.dedup_lines(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id."""
    return simhash.first_of_each(docs, SHINGLE, RADIUS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked."""
    return _shape(secrets.redact(docs), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of one length."""
    return packing.pack(
        docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, END_ID, CAPACITY
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packed),
]

# Models, fingerprints and tokens cannot be written in SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
