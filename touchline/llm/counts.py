"""Token counts through a digest cache.

The cache is a Parquet table (content digest, tokenizer digest, token count). Texts are joined to it
by digest, each distinct text it lacks is encoded once, and the new counts are appended to it. The
content is normalised as the tokenizer itself does before it splits a text, so that equal digests
mean equal counts: for byte-level vocabularies without a normaliser that is the text as it stands.

Null text counts as the empty text (0 tokens). Repeated rows and equal texts share one entry; an
entry that two runs have appended at the same time is read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import add_columns, texts_of, unused, vocabulary
from touchline.llm.encoders import encoder_of
from touchline.operators.keys import first_per_key

CACHE_SCHEMA = "content BINARY, tokenizer BINARY, n_tokens BIGINT"


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts; an empty table where there is no cache yet. Any other fault of the folder is raised."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def _encoded(df: DataFrame, tokenizer: str, pattern: str, text: str) -> DataFrame:
    """Add `n_tokens` of each text as the tokenizers library counts them, with its defaults."""
    raw = vocabulary(df.sparkSession, tokenizer)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        encode = encoder_of(raw.value, pattern)

        def compute(column: pa.Array) -> list[pa.Array]:
            return [pa.array([len(encode([one])[0]) for one in texts_of(column)], pa.int64())]

        return compute

    return add_columns(df, text, "n_tokens bigint", make, keep=[name for name in df.columns if name != text])


def count_tokens(
    df: DataFrame, tokenizer: str, pattern: str, cache: str, text: str = "text", n_tokens: str = "n_tokens"
) -> DataFrame:
    """Add `n_tokens`, the number of tokens of each whole text, and store the counts that `cache` lacks.

    `tokenizer` is a tokenizer.json, `pattern` how a byte-level one splits texts. The misses move once, by digest: map tasks send one row per
    distinct text, so a text that fills a third of the table does not meet in one task.
    """
    spark = df.sparkSession
    with open(tokenizer, "rb") as file:
        version = hashlib.sha256(file.read()).digest()
    # A column that already has the new name is replaced.
    df = df.select(*[f"`{name}`" for name in df.columns if name.lower() != n_tokens.lower()])
    content, body, count = unused(df, "_content"), "_body", unused(df, "_count")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.unhex(F.sha2(whole.cast("binary"), 256))

    def stored() -> DataFrame:
        known = read_cache(spark, cache).where(F.col("tokenizer") == F.lit(version))
        return known.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    texts = df.select(digest.alias("_digest"), whole.alias(body))
    known = stored().select("content")
    misses = texts.join(known, texts["_digest"] == known["content"], "left_anti")
    misses = first_per_key(misses, ["_digest"], [F.col("_digest")])
    fresh = _encoded(misses, tokenizer, pattern, body).select(
        F.col("_digest").alias("content"), F.lit(version).alias("tokenizer"), "n_tokens"
    )
    fresh.write.mode("append").parquet(cache)

    counts = stored().select(F.col("content").alias(content), F.col("n_tokens").alias(count))
    joined = df.withColumn(content, digest).join(counts, content, "left")
    return joined.withColumn(n_tokens, F.col(count)).drop(content, count)
