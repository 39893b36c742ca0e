"""Vectors by content: a text is encoded once, however many articles and runs hold it.

The store is keyed by a hash of the text and by the encoder's name, so another model never meets these vectors. Of the
texts asked for, those that the store lacks are found by an anti-join on hashes, encoded, and appended; articles then look
their vectors up by hash, and a text that a large share of them has is spread over several tasks.

Contract. Null texts count as empty ones. Two runs that append the same text leave two equal rows; readers take one. The
encoder gets one row per missing text (text_hash, text) and returns text_hash and embedding; a text it leaves out has a null vector.
"""

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pressledger.operators.joins import lookup_join
from pressledger.plans.publish import exists
from pressledger.session import checkpointed

_STORED = "text_hash string, embedding array<double>"


def text_hash(text):
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def stored_vectors(spark: SparkSession, folder: str, encoder: str) -> DataFrame:
    """text_hash, embedding of one encoder, one row per text."""
    if not re.fullmatch(r"[\w.-]+", encoder):
        raise ValueError("an encoder's name has letters, digits, dots and dashes only")
    path = f"{folder}/encoder={encoder}"
    if not exists(spark, path):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(f"{path}/batch=*").dropDuplicates(["text_hash"])


def cached_vectors(
    spark: SparkSession, folder: str, articles: DataFrame, encode: Callable[[DataFrame], DataFrame], encoder: str, key: str = "article_id", text: str = "text"
) -> tuple[DataFrame, int]:
    """(key, embedding) for every article, and how many texts had to be encoded."""
    hashed = articles.select(key, text_hash(F.col(text)).alias("text_hash"), F.coalesce(text, F.lit("")).alias("text"))
    missing = hashed.select("text_hash", "text").join(stored_vectors(spark, folder, encoder).select("text_hash"), "text_hash", "left_anti")
    missing = missing.dropDuplicates(["text_hash"])
    seen = Observation()
    new = encode(missing.observe(seen, F.count(F.lit(1)).alias("n"))).select("text_hash", F.col("embedding").cast("array<double>").alias("embedding"))
    new.write.parquet(f"{folder}/encoder={encoder}/batch={uuid.uuid4().hex}")
    names = checkpointed(hashed.select(key, "text_hash"))
    counts = names.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"))
    found = lookup_join(names, stored_vectors(spark, folder, encoder), "text_hash", F.col(key), counts)
    return found.select(key, "embedding"), seen.get["n"]
