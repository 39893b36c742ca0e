"""Article files cleaned as they arrive.

Cleaning is made of row-wise expressions, so the batch functions run on a stream unchanged: no
state, no watermark. Identity, neighbours and publishing need the whole set and stay with the run.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressledger.functions.keys import record_hash
from pressledger.plans.model import clean_articles
from pressledger.schemas import ARTICLE_COLUMNS, ARTICLES_RAW, RAW_RENAMES


def stream_csv(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Raw articles of new files in a folder; all text. A file with another header or a row that doesn't fit ends the stream."""
    raw = (
        spark.readStream.schema(ARTICLES_RAW)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(folder)
    )
    return raw.select("*", F.col("_metadata.file_name").alias("source_file")).fillna("", subset=ARTICLE_COLUMNS)


def cleaned_stream(raw: DataFrame) -> DataFrame:
    hashed = raw.withColumn("source_record_hash", record_hash(*[F.col(c) for c in ARTICLE_COLUMNS]))
    return clean_articles(hashed.withColumnsRenamed(RAW_RENAMES))


def append_cleaned(raw: DataFrame, output: str, checkpoint: str):
    """Append cleaned articles as Parquet for what has arrived; restarts continue where they stopped."""
    return (
        cleaned_stream(raw).writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
