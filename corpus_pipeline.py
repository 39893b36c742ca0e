"""A training-data pipeline over ``documents``: toxicity, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of the documents
they got. ``run`` writes every stage as Parquet in the shared folder named by spark.checkpoint.dir and reads it again, so a
lost executor costs a re-read. Rows are decided on one by one: a stage never joins texts to decisions where it can
compute both in one pass.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from pressledger.llm import mixing, neardup, packing, secrets, toxicity
from pressledger.llm.pretokens import vocabulary
from pressledger.session import shared_folder

#: Most rows of an Arrow batch. A batch of whole texts is held by the JVM and by a worker, each on the way there and back.
BATCH_ROWS = 1_000

#: No stage's decisions can be written in SQL (learned scores, curve order), so run() is tested against brute force.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the stages to come; a smaller bound that the session has stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold. The model learns from them and from ``labels``."""
    _small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (similarity 0.8 or more of 5-word shingles): the one with the smallest id."""
    _small_batches(spark)
    return neardup.drop_near_duplicates(docs, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by its kind in brackets; n_chars follows where it is given."""
    _small_batches(spark)
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1,024 tokens, with their ids."""
    _small_batches(spark)
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage for the documents of ``sf_dir``."""
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
