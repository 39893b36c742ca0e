"""Lookup joins that survive one key holding a large share of all rows."""

from pyspark.sql import Column, DataFrame, functions as F

#: Rows of one key in one partition; a key with more is spread over as many partitions as it takes.
TARGET_ROWS = 100_000
BROADCAST_MAX_ROWS = 100_000


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    row_id: Column,
    counts: DataFrame,
    lookup_rows: int | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """``rows`` left-joined to ``lookup``, which holds at most one row per ``key``.

    A lookup counted by the caller and found small is broadcast. Otherwise this is a shuffled join, and every key
    with more than ``target_rows`` rows, by ``counts`` (key, n), is spread over n / ``target_rows`` partitions.
    Such keys are at most one in ``target_rows`` rows, so their list is small enough for every task.
    """
    if lookup_rows is not None and lookup_rows <= BROADCAST_MAX_ROWS:
        return rows.join(F.broadcast(lookup), key, "left")

    hot = counts.filter(F.col("n") > target_rows).select(key, F.ceil(F.col("n") / target_rows).cast("int").alias("_salts"))
    salted = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(row_id), F.col("_salts"))).cast("int"),
        )
        .drop("_salts")
    )
    copies = (
        lookup.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts")
    )
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")
