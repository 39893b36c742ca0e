"""Exact deduplication by skew-safe combining: local, then salted groups, then the winners of all salts.

Every stage groups by digest and by the whole text, so two texts that share a digest never merge:

1. a task combines its own copies of a text before anything is shuffled (the map side of the first aggregation);
2. what tasks have left meets by digest, salt and text. Salts are given only to hot digests, those of more than ``1 / HOT``
   of all rows, and follow the task, so that a task sends one row per text however many copies it read;
3. the winners of a hot text's salts, one row each, are combined into the one that stays.

Texts are shuffled once. There are fewer than ``HOT`` hot digests by their definition, so their groups are sent to every task and
the rows of a hot text find theirs without a shuffle; all others join by digest, at most ``1 / HOT`` of the rows
per key. Should texts of different content share a digest, their rows join by content.

Contract. ``exact_groups`` returns ``doc_id, keep_id, group_size, kept, text_sha256`` per input row; the largest id of equal texts
stays, and a null text is an empty one. ``normalise`` may change texts before they are compared; the hash is that of what is compared.
A null id never wins against another; in a group without ids, ``keep_id`` is null and every row counts as kept. Rows that repeat the
winning id are kept each. ``drop_copies`` returns exactly one whole row per group, with all columns of the input. Only ``doc_id`` and
``text`` are read otherwise. An empty table gives an empty one.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pressledger.llm.common import checkpointed

#: A digest of more than one in so many rows is hot.
HOT = 4096
#: Salts of a hot digest; its winners are combined last.
SALTS = 256


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rows(docs: DataFrame, normalise: Callable[[Column], Column] | None, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    text = text if normalise is None else F.coalesce(normalise(text), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", digest(F.col("text")).alias("digest"))


def hot_digests(names: DataFrame, one_in: int) -> DataFrame:
    """Digests of more than ``1 / one_in`` of all rows: fewer than ``one_in`` rows, for every task."""
    rows = names.count()
    counted = names.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") * one_in > rows)
    return F.broadcast(checkpointed(counted.select("digest")))


def combined(rows: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of equal texts as digest, keep_id, group_size: those of hot digests, and all others."""
    salted = rows.withColumn("task", F.pmod(F.spark_partition_id(), F.lit(SALTS))).join(hot.withColumn("hot", F.lit(True)), "digest", "left")
    salted = salted.withColumn("salt", F.when(F.col("hot"), F.col("task")).otherwise(-1))
    own = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    met = salted.groupBy("digest", "salt", "text").agg(*own)
    # The text goes on only where winners of several salts have to be compared.
    met = checkpointed(met.select("digest", "salt", F.when(F.col("salt") >= 0, F.col("text")).alias("text"), "keep_id", "group_size"))
    winners = met.where(F.col("salt") >= 0).groupBy("digest", "text")
    winners = winners.agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return checkpointed(winners.drop("text")), met.where(F.col("salt") < 0).select("digest", "keep_id", "group_size")


def exact_groups(
    docs: DataFrame, normalise: Callable[[Column], Column] | None = None, digest: Callable[[Column], Column] = sha256_of, one_in: int = HOT
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every input row; see the module's contract."""
    rows = _rows(docs, normalise, digest)
    names = checkpointed(rows.select("doc_id", "digest", *([] if digest is sha256_of else [sha256_of(F.col("text")).alias("sha")])))
    sha = F.lower(F.hex("digest" if digest is sha256_of else "sha")).alias("text_sha256")
    hot = hot_digests(names, one_in)
    frequent, rest = combined(rows, hot)
    twins = checkpointed(frequent.union(rest).groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("digest"))

    found = ["doc_id", "keep_id", "group_size", "text_sha256"]
    common = names.join(F.broadcast(frequent.join(twins, "digest", "left_anti")), "digest").select("doc_id", "keep_id", "group_size", sha)
    others = names.join(hot, "digest", "left_anti").join(twins, "digest", "left_anti")
    # A text that is there once needs no partner.
    others = others.join(rest.where(F.col("group_size") > 1).withColumnRenamed("keep_id", "most"), "digest", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("most")).alias("keep_id")
    others = others.select("doc_id", keep, F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), sha)
    out = common.select(*found).union(others.select(*found))
    if not twins.isEmpty():
        clashing = checkpointed(rows.join(twins, "digest", "left_semi").select("doc_id", "text"))
        own = clashing.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        met = clashing.join(own, "text").select("doc_id", "keep_id", "group_size", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
        out = out.union(met.select(*found))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row of every group of equal texts, that of the largest id, with all its columns.

    Where rows repeat that id and text, or where no row of a group has an id, the first by a hash of the whole row stays.
    """
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    found = exact_groups(docs, normalise).where("kept").groupBy("text_sha256")
    found = checkpointed(found.agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    text = text if normalise is None else F.coalesce(normalise(text), F.lit(""))
    whole = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.sha2(text.cast("binary"), 256).alias("sha"))
    ids = found.where(F.col("keep_id").isNotNull()).select(F.col("keep_id").alias("id"), F.col("text_sha256").alias("sha"), "n")
    left = whole.join(ids, ["id", "sha"])
    without = whole.where(F.col("id").isNull()).join(found.where(F.col("keep_id").isNull()).select(F.col("text_sha256").alias("sha")), "sha", "left_semi")
    again = left.where(F.col("n") > 1).select("id", "sha", "row").union(without.select("id", "sha", "row"))
    # Rows as JSON order any kind of column, maps too.
    first = again.groupBy("id", "sha").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row"))
    return left.where(F.col("n") == 1).select("row.*").union(first.select("row.*"))
