"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit key from its id and text. Words are summed by source and leading key bits;
running sums over those few buckets show in which bucket a source's budget ends, and only the documents
of that bucket are summed again by their next bits. After five steps of twelve bits each budget ends at
one key, so the mix is a filter ``key < threshold``: nothing is sorted, and a larger budget always takes
a superset of what a smaller one takes.

Contract. ``mix_sources`` returns each input row once with ``size``, ``source_size``, ``target`` and
``taken``. A target below its source's size takes whole documents once; a larger one takes all of them
and some of them twice. The document at the threshold is taken if that brings the sum nearer to the
target, so a source misses by half of that document at most. Rows that repeat both id and text share a
key and are taken together. A null source is a source of its own, sorted last; a null or empty text has
size 0 and takes nothing; an empty table gives an empty result. Only ``doc_id``, ``source`` and ``text``
are read, so other columns never clash. All counting happens before any shuffle, per source and bucket,
so a hot source costs no more than another.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressledger.llm.common import WORD, checkpointed

KEY_BITS, STEP_BITS = 60, 12
#: Thresholds of at most so many sources are sent to every task; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(doc_id: Column, text: Column) -> Column:
    """First 60 bits of md5(id ":" md5(text)) as a number."""
    inner = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), inner)
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float, weights: tuple[int, ...], most: float) -> DataFrame:
    """One row per source: its size, and its target by weight, levelled so that none passes ``most`` x its size.

    Reshared excess ends at target = min(most x size, level x weight); the level follows from the sources
    in the order in which they reach their bound.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    filling = Window.orderBy("_bound_at", F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_weight", F.element_at(cycle, ((F.row_number().over(named) - 1) % len(weights) + 1)))
    ranked = ranked.withColumn("_bound_at", most * F.col("source_size") / F.col("_weight"))
    steps = ranked.withColumns({
        "_all": F.sum("source_size").over(Window.partitionBy()),
        "_full": F.coalesce(F.sum(most * F.col("source_size")).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_rest": F.sum("_weight").over(filling.rowsBetween(0, Window.unboundedFollowing)),
        "_place": F.row_number().over(filling),
    }).withColumn("_level", (share * F.col("_all") - F.col("_full")) / F.col("_rest"))
    fits = F.when(F.col("_level") <= F.col("_bound_at"), F.col("_place"))
    levelled = steps.withColumn("_level", F.min_by("_level", fits).over(Window.partitionBy()))
    return levelled.select("source", "source_size", F.least(most * F.col("source_size"), F.col("_level") * F.col("_weight")).alias("target"))


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def budget_thresholds(keyed: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the threshold under which keys are within the budget; keyed: source, size, _key."""
    open_ = budgets.select("source", "_budget", F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_spent"))
    for level in range(KEY_BITS // STEP_BITS):
        shift = KEY_BITS - STEP_BITS * (level + 1)
        bucket = F.shiftright("_key", shift)
        inside = keyed if level == 0 else _same_source(keyed, open_.select("source", "_prefix")).where(
            F.shiftright("_key", shift + STEP_BITS) == F.col("_prefix")
        )
        sums = inside.groupBy("source", bucket.alias("_bucket")).agg(F.sum("size").alias("_size"))
        running = Window.partitionBy("source").orderBy("_bucket")
        sums = _same_source(sums, open_).withColumn("_upto", F.col("_spent") + F.sum("_size").over(running))
        # The first bucket that passes the budget; a source whose words all fit keeps none.
        edge = F.struct("_bucket", "_size", "_upto")
        found = sums.where(F.col("_upto") > F.col("_budget")).groupBy("source", "_budget").agg(F.min(edge).alias("_edge"))
        open_ = checkpointed(found.select(
            "source", "_budget", F.col("_edge._bucket").alias("_prefix"),
            (F.col("_edge._upto") - F.col("_edge._size")).alias("_spent"), F.col("_edge._size").alias("_last"),
        ))
    nearer = (2 * (F.col("_budget") - F.col("_spent")) > F.col("_last")).cast("long")
    return open_.select("source", (F.col("_prefix") + nearer).alias("_threshold"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mix_key(F.col("doc_id"), F.col("text")).alias("_key"))


def mix_plan(keyed: DataFrame, share: float, weights: tuple[int, ...], most: float) -> DataFrame:
    """One row per source: source_size, target, whole copies of each of its documents, and the threshold for one more."""
    targets = checkpointed(source_targets(
        keyed.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights, most
    ))
    budgets = targets.select("source", F.when(
        F.col("target") > F.col("source_size"), F.col("target") - F.col("source_size")
    ).otherwise(F.col("target")).alias("_budget"))
    plan = _same_source(targets, budget_thresholds(keyed, budgets), "left")
    plan = plan.withColumn("_copies", (F.col("target") > F.col("source_size")).cast("long"))
    return F.broadcast(plan) if targets.count() <= BROADCAST_SOURCES else plan


def _times(key: Column) -> Column:
    """How often the mix takes a document."""
    return F.col("_copies") + F.when(F.col("_threshold").isNull() | (key < F.col("_threshold")), 1).otherwise(0)


def mix_sources(
    docs: DataFrame, share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1), most: float = 2.0
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, one row per input row; see the module's contract."""
    keyed = checkpointed(_keyed(docs))
    return _same_source(keyed, mix_plan(keyed, share, weights, most), "left").select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * _times(F.col("_key"))).cast("long").alias("taken")
    )


def take_mix(docs: DataFrame, share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1), most: float = 2.0) -> DataFrame:
    """Every row as often as the mix takes it, with all its columns."""
    plan = mix_plan(checkpointed(_keyed(docs)), share, weights, most)
    rows = docs.select(F.struct("*").alias("_row"), "source", mix_key(F.col("doc_id"), F.col("text")).alias("_key"))
    taken = _same_source(rows, plan, "left").select("_row", F.explode(F.array_repeat(F.lit(0), _times(F.col("_key")).cast("int"))))
    return taken.select("_row.*")
