"""Company identity: distinct raw names resolved by prioritised equi-joins."""

import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pressledger.functions.keys import company_id
from pressledger.functions.text import strip
from pressledger.operators.fuzzy import fuzzy_suggest

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.StringType())
def _compatibility_fold(names: pd.Series) -> pd.Series:
    return names.map(lambda s: unicodedata.normalize("NFKC", s).casefold(), na_action="ignore")


def normalize_name(c: Column) -> Column:
    """Join key of a company name: folded, with every run of other characters one space.

    Spark has no compatibility fold, so non-ASCII names (only those) visit a pandas UDF.
    """
    ascii_only = c.rlike(r"^[\x00-\x7f]*\z")
    folded = F.when(ascii_only, F.lower(c)).otherwise(_compatibility_fold(F.when(~ascii_only, c)))
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def distinct_names(articles: DataFrame) -> DataFrame:
    """One row per raw spelling with its row count and first and last source position."""
    return articles.groupBy("company_name_raw").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("source_row_number").alias("first_row"),
        F.max("source_row_number").alias("last_row"),
    )


def _names_by_norm(master: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per normal form: the master name that has it, and the alias target if one is in master."""
    known = master.select("company_name", "master_order", normalize_name(F.col("company_name")).alias("name_norm"))
    direct = known.groupBy("name_norm").agg(F.max_by("company_name", "master_order").alias("_direct"))
    targets = (
        aliases.select(normalize_name(F.col("alias")).alias("name_norm"), "canonical", "alias_order")
        .groupBy("name_norm")
        .agg(F.max_by("canonical", "alias_order").alias("_alias_of"))
        .join(
            known.select(F.col("company_name").alias("_alias_of"), F.col("name_norm").alias("_alias_norm")),
            "_alias_of",
        )
    )
    return direct.join(targets, "name_norm", "full")


def resolve_companies(
    names: DataFrame, master: DataFrame, aliases: DataFrame, ambiguous: DataFrame
) -> DataFrame:
    """Resolve ``names`` (``company_name_raw``, any other columns kept).

    ``master`` has company_name and master_order, ``aliases`` alias, canonical and alias_order,
    ``ambiguous`` company_name. Order of priority: exact, normalised, alias, none. The confidence
    of unresolved names stays NULL here; ``with_fuzzy_confidence`` fills it.
    """
    exact = master.select(F.col("company_name").alias("company_name_clean"), F.lit(True).alias("_exact"))
    known_ambiguous = ambiguous.select(
        F.col("company_name").alias("company_name_clean"), F.lit(True).alias("_ambiguous")
    ).distinct()
    joined = (
        names.withColumn("company_name_clean", strip(F.coalesce(F.col("company_name_raw"), F.lit(""))))
        .withColumn("name_norm", normalize_name(F.col("company_name_clean")))
        .join(exact, "company_name_clean", "left")
        .join(_names_by_norm(master, aliases), "name_norm", "left")
        .join(known_ambiguous, "company_name_clean", "left")
    )
    method = (
        F.when(F.col("_exact"), "EXACT")
        .when(F.col("_direct").isNotNull(), "NORMALIZED")
        .when(F.col("_alias_of").isNotNull(), "ALIAS")
        .when(F.col("_ambiguous"), "AMBIGUOUS_SOURCE")
        .otherwise("UNRESOLVED")
    )
    how = F.col("company_match_method")
    matched = how.isin("EXACT", "NORMALIZED", "ALIAS")
    return (
        joined.withColumn("company_match_method", method)
        .withColumns({
            "company_name_canonical": F.when(how == "EXACT", F.col("company_name_clean"))
            .when(how == "NORMALIZED", F.col("_direct"))
            .when(how == "ALIAS", F.col("_alias_of")),
            "company_id": company_id(F.when(how == "ALIAS", F.col("_alias_norm")).otherwise(F.col("name_norm"))),
            "company_match_status": F.when(matched, "MATCHED")
            .when(how == "AMBIGUOUS_SOURCE", "AMBIGUOUS")
            .otherwise("UNRESOLVED"),
            "company_match_confidence": F.when(how == "EXACT", F.lit(1.0))
            .when(how == "NORMALIZED", F.lit(0.99))
            .when(how == "ALIAS", F.lit(0.98)),
            "has_company_metadata": matched,
        })
        .withColumn("company_entity_name", F.coalesce("company_name_canonical", "company_name_clean"))
        .select(
            *names.columns, "company_name_clean", "name_norm", "company_id", "company_name_canonical",
            "company_entity_name", "company_match_status", "company_match_method",
            "company_match_confidence", "has_company_metadata",
        )
    )


def master_points(master: DataFrame) -> DataFrame:
    """Distinct normal forms of master names; the first name in master order stands for each."""
    return (
        master.select("company_name", "master_order", normalize_name(F.col("company_name")).alias("name_norm"))
        .groupBy("name_norm")
        .agg(F.min_by("company_name", "master_order").alias("company_name"), F.min("master_order").alias("master_order"))
    )


def with_fuzzy_confidence(resolved: DataFrame, master: DataFrame) -> DataFrame:
    """Fill the confidence of unresolved names with their best similarity to any master name.

    The suggestion itself is never used as an identity.
    """
    unresolved = resolved.filter(~F.col("has_company_metadata")).select("name_norm").distinct()
    scores = fuzzy_suggest(unresolved, master_points(master)).select("name_norm", "score")
    return (
        resolved.join(scores, "name_norm", "left")
        .withColumn(
            "company_match_confidence",
            F.coalesce("company_match_confidence", "score", F.lit(0.0)),
        )
        .select(*resolved.columns)
    )
