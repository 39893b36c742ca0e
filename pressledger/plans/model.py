"""Star schema: one dimension, two facts, one export, two views."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressledger import rules
from pressledger.functions.dates import observation_status, parse_published_date
from pressledger.functions.keys import arr_observation_id, bool_text, company_id, record_hash
from pressledger.functions.money import parse_arr
from pressledger.functions.taxonomy import (
    company_age, company_size, display_name, lenient_long, standardize_category, standardize_industry,
)
from pressledger.operators.joins import lookup_join
from pressledger.operators.matching import normalize_name
from pressledger.schemas import (
    ARTICLE_COLUMNS, DIM_COMPANY_COLUMNS, EXPORT_COLUMNS, FACT_ARR_COLUMNS, FACT_ARTICLE_COLUMNS, RAW_RENAMES,
)

ENRICHMENT = [
    "industry_raw", "industry_standardized", "founded_year", "headquarters", "employee_count",
    "company_size_category", "is_public", "stock_ticker",
]
RESOLUTION = [
    "company_name_canonical", "company_id", "company_match_status", "company_match_method",
    "company_match_confidence", "has_company_metadata",
]


def named_articles(raw: DataFrame) -> DataFrame:
    """Known columns only, with lineage and the names the facts use. A missing company name is a blank one; ``_unnamed`` tells it from a blank one."""
    return (
        raw.select(*ARTICLE_COLUMNS, "source_row_number", "source_file")
        .withColumn("_unnamed", F.col("company_name").isNull())
        .withColumn("company_name", F.coalesce("company_name", F.lit("")))
        .withColumnsRenamed(RAW_RENAMES)
    )


def with_record_hash(named: DataFrame) -> DataFrame:
    """Add the hash of the article as it was read."""
    values = {c: F.col(RAW_RENAMES.get(c, c)) for c in ARTICLE_COLUMNS}
    values["company_name"] = F.when(~F.col("_unnamed"), values["company_name"])
    return named.withColumn("source_record_hash", record_hash(*values.values())).drop("_unnamed")


def prepare_articles(raw: DataFrame) -> DataFrame:
    """Known columns only, with lineage, record hash and the names the facts use. A missing company name is a blank one."""
    return with_record_hash(named_articles(raw))


def clean_articles(prepared: DataFrame) -> DataFrame:
    """Parsed revenue and date, category code and word count. Narrow: no shuffle, no Python."""
    return parse_published_date(parse_arr(prepared)).withColumns({
        "category_standardized": standardize_category(F.col("category_raw")),
        "word_count": lenient_long(F.col("word_count")),
    })


def build_dim_company(
    master: DataFrame,
    resolved: DataFrame,
    run_id: str,
    master_file: str = "company_metadata.json",
    article_file: str = "tech_news.csv",
) -> DataFrame:
    """One row per master company and per unresolved identity.

    ``resolved`` has one row per raw name. The last article that names a master company lends it
    its raw name and method; the first one describes an unresolved company. An id is either in
    master or not, so one full join unites both kinds.
    """
    seen = resolved.groupBy("company_id").agg(
        F.max_by(
            F.struct("company_name_clean", "company_match_method", "company_match_confidence"), "last_row"
        ).alias("_last"),
        F.min_by(
            F.struct(
                "company_entity_name", "company_name_clean", "company_match_status",
                "company_match_method", "company_match_confidence",
            ),
            "first_row",
        ).alias("_first"),
    )
    known = master.select(
        company_id(normalize_name(F.col("company_name"))).alias("company_id"),
        F.struct(
            "company_name", "industry", "founded_year", "headquarters", "employee_count", "is_public", "stock_ticker"
        ).alias("_master"),
    )
    joined = known.join(seen, "company_id", "full")
    has_master = F.col("_master").isNotNull()

    def either(from_master: Column, from_first: Column) -> Column:
        return F.when(has_master, from_master).otherwise(from_first)

    first, last, attrs = F.col("_first"), F.col("_last"), F.col("_master")
    industry = F.when(has_master, standardize_industry(attrs["industry"])).otherwise(rules.UNMAPPED)
    named = joined.select(
        "company_id",
        either(attrs["company_name"], first["company_entity_name"]).alias("company_name"),
        either(F.coalesce(last["company_name_clean"], attrs["company_name"]), first["company_name_clean"]).alias("company_name_raw"),
        either(F.when(last.isNotNull(), "MATCHED").otherwise("METADATA_ONLY"), first["company_match_status"]).alias("company_match_status"),
        either(F.coalesce(last["company_match_method"], F.lit("METADATA_KEY")), first["company_match_method"]).alias("company_match_method"),
        either(F.when(last.isNull(), F.lit(1.0)).otherwise(last["company_match_confidence"]), first["company_match_confidence"]).alias("company_match_confidence"),
        has_master.alias("has_company_metadata"),
        attrs["industry"].alias("industry_raw"),
        industry.alias("industry_standardized"),
        attrs["founded_year"].alias("founded_year"),
        attrs["headquarters"].alias("headquarters"),
        attrs["employee_count"].alias("employee_count"),
        company_size(attrs["employee_count"]).alias("company_size_category"),
        attrs["is_public"].alias("is_public"),
        attrs["stock_ticker"].alias("stock_ticker"),
        F.when(has_master, master_file).otherwise(article_file).alias("source_file"),
        F.lit(run_id).alias("pipeline_run_id"),
    )
    described = record_hash(
        F.col("founded_year").cast("string"), F.col("headquarters"), F.col("employee_count").cast("string"),
        F.col("industry_raw"), F.col("industry_standardized"), bool_text(F.col("is_public")), F.col("stock_ticker"),
    )
    bare = record_hash(F.col("company_name"), F.col("company_match_status"))
    return named.withColumn(
        "record_hash", F.when(F.col("has_company_metadata"), described).otherwise(bare)
    ).select(*DIM_COMPANY_COLUMNS)


def dim_order(dim: DataFrame) -> DataFrame:
    return dim.orderBy("company_name", "company_id")


def name_lookup(resolved: DataFrame, dim: DataFrame) -> DataFrame:
    """Resolution and company attributes per raw name.

    Joining the dimension here, on distinct names, saves a second join of the article rows.
    """
    return resolved.select("company_name_raw", *RESOLUTION).join(dim.select("company_id", *ENRICHMENT), "company_id", "left")


def build_fact_article(
    cleaned: DataFrame, lookup: DataFrame, counts: DataFrame, run_id: str, lookup_rows: int | None = None
) -> DataFrame:
    """Every article with its company; text vectors and neighbours come later."""
    joined = lookup_join(
        cleaned, lookup, "company_name_raw", F.col("article_id"), counts, lookup_rows=lookup_rows
    )
    return with_company(joined, run_id)


def with_company(joined: DataFrame, run_id: str) -> DataFrame:
    """What follows from an article and its company together."""
    return joined.withColumns({
        "company_name": display_name(F.col("company_name_canonical"), F.col("company_name_raw")),
        "company_age": company_age(F.col("founded_year"), F.col("published_year")),
        "pipeline_run_id": F.lit(run_id),
    })


def ordered_fact(fact: DataFrame) -> DataFrame:
    """Published columns in their order (those present)."""
    return fact.select(*[c for c in FACT_ARTICLE_COLUMNS if c in fact.columns])


def build_fact_arr(fact: DataFrame) -> DataFrame:
    """One observation per article with a parsed amount; undated and unresolved ones stay."""
    return (
        fact.filter(F.col("arr_parse_status") == "PARSED")
        .withColumnsRenamed({
            "published_date": "observation_date",
            "published_year": "observation_year",
            "published_quarter": "observation_quarter",
            "published_month": "observation_month",
        })
        .withColumns({
            "arr_observation_id": arr_observation_id(F.col("article_id")),
            "observation_status": observation_status(F.col("observation_date")),
            "parse_method_version": F.lit(rules.ARR_PARSER_VERSION),
        })
        .select(*FACT_ARR_COLUMNS)
    )


def export_enriched(
    fact: DataFrame,
    tag: str = rules.EXPORT_TAG,
    years: tuple[int, int] = rules.EXPORT_YEARS,
    min_usd: int = rules.EXPORT_MIN_USD,
) -> DataFrame:
    """Articles tagged by category or industry, inside the years, strictly above the floor."""
    return (
        fact.filter(
            ((F.col("category_standardized") == tag) | (F.col("industry_standardized") == tag))
            & F.col("published_year").between(*years)
            & (F.col("arr_parse_status") == "PARSED")
            & (F.col("arr_usd") > min_usd)
        )
        .withColumnsRenamed({"category_standardized": "category", "industry_raw": "industry"})
        .select(*[c for c in EXPORT_COLUMNS if c != "embedding" or "embedding" in fact.columns])
    )


def latest_company_arr(arr: DataFrame) -> DataFrame:
    """Newest dated observation per company; the row limit runs before the shuffle."""
    newest = Window.partitionBy("company_id").orderBy(F.desc("observation_date"), F.desc("article_id"))
    return (
        arr.filter(F.col("observation_status") == "DATED")
        .withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") == 1)
        .drop("_n")
    )


def company_arr_by_quarter(arr: DataFrame) -> DataFrame:
    """Count, range and latest amount per company and quarter; equal dates go to the higher article id."""
    return (
        arr.filter(F.col("observation_status") == "DATED")
        .groupBy("company_id", "observation_year", "observation_quarter")
        .agg(
            F.count(F.lit(1)).alias("observation_count"),
            F.min("arr_usd").alias("min_reported_arr_usd"),
            F.max("arr_usd").alias("max_reported_arr_usd"),
            F.max_by("arr_usd", F.struct("observation_date", "article_id")).alias("latest_reported_arr_usd"),
            F.max("observation_date").alias("latest_observation_date"),
        )
    )


def quarter_order(quarters: DataFrame) -> DataFrame:
    return quarters.orderBy("company_id", "observation_year", "observation_quarter")


def arr_over_time(arr: DataFrame, dim: DataFrame, company_name: str) -> DataFrame:
    """Observations of one company. The name filter reaches the dimension before the join."""
    return (
        arr.join(dim.filter(F.col("company_name") == company_name).select("company_id", "company_name"), "company_id")
        .select("company_name", "observation_date", "arr_usd", "article_id", "revenue_raw")
        .orderBy("observation_date", "article_id")
    )


def trace_observation(arr: DataFrame, fact: DataFrame, observation_id: str) -> DataFrame:
    """An observation next to its source article."""
    one = arr.filter(F.col("arr_observation_id") == observation_id).select("arr_observation_id", "arr_usd", "article_id")
    return one.join(fact.select("article_id", "title", "url", "revenue_raw"), "article_id").select(
        "arr_observation_id", "arr_usd", "article_id", "title", "url", "revenue_raw"
    )


def filter_articles(
    fact: DataFrame, start: str, end: str, category: str, industry: str, min_usd: int
) -> DataFrame:
    """Articles inside the dates (inclusive) with both codes and more than ``min_usd``."""
    return (
        fact.filter(
            F.col("published_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
            & (F.col("category_standardized") == category)
            & (F.col("industry_standardized") == industry)
            & (F.col("arr_usd") > min_usd)
        )
        .select("article_id", "title", "company_name", "published_date", "arr_usd")
        .orderBy(F.desc("arr_usd"))
    )


def register_catalog(tables: dict[str, DataFrame]) -> None:
    """Temporary views of all tables and the two analytical views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    arr = tables["fact_arr_observation"]
    latest_company_arr(arr).createOrReplaceTempView("latest_company_arr")
    company_arr_by_quarter(arr).createOrReplaceTempView("company_arr_by_quarter")
