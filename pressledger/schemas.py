"""Explicit schemas and column orders of the input and published tables."""

from pyspark.sql import types as T

# --- fixed values: column names and their order are part of the published contract ---

ARTICLE_COLUMNS = [
    "article_id", "title", "company_name", "published_date", "category",
    "revenue", "summary", "url", "author", "word_count",
]
RAW_RENAMES = {
    "company_name": "company_name_raw",
    "published_date": "published_date_raw",
    "category": "category_raw",
    "revenue": "revenue_raw",
}
MASTER_FIELDS = [
    "founded_year", "headquarters", "employee_count", "industry", "is_public", "stock_ticker",
]
DIM_COMPANY_COLUMNS = [
    "company_id", "company_name", "company_name_raw", "company_match_status",
    "company_match_method", "company_match_confidence", "has_company_metadata", "industry_raw",
    "industry_standardized", "founded_year", "headquarters", "employee_count",
    "company_size_category", "is_public", "stock_ticker", "source_file", "pipeline_run_id",
    "record_hash",
]
FACT_ARTICLE_COLUMNS = [
    "article_id", "title", "company_name_raw", "company_name_canonical", "company_name",
    "company_id", "company_match_status", "company_match_method", "company_match_confidence",
    "has_company_metadata", "published_date_raw", "published_date", "published_year",
    "published_quarter", "published_month", "date_parse_status", "date_parse_reason",
    "category_raw", "category_standardized", "revenue_raw", "arr_usd", "source_currency",
    "lower_bound_source", "upper_bound_source", "arr_parse_status", "arr_parse_reason",
    "summary", "url", "author", "word_count", "industry_raw", "industry_standardized",
    "founded_year", "headquarters", "employee_count", "is_public", "stock_ticker",
    "company_age", "company_size_category", "embedding", "top_similar_articles",
    "source_file", "source_row_number", "source_record_hash", "pipeline_run_id",
]
FACT_ARR_COLUMNS = [
    "arr_observation_id", "article_id", "company_id", "observation_date", "observation_status",
    "date_parse_status", "observation_year", "observation_quarter", "observation_month",
    "arr_usd", "revenue_raw", "source_currency", "company_match_status", "source_file",
    "parse_method_version", "pipeline_run_id",
]
QUALITY_COLUMNS = [
    "issue_id", "pipeline_run_id", "source_table", "source_record_id", "field_name",
    "rule_code", "severity", "raw_value", "message", "created_at",
]
BRIDGE_COLUMNS = [
    "source_article_id", "similar_article_id", "similarity_rank", "similarity_score",
    "embedding_model", "pipeline_run_id",
]
EXPORT_COLUMNS = [
    "article_id", "title", "company_name", "published_date", "category", "arr_usd", "summary",
    "url", "industry", "founded_year", "headquarters", "employee_count", "is_public",
    "stock_ticker", "company_age", "company_size_category", "embedding",
]

# --- Spark types ---

ARTICLES_RAW = T.StructType([T.StructField(c, T.StringType()) for c in ARTICLE_COLUMNS])
MASTER_RECORD = T.StructType([
    T.StructField("founded_year", T.IntegerType()),
    T.StructField("headquarters", T.StringType()),
    T.StructField("employee_count", T.IntegerType()),
    T.StructField("industry", T.StringType()),
    T.StructField("is_public", T.BooleanType()),
    T.StructField("stock_ticker", T.StringType()),
])
