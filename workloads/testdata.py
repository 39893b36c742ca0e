"""Adapters: article-shaped inputs derived, row by row, from the test tables.

Every messy text follows from a case number, so the expected result is known without parsing.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressledger import rules
from pressledger.session import spread_if_small

CATEGORY_LABELS = [*rules.CATEGORY_CODES, "new category", ""]
INDUSTRY_LABELS = ["AI/ML", "Cloud Computing", "FinTech", "Cybersecurity", "Data Analytics", "SaaS", "Other"]


SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _labels(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


_REVENUE = """
CASE o_orderkey % 20
  WHEN 0 THEN concat('$', k div 1000, ',', lpad(string(k % 1000), 3, '0'))
  WHEN 1 THEN concat(k div 10, '.', k % 10, 'M')
  WHEN 2 THEN concat(k, ' million')
  WHEN 3 THEN concat(k, 'K USD')
  WHEN 4 THEN concat('$', k, 'M - $', k + 10, 'M')
  WHEN 5 THEN concat('€', k, 'M')
  WHEN 6 THEN concat('£', k, 'K')
  WHEN 7 THEN concat('¥', k, 'B')
  WHEN 8 THEN concat('JPY ', k)
  WHEN 9 THEN 'N/A'
  WHEN 10 THEN ''
  WHEN 11 THEN ' Not disclosed '
  WHEN 12 THEN 'garbage'
  WHEN 13 THEN concat('$-', k, 'M')
  WHEN 14 THEN concat('$', k + 10, 'M - $', k, 'M')
  WHEN 15 THEN concat('€', k, 'M USD')
  WHEN 16 THEN concat(k, ' - ', k + 20, 'M')
  WHEN 17 THEN concat(k, 'm - ', k + 1, ' million')
  WHEN 18 THEN concat('1 - 2 - ', k)
  ELSE concat('GBP ', k, ' billion') END
"""
_DATE = """
CASE (o_orderkey div 20) % 9
  WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
  WHEN 1 THEN date_format(o_orderdate, "yyyy-MM-dd'T'00:00:00'Z'")
  WHEN 2 THEN date_format(o_orderdate, 'MM/dd/yyyy')
  WHEN 3 THEN date_format(o_orderdate, 'dd-MM-yyyy')
  WHEN 4 THEN date_format(o_orderdate, 'dd MMM yyyy')
  WHEN 5 THEN date_format(o_orderdate, 'MMMM dd, yyyy')
  WHEN 6 THEN ''
  WHEN 7 THEN '31/12/2023'
  ELSE '2023-02-30' END
"""
_COMPANY = """
CASE (o_orderkey div 180) % 4
  WHEN 0 THEN c_name
  WHEN 1 THEN concat('  ', lower(c_name), ' ')
  WHEN 2 THEN translate(c_name, '#', ' ')
  ELSE concat('Cust-', right(c_name, 9)) END
"""


def orders_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer as raw articles."""
    orders = spread_if_small(table(spark, sf, "orders")).selectExpr(
        "*",
        "bigint(floor(o_totalprice)) AS k",
        "concat('ART', lpad(string(o_orderkey), 9, '0')) AS article_id",
        f"get({_labels(CATEGORY_LABELS)}, int(o_orderkey % {len(CATEGORY_LABELS)})) AS label",
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).selectExpr(
        "article_id",
        "concat('Report ', o_orderkey) AS title",
        f"{_COMPANY} AS company_name",
        f"{_DATE} AS published_date",
        "if(o_orderkey % 2 = 1, upper(label), label) AS category",
        f"{_REVENUE} AS revenue",
        "o_orderpriority AS summary",
        "concat('https://news.example/', article_id) AS url",
        "o_orderstatus AS author",
        "if(o_orderkey % 10 = 9, 'unknown', string(o_orderkey % 1000)) AS word_count",
        "o_orderkey + 2 AS source_row_number",
        "'orders' AS source_file",
    )


def customer_master(spark: SparkSession, sf: str) -> DataFrame:
    """Nine of ten customers as company master data."""
    return table(spark, sf, "customer").filter("c_custkey % 10 <> 9").selectExpr(
        "c_name AS company_name",
        "c_custkey AS master_order",
        "int(1980 + c_custkey % 25) AS founded_year",
        "c_mktsegment AS headquarters",
        """int(CASE c_custkey % 8 WHEN 0 THEN 9999 WHEN 1 THEN 10000 WHEN 2 THEN 30000 WHEN 3 THEN 30001
               WHEN 4 THEN -5 WHEN 5 THEN NULL ELSE c_custkey * 7 END) AS employee_count""",
        f"get({_labels(INDUSTRY_LABELS)}, int(c_custkey % 7)) AS industry",
        "c_custkey % 2 = 0 AS is_public",
        "CASE c_custkey % 3 WHEN 0 THEN concat('T', c_custkey) WHEN 1 THEN '' END AS stock_ticker",
    )


def customer_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.concat(F.lit("Cust-"), F.substring("c_name", -9, 9)).alias("alias"),
        F.col("c_name").alias("canonical"),
        F.col("c_custkey").alias("alias_order"),
    )


def customer_ambiguous(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter(F.col("c_custkey") % 50 == 9).select(F.col("c_name").alias("company_name"))


def document_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles with whole texts: the first line is the title, the rest the summary."""
    return spread_if_small(table(spark, sf, "documents")).selectExpr(
        "string(doc_id) AS article_id",
        "substring_index(text, '\n', 1) AS title",
        "if(instr(text, '\n') > 0, substr(text, instr(text, '\n') + 1), '') AS summary",
        "source AS company_name",
        "date_add(DATE '2022-01-01', int(doc_id % 1461)) AS published_date",
        f"get({_labels(CATEGORY_LABELS)}, int(doc_id % {len(CATEGORY_LABELS)})) AS category",
        f"get({_labels(INDUSTRY_LABELS)}, int(doc_id % {len(INDUSTRY_LABELS)})) AS industry",
        "if(doc_id % 4 <> 3, n_chars * 100000, NULL) AS arr_usd",
        "doc_id AS source_row_number",
    )


def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw articles, in the order of their ids, which count from 0."""
    return document_articles(spark, sf).selectExpr(
        "article_id", "title", "company_name", "string(published_date) AS published_date", "category",
        "if(arr_usd IS NULL, 'N/A', concat('$', arr_usd)) AS revenue", "summary", "concat('https://news.example/', article_id) AS url",
        "company_name AS author", "'1' AS word_count", "source_row_number + 2 AS source_row_number", "'documents' AS source_file",
    )


def embedding_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("article_id"), F.col("vec_id").alias("position"), "embedding", "label"
    )
