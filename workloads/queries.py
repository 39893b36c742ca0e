"""Registered queries: each reads whole test tables and returns one DataFrame."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressledger import rules
from pressledger.functions.dates import DATE_COLUMNS, parse_published_date
from pressledger.functions.keys import arr_observation_id, company_id, issue_id, record_hash
from pressledger.functions.money import ARR_COLUMNS, parse_arr
from pressledger.functions.taxonomy import (
    company_age, company_size, display_name, lenient_long, standardize_category, standardize_industry,
)
from pressledger.functions.text import article_text
from pressledger.operators import search, similarity, tfidf, validate
from pressledger.operators.metrics import quality_metrics
from pressledger.operators.postings import build_postings, postings_search, read_postings
from pressledger.operators.urls import duplicate_urls
from pressledger.operators.vector_cache import cached_vectors
from pressledger.operators.fuzzy import fuzzy_suggest
from pressledger.operators.joins import lookup_join
from pressledger.operators.matching import distinct_names, master_points, normalize_name, resolve_companies
from pressledger.operators.quality import quality_issues
from pressledger.plans import model
from pressledger.plans.incremental import read_store, update_store
from pressledger.plans.publish import write_table
from pressledger.plans.run import run
from pressledger.schemas import ARTICLE_COLUMNS, MASTER_FIELDS
from pressledger.session import checkpointed, shared_folder
from pressledger.sources.articles import read_csv, unknown_columns
from pressledger.sources.master import read_json_object
from pressledger.sources.published import read_current, read_metrics, search_published
from workloads import testdata as td

RUN_ID = "run"
EXPORT_YEARS = (1998, 2000)  # orders span 1995 to 2001
SEARCH_TEXT = "ouen the interes nteres edshhe inea"
HYBRID = {
    "start_date": "2022-06-01",
    "end_date": "2025-06-30",
    "categories": ["AI_ML", "CLOUD", "FINTECH"],
    "industries": ["AI_ML", "CLOUD", "DATA_ANALYTICS", "SOFTWARE_SAAS"],
    "min_arr_usd": 50_000_000,
}
TOP_K = 25
THRESHOLDS = {"match_rate": (0.95, 0.5, None), "arr_parse_rate": (0.5, 0.2, None), "date_parse_rate": (0.9, 0.8, None), "category_mapped_rate": (0.5, 0.0, None)}


def _text(df: DataFrame, *dates: str) -> DataFrame:
    """Dates as ISO text, so that both engines return the same type."""
    return df.withColumns({d: F.col(d).cast("string") for d in dates})


# --- cleaning ---

def q_parse_arr(spark, sf):
    raw = td.orders_articles(spark, sf).select("article_id", F.col("revenue").alias("revenue_raw"))
    return parse_arr(raw).select("article_id", *ARR_COLUMNS).withColumns({
        c: F.col(c).cast("double") for c in ("lower_bound_source", "upper_bound_source")
    })


def q_parse_published_date(spark, sf):
    raw = td.orders_articles(spark, sf).select("article_id", F.col("published_date").alias("published_date_raw"))
    return _text(parse_published_date(raw).select("article_id", *DATE_COLUMNS), "published_date")


def q_standardize_taxonomy(spark, sf):
    articles = td.orders_articles(spark, sf).select(
        F.col("article_id").alias("record"), F.lit("category").alias("field"),
        standardize_category(F.col("category")).alias("code"),
    )
    companies = td.customer_master(spark, sf).select(
        F.col("company_name").alias("record"), F.lit("industry").alias("field"),
        standardize_industry(F.col("industry")).alias("code"),
    )
    return articles.unionByName(companies)


def q_company_derived(spark, sf):
    orders = td.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    master = td.customer_master(spark, sf)
    texts = td.orders_articles(spark, sf).select(
        (F.col("source_row_number") - 2).alias("o_orderkey"), "company_name", "word_count"
    )
    return (
        orders.join(texts, "o_orderkey")
        .join(master, orders.o_custkey == master.master_order, "left")
        .select(
            "o_orderkey",
            company_size(F.col("employee_count")).alias("company_size_category"),
            company_age(F.col("founded_year"), F.year("o_orderdate")).alias("company_age"),
            lenient_long(F.col("word_count")).alias("word_count"),
            display_name(master["company_name"], texts["company_name"]).alias("display_name"),
        )
    )


def q_stable_keys(spark, sf):
    orders = td.orders_articles(spark, sf)
    article = F.col("article_id")
    return orders.select(
        "article_id",
        arr_observation_id(article).alias("arr_observation_id"),
        issue_id(F.lit("fact_article"), article, F.lit("revenue_raw"), F.lit("ARR_MISSING")).alias("issue_id"),
        company_id(normalize_name(F.col("title"))).alias("company_id"),
    )


def q_record_hash(spark, sf):
    return td.orders_articles(spark, sf).select(
        "article_id", record_hash(*[F.col(c) for c in ARTICLE_COLUMNS]).alias("source_record_hash")
    )


def q_csv_articles(spark, sf):
    """Record hashes after a round trip through CSV files of two column orders, with quotes and line breaks in titles."""
    base = _run_folder(spark)
    rows = td.orders_articles(spark, sf).withColumn("title", F.concat("title", F.lit('\n"q", ')))
    for half, columns in enumerate((ARTICLE_COLUMNS, ARTICLE_COLUMNS[::-1])):
        part = rows.where(F.pmod(F.xxhash64("article_id"), F.lit(2)) == half).select(*columns).write.option("header", True).option("escape", '"')
        part.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{base}/{half}")
    back = read_csv(spark, f"{base}/*")
    return back.select("article_id", record_hash(*[F.col(c) for c in ARTICLE_COLUMNS]).alias("source_record_hash"))


def q_csv_unknown_columns(spark, sf):
    """Columns that only some files have, after a round trip through files of three headers."""
    base = _run_folder(spark)
    order = F.col("source_row_number") - 2
    rows = td.orders_articles(spark, sf).withColumns({
        "desk": F.col("summary"), "region": F.when(F.col("word_count") == "unknown", "").otherwise(F.concat(F.lit("r"), "word_count")),
    })
    for third, columns in enumerate((ARTICLE_COLUMNS, [*ARTICLE_COLUMNS, "desk"], ["region", *ARTICLE_COLUMNS, "desk"])):
        rows.where(order % 3 == third).select(*columns).write.option("header", True).option("escape", '"').csv(f"{base}/{third}")
    back = read_csv(spark, f"{base}/*")
    return back.select("article_id", F.to_json(unknown_columns(back)).alias("attributes"))


def q_csv_lineage(spark, sf):
    """Row ordinals over files in path order, and file names, after a round trip through sorted CSV files in four folders."""
    base = _run_folder(spark)
    rows = td.orders_articles(spark, sf)
    for part in range(4):
        own = rows.where((F.col("source_row_number") - 2) % 4 == part).orderBy("article_id").select(*ARTICLE_COLUMNS)
        own.write.option("header", True).option("escape", '"').csv(f"{base}/{part}")
    back = read_csv(spark, f"{base}/*")
    return back.select("article_id", "source_row_number", F.col("source_file").rlike(r"^part-\d{5}-.*\.csv$").alias("named"))


def q_json_master(spark, sf):
    """Company master data after a round trip through files of one JSON object each, of 500 customers."""
    base = _run_folder(spark)
    entry = F.struct("company_name", F.struct(*MASTER_FIELDS))
    objects = td.customer_master(spark, sf).groupBy(F.floor(F.col("master_order") / 500).alias("part")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")
    )
    objects.write.partitionBy("part").text(base)
    return read_json_object(spark, base).select("company_name", *MASTER_FIELDS, F.to_json("missing_fields").alias("missing_fields"))


# --- identity ---

def _prepared(spark, sf):
    return model.prepare_articles(td.orders_articles(spark, sf))


def _resolve(names, master, spark, sf):
    return resolve_companies(names, master, td.customer_aliases(spark, sf), td.customer_ambiguous(spark, sf))


def _resolved(spark, sf):
    return _resolve(distinct_names(_prepared(spark, sf)), td.customer_master(spark, sf), spark, sf)


def q_resolve_company(spark, sf):
    return _resolved(spark, sf).select(
        "company_name_raw", "n", "company_id", "company_name_canonical", "company_entity_name",
        "company_match_status", "company_match_method", "company_match_confidence", "has_company_metadata",
    )


def q_fuzzy_suggestion(spark, sf):
    """Every unresolved customer name against every master name."""
    unresolved = _resolved(spark, sf).filter(~F.col("has_company_metadata")).select("name_norm").distinct()
    return fuzzy_suggest(unresolved, master_points(td.customer_master(spark, sf)))


# --- star schema ---

def _dim_of(master, resolved):
    return model.build_dim_company(master, resolved, RUN_ID, "customer", "orders")


def _dim(spark, sf):
    master = td.customer_master(spark, sf)
    return _dim_of(master, _resolve(distinct_names(_prepared(spark, sf)), master, spark, sf))


def _star(spark, sf):
    """Dimension and article fact from one definition of the inputs."""
    prepared, master = _prepared(spark, sf), td.customer_master(spark, sf)
    names = distinct_names(prepared)
    resolved = _resolve(names, master, spark, sf)
    dim = _dim_of(master, resolved)
    fact = model.build_fact_article(
        model.clean_articles(prepared), model.name_lookup(resolved, dim), names.select("company_name_raw", "n"), RUN_ID
    )
    return dim, fact


def _fact(spark, sf):
    return _star(spark, sf)[1]


def _arr(spark, sf):
    """Observations need the identity only, not the company attributes."""
    prepared = _prepared(spark, sf)
    names = distinct_names(prepared)
    resolved = _resolve(names, td.customer_master(spark, sf), spark, sf)
    cleaned = model.clean_articles(prepared).filter(F.col("arr_parse_status") == "PARSED")
    fact = lookup_join(
        cleaned, resolved.select("company_name_raw", "company_id", "company_match_status"), "company_name_raw",
        F.col("article_id"), names.select("company_name_raw", "n"),
    )
    return model.build_fact_arr(fact.withColumn("pipeline_run_id", F.lit(RUN_ID)))


def q_dim_company(spark, sf):
    known = F.col("has_company_metadata")
    return _dim(spark, sf).withColumn(
        "company_match_confidence", F.when(known, F.col("company_match_confidence"))
    )


def q_fact_article_enriched(spark, sf):
    fact = model.ordered_fact(_fact(spark, sf)).drop("company_match_confidence", "source_record_hash")
    return _text(fact, "published_date").withColumns({
        c: F.col(c).cast("double") for c in ("lower_bound_source", "upper_bound_source")
    })


def q_fact_arr_observation(spark, sf):
    return _text(_arr(spark, sf), "observation_date")


def q_latest_company_arr(spark, sf):
    return _text(model.latest_company_arr(_arr(spark, sf)), "observation_date")


def q_company_arr_by_quarter(spark, sf):
    return _text(model.quarter_order(model.company_arr_by_quarter(_arr(spark, sf))), "latest_observation_date")


def q_ai_export(spark, sf):
    return _text(model.export_enriched(_fact(spark, sf), years=EXPORT_YEARS), "published_date")


def q_arr_over_time(spark, sf):
    return _text(model.arr_over_time(_arr(spark, sf), _dim(spark, sf), "Customer#000000042"), "observation_date")


def q_arr_lineage(spark, sf):
    arr = _arr(spark, sf)
    articles = _prepared(spark, sf)
    # The id asked for is the one of order 42, computed the same way a user would look it up.
    observation = spark.range(1).select(arr_observation_id(F.lit("ART000000042"))).first()[0]
    return model.trace_observation(arr, articles, observation)


def q_article_filter(spark, sf):
    return _text(
        model.filter_articles(_fact(spark, sf), "1997-01-01", "2000-12-31", "AI_ML", "AI_ML", 50_000_000),
        "published_date",
    )


def q_quality_issues(spark, sf):
    dim, fact = _star(spark, sf)
    issues = quality_issues(fact, dim, RUN_ID, dt.datetime(2024, 1, 1))
    return issues.drop("created_at")


def q_quality_metrics(spark, sf):
    """Rates of all articles, with thresholds that one rate passes, one warns of and one fails."""
    return quality_metrics(_fact(spark, sf), THRESHOLDS).withColumn("rate", F.round("rate", 9)).drop("previous_rate")


def q_duplicate_urls(spark, sf):
    """Pages as articles, some crawled again under other spellings of their address."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").selectExpr("page_id", "url", "split(url, '#')[0] AS bare")
    again = pages.where("page_id % 3 = 0").selectExpr(
        "page_id", "1 AS turn", "concat(regexp_replace(bare, '^https?://', 'HTTP://'), if(instr(bare, '?') > 0, '&', '?'), 'utm_source=feed#again') AS url"
    )
    thrice = pages.where("page_id % 12 = 0").selectExpr(
        "page_id", "2 AS turn", "concat(' https://', upper(regexp_extract(bare, '^https?://([^/?]*)', 1)), ':443', regexp_extract(bare, '^https?://[^/?]*(.*)$', 1), ' ') AS url"
    )
    crawled = pages.selectExpr("page_id", "0 AS turn", "url").unionByName(again).unionByName(thrice)
    articles = crawled.selectExpr("concat('P', page_id, '-', turn) AS article_id", "url", "bigint(page_id * 4 + turn) AS source_row_number")
    return duplicate_urls(articles).drop("url")


# --- text, vectors, search ---

def _documents(spark, sf):
    articles = td.document_articles(spark, sf)
    return articles.withColumns({
        "text": article_text(F.col("title"), F.col("summary")),
        "category_standardized": standardize_category(F.col("category")),
        "industry_standardized": standardize_industry(F.col("industry")),
    })


def q_article_text(spark, sf):
    return _documents(spark, sf).select("article_id", "text")


def q_tfidf_vocabulary(spark, sf):
    terms = tfidf.vocabulary_frame(_documents(spark, sf), "text")
    return terms.withColumn("idf", F.round("idf", 6))


def q_tfidf_weights(spark, sf):
    docs = _documents(spark, sf)
    fitted = tfidf.fit_tfidf(docs, "text")
    weights = tfidf.term_weights(fitted.transform(docs.select("article_id", "text"), "text"), fitted, "article_id")
    return weights.withColumn("weight", F.round("weight", 6))


def _search_articles(spark, sf):
    docs = _documents(spark, sf)
    fitted = tfidf.fit_tfidf(docs, "text")
    return fitted.transform(docs, "text"), fitted


def q_semantic_search(spark, sf):
    articles, fitted = _search_articles(spark, sf)
    return _text(search.semantic_search(articles, fitted, SEARCH_TEXT, TOP_K), "published_date")


def q_hybrid_search(spark, sf):
    articles, fitted = _search_articles(spark, sf)
    return _text(search.hybrid_search(articles, fitted, SEARCH_TEXT, TOP_K, **HYBRID), "published_date")


def _searched(spark, sf, **filters):
    docs, fitted = _search_articles(spark, sf)
    docs, base = checkpointed(docs), _run_folder(spark)
    write_table(build_postings(docs.withColumn("position", F.col("source_row_number")), block=64), base, "term_posting")
    found = postings_search(read_postings(spark, f"{base}/term_posting"), docs, fitted, SEARCH_TEXT, TOP_K, **filters)
    return _text(found, "published_date")


def q_postings_search(spark, sf):
    """The rows of ``semantic_search``, from postings."""
    return _searched(spark, sf)


def q_postings_hybrid(spark, sf):
    """The rows of ``hybrid_search``, from postings."""
    return _searched(spark, sf, **HYBRID)


def q_similar_documents(spark, sf):
    docs = _documents(spark, sf).select("article_id", F.col("source_row_number").alias("position"), "text")
    vectors = tfidf.fit_tfidf(docs, "text").transform(docs, "text").drop("text")
    return similarity.similarity_bridge(similarity.similar_list(checkpointed(vectors)))


def q_similar_documents_approx(spark, sf):
    """Approximate neighbours: the zones of 16 pivots, of one pivot per 64 distinct vectors."""
    docs = _documents(spark, sf).select("article_id", F.col("source_row_number").alias("position"), "text")
    vectors = checkpointed(tfidf.fit_tfidf(docs, "text").transform(docs, "text").drop("text"))
    return similarity.similarity_bridge(similarity.similar_list(vectors, block_rows=64, probes=16))


def q_similar_topn(spark, sf):
    return similarity.similarity_bridge(similarity.similar_list(td.embedding_vectors(spark, sf)))


def q_similar_list(spark, sf):
    ids = similarity.similar_ids(similarity.similar_list(td.embedding_vectors(spark, sf)))
    return ids.withColumn("top_similar_articles", F.to_json("top_similar_articles"))


def q_normalize_vectors(spark, sf):
    scaled = similarity.normalize_vectors(td.embedding_vectors(spark, sf))
    return scaled.select(
        "article_id", F.posexplode(similarity.rounded_vector(F.col("embedding"))).alias("at", "value")
    )


def q_vector_profile(spark, sf):
    profile = similarity.vector_profile(td.embedding_vectors(spark, sf))
    return profile.withColumns({c: F.round(c, 6) for c in ("min_norm", "max_norm")})


def q_article_search(spark, sf):
    articles = td.embedding_vectors(spark, sf).select(
        "article_id", F.lit(None).cast("string").alias("title"), F.col("label").cast("string").alias("company_name"),
        F.lit(None).cast("string").alias("published_date"), F.lit(None).cast("bigint").alias("arr_usd"),
        F.col("position").alias("source_row_number"), "embedding",
    )
    found = search.search_by_article(articles, 7, TOP_K)
    return found.select("article_id", "similarity_score", "company_name")


def q_search_alignment(spark, sf):
    """Documents against vectors: ids without a partner on the other side."""
    docs = td.table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"))
    return search.misaligned_ids(docs, td.embedding_vectors(spark, sf))


# --- validation, publishing ---

def q_validation_report(spark, sf):
    # Checks read finished tables, as they do in a run, and do not rebuild them one by one.
    tables = {
        "dim_company": checkpointed(_dim(spark, sf)),
        "fact_article": checkpointed(_prepared(spark, sf).select("article_id", "source_row_number")),
        "fact_arr_observation": checkpointed(_arr(spark, sf)),
    }
    return validate.validation_report(tables)


def q_validation_violations(spark, sf):
    """Every check on tables made from orders and customers with known faults."""
    orders = td.table(spark, sf, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c")
    customers = td.table(spark, sf, "customer").selectExpr("c_custkey AS c")
    again = lambda df, where: df.unionByName(df.where(where))
    vectors = again(orders.where("k % 90 <> 0"), "k % 700 = 5").selectExpr(
        "string(k) AS article_id",
        "CASE WHEN k % 60 = 7 THEN array(1f) WHEN k % 60 = 8 THEN array(1f, float('NaN')) ELSE array(1f, 2f) END AS embedding",
    )
    stray = orders.where("k % 400 = 2").selectExpr("concat('y', k) AS article_id", "array(1f, 2f) AS embedding")
    tables = {
        "dim_company": again(customers, "c % 100 = 1").selectExpr("string(c) AS company_id"),
        "fact_article": again(orders, "k % 1000 = 1").selectExpr("string(k) AS article_id", "k + 2 AS source_row_number"),
        "fact_arr_observation": again(orders.where("k % 3 = 0"), "k % 300 = 0").selectExpr(
            "concat('o', k) AS arr_observation_id", "if(k % 7 = 0, concat('x', k), string(k)) AS article_id",
            "if(k % 11 = 0, concat('none', k % 10), string(c)) AS company_id", "k % 5 AS arr_usd",
        ),
        "bridge_article_similarity": orders.selectExpr("explode(sequence(1, if(k % 50 = 0, 2, 3))) AS similarity_rank"),
        "article_embedding": vectors.unionByName(stray),
    }
    return validate.validation_report(tables, dimension=2)


def q_input_fingerprint(spark, sf):
    """The same rows in another order and partitioning keep their fingerprint."""
    raw = td.orders_articles(spark, sf).select(*ARTICLE_COLUMNS)
    once = validate.fingerprint(raw).select("row_count", F.struct("hash_xor", "hash_sum").alias("h"))
    # Rebalanced by id: another order, in partitions of bounded size however many rows there are.
    again = validate.fingerprint(raw.hint("rebalance", "article_id")).select(F.struct("hash_xor", "hash_sum").alias("h"))
    both = once.unionByName(again.select(F.lit(None).cast("bigint").alias("row_count"), "h"))
    return both.agg(F.max("row_count").alias("row_count"), (F.count_distinct("h") == 1).cast("int").alias("same"))


def _run_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared area."""
    return f"{shared_folder(spark)}/press-{uuid.uuid4()}"


def q_publish_roundtrip(spark, sf):
    """A whole run over orders and customers, then the rows read back from the published tables."""
    base = _run_folder(spark)
    run(
        spark, td.orders_articles(spark, sf), td.customer_master(spark, sf), base,
        aliases=td.customer_aliases(spark, sf), ambiguous=td.customer_ambiguous(spark, sf),
        export={"years": EXPORT_YEARS},
    )
    return validate.row_counts(read_current(spark, base))


def q_run_metrics(spark, sf):
    """Metrics of a whole run with ready-made vectors, and of one after it whose input has no revenue."""
    base = _run_folder(spark)
    articles, master = td.orders_articles(spark, sf), td.customer_master(spark, sf)
    angle = F.col("source_row_number") % 97
    vectors = articles.select("article_id", F.array(F.cos(angle), F.sin(angle)).cast("array<float>").alias("embedding"))
    names = {"aliases": td.customer_aliases(spark, sf), "ambiguous": td.customer_ambiguous(spark, sf)}
    run(spark, articles, master, base, vectors=vectors, export={"years": EXPORT_YEARS}, **names)
    try:
        run(spark, articles.drop("revenue"), master, base, **names)
    except validate.ContractError:
        pass  # what it leaves in the metrics is part of the result
    return read_metrics(spark, base).select("table_name", "row_count", "status", "message")


def q_csv_mirror(spark, sf):
    """Observations read back from the CSV mirror of their table."""
    base = _run_folder(spark)
    write_table(_arr(spark, sf), base, "fact_arr_observation", formats=("parquet", "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(f"{base}/csv/fact_arr_observation")
    return back.select("article_id", "company_id", "observation_date", "observation_quarter", "arr_usd", "revenue_raw", "source_currency")


def q_catalog_views(spark, sf):
    """SQL over the registered tables and views: the newest amount of each company beside its quarters."""
    model.register_catalog({"dim_company": checkpointed(_dim(spark, sf)), "fact_arr_observation": checkpointed(_arr(spark, sf))})
    return spark.sql("""
        SELECT company_name, string(observation_date) AS observation_date, arr_usd, quarters, most_reported
        FROM latest_company_arr JOIN dim_company USING (company_id) JOIN (
          SELECT company_id, count(*) AS quarters, max(max_reported_arr_usd) AS most_reported FROM company_arr_by_quarter GROUP BY company_id
        ) USING (company_id)""")


def q_published_search(spark, sf):
    """A whole run over documents as articles; then a new session searches what was published, with the stored text model."""
    base = _run_folder(spark)
    run(spark, td.raw_documents(spark, sf), td.customer_master(spark, sf), base, aliases=td.customer_aliases(spark, sf), ambiguous=td.customer_ambiguous(spark, sf))
    return search_published(spark.newSession(), base, SEARCH_TEXT, TOP_K).select("article_id", "similarity_score", "title")


def q_incremental_run(spark, sf):
    """The article store after an earlier state of the orders and then the present one: what changed, and the parsed amounts."""
    base = _run_folder(spark)
    now = td.orders_articles(spark, sf)
    order = F.col("source_row_number") - 2
    earlier = now.where(order % 50 != 3).withColumn("revenue", F.when(order % 20 == 7, "1M").otherwise(F.col("revenue")))
    gone = now.where(order % 90 == 5).withColumn("article_id", F.concat(F.lit("OLD"), "article_id"))
    update_store(spark, base, model.prepare_articles(earlier.unionByName(gone)), buckets=32)
    done = update_store(spark, base, model.prepare_articles(now), buckets=32)
    rows = read_store(spark, base, done.folders).select("article_id", *ARR_COLUMNS)
    return done.changes.select("article_id", "change").join(rows, "article_id", "left").withColumns({
        c: F.col(c).cast("double") for c in ("lower_bound_source", "upper_bound_source")
    })


def q_vector_cache(spark, sf):
    """Vectors of all documents after an earlier state of every third one: how many texts each pass had to encode, and weights."""
    folder = _run_folder(spark)
    docs = _documents(spark, sf).select("article_id", "text")
    fitted = tfidf.fit_tfidf(docs, "text")
    earlier = docs.withColumn("text", F.when(F.col("article_id").cast("long") % 3 == 0, F.concat("text", F.lit(" earlier"))).otherwise(F.col("text")))
    encode = lambda texts: fitted.transform(texts, "text")
    _, first = cached_vectors(spark, folder, earlier, encode, "tfidf")
    vectors, second = cached_vectors(spark, folder, docs, encode, "tfidf")
    weights = F.filter("embedding", lambda w: w != 0)
    return vectors.select(
        "article_id", F.size(weights).alias("terms"), F.round(F.aggregate(weights, F.lit(0.0), lambda a, w: a + w), 6).alias("total"),
        F.lit(first).cast("bigint").alias("encoded_first"), F.lit(second).cast("bigint").alias("encoded_second"),
    )


QUERIES = {name.removeprefix("q_"): fn for name, fn in list(globals().items()) if name.startswith("q_")}
