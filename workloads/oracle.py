"""Expected results as SQL for another engine.

For the order-based inputs the SQL starts from the case numbers and never parses the messy text.
"""

from pressledger import rules
from workloads.queries import EXPORT_YEARS, HYBRID, SEARCH_TEXT, THRESHOLDS, TOP_K


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _uuid5(namespace: str, name: str) -> str:
    h = f"sha1(unhex('{namespace.replace('-', '')}') || CAST({name} AS BLOB))"
    return (
        f"(SELECT substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||"
        f"translate(substr(h,17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr(h,18,3)||'-'||substr(h,21,12) "
        f"FROM (SELECT {h} AS h))"
    )


def _company_id(norm: str) -> str:
    return _uuid5(rules.COMPANY_NAMESPACE, f"'company:' || {norm}")


_CATEGORY = (
    "CASE WHEN {x} % 21 < 4 THEN 'AI_ML' WHEN {x} % 21 < 7 THEN 'CLOUD' WHEN {x} % 21 < 10 THEN 'FINTECH' "
    "WHEN {x} % 21 < 13 THEN 'CYBERSECURITY' WHEN {x} % 21 < 16 THEN 'DATA_ANALYTICS' "
    "WHEN {x} % 21 < 19 THEN 'SOFTWARE_SAAS' ELSE 'UNMAPPED' END"
)
_INDUSTRY = (
    "['AI_ML','CLOUD','FINTECH','CYBERSECURITY','DATA_ANALYTICS','SOFTWARE_SAAS','UNMAPPED'][{x} % 7 + 1]"
)
_INDUSTRY_LABEL = "['AI/ML','Cloud Computing','FinTech','Cybersecurity','Data Analytics','SaaS','Other'][{x} % 7 + 1]"
_CATEGORY_LABEL = f"[{_quoted([*rules.CATEGORY_CODES, 'new category', ''])}][{{x}} % 21 + 1]"
_EMPLOYEES = (
    "CASE {x} % 8 WHEN 0 THEN 9999 WHEN 1 THEN 10000 WHEN 2 THEN 30000 WHEN 3 THEN 30001 WHEN 4 THEN -5 "
    "WHEN 5 THEN NULL ELSE {x} * 7 END"
)
_SIZE = (
    "CASE {x} % 8 WHEN 0 THEN 'SMALL' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'LARGE' "
    "WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'UNKNOWN' ELSE "
    "CASE WHEN {x} * 7 < 10000 THEN 'SMALL' WHEN {x} * 7 <= 30000 THEN 'MEDIUM' ELSE 'LARGE' END END"
)
_TICKER = "CASE {x} % 3 WHEN 0 THEN 'T' || {x} WHEN 1 THEN '' ELSE NULL END"

# One row per order with its messy texts (raw_*) and everything expected of it.
_BASE = f"""
b AS (
  SELECT o_orderkey AS ok, o_custkey AS ck, CAST(floor(o_totalprice) AS BIGINT) AS k,
         o_orderkey % 20 AS c, (o_orderkey // 20) % 9 AS v, (o_orderkey // 180) % 4 AS n,
         CAST(o_orderdate AS DATE) AS d, o_orderpriority, o_orderstatus,
         'ART' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS article_id,
         c_name, right(c_name, 9) AS digits, o_custkey % 10 <> 9 AS in_master
  FROM orders JOIN customer ON o_custkey = c_custkey
),
t AS (
  SELECT *,
    CASE c WHEN 0 THEN '$' || (k // 1000) || ',' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0')
      WHEN 1 THEN (k // 10) || '.' || (k % 10) || 'M' WHEN 2 THEN k || ' million' WHEN 3 THEN k || 'K USD'
      WHEN 4 THEN '$' || k || 'M - $' || (k + 10) || 'M' WHEN 5 THEN '€' || k || 'M' WHEN 6 THEN '£' || k || 'K'
      WHEN 7 THEN '¥' || k || 'B' WHEN 8 THEN 'JPY ' || k WHEN 9 THEN 'N/A' WHEN 10 THEN ''
      WHEN 11 THEN ' Not disclosed ' WHEN 12 THEN 'garbage' WHEN 13 THEN '$-' || k || 'M'
      WHEN 14 THEN '$' || (k + 10) || 'M - $' || k || 'M' WHEN 15 THEN '€' || k || 'M USD'
      WHEN 16 THEN k || ' - ' || (k + 20) || 'M' WHEN 17 THEN k || 'm - ' || (k + 1) || ' million'
      WHEN 18 THEN '1 - 2 - ' || k ELSE 'GBP ' || k || ' billion' END AS revenue_raw,
    CASE c WHEN 0 THEN k WHEN 1 THEN k * 100000 WHEN 2 THEN k * 1000000 WHEN 3 THEN k * 1000
      WHEN 4 THEN (k + 5) * 1000000 WHEN 5 THEN k * 1100000 WHEN 6 THEN k * 1270
      WHEN 7 THEN (2 * k * 1000000000 + 150) // 300 WHEN 8 THEN (2 * k + 150) // 300
      WHEN 16 THEN (k + 10) * 1000000 WHEN 19 THEN k * 1270000000 END AS arr_usd,
    CASE WHEN c IN (9, 10, 11, 15) THEN NULL WHEN c = 5 THEN 'EUR' WHEN c IN (6, 19) THEN 'GBP'
      WHEN c IN (7, 8) THEN 'JPY' ELSE 'USD' END AS source_currency,
    CAST(CASE c WHEN 0 THEN k WHEN 1 THEN k * 100000 WHEN 2 THEN k * 1000000 WHEN 3 THEN k * 1000
      WHEN 4 THEN k * 1000000 WHEN 5 THEN k * 1000000 WHEN 6 THEN k * 1000 WHEN 7 THEN k * 1000000000
      WHEN 8 THEN k WHEN 16 THEN k * 1000000 WHEN 19 THEN k * 1000000000 END AS DOUBLE) AS lower_bound_source,
    CAST(CASE c WHEN 0 THEN k WHEN 1 THEN k * 100000 WHEN 2 THEN k * 1000000 WHEN 3 THEN k * 1000
      WHEN 4 THEN (k + 10) * 1000000 WHEN 5 THEN k * 1000000 WHEN 6 THEN k * 1000 WHEN 7 THEN k * 1000000000
      WHEN 8 THEN k WHEN 16 THEN (k + 20) * 1000000 WHEN 19 THEN k * 1000000000 END AS DOUBLE) AS upper_bound_source,
    CASE WHEN c IN (9, 10) THEN 'MISSING' WHEN c = 11 THEN 'UNDISCLOSED'
      WHEN c IN (12, 13, 14, 15, 17, 18) THEN 'INVALID_FORMAT' ELSE 'PARSED' END AS arr_parse_status,
    CASE c WHEN 9 THEN 'missing revenue' WHEN 10 THEN 'missing revenue' WHEN 11 THEN 'revenue not disclosed'
      WHEN 12 THEN 'amount does not match a supported format' WHEN 13 THEN 'negative amounts are not valid ARR'
      WHEN 14 THEN 'range lower bound exceeds upper bound' WHEN 15 THEN 'multiple currency markers found'
      WHEN 17 THEN 'range endpoints use different scales'
      WHEN 18 THEN 'range has more than two endpoints' END AS arr_parse_reason,
    CASE v WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%m-%dT00:00:00Z')
      WHEN 2 THEN strftime(d, '%m/%d/%Y') WHEN 3 THEN strftime(d, '%d-%m-%Y') WHEN 4 THEN strftime(d, '%d %b %Y')
      WHEN 5 THEN strftime(d, '%B %d, %Y') WHEN 6 THEN '' WHEN 7 THEN '31/12/2023' ELSE '2023-02-30' END AS published_date_raw,
    CASE WHEN v < 6 THEN d END AS pub,
    CASE WHEN v < 6 THEN 'PARSED' WHEN v = 6 THEN 'MISSING' ELSE 'INVALID' END AS date_parse_status,
    CASE WHEN v = 2 AND day(d) <= 12 THEN 'ambiguous numeric date interpreted as MM/DD/YYYY'
      WHEN v = 6 THEN 'missing published date' WHEN v > 6 THEN 'unsupported or invalid date' END AS date_parse_reason,
    CASE n WHEN 0 THEN c_name WHEN 1 THEN '  ' || lower(c_name) || ' ' WHEN 2 THEN replace(c_name, '#', ' ')
      ELSE 'Cust-' || digits END AS company_name_raw,
    CASE n WHEN 0 THEN c_name WHEN 1 THEN lower(c_name) WHEN 2 THEN replace(c_name, '#', ' ')
      ELSE 'Cust-' || digits END AS company_name_clean,
    CASE WHEN in_master THEN c_name END AS company_name_canonical,
    CASE WHEN in_master OR n < 3 THEN 'customer ' || digits ELSE 'cust ' || digits END AS norm,
    CASE WHEN in_master THEN 'MATCHED' WHEN n = 0 AND ck % 50 = 9 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS company_match_status,
    CASE WHEN in_master THEN ['EXACT', 'NORMALIZED', 'NORMALIZED', 'ALIAS'][n + 1]
      WHEN n = 0 AND ck % 50 = 9 THEN 'AMBIGUOUS_SOURCE' ELSE 'UNRESOLVED' END AS company_match_method,
    CASE WHEN in_master THEN CAST([1.0, 0.99, 0.99, 0.98][n + 1] AS DOUBLE) END AS company_match_confidence,
    CASE WHEN ok % 2 = 1 THEN upper({_CATEGORY_LABEL.format(x="ok")}) ELSE {_CATEGORY_LABEL.format(x="ok")} END AS category_raw,
    {_CATEGORY.format(x="ok")} AS category_standardized,
    CASE WHEN in_master THEN {_INDUSTRY_LABEL.format(x="ck")} END AS industry_raw,
    CASE WHEN in_master THEN {_INDUSTRY.format(x="ck")} ELSE 'UNMAPPED' END AS industry_standardized,
    CASE WHEN in_master THEN CAST(1980 + ck % 25 AS INTEGER) END AS founded_year,
    CASE WHEN in_master THEN CAST({_EMPLOYEES.format(x="ck")} AS INTEGER) END AS employee_count,
    CASE WHEN in_master THEN {_SIZE.format(x="ck")} ELSE 'UNKNOWN' END AS company_size_category,
    CASE WHEN in_master THEN ck % 2 = 0 END AS is_public,
    CASE WHEN in_master THEN {_TICKER.format(x="ck")} END AS stock_ticker,
    CASE WHEN ok % 10 = 9 THEN NULL ELSE ok % 1000 END AS word_count,
    CASE WHEN ok % 10 = 9 THEN 'unknown' ELSE CAST(ok % 1000 AS VARCHAR) END AS word_count_raw
  FROM b
)
"""
_WITH = "WITH " + _BASE
_COMPANY = _company_id("norm")
_OBSERVATION = _uuid5(rules.ARR_NAMESPACE, "article_id || ':reported_arr'")


def _issue(table: str, record: str, field: str, rule: str) -> str:
    return _uuid5(rules.ISSUE_NAMESPACE, f"'{table}:' || {record} || ':{field}:' || {rule}")


_ARR_ROWS = f"""
a AS (
  SELECT {_OBSERVATION} AS arr_observation_id, article_id, {_COMPANY} AS company_id, pub AS observation_date,
         CASE WHEN pub IS NULL THEN 'UNDATED' ELSE 'DATED' END AS observation_status, date_parse_status,
         CAST(year(pub) AS INTEGER) AS observation_year, CAST(quarter(pub) AS INTEGER) AS observation_quarter,
         CAST(month(pub) AS INTEGER) AS observation_month, arr_usd, revenue_raw, source_currency,
         company_match_status, 'orders' AS source_file, '1.0.0' AS parse_method_version, 'run' AS pipeline_run_id
  FROM t WHERE arr_parse_status = 'PARSED'
)
"""
_ARR_OUT = "SELECT * REPLACE (CAST(observation_date AS VARCHAR) AS observation_date) FROM "

_DIM_ROWS = f"""
seen AS (
  SELECT norm, arg_max({{'raw': company_name_clean, 'm': company_match_method, 'c': company_match_confidence}}, ok) AS l,
         arg_min({{'raw': company_name_clean, 'm': company_match_method, 's': company_match_status}}, ok) AS f,
         bool_and(in_master) AS in_master
  FROM t GROUP BY norm
),
dim AS (
  SELECT {_company_id("'customer ' || right(c_name, 9)")} AS company_id, c_name AS company_name,
         coalesce(l.raw, c_name) AS company_name_raw,
         CASE WHEN l IS NULL THEN 'METADATA_ONLY' ELSE 'MATCHED' END AS company_match_status,
         coalesce(l.m, 'METADATA_KEY') AS company_match_method,
         CASE WHEN l IS NULL THEN 1.0 ELSE l.c END AS company_match_confidence, TRUE AS has_company_metadata,
         {_INDUSTRY_LABEL.format(x="c_custkey")} AS industry_raw, {_INDUSTRY.format(x="c_custkey")} AS industry_standardized,
         CAST(1980 + c_custkey % 25 AS INTEGER) AS founded_year, c_mktsegment AS headquarters,
         CAST({_EMPLOYEES.format(x="c_custkey")} AS INTEGER) AS employee_count,
         {_SIZE.format(x="c_custkey")} AS company_size_category, c_custkey % 2 = 0 AS is_public,
         {_TICKER.format(x="c_custkey")} AS stock_ticker, 'customer' AS source_file, 'run' AS pipeline_run_id
  FROM customer LEFT JOIN seen ON seen.norm = 'customer ' || right(c_name, 9)
  WHERE c_custkey % 10 <> 9
  UNION ALL
  SELECT {_company_id("norm")}, f.raw, f.raw, f.s, f.m, NULL, FALSE, NULL, 'UNMAPPED', NULL, NULL, NULL, 'UNKNOWN',
         NULL, NULL, 'orders', 'run'
  FROM seen WHERE NOT in_master
)
"""
_DIM = f"""
{_WITH}, {_DIM_ROWS}
SELECT *, sha256(CAST(CASE WHEN has_company_metadata THEN to_json([CAST(founded_year AS VARCHAR), headquarters,
         CAST(employee_count AS VARCHAR), industry_raw, industry_standardized,
         CASE WHEN is_public THEN 'True' ELSE 'False' END, stock_ticker])
       ELSE to_json([company_name, company_match_status]) END AS VARCHAR)) AS record_hash
FROM dim
"""

_FACT_COLUMNS = """
  article_id, 'Report ' || ok AS title, company_name_raw, company_name_canonical,
  coalesce(company_name_canonical, company_name_raw) AS company_name, {company} AS company_id, company_match_status,
  company_match_method, in_master AS has_company_metadata, published_date_raw, CAST(pub AS VARCHAR) AS published_date,
  CAST(year(pub) AS INTEGER) AS published_year, CAST(quarter(pub) AS INTEGER) AS published_quarter,
  CAST(month(pub) AS INTEGER) AS published_month, date_parse_status, date_parse_reason, category_raw,
  category_standardized, revenue_raw, arr_usd, source_currency, lower_bound_source, upper_bound_source,
  arr_parse_status, arr_parse_reason, o_orderpriority AS summary, 'https://news.example/' || article_id AS url,
  o_orderstatus AS author, word_count, industry_raw, industry_standardized, founded_year,
  CASE WHEN in_master THEN c_mktsegment END AS headquarters, employee_count, is_public, stock_ticker,
  CAST(CASE WHEN year(pub) >= founded_year THEN year(pub) - founded_year END AS INTEGER) AS company_age,
  company_size_category, 'orders' AS source_file, ok + 2 AS source_row_number, 'run' AS pipeline_run_id
""".format(company=_COMPANY)
_FACT_FROM = "FROM t JOIN (SELECT c_custkey, c_mktsegment FROM customer) ON ck = c_custkey"
_EXPORT_WHERE = (
    f"(category_standardized = 'AI_ML' OR industry_standardized = 'AI_ML') AND year(pub) BETWEEN {EXPORT_YEARS[0]} "
    f"AND {EXPORT_YEARS[1]} AND arr_parse_status = 'PARSED' AND arr_usd > {rules.EXPORT_MIN_USD}"
)

_ISSUE_ROWS = f"""
raised AS (
  SELECT 'fact_article' AS source_table, article_id AS source_record_id, 'revenue_raw' AS field_name,
         'ARR_' || arr_parse_status AS rule_code,
         CASE WHEN arr_parse_status = 'INVALID_FORMAT' THEN 'ERROR' ELSE 'INFO' END AS severity,
         revenue_raw AS raw_value, arr_parse_reason AS message FROM t WHERE arr_parse_status <> 'PARSED'
  UNION ALL SELECT 'fact_article', article_id, 'published_date_raw', 'DATE_' || date_parse_status, 'ERROR',
         published_date_raw, date_parse_reason FROM t WHERE v >= 6
  UNION ALL SELECT 'fact_article', article_id, 'published_date_raw', 'DATE_AMBIGUOUS_POLICY_APPLIED', 'INFO',
         published_date_raw, date_parse_reason FROM t WHERE v = 2 AND day(d) <= 12
  UNION ALL SELECT 'fact_article', article_id, 'company_name_raw', 'COMPANY_' || company_match_status, 'WARNING',
         company_name_raw, 'company metadata was not joined' FROM t WHERE NOT in_master
  UNION ALL SELECT 'fact_article', article_id, 'category_raw', 'CATEGORY_UNMAPPED', 'WARNING', category_raw,
         'category is not in the configured taxonomy' FROM t WHERE ok % 21 >= 19
  UNION ALL SELECT 'fact_article', article_id, 'founded_year', 'COMPANY_AGE_NEGATIVE', 'WARNING',
         CAST(founded_year AS VARCHAR), 'founded year is after publication year' FROM t WHERE founded_year > year(pub)
  UNION ALL SELECT 'dim_company', company_id, 'stock_ticker', 'PUBLIC_COMPANY_WITHOUT_TICKER', 'WARNING', stock_ticker,
         'public company has no ticker in source metadata' FROM dim
         WHERE has_company_metadata AND is_public AND coalesce(stock_ticker, '') = ''
  UNION ALL SELECT 'dim_company', company_id, 'stock_ticker', 'PRIVATE_COMPANY_WITH_TICKER', 'WARNING', stock_ticker,
         'private company has a ticker in source metadata' FROM dim
         WHERE has_company_metadata AND NOT is_public AND coalesce(stock_ticker, '') <> ''
)
"""
_ISSUE_ID = _uuid5(
    rules.ISSUE_NAMESPACE, "source_table || ':' || source_record_id || ':' || field_name || ':' || rule_code"
)


def _terms(source: str, prefix: str) -> str:
    """CTEs {prefix}tf(doc_id, term, tf): words without stop words and pairs of neighbours."""
    return f"""
{prefix}words AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                             lambda w: w NOT IN ({_quoted(rules.STOP_WORDS)})) AS w FROM {source}
),
{prefix}tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
    FROM {prefix}words)
  GROUP BY doc_id, term
)"""


_TFIDF = f"""WITH {_terms("documents", "")},
vocabulary AS (
  SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx,
         ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + document_frequency)) + 1.0 AS idf
  FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS document_frequency FROM tf GROUP BY term
        ORDER BY corpus_count DESC, term LIMIT {rules.VOCABULARY_SIZE})
),
weights AS (
  SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS weight
  FROM (SELECT doc_id, term, tf * idf AS x FROM tf JOIN vocabulary USING (term))
)"""

_QUERY_WEIGHTS = f"""
query AS (SELECT 0 AS doc_id, '{SEARCH_TEXT}' AS text),
{_terms("query", "q")},
qweights AS (
  SELECT term, x / sqrt(sum(x * x) OVER ()) AS weight
  FROM (SELECT term, tf * idf AS x FROM qtf JOIN vocabulary USING (term))
),
scored AS (
  SELECT doc_id, sum(w.weight * q.weight) AS score FROM weights w JOIN qweights q USING (term) GROUP BY doc_id
)"""


def _search(where: str = "TRUE") -> str:
    return f"""{_TFIDF}, {_QUERY_WEIGHTS}
SELECT CAST(doc_id AS VARCHAR) AS article_id, round(coalesce(score, 0.0), 8) AS similarity_score,
       split_part(text, chr(10), 1) AS title, source AS company_name,
       CAST(DATE '2022-01-01' + CAST(doc_id % 1461 AS INTEGER) AS VARCHAR) AS published_date,
       CASE WHEN doc_id % 4 <> 3 THEN n_chars * 100000 END AS arr_usd
FROM documents LEFT JOIN scored USING (doc_id)
WHERE {where}
ORDER BY similarity_score DESC, doc_id LIMIT {TOP_K}"""


_HYBRID_WHERE = f"""
  DATE '2022-01-01' + CAST(doc_id % 1461 AS INTEGER) BETWEEN DATE '{HYBRID["start_date"]}' AND DATE '{HYBRID["end_date"]}'
  AND {_CATEGORY.format(x="doc_id")} IN ({_quoted(HYBRID["categories"])})
  AND {_INDUSTRY.format(x="doc_id")} IN ({_quoted(HYBRID["industries"])})
  AND doc_id % 4 <> 3 AND n_chars * 100000 > {HYBRID["min_arr_usd"]}
"""

_VECTOR_TOP = f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (
  SELECT a.vec_id AS s, b.vec_id AS m, round(list_inner_product(a.x, b.x), 8) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id
),
top AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY score DESC, m) AS r FROM pairs
  QUALIFY r <= {rules.NEIGHBOURS}
)"""

_EDGE_SPACE = "regexp_replace({x}, '^[\\s]+|[\\s]+$', '', 'g')"

_ARTICLE_TEXT = f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, {_EDGE_SPACE.format(x="a || chr(10) || chr(10) || b")} AS text
        FROM (SELECT doc_id, {_EDGE_SPACE.format(x="split_part(text, chr(10), 1)")} AS a,
        {_EDGE_SPACE.format(x="CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END")} AS b
        FROM documents)"""

_RATE_STATUS = " ".join(
    f"WHEN metric = '{m}' AND hits < {fail} * base THEN 'FAIL' WHEN metric = '{m}' AND hits < {warn} * base THEN 'WARN'"
    for m, (warn, fail, _) in THRESHOLDS.items()
)
_FORMAT = "['ISO', 'ISO', 'MONTH_DAY_YEAR', 'DAY_MONTH_YEAR', 'DAY_MONTH_NAME', 'MONTH_NAME_DAY', 'BLANK', 'MONTH_DAY_YEAR', 'ISO'][v + 1]"
_QUALITY_METRICS = f"""{_WITH}, r AS (
  SELECT 'match_rate' AS metric, '' AS part, count(*) FILTER (in_master) AS hits, count(*) AS base FROM t
  UNION ALL SELECT 'arr_parse_rate', '', count(*) FILTER (arr_parse_status = 'PARSED'), count(*) FILTER (c NOT IN (9, 10, 11)) FROM t
  UNION ALL SELECT 'date_parse_rate', '', count(*) FILTER (v < 6), count(*) FROM t
  UNION ALL SELECT 'date_parse_rate', {_FORMAT}, count(*) FILTER (v < 6), count(*) FROM t GROUP BY 2
  UNION ALL SELECT 'category_mapped_rate', '', count(*) FILTER (ok % 21 < 19), count(*) FROM t
  UNION ALL SELECT 'match_share', company_match_method, count(*), (SELECT count(*) FROM t) FROM t GROUP BY 2
  UNION ALL SELECT 'arr_share', arr_parse_status, count(*), (SELECT count(*) FROM t) FROM t GROUP BY 2
)
SELECT source_file, metric, part, hits, base, round(hits / base, 9) AS rate,
       CASE WHEN part <> '' THEN 'OK' {_RATE_STATUS} ELSE 'OK' END AS status
FROM r, (VALUES ('orders'), (NULL)) files(source_file)"""

_PUBLISHED_ROWS = f"""SELECT 'dim_company' AS table_name, count(*) AS row_count FROM dim
        UNION ALL SELECT 'fact_article', count(*) FROM t
        UNION ALL SELECT 'fact_arr_observation', count(*) FROM t WHERE arr_parse_status = 'PARSED'
        UNION ALL SELECT 'data_quality_issue', count(*) FROM raised
        UNION ALL SELECT 'bridge_article_similarity', count(*) * {rules.NEIGHBOURS} FROM t
        UNION ALL SELECT 'ai_articles_enriched', count(*) FROM t WHERE {_EXPORT_WHERE}
        UNION ALL SELECT 'article_embedding', count(*) FROM t"""

_URL_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"
_DUPLICATE_URLS = f"""WITH p AS (
  SELECT page_id, 0 AS turn, url FROM pages UNION ALL SELECT page_id, 1, url FROM pages WHERE page_id % 3 = 0
  UNION ALL SELECT page_id, 2, url FROM pages WHERE page_id % 12 = 0
),
s AS (SELECT page_id, turn, split_part(url, '#', 1) AS u FROM p),
k AS (
  SELECT page_id, turn, regexp_replace(lower(regexp_extract(u, '{_URL_SCHEME}([^/?]*)', 1)), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(u, '{_URL_SCHEME}[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '[?](.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid)='))), '&') AS asked FROM s
),
c AS (SELECT page_id * 4 + turn AS n, 'P' || page_id || '-' || turn AS article_id, host || path || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END AS url_canonical FROM k),
g AS (SELECT *, min(n) OVER (PARTITION BY url_canonical) AS first_row_number, count(*) OVER (PARTITION BY url_canonical) AS copies FROM c)
SELECT article_id, url_canonical, first_row_number, copies FROM g WHERE n > first_row_number"""

ORACLE = {
    "quality_metrics": _QUALITY_METRICS,
    "duplicate_urls": _DUPLICATE_URLS,
    "csv_unknown_columns": _WITH + """SELECT article_id, CASE ok % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{"desk":"' || o_orderpriority || '"}'
        ELSE '{"desk":"' || o_orderpriority || '"' || CASE WHEN word_count_raw = 'unknown' THEN '' ELSE ',"region":"r' || word_count_raw || '"' END || '}' END
        AS attributes FROM t""",
    "parse_arr": _WITH + """SELECT article_id, arr_usd, source_currency, lower_bound_source, upper_bound_source,
        arr_parse_status, arr_parse_reason FROM t""",
    "parse_published_date": _WITH + """SELECT article_id, CAST(pub AS VARCHAR) AS published_date,
        CAST(year(pub) AS INTEGER) AS published_year, CAST(quarter(pub) AS INTEGER) AS published_quarter,
        CAST(month(pub) AS INTEGER) AS published_month, date_parse_status, date_parse_reason FROM t""",
    "standardize_taxonomy": _WITH + f"""SELECT article_id AS record, 'category' AS field, category_standardized AS code FROM t
        UNION ALL SELECT c_name, 'industry', {_INDUSTRY.format(x="c_custkey")} FROM customer WHERE c_custkey % 10 <> 9""",
    "company_derived": _WITH + """SELECT ok AS o_orderkey, company_size_category,
        CAST(CASE WHEN year(d) >= founded_year THEN year(d) - founded_year END AS INTEGER) AS company_age,
        CAST(word_count AS BIGINT) AS word_count, coalesce(company_name_canonical, company_name_raw) AS display_name FROM t""",
    "stable_keys": _WITH + f"""SELECT article_id, {_OBSERVATION} AS arr_observation_id,
        {_issue("fact_article", "article_id", "revenue_raw", "'ARR_MISSING'")} AS issue_id,
        {_company_id("'report ' || ok")} AS company_id FROM t""",
    "record_hash": _WITH + """SELECT article_id, sha256(replace(replace(replace(CAST(to_json([article_id, 'Report ' || ok,
        company_name_raw, published_date_raw, category_raw, revenue_raw, o_orderpriority, 'https://news.example/' || article_id,
        o_orderstatus, word_count_raw]) AS VARCHAR), '€', '\\u20ac'), '£', '\\u00a3'), '¥', '\\u00a5')) AS source_record_hash FROM t""",
    "csv_articles": _WITH + """SELECT article_id, sha256(replace(replace(replace(CAST(to_json([article_id, 'Report ' || ok || chr(10) || '"q", ',
        company_name_raw, published_date_raw, category_raw, revenue_raw, o_orderpriority, 'https://news.example/' || article_id,
        o_orderstatus, word_count_raw]) AS VARCHAR), '€', '\\u20ac'), '£', '\\u00a3'), '¥', '\\u00a5')) AS source_record_hash FROM t""",
    "resolve_company": _WITH + f"""SELECT company_name_raw, count(*) AS n, {_COMPANY} AS company_id, company_name_canonical,
        coalesce(company_name_canonical, company_name_clean) AS company_entity_name, company_match_status,
        company_match_method, company_match_confidence, in_master AS has_company_metadata FROM t GROUP BY ALL""",
    "dim_company": _DIM,
    "fact_article_enriched": f"{_WITH} SELECT {_FACT_COLUMNS} {_FACT_FROM}",
    "fact_arr_observation": f"{_WITH}, {_ARR_ROWS} {_ARR_OUT} a",
    "latest_company_arr": f"""{_WITH}, {_ARR_ROWS} {_ARR_OUT} (SELECT * FROM a WHERE observation_status = 'DATED'
        QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY observation_date DESC, article_id DESC) = 1)""",
    "company_arr_by_quarter": f"""{_WITH}, {_ARR_ROWS} SELECT company_id, observation_year, observation_quarter,
        count(*) AS observation_count, min(arr_usd) AS min_reported_arr_usd, max(arr_usd) AS max_reported_arr_usd,
        arg_max(arr_usd, row(observation_date, article_id)) AS latest_reported_arr_usd,
        CAST(max(observation_date) AS VARCHAR) AS latest_observation_date
        FROM a WHERE observation_status = 'DATED' GROUP BY 1, 2, 3""",
    "ai_export": f"""{_WITH}, f AS (SELECT {_FACT_COLUMNS} {_FACT_FROM} WHERE {_EXPORT_WHERE})
        SELECT article_id, title, company_name, published_date, category_standardized AS category, arr_usd, summary, url,
        industry_raw AS industry, founded_year, headquarters, employee_count, is_public, stock_ticker, company_age,
        company_size_category FROM f""",
    "arr_over_time": f"""{_WITH}, {_ARR_ROWS}, {_DIM_ROWS} SELECT company_name, CAST(observation_date AS VARCHAR) AS observation_date,
        arr_usd, article_id, revenue_raw FROM a JOIN dim USING (company_id) WHERE company_name = 'Customer#000000042'""",
    "arr_lineage": f"""{_WITH}, {_ARR_ROWS} SELECT arr_observation_id, a.arr_usd, a.article_id, 'Report ' || ok AS title,
        'https://news.example/' || a.article_id AS url, t.revenue_raw FROM a JOIN t USING (article_id)
        WHERE arr_observation_id = {_uuid5(rules.ARR_NAMESPACE, "'ART000000042:reported_arr'")}""",
    "article_filter": _WITH + """SELECT article_id, 'Report ' || ok AS title,
        coalesce(company_name_canonical, company_name_raw) AS company_name, CAST(pub AS VARCHAR) AS published_date, arr_usd
        FROM t WHERE pub BETWEEN DATE '1997-01-01' AND DATE '2000-12-31' AND category_standardized = 'AI_ML'
        AND industry_standardized = 'AI_ML' AND arr_usd > 50000000""",
    "quality_issues": f"""{_WITH}, {_DIM_ROWS}, {_ISSUE_ROWS}
        SELECT {_ISSUE_ID} AS issue_id, 'run' AS pipeline_run_id, * FROM raised""",
    "article_text": _ARTICLE_TEXT,
    "tfidf_vocabulary": _TFIDF + " SELECT term, idx, corpus_count, document_frequency, round(idf, 6) AS idf FROM vocabulary",
    "tfidf_weights": _TFIDF + " SELECT CAST(doc_id AS VARCHAR) AS article_id, term, round(weight, 6) AS weight FROM weights",
    "semantic_search": _search(),
    "hybrid_search": _search(_HYBRID_WHERE),
    "similar_documents": f"""{_TFIDF},
pairs AS (
  SELECT a.doc_id AS s, b.doc_id AS m, sum(a.weight * b.weight) AS score FROM weights a JOIN weights b USING (term) GROUP BY 1, 2
),
top AS (
  SELECT a.doc_id AS s, b.doc_id AS m, round(coalesce(score, 0.0), 8) AS score,
         row_number() OVER (PARTITION BY a.doc_id ORDER BY round(coalesce(score, 0.0), 8) DESC, b.doc_id) AS r
  FROM documents a JOIN documents b ON a.doc_id <> b.doc_id LEFT JOIN pairs ON s = a.doc_id AND m = b.doc_id
  QUALIFY r <= {rules.NEIGHBOURS}
)
SELECT CAST(s AS VARCHAR) AS source_article_id, CAST(m AS VARCHAR) AS similar_article_id,
       CAST(r AS INTEGER) AS similarity_rank, score AS similarity_score FROM top""",
    "similar_topn": _VECTOR_TOP + """ SELECT s AS source_article_id, m AS similar_article_id,
        CAST(r AS INTEGER) AS similarity_rank, score AS similarity_score FROM top""",
    "similar_list": _VECTOR_TOP + """ SELECT s AS article_id,
        '[' || string_agg(CAST(m AS VARCHAR), ',' ORDER BY r) || ']' AS top_similar_articles FROM top GROUP BY s""",
    "normalize_vectors": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        s AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS norm FROM e)
        SELECT vec_id AS article_id, CAST(i - 1 AS INTEGER) AS at, round(x[i] / norm, 8) AS value
        FROM (SELECT vec_id, x, norm, unnest(range(1, len(x) + 1)) AS i FROM s)""",
    "vector_profile": """WITH e AS (SELECT CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
        SELECT count(*) AS vectors, CAST(min(len(x)) AS INTEGER) AS min_dimension, CAST(max(len(x)) AS INTEGER) AS max_dimension,
        round(min(sqrt(list_inner_product(x, x))), 6) AS min_norm, round(max(sqrt(list_inner_product(x, x))), 6) AS max_norm,
        count(*) FILTER (WHERE len(list_filter(x, lambda v: NOT isfinite(v))) > 0) AS non_finite FROM e""",
    "article_search": f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
        SELECT b.vec_id AS article_id, round(list_inner_product(a.x, b.x), 8) AS similarity_score,
        CAST(b.label AS VARCHAR) AS company_name FROM e a JOIN e b ON a.vec_id = 7 AND b.vec_id <> 7
        ORDER BY similarity_score DESC, article_id LIMIT {TOP_K}""",
    "search_alignment": """SELECT coalesce(doc_id, vec_id) AS article_id FROM documents FULL JOIN embeddings ON doc_id = vec_id
        WHERE doc_id IS NULL OR vec_id IS NULL""",
    "validation_report": f"""{_WITH}, {_ARR_ROWS}, {_DIM_ROWS}
        SELECT 'dim_company_id_unique' AS check_name, count(*) - count(DISTINCT company_id) AS violations FROM dim
        UNION ALL SELECT 'fact_article_id_unique', count(*) - count(DISTINCT article_id) FROM t
        UNION ALL SELECT 'arr_observation_id_unique', count(*) - count(DISTINCT arr_observation_id) FROM a
        UNION ALL SELECT 'arr_article_exists', count(*) FROM a WHERE article_id NOT IN (SELECT article_id FROM t)
        UNION ALL SELECT 'arr_company_exists', count(*) FROM a WHERE company_id NOT IN (SELECT company_id FROM dim)
        UNION ALL SELECT 'arr_usd_positive', count(*) FROM a WHERE arr_usd <= 0
        UNION ALL SELECT 'source_rows_contiguous', CAST(max(ok) - min(ok) + 1 <> count(*) OR min(ok) <> 0 AS BIGINT) FROM t""",
    "validation_violations": """
        WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders), n AS (SELECT count(*) + count(*) FILTER (k % 1000 = 1) AS articles,
          sum(CASE WHEN k % 50 = 0 THEN 2 ELSE 3 END) AS links FROM o)
        SELECT 'dim_company_id_unique' AS check_name, count(*) AS violations FROM customer WHERE c_custkey % 100 = 1
        UNION ALL SELECT 'fact_article_id_unique', count(*) FROM o WHERE k % 1000 = 1
        UNION ALL SELECT 'arr_observation_id_unique', count(*) FROM o WHERE k % 300 = 0
        UNION ALL SELECT 'arr_article_exists', count(*) FROM o WHERE k % 21 = 0
        UNION ALL SELECT 'arr_company_exists', count(DISTINCT k % 10) FROM o WHERE k % 33 = 0
        UNION ALL SELECT 'arr_usd_positive', count(*) + count(*) FILTER (k % 300 = 0) FROM o WHERE k % 15 = 0
        UNION ALL SELECT 'source_rows_contiguous', 1
        UNION ALL SELECT 'bridge_row_count', CAST(abs(links - articles * 3) AS BIGINT) FROM n
        UNION ALL SELECT 'article_has_vector', count(*) FROM o WHERE k % 90 = 0
        UNION ALL SELECT 'vector_has_article', count(*) FROM o WHERE k % 400 = 2
        UNION ALL SELECT 'vector_article_id_unique', count(*) FROM o WHERE k % 700 = 5 AND k % 90 <> 0
        UNION ALL SELECT 'vector_shape_and_finite', count(*) + count(*) FILTER (k % 700 = 5) FROM o
          WHERE k % 60 IN (7, 8) AND k % 90 <> 0""",
    "input_fingerprint": "SELECT count(*) AS row_count, 1 AS same FROM orders",
    "publish_roundtrip": f"""{_WITH}, {_DIM_ROWS}, {_ISSUE_ROWS}
        {_PUBLISHED_ROWS}""",
    "run_metrics": f"""{_WITH}, {_DIM_ROWS}, {_ISSUE_ROWS}
        SELECT *, 'SUCCEEDED' AS status, CAST(NULL AS VARCHAR) AS message FROM ({_PUBLISHED_ROWS}
          UNION ALL SELECT 'quality_metric', (SELECT count(*) FROM ({_QUALITY_METRICS}))
          UNION ALL SELECT unnest(['input_articles', 'input_lineage', 'input_vectors']), (SELECT count(*) FROM t)
          UNION ALL SELECT 'input_company_master', count(*) FROM customer WHERE c_custkey % 10 <> 9
          UNION ALL SELECT 'input_aliases', count(*) FROM customer
          UNION ALL SELECT 'input_ambiguous', count(*) FROM customer WHERE c_custkey % 50 = 9)
        UNION ALL SELECT 'run', NULL, 'FAILED', 'ContractError: article input is missing columns: revenue'""",
    "csv_mirror": f"""{_WITH}, {_ARR_ROWS} SELECT article_id, company_id, CAST(observation_date AS VARCHAR) AS observation_date,
        CAST(observation_quarter AS VARCHAR) AS observation_quarter, CAST(arr_usd AS VARCHAR) AS arr_usd, revenue_raw, source_currency FROM a""",
    "catalog_views": f"""{_WITH}, {_ARR_ROWS}, {_DIM_ROWS}, dated AS (SELECT * FROM a WHERE observation_status = 'DATED'), l AS (
          SELECT company_id, observation_date, arr_usd FROM dated
          QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY observation_date DESC, article_id DESC) = 1
        ), q AS (
          SELECT company_id, count(DISTINCT observation_year * 4 + observation_quarter) AS quarters, max(arr_usd) AS most_reported FROM dated GROUP BY 1
        )
        SELECT company_name, CAST(observation_date AS VARCHAR) AS observation_date, arr_usd, quarters, most_reported
        FROM l JOIN dim USING (company_id) JOIN q USING (company_id)""",
    "csv_lineage": _WITH + " SELECT article_id, row_number() OVER (ORDER BY ok % 4, ok) + 1 AS source_row_number, TRUE AS named FROM t",
    "json_master": f"""SELECT c_name AS company_name, CAST(1980 + c_custkey % 25 AS INTEGER) AS founded_year, c_mktsegment AS headquarters,
        CAST({_EMPLOYEES.format(x="c_custkey")} AS INTEGER) AS employee_count, {_INDUSTRY_LABEL.format(x="c_custkey")} AS industry,
        c_custkey % 2 = 0 AS is_public, {_TICKER.format(x="c_custkey")} AS stock_ticker,
        '[' || concat_ws(',', CASE WHEN c_custkey % 8 = 5 THEN '"employee_count"' END, CASE WHEN c_custkey % 3 = 2 THEN '"stock_ticker"' END)
          || ']' AS missing_fields FROM customer WHERE c_custkey % 10 <> 9""",
    "postings_search": _search(),
    "postings_hybrid": _search(_HYBRID_WHERE),
    # Published vectors are single precision.
    "published_search": "SELECT article_id, similarity_score, title FROM ("
        + _search().replace("sum(w.weight * q.weight)", "sum(CAST(CAST(w.weight AS FLOAT) AS DOUBLE) * q.weight)") + ")",
    "incremental_run": _WITH + """ SELECT article_id, CASE WHEN ok % 50 = 3 THEN 'INSERTED' WHEN c = 7 THEN 'UPDATED' ELSE 'UNCHANGED' END AS change,
          arr_usd, source_currency, lower_bound_source, upper_bound_source, arr_parse_status, arr_parse_reason FROM t
        UNION ALL SELECT 'OLD' || article_id, 'DELETED', NULL, NULL, NULL, NULL, NULL, NULL FROM t WHERE ok % 90 = 5""",
    "vector_cache": f"""{_TFIDF}, a AS ({_ARTICLE_TEXT}), e AS (
          SELECT text, CASE WHEN CAST(article_id AS BIGINT) % 3 = 0 THEN text || ' earlier' ELSE text END AS earlier FROM a
        )
        SELECT CAST(doc_id AS VARCHAR) AS article_id, CAST(count(weight) AS INTEGER) AS terms, round(coalesce(sum(weight), 0.0), 6) AS total,
          (SELECT count(DISTINCT earlier) FROM e) AS encoded_first,
          (SELECT count(DISTINCT text) FROM e WHERE text NOT IN (SELECT earlier FROM e)) AS encoded_second
        FROM documents LEFT JOIN weights USING (doc_id) GROUP BY doc_id""",
}
