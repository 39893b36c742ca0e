"""Versioned business rules.

Everything here is a default: each function that uses a rule takes it as a parameter.
"""

# --- fixed values: results must agree with published outputs, so these are stated as given ---

PIPELINE_VERSION = "1.0.0"
ARR_PARSER_VERSION = "1.0.0"
CATEGORY_MAPPING_VERSION = "1.0.0"
COMPANY_ALIAS_VERSION = "1.0.0"

# UUIDv5 namespaces.
COMPANY_NAMESPACE = "f34c9717-0844-42e7-b1f3-22d29d332dd1"
ARR_NAMESPACE = "0f7f50c4-ddb2-437f-976b-6cfa447d42fc"
ISSUE_NAMESPACE = "82116fcb-14e3-4a62-9a9e-d15451690cab"

CURRENCY_SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY"}
USD_PER_UNIT = {"USD": "1", "EUR": "1.1", "GBP": "1.27"}
UNITS_PER_USD = {"JPY": 150}
SCALE_WORDS = {
    "k": 1_000,
    "thousand": 1_000,
    "m": 1_000_000,
    "million": 1_000_000,
    "b": 1_000_000_000,
    "billion": 1_000_000_000,
}

MISSING_MARKERS = ("", "n/a", "na", "null", "none", "nan", "missing")
UNDISCLOSED_MARKERS = ("not disclosed", "undisclosed")

UNMAPPED = "UNMAPPED"
CATEGORY_CODES = {
    "ai/ml": "AI_ML",
    "ai & ml": "AI_ML",
    "artificial intelligence": "AI_ML",
    "machine learning": "AI_ML",
    "cloud": "CLOUD",
    "cloud computing": "CLOUD",
    "cloud services": "CLOUD",
    "fintech": "FINTECH",
    "financial technology": "FINTECH",
    "finance": "FINTECH",
    "security": "CYBERSECURITY",
    "infosec": "CYBERSECURITY",
    "cybersecurity": "CYBERSECURITY",
    "analytics": "DATA_ANALYTICS",
    "data analytics": "DATA_ANALYTICS",
    "big data": "DATA_ANALYTICS",
    "saas": "SOFTWARE_SAAS",
    "software": "SOFTWARE_SAAS",
    "enterprise software": "SOFTWARE_SAAS",
}
INDUSTRY_CODES = {
    "ai/ml": "AI_ML",
    "cloud computing": "CLOUD",
    "fintech": "FINTECH",
    "cybersecurity": "CYBERSECURITY",
    "data analytics": "DATA_ANALYTICS",
    "saas": "SOFTWARE_SAAS",
}

# Reviewed by hand; aliases are never inferred from data.
COMPANY_ALIASES = {
    "AWS": "Amazon Web Services",
    "Amazon Web Services (AWS)": "Amazon Web Services",
    "Microsoft Azure": "Microsoft",
    "Azure": "Microsoft",
    "DeepMind": "Google DeepMind",
    "Google Deepmind": "Google DeepMind",
    "Meta AI Research": "Meta AI",
    "Facebook AI Research": "Meta AI",
    "Nvidia": "NVIDIA",
    "NVIDIA Corporation": "NVIDIA",
    "Open AI": "OpenAI",
    "OpenAI Inc.": "OpenAI",
    "Databricks Inc.": "Databricks",
    "Snowflake Inc.": "Snowflake",
    "Stripe Inc.": "Stripe",
    "CloudFlare": "Cloudflare",
    "Data Robot": "DataRobot",
    "Mongo DB": "MongoDB",
    "Palantir Technologies": "Palantir",
}
AMBIGUOUS_COMPANY_NAMES = ("The Boring Company / SpaceX",)

MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# Company size bands by employee count.
SMALL_BELOW = 10_000
MEDIUM_UP_TO = 30_000

# Export window and floor.
EXPORT_TAG = "AI_ML"
EXPORT_YEARS = (2022, 2024)
EXPORT_MIN_USD = 50_000_000

# Rates of a run: WARN below the first, FAIL below the second, FAIL if it falls by more than the third (None: by any).
QUALITY_THRESHOLDS = {
    "match_rate": (0.8, 0.0, None),
    "arr_parse_rate": (0.5, 0.0, None),
    "date_parse_rate": (0.5, 0.0, None),
    "category_mapped_rate": (0.5, 0.0, None),
}

VOCABULARY_SIZE = 384
NEIGHBOURS = 3

# Spark's own default English stop-word list.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)
STOP_WORDS_VERSION = "spark-english-181"
