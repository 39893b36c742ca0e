"""Quality rules by distribution divergence, with DataFrame functions only.

Each language of the corpus gets two references: its histogram over character classes, and one over bins of its most
common short words, by rank. A document's histograms are compared to every language's by Jensen-Shannon distance
(base 2, 0 to 1); it fails if, for the language that fits best, characters or words lie too far away. Short texts scatter
more, so each comparison has a least length below which it says nothing. References are sums over all documents
that pass the base rules; the common words are counted over all documents. Every language has its references; beyond
``GROUP`` of them each further group is one more pass over the common words, not the texts, and the best fit is carried on.

Contract. ``rate_quality`` returns per input row ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
base_failed, kept`` and the distances ``char_distance, word_distance`` (null where the guard holds). A null text is empty: all counts 0,
base_failed. A null language gives no reference. Without any reference the base rules decide alone. Rows that
repeat an id are rated each by itself. Only ``doc_id``, ``text`` and ``lang`` are read. Repeated windows are told by 64-bit
hashes inside one document. Nothing is grouped but counts per language and word, summed before the shuffle.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressledger.llm.common import BLANK, WORD, checkpointed

#: Common words per language, by rank: up to these ranks per bin; at most so many characters; languages compared in one pass.
BINS = (2, 6, 14, 30)
SHORT = 4
GROUP = 32
#: Least lengths: characters for the class histogram, words for the common-word histogram.
LEAST_CHARS, LEAST_WORDS = 200, 50
CHAR_LIMIT, WORD_LIMIT, WORD_SCATTER = 0.28, 0.16, 0.8
COUNTS = ["doc_id", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
#: Symbols of the base rule.
SYMBOLS = "[#*$%&|<>]"
#: Character classes counted; what is left of a text, chiefly a to z, is one more.
CLASSES = {"mark": r"[!\x22'()+,./:;=?@\[\\\]^_`{}~-]", "upper": "[A-Z]", "digit": "[0-9]", "other": r"[^\x00-\x7F]"}


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that later expressions read them instead of repeating their work."""
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def common_words(docs: DataFrame) -> dict[str, list[str]]:
    """The most common short words of each language, most common first."""
    short = F.filter(words_of(F.lower("text")), lambda w: F.length(w) <= SHORT)
    counts = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", F.explode(short).alias("word"))
    counts = checkpointed(counts.groupBy("lang", "word").agg(F.count("*").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= BINS[-1])
    out: dict[str, list[str]] = {}
    for r in best.orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["word"])
    return out


def bin_counts(group: list[list[str]]) -> dict[str, Column]:
    """Per language of a group and bin, how many of the known words fall into it."""
    return {f"w_{k}_{b}": _in_set("known", own[i:j]) for k, own in enumerate(group) for b, (i, j) in enumerate(zip((0, *BINS), BINS))}


def measures(docs: DataFrame, common: dict[str, list[str]]) -> DataFrame:
    """Base counts, character classes, and per language and bin the common words of every document.

    The bins are those of the first group of languages; if there are more, the common words are kept for them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = _once(docs.select("doc_id", "lang", text.alias("text")), ["doc_id", "lang", "text"], words=words_of(F.col("text")))
    windows = F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))
    every = sorted({x for own in common.values() for w in own for x in (w, w.capitalize(), w.upper())})
    known = F.filter("words", lambda w: w.isin(every)) if every else F.array().cast("array<string>")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    rows = _once(
        rows, ["doc_id", "lang"], n_words=F.size("words").cast("long"), windows=windows, known=F.transform(known, F.lower), lines=lines,
        n_chars=F.length("text").cast("long"), n_blanks=_count(F.col("text"), BLANK), n_symbols=_count(F.col("text"), SYMBOLS),
        **{f"c_{k}": _count(F.col("text"), p) for k, p in CLASSES.items()},
    )
    # Equal windows lie side by side once sorted; a document without any is not sorted.
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(placed)).otherwise(none)
    counts = ["doc_id", "lang", "n_words", "n_chars", "n_blanks", "n_symbols", *(f"c_{k}" for k in CLASSES)]
    bins = bin_counts(list(common.values())[:GROUP])
    if len(common) > GROUP:
        bins["known"] = F.col("known")
    rows = _once(
        rows, counts, ordered=ordered, n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"), **bins,
    )
    twice = F.filter("ordered", lambda x, k: (F.get("ordered", k - 1)["h"] == x["h"]) | (F.get("ordered", k + 1)["h"] == x["h"]))
    rows = _once(rows, [*counts, "n_dup_lines", *bins], starts=F.sort_array(F.transform(twice, lambda x: x["i"])))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate("starts", zero, lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return rows.select(*counts, "n_dup_lines", *bins, covered.alias("n_repeat_words"), (F.col("n_chars") - F.col("n_blanks")).alias("word_chars"))


def _in_set(array: str, words: list[str]) -> Column:
    return F.size(F.filter(array, lambda w: w.isin(words) if words else F.lit(False))).cast("long")


def _shares(parts: list[Column], total: Column) -> Column:
    """Shares of the parts of a total, and of the rest, as an array."""
    rest = total
    for p in parts:
        rest = rest - p
    whole = F.greatest(total, F.lit(1)).cast("double")
    return F.transform(F.array(*parts, F.greatest(rest, F.lit(0))), lambda x: x / whole)


def divergence(own: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of two arrays of shares, base 2."""
    def part(p: Column, q: Column) -> Column:
        mid = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / mid)).otherwise(0.0)

    parts = F.zip_with(own, F.array(*map(F.lit, reference)), part)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _class_columns() -> list[Column]:
    return [F.col("n_blanks"), F.col("n_symbols"), *(F.col(f"c_{k}") for k in CLASSES)]


def _bin_columns(k: int) -> list[Column]:
    return [F.col(f"w_{k}_{b}") for b in range(len(BINS))]


def _fitted(rows: DataFrame, group: list[str], keep: list[str]) -> DataFrame:
    """The columns to keep, and the best fit so far or among a group of languages, whose bins the rows have."""
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate([F.col("n_chars"), F.col("n_words"), *_class_columns()])]
    sums += [F.sum(c).alias(f"b{k}_{b}") for k in range(len(group)) for b, c in enumerate(_bin_columns(k))]
    found = {r["lang"]: r for r in rows.where(~F.col("base_failed") & F.col("lang").isin(group)).groupBy("lang").agg(*sums).collect()} if group else {}
    shares = {"class_shares": _shares(_class_columns(), F.col("n_chars"))}
    shares |= {f"bin_shares_{k}": _shares(_bin_columns(k), F.col("n_words")) for k in range(len(group))}
    rows = _once(rows, [*keep, "best"], **shares)
    choices = [F.col("best")]
    for k, lang in enumerate(group):
        r = found.get(lang)
        if r is None or not r["s0"] or not r["s1"]:
            continue
        classes = [r[f"s{i}"] / r["s0"] for i in range(2, 2 + len(_class_columns()))]
        bins = [r[f"b{k}_{b}"] / r["s1"] for b in range(len(BINS))]
        chars = divergence(F.col("class_shares"), [*classes, max(0.0, 1 - sum(classes))])
        words = divergence(F.col(f"bin_shares_{k}"), [*bins, max(0.0, 1 - sum(bins))])
        choices.append(F.struct((chars + words).alias("both"), chars.alias("chars"), words.alias("words")))
    return _once(rows, keep, best=F.array_min(F.array(*choices)))


def rate_quality(docs: DataFrame, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, word_scatter: float = WORD_SCATTER) -> DataFrame:
    """Counts, distances and verdict for every input row; see the module's contract."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    common = common_words(docs)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = checkpointed(measures(docs, common).withColumn("base_failed", failed))
    languages = list(common)
    null = F.lit(None).cast("struct<both:double,chars:double,words:double>")
    kept = [c for c in rows.columns if not c.startswith("w_")]
    rows = rows.withColumn("best", null)
    for at in range(0, max(1, len(languages)), GROUP):
        group, last = languages[at : at + GROUP], at + GROUP >= len(languages)
        if at:
            rows = checkpointed(_once(rows, [*kept, "best"], **bin_counts([common[x] for x in group])))
        rows = _fitted(rows, group, COUNTS if last else kept)
    rows = rows.withColumns({
        "_c": F.when(F.col("n_chars") >= LEAST_CHARS, F.col("best.chars")),
        "_w": F.when(F.col("n_words") >= LEAST_WORDS, F.col("best.words")),
    })
    # Words of a short text scatter about their shares by the root of their number.
    word_limit = F.lit(word_limit) + F.lit(word_scatter) / F.sqrt(F.greatest("n_words", F.lit(1)))
    near = F.coalesce(F.col("_c") <= char_limit, F.lit(True)) & F.coalesce(F.col("_w") <= word_limit, F.lit(True))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), F.col("_c").alias("char_distance"), F.col("_w").alias("word_distance"),
    )
