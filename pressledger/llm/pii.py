"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose spans: the four base kinds (email, ip, card, phone), and looser ones (numbers of seven to nineteen
digits in usual formats; written-out addresses such as "name (at) host (dot) net"). Labelers vote on each: strict pattern,
digit count, grouping, gazetteers (address endings, card issuers, calling codes with the lengths of their numbers), words
before it, and signs against it (part of a longer token, words such as "version" or "isbn"). How often each pattern of votes occurs,
over all documents, is a small table; expectation-maximisation on it estimates every labeler's reliability without labels, starting
from a weak belief that labelers are rather right than wrong, which decides only for labelers that hardly ever vote. A logistic
classifier is trained on the posteriors. It decides about the looser spans; after a word such as "page" only about those that
are written with a calling code, pass Luhn or are addresses, since a local number there is a page's. Base spans always stay. Labelers see the span, 24 characters before and one after it: not the topic, nor what a table's heading says.

Positions come from the lengths of what lies between matches, summed along a document. A match can't start inside
a run that its first part has already read, so the patterns begin with a look-behind (or where the last match ended) and read
runs possessively: results are those of the plain patterns, in time linear in the text, without recursion.

Contract. ``find_personal_data`` returns ``doc_id, spans`` per input row: an array of (kind, start, end) in code points,
exclusive ends, by kind as listed in ``KINDS``, then start. Null or empty texts have none. Base spans of different kinds may
overlap; looser ones overlap nothing. Rows that repeat an id are kept apart. Only ``doc_id`` and ``text`` are read.
"""

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressledger.llm.common import checkpointed

KINDS = ("email", "ip", "card", "phone", "number", "address")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: What proposes spans of each kind.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Telephone formats, runs and fours of card digits, three-two-four numbers; each also next to other numbers, where
    # the greedy base patterns take both for one and fail.
    "number": (
        r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20.-])?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
        r"|(?<![0-9])[0-9]{13,19}(?![0-9])|(?<![0-9])(?:[0-9]{4}[\x20-]){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
        r"|(?<![0-9])\+[0-9]{8,15}(?![0-9])"
        r"|(?<![0-9])\+[0-9]{1,3}\x20?\([0-9]{2,4}\)\x20?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"
    ),
    "address": rf"(?<!{_LOCAL}){_LOCAL}++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)++",
}
BASE = KINDS[:4]
#: Gazetteers and context words, in lower case.
ENDINGS = ("at", "be", "biz", "ca", "ch", "co", "com", "de", "edu", "es", "eu", "fr", "gov", "info", "io", "it", "net", "nl", "org", "uk", "us")
CONTEXT = (
    "account", "address", "adresse", "call", "card", "carte", "cell", "contact", "contacto", "correo", "credit", "e-mail", "email", "fax", "handy", "host",
    "ip", "iban", "karte", "kontakt", "konto", "mail", "mobile", "nummer", "phone", "ssn", "tel", "telefon", "telefono", "visa",
)
AGAINST = ("chapter", "figure", "isbn", "issn", "item", "model", "no", "page", "pages", "section", "seite", "table", "version", "vol", "year")
#: The zones of international calling codes, and how many digits a number has with its code.
CALLING = (
    (r"[17]", 11, 11),
    (r"(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])", 9, 13),
    (r"(?:2[1-69]|3[578]|42|5[09]|6[7-9]|8[0578]|9[679])[0-9]", 9, 14),
)
LABELERS = ("strict", "digits", "grouping", "gazetteer", "context", "joined", "against")
ACCEPT = 0.5
ROUNDS = 60
#: Imagined votes of each labeler on personal data: against, abstaining, for; turned round on what isn't.
BELIEF = (0.1, 0.5, 1.0)
RIDGE = 0.1


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass; counted from the right."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(turned, i, F.lit(1))) - 48
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def proposals(docs: DataFrame) -> DataFrame:
    """One row per proposed span, and one without a kind for a document that has none: row, doc_id, kind, start, end,
    span, and up to 24 characters before and one after it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    digit = F.col("text").rlike("[0-9]")
    guards = {
        "email": F.col("text").contains("@"), "ip": digit & F.col("text").contains("."), "card": digit, "phone": F.col("text").contains("+"),
        "number": digit, "address": F.col("text").contains("at)") | F.col("text").contains("at]"),
    }
    none = F.array().cast("array<string>")
    found = {k: F.when(guards[k], F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none) for k in KINDS}
    # A generator keeps these results from being worked out again wherever they are read.
    rows = rows.select("row", "doc_id", "text", F.inline(F.array(F.struct(*(c.alias(f"m_{k}") for k, c in found.items())))))
    gaps = {k: F.when(F.size(f"m_{k}") > 0, F.split("text", PATTERNS[k], -1)).otherwise(none) for k in KINDS}
    rows = rows.select("row", "doc_id", *(f"m_{k}" for k in KINDS), F.inline(F.array(F.struct(*(c.alias(f"g_{k}") for k, c in gaps.items())))))

    def spans(kind: str) -> Column:
        def one(span: Column, i: Column) -> Column:
            before, after = F.get(f"g_{kind}", i), F.get(f"g_{kind}", i + 1)
            return F.struct(
                F.lit(kind).alias("kind"), i.alias("i"), F.length(before).alias("gap"), span.alias("span"),
                F.right(before, F.lit(24)).alias("before"), F.left(after, F.lit(1)).alias("after"),
            )

        return F.transform(f"m_{kind}", one)

    rows = rows.select("row", "doc_id", F.explode_outer(F.concat(*(spans(k) for k in KINDS))).alias("s")).select("row", "doc_id", "s.*")
    order = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("span")).over(order)
    return rows.repartition("row").withColumn("end", end).select(
        "row", "doc_id", "kind", (F.col("end") - F.length("span")).alias("start"), "end", "span", "before", "after"
    )


def _part_of_ip(part: Column) -> Column:
    return part.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")


def judged(spans: DataFrame) -> DataFrame:
    """Add valid (the base rule of the kind), open (a looser span to decide on), and a vote per labeler: 1 for, -1 against, 0 abstains."""
    digits = F.regexp_replace("span", "[^0-9]", "")
    spans = spans.select(*spans.columns, F.inline(F.array(F.struct(digits.alias("digits"), F.split("span", r"\.").alias("parts"), F.lower("before").alias("lead")))))
    n = F.length("digits")
    kind = F.col("kind")
    valid = (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall("parts", _part_of_ip))
        .when(kind == "card", F.when(n.between(16, 19), _luhn(F.col("digits"))).otherwise(False))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(False)
    )
    word = F.regexp_extract("lead", r"([a-z-]+)[^a-z0-9]*$", 1)
    ending = F.lower(F.regexp_extract(F.right("span", F.lit(24)), r"([A-Za-z]+)$", 1))
    address = kind.isin("email", "address")
    issuer = F.col("digits").rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))")
    either = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    luhn = F.when(n.between(13, 19), _luhn(F.col("digits"))).otherwise(F.lit(False))
    written = F.col("span").rlike(r"^\+") & n.between(8, 15)
    called = F.col("span").rlike(r"^\+") & reduce(lambda a, b: a | b, (F.col("digits").rlike(f"^{zone}") & n.between(low, high) for zone, low, high in CALLING))
    votes = {
        "strict": either(valid | ((kind == "number") & (luhn | written)), ~address & ~valid & ((kind != "number") | (n >= 13))),
        "digits": F.when(address, 0).otherwise(either(n.isin(10, 11, 12, 16), (n < 9) & (kind == "number"))),
        "grouping": F.when(address, 0).otherwise(either(F.col("span").rlike(r"[0-9][\x20).-]{1,2}[0-9]{3,4}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.col("span").rlike(r"[(][^)]*$|[.][0-9]{1,2}$") & (kind == "number"))),
        "gazetteer": F.when(address, either(ending.isin(*ENDINGS), F.length(ending) < 2)).when(kind == "ip", either(~F.col("span").rlike("^0*0[.]"), F.lit(False))).otherwise(
            either((n.between(13, 19) & issuer) | called, F.col("span").rlike(r"^\+") & ~called)
        ),
        "context": either(word.isin(*CONTEXT), F.lit(False)),
        "joined": F.when(F.col("after").rlike("[A-Za-z0-9_]") | F.col("before").rlike("[A-Za-z0-9_=/#.-]$"), -1).otherwise(0),
        "against": F.when(word.isin(*AGAINST), -1).otherwise(0),
    }
    # Thirteen digits or more are a card's or nothing; so is a local number that a word like "page" announces.
    local = n.between(7, 12) & ~word.isin(*AGAINST)
    open_ = (kind == "address") | ((kind == "number") & (local | luhn | written))
    return spans.select("row", "doc_id", "kind", "start", "end", F.inline(F.array(F.struct(valid.alias("valid"), open_.alias("open"), *(v.alias(f"v_{k}") for k, v in votes.items())))))


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> tuple[dict[tuple[int, ...], float], list[list[list[float]]]]:
    """Expectation-maximisation over counted vote patterns: each pattern's posterior of being personal data, and the share of
    each vote (-1, 0, 1) by labeler and class. Starts from the majority of votes; BELIEF imagined votes a labeler and class,
    most of them right, stand beside the counted ones."""
    post = {p: 1 / (1 + math.exp(-2.0 * sum(p))) for p in patterns}
    tables: list[list[list[float]]] = []
    for _ in range(rounds):
        tables = []
        mass = [0.0, 0.0]
        for own in (0, 1):
            share = {p: n * (post[p] if own else 1 - post[p]) for p, n in patterns.items()}
            mass[own] = sum(share.values()) + 1.0
            imagined = BELIEF if own else BELIEF[::-1]
            whole = sum(share.values()) + sum(BELIEF)
            tables.append([[(sum(s for p, s in share.items() if p[k] == v) + imagined[v + 1]) / whole for v in (-1, 0, 1)] for k in range(len(LABELERS))])
        prior = math.log(mass[1] / mass[0])
        for p in patterns:
            logit = prior + sum(math.log(tables[1][k][v + 1]) - math.log(tables[0][k][v + 1]) for k, v in enumerate(p))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
    return post, tables


def classifier(patterns: dict[tuple[int, ...], int], post: dict[tuple[int, ...], float], rounds: int = 30) -> list[float]:
    """Logistic weights, constant first, on votes for and against as separate features; Newton's steps on counted patterns,
    so that a vote that is cast once in a million spans is weighed like any other."""
    known = sorted(patterns)
    x = np.array([[1.0, *(float(v > 0) for v in p), *(float(v < 0) for v in p)] for p in known])
    goal, n = np.array([post[p] for p in known]), np.array([patterns[p] for p in known], dtype=np.float64)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        hit = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (hit - goal)) + RIDGE * weights
        bend = (x * (n * np.maximum(hit * (1 - hit), 1e-6))[:, None]).T @ x + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
    return weights.tolist()


def find_personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, spans for every input row; see the module's contract."""
    spans = checkpointed(judged(proposals(docs)))
    named = spans.where(F.col("kind").isNotNull())
    counts = named.groupBy(*(f"v_{k}" for k in LABELERS)).agg(F.count("*").alias("n")).collect()  # at most 3^7 patterns
    patterns = {tuple(r[f"v_{k}"] for k in LABELERS): r["n"] for r in counts}
    score = F.lit(0.0)
    if patterns:
        weights = classifier(patterns, reliabilities(patterns)[0])
        score = F.lit(weights[0])
        for i, k in enumerate(LABELERS):
            score = score + weights[1 + i] * (F.col(f"v_{k}") > 0).cast("int") + weights[1 + len(LABELERS) + i] * (F.col(f"v_{k}") < 0).cast("int")
    # What a looser span must not touch: base spans, and looser ones that start before it.
    loose = F.coalesce(~F.col("kind").isin(*BASE), F.lit(False))
    chosen = F.col("valid") | (F.col("open") & (score >= math.log(accept / (1 - accept))))
    # A rejected span leaves its row behind, so that its document stays.
    taken = F.coalesce(F.col("kind").isNotNull() & chosen, F.lit(False))
    spans = spans.select("row", "doc_id", loose.alias("loose"), *(F.when(taken, F.col(c)).alias(c) for c in ("kind", "start", "end")))
    order = Window.partitionBy("row").orderBy("start", "loose", "kind", "end")
    spans = spans.withColumns({
        "_before": F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)),
        "_next": F.min(F.when(~F.col("loose"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing)),
    })
    clear = ~F.col("loose") | ((F.coalesce("_before", F.lit(0)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end")))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    kept = F.when(F.col("kind").isNotNull() & clear, F.struct(rank.alias("rank"), "start", "end", "kind"))
    out = spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(kept)).alias("s"))
    return out.select("doc_id", F.transform("s", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))
