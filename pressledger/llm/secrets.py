"""Secret scans: fixed patterns, and a randomness test battery under false-discovery control.

Fixed patterns give the base spans. Every other long run of token characters is a candidate. Its encoding is
inferred (hexadecimal, base 32, lower-case or mixed alphanumeric, base 64), and three tests ask how well it fits uniform
characters of that alphabet: chi-squared on the counts of symbols, a runs test on symbols above and below the
alphabet's middle, and serial correlation of neighbouring symbols. Fisher's method combines them to one fit.

Prose is what a discovery must be told from, so long words made of letters alone give the null distribution of the fit, per
length class: a fixed number of letter sequences drawn by the letters' usual frequencies, the same for every table, and all
such words of all documents. Without long words the fixed ones alone speak, so no table is too small for the method. A candidate's p-value is the share of the null that fits as well; the
Benjamini-Hochberg step-up is applied within each length class, since short runs carry little evidence. Counts of
fits in bins are all that is gathered for that. A run of letters alone is never a discovery.

Contract. ``scan_secrets`` returns ``doc_id, spans`` per input row: an array of (start, end, kind), in code points with
exclusive ends, sorted by start, then kind as listed (assign, access, hex, random); random spans never overlap others. A
null or empty text has none. Rows that repeat an id are scanned each by itself. Only ``doc_id`` and ``text`` are
read. Nothing is grouped by document or source.
"""

import functools
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressledger.llm.common import checkpointed

KINDS = ("assign", "access", "hex", "random")
#: The base patterns, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Alphabets by name, the narrowest first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "abcdefghijklmnopqrstuvwxyz0123456789",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: Lower ends of the length classes, bins of the fit, and the share of false discoveries per class.
CLASSES = (16, 20, 24, 32, 48)
BINS = 200
FALSE_SHARE = 0.05

#: How often the letters a to z come in English, in units of 0.01 %.
LETTERS = (817, 149, 278, 425, 1270, 223, 202, 609, 697, 15, 77, 403, 241, 675, 751, 193, 10, 599, 633, 906, 276, 98, 236, 15, 197, 7)
#: Letter sequences of the fixed null per length class.
FIXED_WORDS = 2_000

_sets = {name: frozenset(x) for name, x in ALPHABETS.items()}
_places = {name: {c: i for i, c in enumerate(x)} for name, x in ALPHABETS.items()}


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared by the Wilson-Hilferty cube root."""
    if df <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def encoding(run: str) -> str:
    chars = set(run)
    return next((name for name, own in _sets.items() if chars <= own), "base64")


def randomness(run: str) -> float:
    """How well a run fits uniform characters of its alphabet: 0 to 1, by three tests combined."""
    run = run.rstrip("=")
    place = _places[encoding(run)]
    k, n = len(place), len(run)
    x = np.array([place[c] for c in run], dtype=np.float64)
    counts = np.bincount(x.astype(np.int64), minlength=k)
    uniform = _chi2_tail(float(((counts - n / k) ** 2).sum() * k / n), k - 1)
    above = x >= k / 2
    up = int(above.sum())
    down = n - up
    if up and down:
        mean = 1 + 2 * up * down / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / max(n - 1, 1), 1e-9))
        runs = _two_sided((1 + int((above[1:] != above[:-1]).sum()) - mean) / spread)
    else:
        runs = 2.0 ** (1 - n)
    centred = x - (k - 1) / 2
    serial = _two_sided(float((centred[1:] * centred[:-1]).sum()) / (math.sqrt(n - 1) * (k * k - 1) / 12)) if n > 1 else 1.0
    statistic = -2 * sum(math.log(max(p, 1e-300)) for p in (uniform, runs, serial))
    half = statistic / 2
    return math.exp(-half) * (1 + half + half * half / 2)


def length_class(n: int) -> int:
    return sum(n >= x for x in CLASSES) - 1


@functools.cache
def fixed_null(each: int = FIXED_WORDS) -> dict[int, int]:
    """Counts by class and bin of letter sequences drawn by the usual frequencies, lengths spread over the class; ever the same."""
    rng, out = random.Random(1), Counter()
    for own, (low, high) in enumerate(zip(CLASSES, (*CLASSES[1:], 2 * CLASSES[-1]), strict=True)):
        for i in range(each):
            run = "".join(rng.choices(string.ascii_lowercase, LETTERS, k=low + i % (high - low)))
            out[own * BINS + min(BINS - 1, int(randomness(run) * BINS))] += 1
    return dict(out)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def scan_text(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, int, int]], list[int]]:
    """Base spans; candidates with length class and bin of their fit; null bins of long words."""
    base = sorted(base_spans(text), key=lambda s: (s[0], KINDS.index(s[2])))
    candidates, null = [], []
    for m in CANDIDATE.finditer(text):
        run = m.group()
        own = length_class(len(run))
        fit = lambda: min(BINS - 1, int(randomness(run) * BINS))  # noqa: B023, E731
        if run.isalpha():
            null.append(own * BINS + fit())
        elif any(c.isdigit() for c in run) and any(c.isalpha() for c in run):
            if not any(s[0] < m.end() and m.start() < s[1] for s in base):
                candidates.append((m.start(), m.end(), own, fit()))
    return base, candidates, null


_SCANNED = "doc_id long, base array<struct<start:int,end:int,kind:string>>, found array<struct<start:int,end:int,cell:int>>, words array<int>"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    cand = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cell", pa.int32())]))
    for whole in batches:
        for at in range(0, len(whole), 512):
            batch = whole.slice(at, 512)
            base, found, null = zip(*(scan_text(t or "") for t in batch.column(1).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in base], span),
                pa.array([[{"start": s, "end": e, "cell": c * BINS + b} for s, e, c, b in x] for x in found], cand),
                pa.array(null, pa.list_(pa.int32())),
            ], names=["doc_id", "base", "found", "words"])


def discoveries(candidates: dict[int, int], null: dict[int, int], share: float = FALSE_SHARE) -> dict[int, int]:
    """The lowest bin accepted per length class; classes without discoveries are left out.

    The p-value of a bin is (1 + null at or above) / (1 + null); step-up: the lowest bin whose p-value is at most
    share x candidates at or above / candidates.
    """
    out = {}
    for own in range(len(CLASSES)):
        cells = range(own * BINS, (own + 1) * BINS)
        total, words = sum(candidates.get(c, 0) for c in cells), sum(null.get(c, 0) for c in cells)
        above = words_above = 0
        for b in range(BINS - 1, 0, -1):
            above += candidates.get(own * BINS + b, 0)
            words_above += null.get(own * BINS + b, 0)
            if above and (1 + words_above) / (1 + words) <= share * above / total:
                out[own] = b
    return out


def _lowest(counts: list, share: float) -> dict[int, int]:
    """From rows of cell, candidate, count: classes x bins x 2 at most. The fixed null joins that of the table."""
    candidates, words = ({r["cell"]: r["count"] for r in counts if r["candidate"] is kind} for kind in (True, False))
    return discoveries(candidates, Counter(words) + Counter(fixed_null()), share)


def scan_secrets(docs: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """doc_id, spans for every input row; see the module's contract."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = checkpointed(rows.mapInArrow(_scanned, _SCANNED))
    found = seen.select(F.explode("found.cell").alias("cell"), F.lit(True).alias("candidate"))
    words = seen.select(F.explode("words").alias("cell"), F.lit(False).alias("candidate"))
    lowest = _lowest(found.union(words).groupBy("cell", "candidate").count().collect(), share)

    def accepted(x: Column) -> Column:
        out = F.lit(False)
        for own, low in sorted(lowest.items()):
            out = out | x["cell"].between(own * BINS + low, (own + 1) * BINS - 1)
        return out

    added = F.transform(F.filter("found", accepted), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit("random").alias("kind")))
    rank = F.array(*map(F.lit, KINDS))
    placed = F.transform(F.concat("base", added), lambda x: F.struct(x["start"].alias("start"), F.array_position(rank, x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    spans = F.transform(F.array_sort(placed), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return seen.select("doc_id", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def lowest_bins(docs: DataFrame, share: float = FALSE_SHARE) -> dict[int, int]:
    """The lowest accepted bin of each length class, from all documents; gathers counts by class and bin only."""
    seen = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scanned, _SCANNED)
    cells = seen.select(F.explode(F.concat(
        F.transform("found", lambda x: F.struct(x["cell"].alias("cell"), F.lit(True).alias("candidate"))),
        F.transform("words", lambda x: F.struct(x.alias("cell"), F.lit(False).alias("candidate"))),
    )).alias("c"))
    return _lowest(cells.groupBy("c.cell", "c.candidate").count().collect(), share)


def redact_text(text: str | None, lowest: dict[int, int]) -> str | None:
    """The text with every secret replaced by its kind in brackets; overlapping ones by the kind that starts first."""
    if not text:
        return text
    base, found, _ = scan_text(text)
    spans = sorted([*base, *((s, e, "random") for s, e, own, b in found if own in lowest and b >= lowest[own])], key=lambda x: (x[0], KINDS.index(x[2])))
    out, upto = [], 0
    for start, end, kind in spans:
        if start >= upto:
            out += (text[upto:start], f"[{kind}]")
        upto = max(upto, end)
    return "".join((*out, text[upto:]))


def redact_secrets(docs: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """All rows and columns; secrets in ``text`` are replaced, and ``n_chars``, where there is one, is counted anew."""
    lowest = lowest_bins(docs, share)

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        return pd.Series([redact_text(t if isinstance(t, str) else None, lowest) for t in texts], dtype=object)

    new = docs.withColumn("text", redact(F.col("text").cast("string")))
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else new
