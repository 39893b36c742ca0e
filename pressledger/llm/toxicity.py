"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posteriors.

Voters are lexicons (a fixed list of insults; words mined from labelled rows) and patterns
(mined word beginnings of four to six bytes; mined pairs of three-byte characters, for scripts without blanks; disguised insults; repeated
hits; hits per word; shouting). A feature is mined if its count among toxic rows is beyond chance by a likelihood-ratio test, however
small a share of them has it, so that more labels show rarer terms. Each votes
toxic, clean or abstains. A label model fitted by expectation-maximisation gives every voter a table of votes for both classes. Voters
that still agree once the class is accounted for are correlated; each is discounted by its conditional correlations,
so that near-copies of one voter don't count twice. A logistic regression is trained on the
posterior labels, with hits and votes as features, and scores every text.

The fit uses a bounded sample of labelled rows outside the held-out fold: at most about ``POSITIVES`` toxic and
``NEGATIVES`` clean ones, one per group of near copies (rows with one smallest 5-word shingle). Scoring reads every
text whole.

Contract. ``score_toxicity`` returns ``doc_id, held_out, score, predicted`` per input row. A null or empty text has no hits
and gets the score of an empty text. Without labelled rows only the fixed list and patterns speak. Rows that repeat
an id are scored each by itself; labels of a repeated id: toxic if any is; null labels are ignored. Only ``doc_id`` and ``text`` are
read, of labels ``doc_id`` and ``toxic``.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressledger.llm.common import _LOWER, ByteHashes, checkpointed, is_held_out, mix64, pieces, row_chunks, utf8
from pressledger.llm.neardup import shingle_sets

POSITIVES, NEGATIVES = 8_192, 16_384
#: Mined features kept; the least number of toxic sample rows that have one, and its least log-odds.
LEXICON, LEAST_ROWS, LEAST_ODDS = 4_096, 4, 3.0
#: A feature's log-likelihood ratio against equal shares among toxic and clean rows is at least log(features / LUCKY): of all
#: features seen, fewer than one is expected to pass by chance.
LUCKY = 5
THRESHOLD = 0.3
#: Insults in common use.
INSULTS = (
    "bastard", "bitch", "clown", "crap", "cretin", "cunt", "despicable", "dimwit", "disgusting", "dumb", "fool", "freak", "fuck", "garbage",
    "idiot", "imbecile", "jerk", "loser", "moron", "pathetic", "pig", "retard", "scum", "shit", "slut", "stupid", "trash", "vermin", "whore",
    "worthless",
)
#: Letters and what stands for them in disguised words.
DISGUISES = {"a": "4@", "e": "3", "i": "1!", "o": "0", "s": "5$", "t": "7"}

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MASKED = _WORD.copy()
_MASKED[[ord(c) for c in "4@31!05$7*"]] = True
_UNMASK = _LOWER.copy()
for _letter, _marks in DISGUISES.items():
    for _mark in _marks:
        _UNMASK[ord(_mark)] = ord(_letter)
PREFIXES = (4, 5, 6)
#: Kinds of features: whole words, beginnings by length, pairs of three-byte characters.
KINDS = 2 + len(PREFIXES)
CHARACTERS = KINDS - 1
VOTERS = (
    "insults", "disguised", "words", *(f"beginnings of {n}" for n in PREFIXES), "pairs of characters", "repeated", "dense", "shouting",
)
_SALT = mix64(np.arange(KINDS) + 500)


def _tokens(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = letters[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Kind, row and 64-bit hash of every word, word beginning and pair of three-byte characters of a chunk."""
    if not len(data):
        return
    rows, starts, ends = _tokens(data, offsets, _WORD)
    hashes = ByteHashes(_LOWER[data])
    yield 0, rows, hashes.of(starts, ends) ^ _SALT[0]
    for kind, n in enumerate(PREFIXES, 1):
        long = ends - starts > n
        yield kind, rows[long], hashes.of(starts[long], starts[long] + n) ^ _SALT[kind]
    lead = (data >= 0xE0) & (data < 0xF0)
    at = np.flatnonzero(lead[:-5] & lead[3:-2]) if len(data) > 5 else np.zeros(0, dtype=np.int64)
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 6 <= offsets[row + 1]
    at, row = at[inside], row[inside]
    yield CHARACTERS, row, hashes.of(at, at + 6) ^ _SALT[CHARACTERS]


def _hashes(words: tuple[str, ...]) -> np.ndarray:
    raw = "".join(words).encode()
    ends = np.cumsum([len(w) for w in words])
    return np.sort(pieces(np.frombuffer(raw, dtype=np.uint8), np.concatenate(([0], ends[:-1])), ends))


def _isin(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places in the sorted array of known values, or -1."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


@dataclass
class Lexicon:
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))  # sorted
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    insults: np.ndarray = field(default_factory=lambda: _hashes(INSULTS))

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: words, distinct insults, disguised insults, per kind of mined feature the distinct hits and summed
        odds, share of capitals, exclamation marks per word."""
        n = len(offsets) - 1
        out = np.zeros((n, 3 + 2 * KINDS + 2))
        if not len(data):
            return out
        for kind, rows, hashes in features(data, offsets):
            if kind == 0:
                out[:, 0] = np.bincount(rows, minlength=n)
                at = _isin(hashes ^ _SALT[0], self.insults)
                out[:, 1] = self._distinct(rows, at, len(self.insults), n)[0]
            at = _isin(hashes, self.hashes)
            out[:, 3 + 2 * kind], out[:, 4 + 2 * kind] = self._distinct(rows, at, len(self.hashes), n, self.odds)
        rows, starts, ends = _tokens(data, offsets, _MASKED)
        marks = np.concatenate(([0], np.cumsum(~_WORD[data])))
        mixed = marks[ends] - marks[starts]
        mixed = (mixed > 0) & (mixed < ends - starts)
        at = _isin(pieces(_UNMASK[data], starts[mixed], ends[mixed]), self.insults)
        out[:, 2] = self._distinct(rows[mixed], at, len(self.insults), n)[0]
        row = np.repeat(np.arange(n), np.diff(offsets))
        capitals = np.bincount(row, weights=(data >= 65) & (data <= 90), minlength=n)
        small = np.bincount(row, weights=(data >= 97) & (data <= 122), minlength=n)
        out[:, -2] = capitals / np.maximum(capitals + small, 1)
        out[:, -1] = np.bincount(row, weights=data == 33, minlength=n) / np.maximum(out[:, 0], 1)
        return out

    @staticmethod
    def _distinct(rows, at, size, n, odds=None):
        hit = at >= 0
        cells = np.unique(rows[hit] * max(size, 1) + at[hit])
        row, place = cells // max(size, 1), cells % max(size, 1)
        count = np.bincount(row, minlength=n)
        if odds is None:
            return count, None
        return count, np.bincount(row, weights=odds[place] if size else None, minlength=n)


def votes(evidence: np.ndarray) -> np.ndarray:
    """1 toxic, -1 clean, 0 abstains; one column per voter."""
    words, insults, disguised = evidence[:, 0], evidence[:, 1], evidence[:, 2]
    hits = evidence[:, 3 : 3 + 2 * KINDS : 2]
    long = words >= 20
    either = lambda yes, no: np.where(yes, 1, np.where(no, -1, 0))
    all_hits = insults + hits.sum(axis=1)
    columns = [either(insults > 0, False), either(disguised > 0, False)]
    # A text without three-byte characters says nothing about their pairs.
    columns += [either(hits[:, k] > 0, long & (k != CHARACTERS)) for k in range(KINDS)]
    columns += [either(all_hits >= 2, all_hits == 0), either(all_hits > 0.01 * np.maximum(words, 1), all_hits == 0)]
    columns += [either((evidence[:, -2] > 0.5) & (evidence[:, -1] > 0.2), False)]
    return np.stack(columns, axis=1).astype(np.int8)


def label_model(ballots: np.ndarray, start: np.ndarray, prior: float, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the toxic class per row, vote tables (class, voter, vote), and the weight of each voter.

    start: first posteriors. The correlation of two voters is that of their votes around the class means, weighted
    by the posterior; a voter's weight is 1 / (1 + sum of its positive correlations with others).
    """
    post = np.clip(start, 0.01, 0.99)
    n, k = ballots.shape
    one_hot = np.stack([ballots == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
    for _ in range(rounds):
        tables, cov = [], np.zeros((k, k))
        for own in (1 - post, post):
            table = (np.einsum("n,nkv->kv", own, one_hot) + 0.5) / (own.sum() + 1.5)
            tables.append(table)
            centred = ballots - (table[:, 2] - table[:, 0])
            cov += (centred * own[:, None]).T @ centred
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        rho = cov / np.outer(spread, spread)
        weight = 1 / (1 + np.maximum(rho, 0).sum(axis=1) - np.maximum(np.diag(rho), 0))
        gain = np.log(tables[1]) - np.log(tables[0])
        logit = np.log(prior / (1 - prior)) + np.einsum("nkv,kv,k->n", one_hot, gain, weight)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            post = new
            break
        post = np.clip(new, 1e-4, 1 - 1e-4)
    return post, np.stack(tables), weight


def inputs(evidence: np.ndarray) -> np.ndarray:
    """Features of the linear classifier, with a leading constant."""
    hits, sums = evidence[:, 3 : 3 + 2 * KINDS : 2], evidence[:, 4 : 4 + 2 * KINDS : 2]
    return np.concatenate((
        np.ones((len(evidence), 1)), np.log1p(evidence[:, 1:3]), np.log1p(hits), np.log1p(sums), np.log1p(evidence[:, :1]) / 10,
        (hits > 0), evidence[:, -2:], votes(evidence),
    ), axis=1)


def logistic(x: np.ndarray, goal: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights by damped Newton steps; goal: probabilities."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (goal - p) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-5:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(inputs(self.lexicon.evidence(data, offsets)) @ self.weights, -30, 30)))


def _default() -> Model:
    """Fixed list and patterns only: one insult gives a score of about 0.6."""
    weights = np.zeros(inputs(Lexicon().evidence(*utf8(pa.array(["a"])))).shape[1])
    weights[:3] = -4.0, 6.5, 6.5
    return Model(Lexicon(), weights)


def _group_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_chunks(offsets):
            rows, hashes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            low = np.zeros(j - i, dtype=np.uint64)
            first = np.concatenate(([True], rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, dtype=bool)
            low[rows[first]] = hashes[first]
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), *part.columns], names=["grp", "doc_id", "text", "toxic"])


def _mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature of some rows: how many toxic and clean ones have it."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        data, offsets = utf8(batch.column(0))
        for i, j in row_chunks(offsets):
            for _, rows, hashes in features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
                order = np.lexsort((rows, hashes))
                rows, hashes = rows[order], hashes[order]
                new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, dtype=bool)
                names, inverse = np.unique(hashes[new], return_inverse=True)
                yes = np.bincount(inverse, weights=toxic[i:j][rows[new]], minlength=len(names)).astype(np.int32)
                every = np.bincount(inverse, minlength=len(names)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(yes), pa.array(every - yes)], names=["feature", "yes", "no"])


def _evidence_rows(lexicon: Lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in row_chunks(offsets):
                found = lexicon.evidence(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in found], pa.binary()), batch.column(1).slice(i, j - i)], names=["e", "toxic"])

    return rows


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    """Learn from a bounded sample of the labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = {r["toxic"]: r["n"] for r in known.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if not total.get(1) or not total.get(0):
        return _default()
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) / 1_000_000.0
    share = F.when(F.col("toxic") > 0, positives / total[1]).otherwise(negatives / total[0])
    chosen = known.where(place < share).limit(2 * (positives + negatives))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    # The chosen rows are bounded by the two parameters, so every task may have their ids.
    rows = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(_group_keys, "grp long, doc_id long, text string, toxic int")
    first = F.min(F.struct("doc_id", "text"))
    sample = checkpointed(rows.groupBy("grp", (F.col("toxic") > 0).cast("int").alias("toxic")).agg(first.alias("r")).select("r.text", "toxic"))
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    yes, no = counts.get(1, 0), counts.get(0, 0)
    if not yes or not no:
        return _default()
    odds = F.log((F.col("yes") + 0.5) / (yes + 1)) - F.log((F.col("no") + 0.5) / (no + 1))
    mined = sample.mapInArrow(_mined, "feature long, yes int, no int").groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    mined = checkpointed(mined)
    least = float(np.log(max(mined.count() / LUCKY, 1)))
    every = F.col("yes") + F.col("no")
    among = lambda found, of: F.when(found > 0, found * F.log(found * (yes + no) / (every * of))).otherwise(0.0)
    mined = mined.where((F.col("yes") >= LEAST_ROWS) & (among(F.col("yes"), yes) + among(F.col("no"), no) >= least))
    mined = mined.withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    best = mined.orderBy(F.desc(F.col("odds") * F.sqrt("yes")), "feature").limit(LEXICON).collect()
    hashes = np.array([r["feature"] for r in best], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    lexicon = Lexicon(hashes[order], np.array([r["odds"] for r in best], dtype=np.float64)[order])
    got = sorted((bytes(r["e"]), r["toxic"]) for r in sample.mapInArrow(_evidence_rows(lexicon), "e binary, toxic int").collect())
    evidence = np.stack([np.frombuffer(e) for e, _ in got])
    gold = np.array([t for _, t in got], dtype=np.float64)
    # Labels start the label model; what it then believes is what the classifier learns.
    posterior, _, _ = label_model(votes(evidence), gold, float(np.clip(gold.mean(), 0.01, 0.99)))
    return Model(lexicon, logistic(inputs(evidence), posterior))


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every input row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in row_chunks(offsets):
                score = model.score(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                ], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score stays below the threshold, with all their columns."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        data, offsets = utf8(pa.array(texts, pa.string(), from_pandas=True))
        parts = [model.score(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in row_chunks(offsets)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.where(score(F.col("text").cast("string")) < threshold)
