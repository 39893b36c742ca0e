"""Language identification with a string kernel.

A text is the set of its character 1- to 3-grams (blended spectrum, presence only), hashed to 2^14 bits;
the kernel of two texts is the size of the common set over the root of both sizes. Landmarks give a
Nyström map, kernel ridge regression one machine per language against the rest. A task turns its texts
into a bit matrix and scores them by two matrix products: with the landmarks, then with the dual weights.

Contract. ``identify_languages`` returns ``doc_id``, ``held_out``, ``lang_pred`` and ``score`` for every
input row. It learns from rows with text, a language, an id and a fold other than the held-out one, by a
sample of about ``SAMPLE_ROWS`` in equal parts per language (a bounded classifier sample; scoring reads every text whole).
A null text, or one without a letter, is ``und`` with score 0; so is every row if nothing can be learned.
Equal scores go to the language first by code point. Repeated rows are scored alike; other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressledger.llm.common import is_held_out

BITS = 14
SAMPLE_ROWS = 4_000
LANDMARKS = 128
RIDGE = 0.05
#: Characters worked on at once; windows overlap by two, so long texts give the same set.
WINDOW = 1 << 20
ROWS = 128

_letters = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def presence(text: str | None, out: np.ndarray) -> bool:
    """Set the bits of a text's n-grams in ``out``; False if it has no letter."""
    found = False
    lowered = (text or "").lower()
    for at in range(0, len(lowered), WINDOW):
        part = lowered[max(0, at - 2) : at + WINDOW]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letter_table()[codes]
        found = found or bool(letter.any())
        codes = np.where(letter, codes, np.uint32(32)).astype(np.uint64)
        grams = codes * np.uint64(0x9E3779B97F4A7C15)
        out[(grams[letter] >> np.uint64(64 - BITS)).astype(np.int64)] = True
        for n in (2, 3):
            if len(codes) < n:
                break
            grams = (grams[:-1] ^ (grams[:-1] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + codes[n - 1 :] * np.uint64(0x94D049BB133111EB)
            # Only one space at either side: runs of other characters count as one gap.
            solid = letter[: len(grams)] | letter[1 : len(grams) + 1]
            if n == 3:
                solid &= letter[1 : len(grams) + 1]
            out[(grams[solid] >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return found


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray  # packed bits, one row per landmark
    weights: np.ndarray  # landmarks x languages

    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        bits = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        return bits.T.copy(), np.sqrt(bits.sum(axis=1))


def kernel(bits: np.ndarray, columns: np.ndarray, roots: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(bits.sum(axis=1, keepdims=True), 1))
    return (bits @ columns) / (size * roots)


def train(langs: list[str], rows: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström kernel ridge regression; langs: of each row, rows: packed bits. Landmarks: as many per language."""
    names = sorted(set(langs))
    own = np.array([names.index(x) for x in langs])
    each = max(1, landmarks // max(1, len(names)))
    chosen = np.concatenate([np.flatnonzero(own == k)[:each] for k in range(len(names))])
    model = Model(names, rows[chosen], np.zeros((len(chosen), len(names)), dtype=np.float32))
    columns, roots = model.matrix()
    known = np.concatenate([
        kernel(np.unpackbits(rows[i : i + 512], axis=1).astype(np.float32), columns, roots) for i in range(0, len(rows), 512)
    ]).astype(np.float64)
    goal = np.where(own[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Each language weighs as much as another.
    weight = (len(rows) / len(names) / np.bincount(own, minlength=len(names)))[own][:, None]
    inner = known[chosen]
    left = known.T @ (known * weight) + ridge * len(rows) / len(chosen) * (inner + inner.T) / 2 + 1e-6 * len(rows) * np.eye(len(chosen))
    model.weights = np.linalg.solve(left, known.T @ (goal * weight)).astype(np.float32)
    return model


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Learn from a bounded sample, chosen by a hash of the id, of the rows outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    each = max(16, sample_rows // len(counts))
    share = F.element_at(F.create_map(*(x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, each / n))))), F.col("lang"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000.0
    sample = rows.where(place < share).limit(2 * each * len(counts))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits = np.zeros(1 << BITS, dtype=bool)
                if presence(text, bits):
                    out.append((lang, np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([x for x, _ in out], pa.string()), "bits": pa.array([x for _, x in out], pa.binary()),
            })

    got = sorted((r["lang"], bytes(r["bits"])) for r in sample.select("lang", "text").mapInArrow(featured, "lang string, bits binary").collect())
    if not got:
        return None
    order = np.random.default_rng(5).permutation(len(got))
    return train([got[i][0] for i in order], np.stack([np.frombuffer(got[i][1], dtype=np.uint8) for i in order]))


def identify_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, roots = model.matrix() if model else (None, None)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(2).to_pylist()
                bits = np.zeros((len(texts), 1 << BITS), dtype=bool)
                known = np.array([presence(t, row) for t, row in zip(texts, bits, strict=True)], dtype=bool)
                names, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
                if model and known.any():
                    margin = kernel(bits[known].astype(np.float32), columns, roots) @ model.weights
                    best = margin.argmax(axis=1)
                    names[known] = np.array(model.langs, dtype=object)[best]
                    score[known] = np.clip((margin.max(axis=1) + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names.tolist(), pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, lang_pred string, score double")
