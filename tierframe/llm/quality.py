"""Quality rules: fixed counts of a text, and a classifier on hashed n-grams.

The classifier is a logistic regression on the shares of hashed character
n-grams and of hashed words.  It is trained on the halves of a bounded sample of
labelled rows, each half calibrates what the other one has learnt, and it scores
whole texts in Arrow batches: a score is the mean weight of a text's n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.llm.text import chunks, flat_points, sums
from tierframe.sources.staging import materialize

# The base rules
LEAST_WORDS = 10
REPEAT_WINDOW = 5
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# a document is kept if it is good with at least this calibrated probability
THRESHOLD = 0.2
# labelled rows that the classifier is fitted on, at most, by hash
SAMPLE = 12_000
GRAM = 3
BINS = 1 << 16
# the shares of single n-grams are small numbers
SCALE = 100.0


def _table(characters: str) -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[ord(c) for c in characters]] = True
    return out


IS_SYMBOL, IS_WHITE = _table(SYMBOLS), _table(WHITE)


def _grams(points: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin of the n-gram that starts at each character, and how many each text has.

    Those that would reach into the next text are left out.
    """
    wide = points.astype(np.uint64)
    out = np.zeros(max(len(points) - GRAM + 1, 0), np.uint64)
    for at in range(GRAM):
        out = (out ^ wide[at : at + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
    out = (out >> np.uint64(48)).astype(np.int64) % BINS
    ends = np.cumsum(lengths)
    inside = np.ones(len(points), bool)
    for back in range(1, GRAM):
        inside[(ends - back)[lengths >= back]] = False
    return out[inside[: len(out)]], np.maximum(lengths - GRAM + 1, 0)


def _word_hashes(text: str) -> np.ndarray:
    words = text.encode().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows of REPEAT_WINDOW words that the text has twice or more."""
    n = len(hashes) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    windows = np.zeros(n, np.uint64)
    for at in range(REPEAT_WINDOW):
        windows = (windows ^ hashes[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
        windows ^= windows >> np.uint64(29)
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[which] > 1
    cover = np.zeros(len(hashes) + 1, np.int64)
    cover[:n] += again
    cover[REPEAT_WINDOW:] -= again
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _repeated_lines(text: str) -> int:
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            repeated += line in seen
            seen.add(line)
    return repeated


# parts of the sample in the fits
FIT_PARTS = 12


@dataclass
class QualityModel:
    """Weights of the character bins, then of the word bins; size fixed by BINS."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def probability(self, texts: list[str], hashes: list[np.ndarray]) -> np.ndarray:
        grams, n_grams = _grams(*flat_points(texts))
        sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
        words = np.concatenate(hashes) % np.uint64(BINS) if hashes else np.empty(0, np.uint64)
        margin = self.intercept + SCALE * (
            sums(self.weights[:BINS][grams], n_grams) / np.maximum(n_grams, 1)
            + sums(self.weights[BINS:][words.astype(np.int64)], sizes) / np.maximum(sizes, 1)
        )
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bins and their values."""
    grams, _ = _grams(*flat_points([text]))
    words = (_word_hashes(text) % np.uint64(BINS)).astype(np.int64) + BINS
    at, n = np.unique(np.concatenate([grams, words]), return_counts=True)
    return at, SCALE * n / np.where(at < BINS, max(len(grams), 1), max(len(words), 1))


_sparse = F.udf(lambda at, value: SparseVector(2 * BINS, at, value), VectorUDT())


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> QualityModel | None:
    """Fit and calibrate on at most ``sample`` labelled rows, those of the smallest hash.

    Null labels and texts are left out.  None if a half of the rows has only one
    class, or scores of unseen rows do not rise with their labels.
    The ids of the sample are broadcast, which ``sample`` bounds.
    """
    usable = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = (
        usable.select(F.col(id_col).alias("doc_id"), (F.col(label_col) == 1).cast("double").alias("label"))
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # written first: the sample has to be the same ids in every use
    chosen = materialize(chosen, "sample")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()
    )

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([at for at, _ in made], pa.list_(pa.int32())),
                    pa.array([value for _, value in made], pa.list_(pa.float64())),
                ],
                ["doc_id", "label", "at", "value"],
            )

    # spread over all cores: the sample may sit in a few files
    rows = texts.join(F.broadcast(chosen), "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", "label", "text").mapInArrow(
        featured, f"doc_id {kind}, label double, at array<int>, value array<double>"
    )
    rows = materialize(rows, "features")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).alias("half")
    vectors = rows.select("label", half, _sparse("at", "value").alias("features"))
    # written as vectors, which every step of the fits reads, in a few parts: the rows
    # are bounded, and each part of a step sends a sum as wide as the weights
    vectors = materialize(vectors.coalesce(FIT_PARTS), "vectors")
    classes = {(r.half, r.label): r["count"] for r in vectors.groupBy("half", "label").count().collect()}
    if len(classes) < 4:
        return None
    # each half is scored by the weights of the other one; the mean of both is used
    logistic = LogisticRegression(maxIter=40, regParam=0.02, standardization=False, maxBlockSizeInMB=16)
    fitted = [logistic.fit(vectors.filter(f"half = {n}").select("label", "features")) for n in (0, 1)]
    margin = array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("features")
    unseen = [f.transform(vectors.filter(f"half != {n}")).select("label", margin) for n, f in enumerate(fitted)]
    # few rows say little about the slope: it is held back by as much
    platt = LogisticRegression(maxIter=50, regParam=4 / sum(classes.values())).fit(unseen[0].union(unseen[1]))
    slope = float(platt.coefficients[0])
    if slope <= 0:
        return None
    weights = (fitted[0].coefficients.toArray() + fitted[1].coefficients.toArray()) / 2
    intercept = (fitted[0].intercept + fitted[1].intercept) / 2
    return QualityModel(weights.astype(np.float32), float(intercept), slope, float(platt.intercept))


def judge(
    docs: DataFrame,
    model: QualityModel | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    keep_columns: bool = False,
) -> DataFrame:
    """Counts and verdict of each whole text.

    Returns one row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept and probability (of being good;
    null without a model, which keeps what passes the base rules).  A null text
    has no words, so it fails.  With ``keep_columns`` a struct ``doc`` of the whole
    row stands in front.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    first = F.struct(*docs.columns).alias("doc") if keep_columns else F.col(id_col).alias("doc_id")
    rows = docs.select(first, text)
    name = rows.columns[0]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in chunks(texts):
                part = texts[start:stop]
                points, lengths = flat_points(part)
                hashes = [_word_hashes(t) for t in part]
                counts = [
                    np.array([len(h) for h in hashes], np.int64),
                    lengths - sums(IS_WHITE[points], lengths).astype(np.int64),
                    sums(IS_SYMBOL[points], lengths).astype(np.int64),
                    np.array([_repeated_lines(t) for t in part], np.int64),
                    np.array([_repeated_words(h) for h in hashes], np.int64),
                ]
                failed = (counts[0] < LEAST_WORDS) | (
                    100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
                )
                if model is None:
                    good, probability = np.ones(len(part), bool), pa.nulls(len(part), pa.float64())
                else:
                    p = model.probability(part, hashes)
                    good, probability = p >= threshold, pa.array(p)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(name).slice(start, stop - start),
                        *map(pa.array, counts),
                        pa.array(failed),
                        pa.array(~failed & good),
                        probability,
                    ],
                    [name, *COUNTS, "base_failed", "kept", "probability"],
                )

    kind = rows.schema[name].dataType.simpleString()
    fields = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(
        judged, f"`{name}` {kind}, {fields}, base_failed boolean, kept boolean, probability double"
    )


def good_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that pass, columns unchanged."""
    model = train(docs, labels, id_col, text_col)
    kept = judge(docs, model, id_col, text_col, keep_columns=True).filter("kept")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
