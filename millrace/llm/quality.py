"""Quality classifier: Naive Bayes support vectors.

Texts are sets of n-grams: runs of one to three bytes, and runs of equal words (a word given
twice, three times, ... in a row, whatever the word). Each n-gram's indicator is scaled by the log-ratio of its
counts in the two classes, which is counted over all labelled documents; the scaled vectors, at
unit length, are the input of a linear hinge-loss model, fitted by dual coordinate descent on a
bounded sample of the labelled documents (``SAMPLE``, about, half of it of each class, or all of a
class that has fewer). Its margins become probabilities by a logistic curve fitted on the same
sample, in which each class weighs as much as among all labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..session import write_out
from .common import slices, texts
from .language import fold

#: Hash buckets of byte runs, a power of two.
BUCKETS = 1 << 16
#: Runs of equal words: one feature for each length up to this, longer ones have all of them.
REPEATS = 8
FEATURES = BUCKETS + REPEATS
SAMPLE = 6000
ROUNDS = 12
PENALTY = 1.0
THRESHOLD = 0.7


def present(text: bytes | None) -> np.ndarray:
    """The sorted numbers of a text's n-grams; none for null and empty texts."""
    if not text:
        return np.empty(0, np.int32)
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    there = np.zeros(FEATURES, bool)
    there[b] = True
    if len(b) > 1:
        two = b[:-1] | (b[1:] << 8)
        there[(two * np.uint32(0x9E3779B1)) >> np.uint32(16)] = True
    if len(b) > 2:
        three = two[:-1] | (b[2:] << 16) | np.uint32(1 << 24)
        there[(three * np.uint32(0x85EBCA6B)) >> np.uint32(16)] = True
    words = np.array(text.split(), object)
    if len(words) > 1:
        same = np.r_[False, words[1:] == words[:-1], False]
        edges = np.flatnonzero(np.diff(same.astype(np.int8)))
        longest = int((edges[1::2] - edges[::2]).max(initial=0))
        there[BUCKETS : BUCKETS + min(longest, REPEATS)] = True
    return np.flatnonzero(there).astype(np.int32)


@dataclass(frozen=True)
class QualityModel:
    """The weight of each n-gram on unit-length scaled indicators, and the curve from margins to probabilities."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        scaled = self.ratio[features]
        length = np.sqrt((scaled * scaled).sum())
        return float((scaled * self.weights[features]).sum() / length if length else 0.0) + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(features) + self.shift, -60.0, 60.0))))


def log_ratio(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log of the n-grams' smoothed frequencies in class 1 over those in class 0; counts are (features, 2)."""
    share = (counts + 1.0) / (totals + 2.0)
    return np.log(share[:, 1] / share[:, 0])


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, size: int, rounds: int = ROUNDS, penalty: float = PENALTY, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of the least hinge loss with squared weights, by dual coordinate descent.

    Each step solves one example's dual variable, between 0 and its class's penalty, with all
    others fixed. The smaller class weighs as much as the larger.
    """
    weights, bias = np.zeros(size), 0.0
    dual = np.zeros(len(rows))
    positive = max(1, int((labels > 0).sum()))
    most = np.where(labels > 0, len(rows) / (2 * positive), len(rows) / (2 * max(1, len(rows) - positive))) * penalty
    square = np.array([(v * v).sum() + 1.0 for v in values])
    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slope = labels[i] * ((weights[rows[i]] * values[i]).sum() + bias) - 1.0
            new = min(max(dual[i] - slope / square[i], 0.0), most[i])
            step = (new - dual[i]) * labels[i]
            if step:
                dual[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def curve(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the labels best, with smoothed targets (Newton steps).

    The curve is that of the classes' shares among ``labels``; other shares move the shift alone.
    """
    positive = (labels > 0).sum()
    goal = np.where(labels > 0, (positive + 1.0) / (positive + 2.0), 1.0 / (len(labels) - positive + 2.0))
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margins + shift, -60.0, 60.0)))
        w = p * (1.0 - p)
        gradient = np.array([((p - goal) * margins).sum(), (p - goal).sum()])
        hessian = np.array([[(w * margins * margins).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        step = step / max(1.0, size)
        slope, shift = slope - step[0], shift - step[1]
        if size < 1e-6:
            break
    return float(slope), float(shift)


def featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, features): the n-grams of each text, a byte or so each in the shuffle instead of the text."""
    key = docs.schema[id_col].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                packed = [pack(present(t)) for t in texts(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "features"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(found, f"doc_id {key}, features binary")


def pack(features: np.ndarray) -> bytes:
    """Sorted n-gram numbers as gaps of two bytes: all low bytes, then all high ones, most of which are 0."""
    return np.diff(features, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    gaps = np.frombuffer(raw, np.uint8).reshape(2, -1).T.copy().view("<u2")[:, 0] if raw else np.empty(0, np.uint16)
    return np.cumsum(gaps, dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 13, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel | None:
    """Learn from the documents of ``docs`` that ``labels`` (id, 0 or 1) marks.

    Null labels and labels without a document teach nothing; a document labelled twice, or given
    twice, counts each time. With one class only, the model is its constant; without any, None.
    """
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    # Read twice: for the counts and for the sample.
    marked = write_out(featured(docs, id_col, text_col).join(marks, "doc_id"), "marked")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros((FEATURES, 2), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for raw, label in zip(batch.column("features").to_pylist(), batch.column("label").to_pylist(), strict=True):
                counts[unpacked(raw), label] += 1
                rows[label] += 1
        counts = np.vstack([counts, rows])
        some = np.flatnonzero(counts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some, 0]), pa.array(counts[some, 1])], ["feature", "zero", "one"])

    # One row per feature, a fixed number, comes to the driver; the last row counts documents.
    sums = marked.select("features", "label").mapInArrow(counted, "feature int, zero long, one long")
    sums = sums.groupBy("feature").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).collect()
    counts = np.zeros((FEATURES + 1, 2))
    for r in sums:
        counts[r.feature] = r.zero, r.one
    totals, counts = counts[-1], counts[:-1]
    if not totals.sum():
        return None
    ratio = log_ratio(counts, totals)
    if not totals.all():
        return QualityModel(ratio, np.zeros(FEATURES), 0.0, 0.0, 4.0 if totals[1] else -4.0)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1_000_000))
    wanted = [min(int(totals[k]), max(sample // 2, sample - int(totals[1 - k]))) for k in (0, 1)]
    zero, one = (-(-w * 1_000_000 // int(t)) for w, t in zip(wanted, totals, strict=True))
    chosen = marked.where(draw < F.when(F.col("label") == 1, one).otherwise(zero)).select("doc_id", "features", "label").collect()
    for label in {0, 1} - {r.label for r in chosen}:
        # Only where a class is many rows of a few ids: the first by their draw.
        chosen += marked.where(F.col("label") == label).orderBy(draw, "doc_id").limit(max(1, wanted[label])).select("doc_id", "features", "label").collect()
    chosen = sorted((r.doc_id, r.label, bytes(r.features)) for r in chosen)
    y = np.array([1.0 if label else -1.0 for _, label, _ in chosen])
    rows = [unpacked(raw) for _, _, raw in chosen]
    values = [ratio[f] / max(np.sqrt((ratio[f] ** 2).sum()), 1e-12) for f in rows]
    weights, bias = descend(rows, values, y, FEATURES)
    margins = np.array([(weights[f] * v).sum() + bias for f, v in zip(rows, values, strict=True)])
    slope, shift = curve(margins, y)
    # From the drawn shares of the classes to those of all labelled documents.
    drawn = (y > 0).sum() / (y < 0).sum()
    return QualityModel(ratio, weights, bias, slope, shift + float(np.log(totals[1] / totals[0] / drawn)))


def score(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on); only the text is looked at, all of it.

    Null, empty and wordless texts get the model's score of no n-grams. Without a model every
    score is 0.5. All columns and repeated rows are kept; the new names must not be taken. Empty tables stay empty.
    """
    if {"score", "predicted"} & {c.lower() for c in docs.columns}:
        raise ValueError("score or predicted is a column already")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    names = schema.names

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, text_col):
                found = [0.5 if known is None else known.score(present(t)) for t in texts(part, text_col)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())], names)

    return docs.mapInArrow(scored, schema)


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Per document doc_id, held_out, score, predicted; learned from the labels of the other folds."""
    model = train(docs.where(fold(F.col("doc_id"), folds) != held), labels.where(fold(F.col("doc_id"), folds) != held))
    return score(docs.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "text"), model).drop("text")
