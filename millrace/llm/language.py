"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary. A text's likelihood
is the sum over all its segmentations into pieces, which the forward algorithm adds up; pieces
do not cross chunk borders, so it is the product of the chunks' likelihoods, and a chunk that
was seen before is looked up. Distributions are fitted by expectation maximisation on the chunk
counts of a bounded sample of labelled documents (``SAMPLE`` per language, about).

A background stands for all languages that were not learned: the mean of the learned distributions,
flattened (``FLATNESS``). It is one more alternative of the posterior, in the same forward pass, so a
text that it explains better than any learned language gets a score near 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import kept, slices
from .lattice import Edges, Index, Vocabulary
from .pieces import MODEL

#: Labelled documents per language, about, that distributions are fitted on.
SAMPLE = 200
ROUNDS = 2
#: Sums of words are divided by their size after so many letters, which stays in range; logs of it are kept.
RESCALE = 32
#: Letters of a chunk that are scored at a time; the sums at its end are carried on.
WINDOW = 4096
#: Letters of the chunks that are scored or fitted together, about; a longer chunk is fitted by itself.
TOGETHER = 100_000
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"
#: The power that flattens the background: 1 is the mean of the learned languages, 0 makes all pieces alike.
FLATNESS = 0.3
#: The share of a language's chunks that come from the background (names, keys, addresses), so that a few do not decide.
FOREIGN = 0.003
#: Likelihoods are kept times this much per letter, so that products stay in range.
PER_LETTER = 64.0


@dataclass(frozen=True)
class LanguageModel:
    vocabulary: Vocabulary
    languages: tuple[str, ...]
    weights: np.ndarray  # (pieces + 1, languages): probability times PER_LETTER per letter; the last for unknown letters
    background: np.ndarray  # (pieces + 1,): the same for a text of no learned language


def chunks(vocabulary: Vocabulary, text: str) -> list[str]:
    """The chunks of a lower-cased text."""
    return vocabulary.chunks(text.lower())


def together(words: list[str], most: int | None = None) -> Iterator[slice]:
    """Runs of ``words`` with about ``TOGETHER`` letters, of which a word counts for ``most`` at most."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    sizes = np.minimum(sizes, most or sizes) + 1
    run = (np.cumsum(sizes) - sizes) // TOGETHER
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(words)]
    yield from (slice(x, y) for x, y in zip(cuts, cuts[1:], strict=False) if x < y)


def by_depth(edges: Edges, at: np.ndarray) -> Iterator[np.ndarray]:
    """Edge numbers, one array for each distance of ``at`` from its word's start, nearest first."""
    word_start = np.repeat(edges.first, edges.sizes + 1)  # of each letter, the mark included
    depth = at - word_start[edges.start]
    order = np.argsort(depth, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def forward(edges: Edges, weights: np.ndarray, logs: np.ndarray | None = None, longest: int = 0, before: np.ndarray | None = None) -> np.ndarray:
    """Per position and language the summed weight of all segmentations up to there. ``edges`` by end.

    With ``logs``, zeros of the same shape, sums are divided every ``RESCALE`` letters, and it takes
    the logs of the divisors; no piece has more than ``longest`` letters. ``before`` are the sums at
    each word's first positions, where it goes on from there; edges that end there are not followed.
    """
    total = np.zeros((len(edges.text) + 1, weights.shape[1]))
    lead = 0 if before is None else before.shape[1] - 1
    total[edges.first] = 1.0
    if before is not None:
        total[edges.first[:, None] + np.arange(lead + 1)] = before
    depth = 0
    for group in by_depth(edges, edges.end):
        # Every letter is the end of an edge, so there is a group for each depth.
        depth += 1
        if depth <= lead:
            continue
        ends, starts = edges.end[group], edges.start[group]
        cuts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
        terms = total[starts] * weights[edges.piece[group]]
        total[ends[cuts]] = np.add.reduceat(terms, cuts)
        if logs is not None and depth % RESCALE == 0:
            going = edges.sizes > depth
            rescale(total, logs, edges.first[going], edges.sizes[going], depth, longest)
    return total


def rescale(total: np.ndarray, logs: np.ndarray, first: np.ndarray, sizes: np.ndarray, depth: int, longest: int) -> None:
    """Divide what further sums of the words at ``first`` start from, the last ``longest`` positions, by its highest."""
    if not len(first):
        return
    # Positions farther back are in no further sum and keep their scale.
    last = first[:, None] + np.arange(max(0, depth - longest), depth + 1)
    top = total[last].max(axis=1)
    total[last] /= top[:, None]
    logs[last] += np.log(top)[:, None]
    # Sums up to the next division have this scale as well.
    ahead = first[:, None] + np.minimum(np.arange(depth + 1, depth + RESCALE + 1), sizes[:, None])
    logs[ahead] = logs[first + depth][:, None]


def log_sums(index: Index, words: list[str], weights: np.ndarray) -> np.ndarray:
    """(words, languages): the log of each whole word's summed weight over all segmentations."""
    out = np.zeros((len(words), weights.shape[1]))
    order = np.arange(len(words))
    at, before, shift = 0, None, np.zeros_like(out)
    while len(order):
        lead = min(at, index.longest)
        parts = [words[k][at - lead : at + WINDOW] for k in order]
        edges = index.edges(parts, by_end=True)
        logs = np.zeros((len(edges.text) + 1, weights.shape[1])) if max(map(len, parts)) > RESCALE else None
        total = forward(edges, weights, logs, index.longest, before)
        ends = edges.first + edges.sizes
        more = np.array([len(words[k]) > at + WINDOW for k in order], bool)
        if logs is not None:
            shift[order] += logs[ends]
        out[order] = shift[order] + np.log(np.maximum(total[ends], 1e-300))
        # The sums that the next window's edges start from, all in the scale of the last.
        order, ends, at = order[more], ends[more], at + WINDOW
        if len(order):
            last = ends[:, None] + np.arange(-min(at, index.longest), 1)
            before = total[last] * np.exp(logs[last] - logs[ends][:, None])
            top = before.max(axis=1)
            before /= top[:, None]
            shift[order] += np.log(top)
    return out


def expected(edges: Edges, weights: np.ndarray, counts: np.ndarray, longest: int = 0) -> np.ndarray:
    """Expected uses of each piece (unknown letters last), given how often each word occurs per language."""
    logs = np.zeros((len(edges.text) + 1, weights.shape[1])) if edges.sizes.max(initial=0) > RESCALE else None
    up = forward(edges, weights, logs, longest)

    def weight(group: np.ndarray) -> np.ndarray:
        plain = weights[edges.piece[group]]
        return plain if logs is None else plain * np.exp(logs[edges.start[group]] - logs[edges.end[group]])

    down = np.zeros_like(up)
    ends = edges.first + edges.sizes
    whole = up[ends]
    down[ends] = np.divide(counts, whole, out=np.zeros_like(whole), where=whole > 0)
    for group in reversed(list(by_depth(edges, edges.start))):
        np.add.at(down, edges.start[group], weight(group) * down[edges.end[group]])
    used = up[edges.start] * weight(np.arange(len(edges.start))) * down[edges.end]
    return np.stack([np.bincount(edges.piece % len(weights), used[:, k], len(weights)) for k in range(weights.shape[1])], axis=1)


def fit(vocabulary: Vocabulary, rows: list[tuple[str, str, int]], rounds: int = ROUNDS) -> LanguageModel:
    """The model of (language, chunk, count) rows."""
    languages = sorted({r[0] for r in rows})
    column = {name: k for k, name in enumerate(languages)}
    words = list(dict.fromkeys(r[1] for r in rows))
    row = {w: k for k, w in enumerate(words)}
    counts = np.zeros((len(words), len(languages)))
    for language, word, n in rows:
        counts[row[word], column[language]] += n
    size = len(vocabulary.pieces)
    length = np.array([len(p) if p else 1 for p in vocabulary.pieces] + [1])
    scale = PER_LETTER**length.astype(float)
    # All pieces alike at first; a piece that a language does not use keeps a small probability.
    weights = np.repeat((scale / size)[:, None], len(languages), axis=1)
    for _ in range(rounds):
        used = np.zeros((size + 1, len(languages)))
        for run in together(words):
            used += expected(vocabulary.index.edges(words[run], by_end=True), weights, counts[run], vocabulary.index.longest)
        used += 0.01
        weights = used / used.sum(axis=0) * scale[:, None]
    flat = (weights / scale[:, None]).mean(axis=1) ** FLATNESS
    return LanguageModel(vocabulary, tuple(languages), weights, flat / flat.sum() * scale)


class Scorer:
    """Log-likelihoods of texts, with a memory of chunks up to a bound."""

    BOUND = 200_000

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.weights = np.column_stack([model.weights, model.background])
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.scores = np.empty((0, self.weights.shape[1]))

    def of(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages and background): log-likelihoods; 0 for texts without letters, which are not scored."""
        if len(self.code) > self.BOUND:
            self.clear()
        code, new, vocabulary = self.code, [], self.model.vocabulary
        flat, counts = [], []
        for text in texts:
            parts = chunks(vocabulary, text) if text and LETTER.search(text) else []
            counts.append(len(parts))
            for part in parts:
                at = code.get(part)
                if at is None:
                    at = code[part] = len(code)
                    new.append(part)
                flat.append(at)
        found = [self.scores]
        for run in together(new, WINDOW):
            sizes = np.fromiter(map(len, new[run]), np.int64)
            logs = log_sums(vocabulary.index, new[run], self.weights) - sizes[:, None] * np.log(PER_LETTER)
            logs[:, :-1] = np.logaddexp(logs[:, :-1] + np.log1p(-FOREIGN), logs[:, -1:] + np.log(FOREIGN))
            found.append(logs)
        if new:
            self.scores = np.concatenate(found)
        out = np.zeros((len(texts), self.scores.shape[1]))
        sizes = np.array(counts, np.int64)
        some = np.flatnonzero(sizes)
        if len(some):
            starts = np.cumsum(sizes[some]) - sizes[some]
            out[some] = np.add.reduceat(self.scores[np.array(flat, np.int64)], starts)
        return out


def train(docs: DataFrame, vocabulary: Vocabulary | None = None, sample: int = SAMPLE, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Fit a model on labelled ``docs``: about ``sample`` documents of each language, chosen by a hash of their id.

    Null labels, and null or letterless texts, teach nothing. None if nothing is left.
    """
    vocabulary = vocabulary or Vocabulary.load(MODEL)
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.where("lang is not null and text rlike '\\\\p{L}'")
    # One row per language comes to the driver.
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.length("text")), F.lit(1_000_000))
    below = F.lit(0)
    for name, n in counts.items():
        below = F.when(F.col("lang") == name, F.lit(-(-sample * 1_000_000 // n))).otherwise(below)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = Counter()
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                    found.update((lang, c) for c in chunks(shared.value, text))
                yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in found], "chunk": [k[1] for k in found], "n": pa.array(found.values(), pa.int64())})

    words = labelled.where(draw < below).select("text", "lang").mapInArrow(counted, "lang string, chunk string, n long")
    rows = words.groupBy("lang", "chunk").agg(F.sum("n").alias("n")).orderBy("chunk", "lang").collect()
    return fit(vocabulary, [(r.lang, r.chunk, r.n) for r in rows])


def predict(model: LanguageModel | None, work: Scorer | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Per text the likeliest learned language and its posterior (all of them and the background alike beforehand)."""
    if model is None:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    score = work.of(texts)
    best = score[:, :-1].argmax(axis=1)
    share = np.exp(score - score.max(axis=1, keepdims=True))
    posterior = share[np.arange(len(best)), best] / share.sum(axis=1)
    known = [bool(t and LETTER.search(t)) for t in texts]
    return (
        [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)],
        [float(p) if k else 0.0 for p, k in zip(posterior, known, strict=True)],
    )


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior; only the text is looked at, all of it.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text
    if nothing was learned. A text in none of the learned languages has a score below 0.5, near 0
    unless it is very short. Of equally likely languages the first by name is taken. All columns and repeated rows are kept; the two new names must not be taken. Empty tables stay empty.
    """
    if {pred_col.lower(), score_col.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"{pred_col} or {score_col} is a column already")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(pred_col, StringType()), StructField(score_col, DoubleType())])
    names = [f.name for f in schema.fields]

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        work = None if known is None else kept(Scorer, known)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 21):
                languages, scores = predict(known, work, part.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(identified, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in fold 1, which is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)), F.lit(1))


def identify_held_out(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Per document doc_id, held_out, lang_pred, score; learned from the documents of the other folds."""
    model = train(docs.where(fold(F.col("doc_id"), folds) != held))
    narrow = docs.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "text")
    return identify(narrow, model).drop("text")
