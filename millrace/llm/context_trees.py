"""Language-model scores by context-tree weighting over bytes.

Text is read as its A-Z lower-cased words with one space between them and an end byte. Each byte
is eight binary decisions; each decision is predicted in every context of 0 to ``DEPTH`` preceding
bytes by a Krichevsky-Trofimov estimate, and a node's weighted probability halves its own estimate
with the product over the contexts one byte longer. The evidence of the training documents gives
every node the weight with which its own estimate counts; a prediction mixes all depths whose
context was seen at that decision. The code length is the negative logarithm.

The counts are a table that grows with the corpus and is never gathered anywhere:

* Documents are dealt into blocks of about ``BLOCK_BYTES``. A block hands on its distinct runs of
  ``DEPTH + 1`` bytes, with their training counts (zero where only unlearned documents hold them),
  so a run costs a row per block, not one per occurrence.
* A run is a number: the preceding bytes, latest first, then the byte itself. Runs that share their
  latest two bytes form a subtree, which one task weighs; only the nodes of the two topmost depths,
  at most 257 x 255 whatever the corpus, reach the driver.
* Each block gets back the logarithms of its own runs, and of its own words for the base, ahead of
  its documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import size_shuffles, write_out
from .common import MULTIPLIER, slices, texts

DEPTH = 5
#: Text bytes of a block, about.
BLOCK_BYTES = 32 << 20
#: Bytes that UTF-8 never has: what stands before a text, and its end.
PAD, END = 0xFE, 0xFF
#: Depth of the contexts below which a task weighs a whole subtree.
ROOT = 2
#: Runs that are weighed at once within a task.
TOGETHER = 100_000


# -- texts -------------------------------------------------------------------------------------


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def runs(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The run that ends at each byte of the bodies, laid end to end, and where each body's runs start."""
    pad = bytes([PAD]) * depth
    joined = np.frombuffer(pad + pad.join(bodies), np.uint8)
    count = len(joined) - depth
    found = joined[depth:].astype(np.int64)
    for back in range(1, depth + 1):
        found |= joined[depth - back : depth - back + count].astype(np.int64) << (8 * (depth + 1 - back))
    sizes = np.array([len(b) for b in bodies], np.int64)
    starts = np.cumsum(sizes) - sizes
    return found[(found & 0xFF) != PAD], starts


class Gathered:
    """Distinct keys with summed counts, merged whenever they have doubled."""

    def __init__(self) -> None:
        self.keys, self.counts, self.held, self.merged = [], [], 0, 500_000

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > 2 * self.merged:
            keys, counts = self.result()
            self.keys, self.counts, self.held = [keys], [counts], len(keys)
            self.merged = max(self.merged, self.held)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(np.concatenate(self.counts)[order], first)


class Lookup:
    """Values by key in an open hash table of two to four places per key; only for keys that it holds."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == -1]
            self.keys[at[free]] = keys[free]
            own = self.keys[at[left]] == keys[left]
            self.values[at[left[own]]] = values[left[own]]
            left = left[~own]
            at[left] = (at[left] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * MULTIPLIER) >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = self._place(keys)
        found = self.values[at]
        left = np.flatnonzero(self.keys[at] != keys)
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            found[left] = self.values[at]
            other = self.keys[at] != keys[left]
            left, at = left[other], at[other]
        return found


class Block:
    """What one block holds: its runs and its words, with their numbers in learned documents."""

    #: Distinct words that are kept before they are handed on; a block may hand on a word again.
    WORDS = 500_000

    def __init__(self, depth: int) -> None:
        self.depth, self.runs, self.words = depth, Gathered(), Counter()

    def add(self, rows: list[tuple[bytes | None, bool]]) -> None:
        for learned in (True, False):
            own = [words_of(text) for text, learn in rows if learn == learned]
            if not own:
                continue
            keys, counts = np.unique(runs([b" ".join(w) + bytes([END]) for w in own], self.depth)[0], return_counts=True)
            self.runs.add(keys, counts if learned else np.zeros(len(keys), np.int64))
            for w in own:
                if learned:
                    self.words.update(w)
                else:
                    for word in w:
                        self.words[word] += 0

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        keys, counts = self.runs.result()
        for k in range(0, len(keys), 50_000):
            n = len(keys[k : k + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int32()), pa.array(keys[k : k + n]), pa.nulls(n, pa.binary()), pa.array(counts[k : k + n])], GATHERED
            )
        yield from self.word_rows(number)

    def word_rows(self, number: int) -> Iterator[pa.RecordBatch]:
        words = list(self.words)
        for k in range(0, len(words), 50_000):
            part = words[k : k + 50_000]
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(part, pa.binary()), pa.array([self.words[w] for w in part], pa.int64())], GATHERED
            )
        self.words.clear()


GATHERED = ["block", "run", "word", "n"]


def gathered(blocks: DataFrame, depth: int) -> DataFrame:
    """(block, run, word, n): the runs, and the words, of each block, with their numbers in learned documents."""

    def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, Block(depth)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                numbers = part.column("block").to_numpy()
                rows = list(zip(texts(part, "text"), part.column("learn").to_pylist(), strict=True))
                cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(rows)]
                for start, stop in zip(cuts, cuts[1:], strict=False):
                    if numbers[start] != number:
                        yield from block.rows(number)
                        number, block = int(numbers[start]), Block(depth)
                    block.add(rows[start:stop])
                    if len(block.words) > Block.WORDS:
                        yield from block.word_rows(number)
        yield from block.rows(number)

    dealt = blocks.select("block", "learn", "text").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(collected, "block int, run long, word binary, n long")


# -- trees -------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function for positive values: Stirling's series eight steps up."""
    y = x + 8.0
    shift = np.log(x)
    for k in range(1, 8):
        shift += np.log(x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def estimated(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Tree:
    """Nodes of one depth, and what deeper ones predict for each run's eight decisions.

    ``nodes`` are context << 8 | decision, where decision is 1 and the bits decided before.
    ``at`` (runs, 8) is each decision's node, ``chance`` the probability of the run's bit, nan where
    its context was never seen there. ``below`` is the summed evidence of longer contexts.
    """

    def __init__(self, runs: np.ndarray, counts: np.ndarray, depth: int) -> None:
        byte = (runs & 0xFF)[:, None]
        level = np.arange(8)
        decision = (1 << level) | (byte >> (8 - level))
        self.bit = ((byte >> (7 - level)) & 1).astype(bool)
        self.depth, self.below = depth, None
        self.nodes, at = np.unique((((runs >> 8) << 8)[:, None] | decision).ravel(), return_inverse=True)
        self.at = at.reshape(self.bit.shape).astype(np.int32)
        weight = np.repeat(counts, 8).astype(float)
        one = self.bit.ravel()
        self.ones = np.bincount(at, weight * one, len(self.nodes))
        self.zeros = np.bincount(at, weight * ~one, len(self.nodes))
        self.chance = np.full(self.bit.shape, np.nan)
        self._weigh()

    def _weigh(self) -> None:
        """Fold this depth's estimates into evidence and predictions."""
        self.evidence, own = folded(self.zeros, self.ones, self.below)
        total = self.zeros + self.ones
        for k in range(8):
            at = self.at[:, k]
            chance = (np.where(self.bit[:, k], self.ones[at], self.zeros[at]) + 0.5) / (total[at] + 1.0)
            longer = self.chance[:, k]
            mixed = np.where(np.isnan(longer), chance, own[at] * chance + (1 - own[at]) * longer)
            self.chance[:, k] = np.where(total[at] > 0, mixed, np.nan)

    def climb(self) -> Tree:
        """Go on to the contexts that are one byte shorter."""
        # The oldest byte of a context is its lowest one.
        parents, at = np.unique(((self.nodes >> 16) << 8) | (self.nodes & 0xFF), return_inverse=True)
        self.zeros, self.ones, self.below = (np.bincount(at, x, len(parents)) for x in (self.zeros, self.ones, self.evidence))
        self.nodes, self.at, self.depth = parents, at.astype(np.int32)[self.at], self.depth - 1
        self._weigh()
        return self

    @classmethod
    def joined(cls, parts: list[Tree]) -> Tree:
        """Trees of one depth over different contexts as one."""
        if len(parts) == 1:
            return parts[0]
        whole = cls.__new__(cls)
        whole.depth = parts[0].depth
        for name in ("nodes", "zeros", "ones", "evidence", "bit", "chance"):
            setattr(whole, name, np.concatenate([getattr(p, name) for p in parts]))
        ends = np.cumsum([0, *(len(p.nodes) for p in parts)])
        whole.at = np.concatenate([p.at + n for p, n in zip(parts, ends, strict=False)]).astype(np.int32)
        return whole


def folded(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The weighted evidence of nodes, and the weight their own estimate has against longer contexts."""
    estimate = estimated(zeros, ones)
    if below is None:
        return estimate, np.ones(len(zeros))
    return np.logaddexp(estimate, below) - math.log(2), np.exp(-np.logaddexp(0.0, below - estimate))


def weighed(runs: np.ndarray, counts: np.ndarray, depth: int, root: int) -> Tree:
    """The tree over sorted distinct runs, climbed to contexts of ``root`` bytes.

    Many runs are taken in parts that end where a context of one byte more does.
    """
    inner = min(root + 1, depth)
    first = np.flatnonzero(np.diff(runs >> (8 * (depth + 1 - inner)))) + 1
    cuts = [0]
    for k in first.tolist():
        if k - cuts[-1] >= TOGETHER:
            cuts.append(k)
    parts = []
    for start, end in zip(cuts, [*cuts[1:], len(runs)], strict=True):
        tree = Tree(runs[start:end], counts[start:end], depth)
        while tree.depth > inner:
            tree.climb()
        parts.append(tree)
    tree = Tree.joined(parts)
    while tree.depth > root:
        tree.climb()
    return tree


def subtrees(counts: DataFrame, depth: int) -> DataFrame:
    """(run, chances, node, zeros, ones, evidence): a row per run with its chances below the root, one per node at the root.

    A task buffers a subtree: all distinct runs whose latest two bytes agree.
    """
    root = min(ROOT, depth)
    shift = 8 * (depth + 1 - root)
    schema = "run long, chances binary, node long, zeros double, ones double, evidence double"
    names = ["run", "chances", "node", "zeros", "ones", "evidence"]

    def rows(runs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        tree = weighed(runs, n, depth, root)
        for k in range(0, len(runs), 20_000):
            part = tree.chance[k : k + 20_000]
            m = len(part)
            offsets = pa.py_buffer(np.arange(0, 64 * m + 1, 64, dtype=np.int32))
            chances = pa.Array.from_buffers(pa.binary(), m, [None, offsets, pa.py_buffer(np.ascontiguousarray(part))])
            yield pa.RecordBatch.from_arrays([pa.array(runs[k : k + m]), chances, pa.nulls(m, pa.int64()), *[pa.nulls(m, pa.float64())] * 3], names)
        m = len(tree.nodes)
        yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), *(pa.array(x) for x in (tree.nodes, tree.zeros, tree.ones, tree.evidence))], names)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column("run").to_numpy(), batch.column("n").to_numpy()))
            size += batch.num_rows
            if size < TOGETHER:
                continue
            runs, n = (np.concatenate(x) for x in zip(*held, strict=True))
            ends = np.flatnonzero(np.diff(runs >> shift)) + 1
            held, size = [(runs, n)], len(runs)
            if len(ends):
                cut = int(ends[-1])
                yield from rows(runs[:cut], n[:cut])
                held, size = [(runs[cut:], n[cut:])], len(runs) - cut
        if held:
            yield from rows(*(np.concatenate(x) for x in zip(*held, strict=True)))

    dealt = counts.withColumn("context", F.shiftright("run", shift))
    return dealt.repartition("context").sortWithinPartitions("run").select("run", "n").mapInArrow(built, schema)


class Top:
    """The nodes above the subtrees' roots; contexts of fewer than ``ROOT`` bytes, a bounded number."""

    def __init__(self, rows: list, depth: int) -> None:
        self.root = min(ROOT, depth)
        nodes = np.array([r["node"] for r in rows], np.int64)
        zeros, ones, below = (np.array([r[x] for r in rows], float) for x in ("zeros", "ones", "evidence"))
        self.levels = []
        for _ in range(self.root):
            order = np.argsort(nodes)
            nodes, zeros, ones, below = nodes[order], zeros[order], ones[order], below[order]
            evidence, own = folded(zeros, ones, below)
            self.levels.append((nodes, zeros, ones, own))
            nodes, at = np.unique(((nodes >> 16) << 8) | (nodes & 0xFF), return_inverse=True)
            zeros, ones, below = (np.bincount(at, x, len(nodes)) for x in (zeros, ones, evidence))

    def logs(self, runs: np.ndarray, chance: np.ndarray, depth: int) -> np.ndarray:
        """The decimal logarithm of each run's last byte after the others."""
        byte = runs & 0xFF
        total = np.zeros(len(runs))
        for level in range(8):
            decision = (1 << level) | (byte >> (8 - level))
            bit = (byte >> (7 - level)) & 1
            best = chance[:, level]
            for up, (nodes, zeros, ones, own) in enumerate(self.levels):
                context = runs >> (8 * (depth + 1 - (self.root - 1 - up)))
                at = np.searchsorted(nodes, context << 8 | decision)
                seen = zeros[at] + ones[at]
                here = (np.where(bit == 1, ones[at], zeros[at]) + 0.5) / (seen + 1.0)
                mixed = np.where(np.isnan(best), here, own[at] * here + (1 - own[at]) * best)
                best = np.where(seen > 0, mixed, np.nan)
            total += np.log10(np.where(np.isnan(best), 0.5, best))
        return total


def run_logs(counts: DataFrame, depth: int) -> DataFrame:
    """(run, value): the decimal logarithm that the weighted tree gives each run's last byte."""
    spark = counts.sparkSession
    trees = write_out(subtrees(counts, depth), "context-trees")
    up = F.shiftright("node", 16) * 256 + F.col("node").bitwiseAND(F.lit(255))
    roots = trees.where("node is not null").select(up.alias("node"), "zeros", "ones", "evidence")
    # Contexts of one byte at most: 256 x 255 rows, whatever the corpus.
    roots = roots.groupBy("node").agg(*(F.sum(x).alias(x) for x in ("zeros", "ones", "evidence")))
    top = spark.sparkContext.broadcast(Top(roots.collect(), depth))

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = batch.column("run").to_numpy()
                chance = np.frombuffer(b"".join(batch.column("chances").to_pylist())).reshape(-1, 8)
                yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(top.value.logs(found, chance, depth))], ["run", "value"])

    return trees.where("run is not null").select("run", "chances").mapInArrow(finished, "run long, value double")


# -- scores ------------------------------------------------------------------------------------


class Known(dict):
    """The logarithms of known words; any other word has that of a count of zero."""

    def __init__(self, other: float) -> None:
        self.other = other

    def __missing__(self, word: bytes) -> float:
        return self.other


def score(docs: DataFrame, learn: Column, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    ``learn`` says which documents teach. ``score`` is the decimal logarithm of the probability of
    the words with one space between them and the end; ``n_bytes`` counts those bytes and the end,
    ``bits_per_byte`` is the code length of one. ``base_score`` adds up smoothed frequencies of
    words and the end. Null, empty and wordless texts are an end alone. Where nothing is learned
    every decision has chance 1/2 and every base term is 0. Ids may be null or repeated; repeated
    rows count as often as they occur. Other columns are not looked at. Empty tables stay empty.
    ``depth`` is 1 to 6.
    """
    if not 1 <= depth <= 6:
        raise ValueError("a run of depth + 1 bytes must fit into a positive 64-bit number")
    spark = docs.sparkSession
    key = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if("learn").alias("learned")).first()
    total, learned = size["bytes"] or 0, size["learned"]
    size_shuffles(spark, total)
    number = -(-total // BLOCK_BYTES) or 1
    blocks = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(number)).cast("int"))
    found = write_out(gathered(blocks, depth), "runs")

    of_runs = found.where("run is not null").select("block", "run", "n")
    values = run_logs(of_runs.groupBy("run").agg(F.sum("n").alias("n")), depth)
    of_words = found.where("word is not null").select("block", "word", "n")
    words = of_words.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")
    words = write_out(words, "words")
    sums = words.agg(F.count("*").alias("distinct"), F.sum("n").alias("n")).first()
    tokens = (sums["n"] or 0) + learned
    distinct = sums["distinct"] + (learned > 0)
    whole = tokens + 0.5 * (distinct + 1)
    other, end = math.log10(0.5 / whole), math.log10((learned + 0.5) / whole)

    kind = lambda k: F.lit(k).alias("kind")
    none = {"doc_id": key, "text": "string", "run": "long", "word": "binary", "value": "double"}

    def rows(df: DataFrame, k: int) -> DataFrame:
        return df.select("block", kind(k), *(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in none.items()))

    heads = rows(of_runs.join(values, "run").select("block", "run", "value"), 0).unionAll(
        rows(of_words.join(words.select("word", F.log10((F.col("n") + 0.5) / F.lit(whole)).alias("value")), "word").select("block", "word", "value"), 1)
    )
    stream = heads.unionAll(rows(blocks, 2)).repartition("block").sortWithinPartitions("block", "kind")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, logs, known, table = None, [], [], Known(other), None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.column_stack([batch.column("block").to_numpy(), batch.column("kind").to_numpy()])
            cuts = [0, *(np.flatnonzero((np.diff(at, axis=0) != 0).any(axis=1)) + 1).tolist(), len(at)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                piece = batch.slice(start, stop - start)
                if at[start, 0] != block:
                    block, keys, logs, known, table = at[start, 0], [], [], Known(other), None
                if at[start, 1] == 0:
                    keys.append(piece.column("run").to_numpy())
                    logs.append(piece.column("value").to_numpy())
                elif at[start, 1] == 1:
                    known.update(zip(piece.column("word").to_pylist(), piece.column("value").to_pylist(), strict=True))
                else:
                    if table is None:
                        table = Lookup(np.concatenate(keys), np.concatenate(logs))
                        keys, logs = [], []
                    for part in slices(piece, "text", 2 << 20):
                        yield scores_of(part, table, known, end, learned > 0, tokens, depth)

    schema = f"doc_id {key}, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return stream.select("block", "kind", "doc_id", "text", "run", "word", "value").mapInArrow(scored, schema)


def scores_of(part: pa.RecordBatch, table: Lookup, known: Known, end: float, ends_known: bool, tokens: int, depth: int) -> pa.RecordBatch:
    """The result rows of some documents of a block whose runs and words have these logarithms."""
    own = [words_of(t) for t in texts(part, "text")]
    bodies = [b" ".join(w) + bytes([END]) for w in own]
    found, starts = runs(bodies, depth)
    score_ = np.add.reduceat(table.of(found), starts)
    base, n_known = [], []
    for w in own:
        logs = list(map(known.__getitem__, w))
        base.append(math.fsum(logs) + end)
        n_known.append(len(w) - logs.count(known.other) + ends_known)
    sizes = np.array([len(b) for b in bodies], np.int64)
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array([len(w) + 1 for w in own], pa.int64()),
            pa.array(n_known, pa.int64()),
            pa.array([tokens] * len(own), pa.int64()),
            pa.array(base, pa.float64()),
            pa.array(score_),
            pa.array(sizes),
            pa.array(-score_ / math.log10(2) / sizes),
        ],
        ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"],
    )


def score_held_out(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """``score`` with held_out: learned from documents whose crc32 of the id, modulo ``folds``, is not ``held``.

    Null ids are learned from.
    """
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held, F.lit(False))
    return score(docs, ~out).withColumn("held_out", out)
