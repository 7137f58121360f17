"""Nearest neighbours by inner product: vantage-point trees per shard.

Vectors get one more component so that all are equally long; then the largest inner product
is the least distance. Rows are dealt into shards by a hash of their id; each shard's rows
become a tree: a vantage point splits the rest into a near and a far half by their distance to
it, down to leaves. By the triangle inequality a half can be skipped if the query's distance to
the vantage point, less the half's farthest (or the half's nearest less it), exceeds the query's
k-th best distance so far. ``factor`` relaxes the test: that distance is divided by it, so a
larger factor skips more; factor one restores exact search.

Trees are built once and kept as a table. Queries are dealt into blocks, and each block is
searched in each shard, all its queries at once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out

#: Bytes of a shard's vectors, about: its tree is one row of a table.
SHARD_BYTES = 8 << 20
#: Queries that are sent to a shard together, and those that walk its tree together.
QUERY_BLOCK = 1024
WALK = 256
LEAF = 128
#: Distances carry rounding errors; what is within this share of them is not skipped.
SLACK = 1e-9


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, summed from the first component on."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * y[:, k]
    return total


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to all rows of ``y``."""
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0.0))


class Tree:
    """A vantage-point tree over the rows of one shard, reordered so that each node is a range of them.

    A node is (vantage row, start, end, children); a child is (nearest, farthest, node), with
    the distances of the child's rows to the vantage point. Leaves have no children.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float) -> None:
        self.ids, self.vectors, self.longest = ids, vectors, longest
        self._lengthen()
        order = np.argsort(ids, kind="stable")
        self.root = self._build(order) if len(order) else None

    def _lengthen(self) -> None:
        extra = np.sqrt(np.maximum(self.longest**2 - (self.vectors * self.vectors).sum(axis=1), 0.0))
        self.points = np.column_stack([self.vectors, extra])

    def __getstate__(self) -> dict:
        return {n: getattr(self, n) for n in ("ids", "vectors", "longest", "root")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._lengthen()

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return (-1, rows, ())
        vantage, rest = rows[0], rows[1:]
        away = distances(self.points[vantage : vantage + 1], self.points[rest])[0]
        order = np.argsort(away, kind="stable")
        rest, away = rest[order], away[order]
        half = len(rest) // 2
        parts = ((rest[:half], away[:half]), (rest[half:], away[half:]))
        return (vantage, rows[:1], tuple((d[0], d[-1], self._build(r)) for r, d in parts if len(r)))

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of each query's ``k`` best rows, without its own; -1 where there are fewer."""
        self.k, self.factor = k, factor
        self.queries, self.own = queries, own
        self.targets = np.column_stack([queries, np.zeros(len(queries))])
        self.best = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1, np.int64)
        self.square = (queries * queries).sum(axis=1) + self.longest**2
        if self.root is not None and len(queries):
            self._visit(self.root, np.arange(len(queries)))
        return self.found, self.best

    def _radius(self, active: np.ndarray) -> np.ndarray:
        """The distance at which a row would score as the k-th best so far."""
        worst = self.best[active, -1]
        return np.sqrt(np.maximum(np.where(np.isinf(worst), np.inf, self.square[active] - 2.0 * worst), 0.0))

    def _visit(self, node, active: np.ndarray) -> None:
        vantage, rows, children = node
        self._offer(active, rows)
        if not children:
            return
        away = distances(self.targets[active], self.points[vantage : vantage + 1])[:, 0]
        # The half most queries lie in comes first, so that radii are small before the other. Each
        # half is visited once, by all the queries that need it together.
        nearer_first = (away <= children[0][1]).mean() >= 0.5
        for nearest, farthest, child in children if nearer_first else children[::-1]:
            gap = np.maximum(np.maximum(away - farthest, nearest - away), 0.0)
            go = gap <= self._radius(active) / self.factor * (1.0 + SLACK) + SLACK * self.longest
            if go.any():
                self._visit(child, active[go])

    def _offer(self, active: np.ndarray, rows: np.ndarray) -> None:
        """Put rows among the best of the active queries; ties go to the smaller id."""
        rough = self.queries[active] @ self.vectors[rows].T
        rough[self.ids[rows][None, :] == self.own[active][:, None]] = -np.inf
        floor = self.best[active, -1]
        with np.errstate(invalid="ignore"):
            at, which = np.nonzero((rough >= (floor - np.abs(floor) * SLACK - SLACK * self.longest**2)[:, None]) & ~np.isneginf(rough))
        if not len(at):
            return
        score = inner(self.queries[active[at]], self.vectors[rows[which]])
        touched = np.unique(at)
        query = np.concatenate([np.repeat(touched, self.k), at])
        scores = np.concatenate([self.best[active[touched]].reshape(-1), score])
        ids = np.concatenate([self.found[active[touched]].reshape(-1), self.ids[rows[which]]])
        order = np.lexsort((ids, -scores, query))
        query, scores, ids = query[order], scores[order], ids[order]
        starts = np.searchsorted(query, touched)
        take = starts[:, None] + np.arange(self.k)
        self.best[active[touched]] = scores[take]
        self.found[active[touched]] = ids[take]


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the vectors that take part: finite, not null, not zero, with an id."""
    own = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return own.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & good & F.exists("vector", lambda v: v != 0))


def index(rows: DataFrame, shard_rows: int | None = None) -> tuple[DataFrame, int]:
    """The trees, one row (shard, tree) for each shard, and the number of shards."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    total = rows.agg(F.count("*").alias("n"), F.max(square).alias("square"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
    if total["low"] != total["high"]:
        raise ValueError("vectors differ in length")
    shard_rows = shard_rows or max(LEAF, SHARD_BYTES // (8 * max(1, total["high"] or 1)))
    shards = max(1, -(-total["n"] // shard_rows))
    longest = float(np.sqrt(total["square"] or 0.0)) * (1.0 + SLACK)

    def built(key: tuple, table: pa.Table) -> pa.Table:
        flat = table.column("vector").combine_chunks()
        values = flat.flatten().to_numpy(zero_copy_only=False)
        ids = table.column("vec_id").to_numpy()
        tree = Tree(ids, values.reshape(len(ids), -1), longest)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(built, "shard int, tree binary"), shards


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0, shard_rows: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query its ``k`` nearest rows of ``vectors``: query_id, rank from 1, vec_id, score.

    Nearest is the largest inner product in double precision, ties to the smaller id; a query's own
    id is no candidate. Vectors that are null or zero, or hold null or non-finite components, take
    no part, on either side, nor do rows without an id. Repeated rows count once; different vectors
    with one id are candidates each, and of such queries the least vector asks. With fewer
    candidates all are given; empty tables give an empty result. Vectors of different lengths
    are an error. Other columns are not looked at.
    """
    if factor < 1.0:
        raise ValueError("a factor below one would only search what is skipped anyway")
    rows = valid(vectors, id_col, vector_col).dropDuplicates(["vec_id", "vector"])
    trees, shards = index(rows, shard_rows)
    trees = write_out(trees, "trees")
    asked = valid(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    packed = asked.groupBy("block").agg(F.collect_list(F.struct("vec_id", "vector")).alias("asked"))
    packed = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    packed = packed.select("shard", "block", F.col("asked.vec_id").alias("ids"), F.flatten("asked.vector").alias("values"))
    pairs = packed.join(trees, "shard").repartition(shards * blocks, "shard", "block")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tree = pickle.loads(batch.column("tree")[row].as_py())
                ids = batch.column("ids")[row].values.to_numpy(zero_copy_only=False)
                values = batch.column("values")[row].values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                for start in range(0, len(ids), WALK):
                    own = ids[start : start + WALK]
                    found, score = tree.search(values[start : start + WALK], own, k, factor)
                    there = ~np.isneginf(score)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, k)[there.reshape(-1)]), pa.array(found[there]), pa.array(score[there])], ["query_id", "vec_id", "score"])

    found = pairs.select("ids", "values", "tree").mapInArrow(searched, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
