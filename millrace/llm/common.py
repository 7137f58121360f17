"""Helpers the text operators share: Arrow slices of bounded size, word and shingle hashes, universal hash minima."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import SparkSession

#: Words of a shingle where an operator is about near-duplicates.
SHINGLE_WORDS = 5

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_shipped: set[str] = set()


#: Bytes of an Arrow batch that a worker gets, about; one longer row is a batch of its own.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, where their PYTHONPATH does not name it: as with --py-files.

    Workers get rows in batches of bounded bytes, so that 10,000 long texts are never in memory together.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    named = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    app = spark.sparkContext.applicationId
    if app in _shipped or ROOT in map(os.path.abspath, filter(None, named)):
        return
    folder = tempfile.mkdtemp()
    package = os.path.join(folder, "package")
    shutil.copytree(os.path.join(ROOT, "millrace"), os.path.join(package, "millrace"), ignore=shutil.ignore_patterns("__pycache__"))
    before = list(sys.path)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, f"millrace-{app}"), "zip", package))
    sys.path[:] = before  # the driver goes on with the modules it has
    _shipped.add(app)


_kept: list = []


def kept(make: Callable, source: object) -> object:
    """The worker process's ``make(source)``: what it remembers serves the next task too.

    There is one of them at a time. Spark reuses a worker from job to job, where those of earlier
    operators would stay in memory beside it.
    """
    if not _kept or _kept[0] is not make or _kept[1] is not source:
        _kept.clear()
        _kept[:] = [make, source, make(source)]
    return _kept[2]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes, so that work memory stays bounded.

    A single longer text is a run of its own: texts are never cut.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    # Rows whose running size falls into the same multiple of the limit go together.
    run = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(start, end - start)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return batch.column(column).cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    BOUND = 200_000

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        self[word] = found
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.BOUND:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of multiply and shift steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, n: int, multiplier: np.uint64 = MULTIPLIER) -> np.ndarray:
    """A hash of every run of ``n`` consecutive words; none if there are fewer words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    found = words[:count].copy()
    for k in range(1, n):
        found *= multiplier
        found += words[k : k + count]
    return mixed(found)


def shingles(text: bytes | None, hashes: WordHashes, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles: runs of ``n`` words, A-Z lower-cased.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(n, len(words))))


def universal(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of ``count`` universal hash functions on 64-bit values."""
    rng = np.random.Generator(np.random.PCG64(seed))
    a = rng.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 2**64, count, dtype=np.uint64)


def minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """The least value of each universal hash over each set, as its upper 32 bits: (sets, hashes).

    Sets are laid end to end in blocks that stay in the cache. Empty sets get the highest value.
    """
    out = np.full((len(sets), len(a)), np.iinfo(np.uint32).max, np.uint32)
    sizes = np.array([len(s) for s in sets])
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    ends = np.cumsum(sizes[filled])
    for group in np.split(filled, np.flatnonzero(np.diff(ends // block)) + 1):
        values = np.concatenate([sets[i] for i in group])
        starts = np.concatenate([[0], np.cumsum(sizes[group])[:-1]])
        work = np.empty_like(values)
        for k in range(len(a)):
            np.multiply(values, a[k], out=work)
            np.add(work, b[k], out=work)
            out[group, k] = np.minimum.reduceat(work, starts) >> np.uint64(32)
    return out
