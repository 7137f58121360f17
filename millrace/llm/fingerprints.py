"""MinHash fingerprints of documents, and of their edited texts.

A fingerprint holds, for each of ``PERMUTATIONS`` universal hash functions, one byte of the least
hash of the text's five-word shingles, in hexadecimal. Likeness is the share of agreeing bytes,
less what chance gives. ``similar`` joins bands of the same minima in Spark and verifies the
Jaccard similarity on full shingle sets, at any percentage.

A document's edited text takes the beginning of the next document by id. Documents are dealt
into ranges of ids; a range also gets the first document of the next one, so that neighbours
meet within one sorted partition and the text is shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_out
from . import neardup
from .common import WordHashes, minima, shingles, slices, texts, universal

PERMUTATIONS = 128
SEED = 3
#: Text bytes of a range of ids, about.
RANGE_BYTES = 8 << 20
LOWEST = -(2**63)


def fingerprint_bytes(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(sets, permutations): one byte of each least hash."""
    return (minima(sets, a, b) & np.uint32(0xFF)).astype(np.uint8)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: agreeing places beyond the 1 in 256 that agree by chance."""
    share = (x == y).mean(axis=1)
    return np.clip((share - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the following text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def ranges(docs: DataFrame) -> np.ndarray:
    """The ids at which ranges of about ``RANGE_BYTES`` start, without the first."""
    total = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n = int((total["bytes"] or 0) // RANGE_BYTES)
    if not n:
        return np.empty(0, np.int64)
    cuts = docs.agg(F.percentile_approx("at", [k / (n + 1) for k in range(1, n + 1)], F.lit(max(10_000, 20 * n)))).first()[0]
    return np.unique(np.array(cuts, np.int64))


def with_following(docs: DataFrame) -> DataFrame:
    """(at, doc_id, text, range, tail) in order within ranges: each range ends with its successor's first row as its tail."""
    bounds = ranges(docs)
    numbered = F.pandas_udf(lambda ids: pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right")), "int")
    dealt = docs.withColumn("range", numbered("at"))
    # One row per range comes to the driver.
    first = F.min(F.struct("at", "tie"))
    firsts = {r["range"]: r["first"] for r in dealt.select("range", "at", "tie").groupBy("range").agg(first.alias("first")).collect()}
    order = sorted(firsts)
    heads = [(firsts[r]["at"], firsts[r]["tie"], order[k - 1]) for k, r in enumerate(order)]
    before = docs.sparkSession.createDataFrame(heads, "at long, tie long, before int")
    tails = docs.join(F.broadcast(before), ["at", "tie"]).select("at", "tie", "doc_id", "text", F.col("before").alias("range"), F.lit(True).alias("tail"))
    rows = dealt.select("at", "tie", "doc_id", "text", "range", F.lit(False).alias("tail")).unionAll(tails)
    return rows.repartition("range").sortWithinPartitions("range", "tail", "at", "tie")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", permutations: int = PERMUTATIONS) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Ids are integers. A null text counts as empty; texts without words have the fingerprint of the
    empty set, alike to each other. Null ids come first, rows with equal ids follow each other by
    their text's hash, repeated rows too: the next document of a repeated row is its repeat. A
    single document is its own next. Other columns are not looked at. Empty tables stay empty.
    """
    a, b = universal(permutations, SEED)
    key = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("at"), F.xxhash64(text).alias("tie"), text.alias("text"))

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = WordHashes(), None
        for batch in batches:
            for part in slices(batch, "text"):
                rows = list(zip(*(part.column(c).to_pylist() for c in ("range", "tail", "doc_id", "text")), strict=True))
                found = fingerprint_bytes([shingles(r[3].encode(), words) for r in rows], a, b)
                pairs = []
                for k, row in enumerate(rows):
                    if last is not None and last[0][0] == row[0] and not last[0][1]:
                        pairs.append((last[0], last[1], row, found[k]))
                    last = (row, found[k])
                if not pairs:
                    continue
                changed = [edited(x[3], y[3]).encode() for x, _, y, _ in pairs]
                new = fingerprint_bytes([shingles(t, words) for t in changed], a, b)
                mine, following = np.stack([p[1] for p in pairs]), np.stack([p[3] for p in pairs])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[2] for x, _, _, _ in pairs], part.schema.field("doc_id").type),
                        pa.array([len(x[3]) for x, _, _, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
                        pa.array([p.tobytes().hex() for p in mine], pa.string()),
                        pa.array([p.tobytes().hex() for p in new], pa.string()),
                        pa.array(likeness(mine, new)),
                        pa.array(likeness(mine, following)),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    schema = f"doc_id {key}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_following(own).select("range", "tail", "doc_id", "text").mapInArrow(printed, schema)


def signatures(docs: DataFrame, permutations: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, nameless, n_shingles, set_id, signature): two bytes of each least hash; null for empty sets.

    The lower byte is the one the fingerprint holds.
    """
    a, b = universal(permutations, SEED)
    key = docs.schema[id_col].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [shingles(t, words) for t in texts(part, "text")]
                least = (minima(found, a, b) & np.uint32(0xFFFF)).astype(np.uint16).view(np.int16)
                offsets = pa.array(np.arange(0, least.size + 1, permutations, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("nameless"),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(least.reshape(-1)), mask=pa.array([not len(s) for s in found], pa.bool_())),
                    ],
                    ["doc_id", "nameless", "n_shingles", "set_id", "signature"],
                )

    return neardup.named_texts(docs, id_col, text_col).mapInArrow(signed, f"doc_id {key}, nameless long, n_shingles long, set_id binary, signature array<smallint>")


def similar(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", permutations: int = PERMUTATIONS) -> DataFrame:
    """Per document: doc_id, class_id, component_id, of documents with Jaccard similarity ``percent`` or more.

    The signatures are made by the fingerprints' own hash functions. Bands of them, as many and as long
    as ``percent`` needs, are joined in Spark; pairs are verified on full shingle sets.
    A percent that so many permutations cannot find surely is refused. Null ids, empty texts and
    repeated rows are as in ``neardup.groups``.
    """
    neardup.banding(percent, permutations)
    found = write_out(signatures(docs, permutations, id_col, text_col), "signatures")
    groups = neardup.groups(docs, percent, id_col, text_col, found=found, minima=permutations)
    return groups.select("doc_id", "class_id", "component_id")
