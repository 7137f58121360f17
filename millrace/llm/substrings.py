"""Substring dedup: words under a window that occurs earlier are removed.

A window is ``WINDOW`` consecutive words. Difference-cover anchors find them: in every document
short runs of ``ANCHOR`` words are hashed only at positions that are in ``COVER`` modulo
``PERIOD``. COVER is a difference cover: whatever the distance of two equal windows, some offset
below PERIOD puts both on cover positions, so they share an aligned anchor. Anchors that occur
twice are extended to the windows around them; equal windows are found by hashes of the whole
window, and all but the earliest are removed.

Within each Arrow batch repeats of an anchor or window are settled on the spot: in the shuffle, a
passage that many documents share has a row or two per batch in one place, not one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out
from .common import WordHashes, slices, texts, window_hashes

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
SECOND = np.uint64(0xD6E8FEB86659FD93)
#: Text bytes that are settled together in a task.
TOGETHER = 1 << 22


def tie_of(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """What tells rows with one doc_id and different texts apart: their checksum, or 0 where there are no such rows.

    It only has to be carried along where it is needed.
    """
    tie = F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"))
    each = docs.select(F.col(id_col).alias("doc_id"), tie.alias("tie")).groupBy("doc_id").agg(F.min("tie").alias("low"), F.max("tie").alias("high"))
    return F.lit(0).cast("long") if each.where("low != high").isEmpty() else tie


def keyed(docs: DataFrame, id_col: str, text_col: str, tie: Column) -> DataFrame:
    """(doc_id, tie, text): equal rows are one document; other rows with one doc_id are ordered by ``tie``."""
    return docs.select(F.col(id_col).alias("doc_id"), tie.alias("tie"), F.col(text_col).alias("text"))


def hashed_words(part: pa.RecordBatch, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts end to end, and the number of words of each."""
    words = [t.split() if t else [] for t in texts(part, "text")]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.concatenate([hashes.of(w) for w in words]) if len(words) else np.empty(0, np.uint64), sizes


def runs(values: np.ndarray, sizes: np.ndarray, n: int, multiplier: np.uint64 | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, position) of all runs of ``n`` words that lie within one text."""
    found = window_hashes(values, n) if multiplier is None else window_hashes(values, n, multiplier)
    row = np.repeat(np.arange(len(sizes)), sizes)
    position = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = position[: len(found)] + n <= sizes[row[: len(found)]]
    return found[inside], row[: len(found)][inside], position[: len(found)][inside]


def running(new: np.ndarray) -> np.ndarray:
    """The running number, from 0, of each entry since the last one that is ``new``."""
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def anchors(docs: DataFrame, key: str) -> DataFrame:
    """(anchor, known, doc_id, tie, position).

    The first two of an anchor in a batch meet those of other batches. Further ones are known to be
    shared; any number stands for their anchor, so that no anchor has more than two rows per batch
    in one place.
    """
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                found, row, position = runs(*hashed_words(part, hashes), ANCHOR)
                at = cover[position % PERIOD]
                found, row, position = found[at], row[at], position[at]
                order = np.argsort(found, kind="stable")
                ordered = found[order]
                known = np.zeros(len(found), bool)
                known[order] = running(np.r_[True, ordered[1:] != ordered[:-1]][: len(found)]) >= 2
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(known, np.arange(len(found)), found.view(np.int64))),
                        pa.array(known),
                        part.column("doc_id").take(at),
                        part.column("tie").take(at),
                        pa.array(position, pa.int32()),
                    ],
                    ["anchor", "known", "doc_id", "tie", "position"],
                )

    return docs.mapInArrow(hashed, f"anchor long, known boolean, doc_id {key}, tie long, position int")


def shared_positions(found: DataFrame) -> DataFrame:
    """(doc_id, tie, positions): per document where its shared anchors start."""
    times = F.count("*").over(Window.partitionBy("anchor", "known"))
    shared = found.withColumn("times", times).where("times > 1 or known")
    return shared.groupBy("doc_id", "tie").agg(F.collect_set("position").alias("positions"))


def beside(docs: DataFrame, more: DataFrame, name: str) -> DataFrame:
    """``docs`` with column ``name`` of the (doc_id, tie, name) rows, null without any."""
    more = more.toDF("__id", "__tie", name)
    return docs.join(more, docs["doc_id"].eqNullSafe(more["__id"]) & (docs["tie"] == more["__tie"]), "left").drop("__id", "__tie")


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in one of the ranges."""
    change = np.bincount(starts, minlength=size + 1)[: size + 1] - np.bincount(ends, minlength=size + 1)[: size + 1]
    return np.cumsum(change)[:size] > 0


def document_numbers(part: pa.RecordBatch) -> np.ndarray:
    """Numbers of a batch's documents in the order of (doc_id, tie), nulls first; equal rows share one."""
    table = pa.table({"d": part.column("doc_id"), "t": part.column("tie")})
    order = pc.sort_indices(table, sort_keys=[("d", "ascending"), ("t", "ascending")], null_placement="at_start").to_numpy()
    in_order = list(zip(*(c.to_pylist() for c in table.take(pa.array(order)).columns), strict=True))
    number = np.empty(part.num_rows, np.int64)
    number[order] = np.cumsum([k > 0 and in_order[k] != in_order[k - 1] for k in range(len(in_order))])
    return number


def windows(docs: DataFrame, key: str) -> DataFrame:
    """(h, g, known, doc_id, tie, position) of the windows around shared anchors.

    A batch's earliest of equal windows meets those of other batches. Others are known to be removed
    whatever other batches hold; any number stands for their hash.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                values, sizes = hashed_words(part, hashes)
                starts = np.cumsum(sizes) - sizes
                positions = part.column("positions")
                text_start = np.repeat(starts, positions.value_lengths().to_numpy(zero_copy_only=False))
                anchor = positions.flatten().to_numpy(zero_copy_only=False) + text_start
                # The windows that hold an anchor start up to PERIOD - 1 words before it.
                near = covered(np.maximum(anchor - PERIOD + 1, text_start), anchor + 1, len(values))
                h, row, position = runs(values, sizes, WINDOW)
                g = runs(values, sizes, WINDOW, SECOND)[0]
                keep = near[starts[row] + position]
                h, g, row, position = h[keep], g[keep], row[keep], position[keep]
                number = document_numbers(part)[row]
                order = np.lexsort((position, number, g, h))
                h, g, row, position, number = (x[order] for x in (h, g, row, position, number))
                new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])][: len(h)]
                first = np.arange(len(h)) - running(new)
                later = (number != number[first]) | (position != position[first])
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(later, np.arange(len(h)), h.view(np.int64))),
                        pa.array(np.where(later, 0, (g >> np.uint64(32)).astype(np.uint32).view(np.int32))),
                        pa.array(later),
                        part.column("doc_id").take(at),
                        part.column("tie").take(at),
                        pa.array(position, pa.int32()),
                    ],
                    ["h", "g", "known", "doc_id", "tie", "position"],
                )

    return docs.mapInArrow(hashed, f"h long, g int, known boolean, doc_id {key}, tie long, position int")


def later_starts(found: DataFrame) -> DataFrame:
    """(doc_id, tie, starts): per document where windows start whose words start earlier too."""
    earliest_first = Window.partitionBy("h", "g", "known").orderBy(F.asc_nulls_first("doc_id"), "tie", "position")
    later = found.withColumn("place", F.rank().over(earliest_first)).where("place > 1 or known")
    return later.groupBy("doc_id", "tie").agg(F.collect_set("position").alias("starts"))


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def settle(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, tie, n_words, kept_sha256, text, positions): documents without shared anchors get their result.

    Their text is not carried on.
    """

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                is_open = part.column("positions").is_valid().to_pylist()
                raw = texts(part, "text")
                words = [t.split() if t else [] for t in raw]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("tie"),
                        pa.array(map(len, words), pa.int64()),
                        pa.array([None if o else digest(w) for o, w in zip(is_open, words, strict=True)], pa.string()),
                        pa.array([t if o else None for o, t in zip(is_open, raw, strict=True)], pa.binary()).cast(pa.string()),
                        part.column("positions"),
                    ],
                    ["doc_id", "tie", "n_words", "kept_sha256", "text", "positions"],
                )

    return docs.mapInArrow(settled, f"doc_id {key}, tie long, n_words long, kept_sha256 string, text string, positions array<int>")


def removed(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, tie, n_words, n_removed, kept_sha256, kept) from (doc_id, tie, text, starts)."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                total, left = [], []
                for text, starts in zip(texts(part, "text"), part.column("starts").to_pylist(), strict=True):
                    words = text.split() if text else []
                    total.append(len(words))
                    if starts:
                        at = np.array(starts, np.int64)
                        gone = covered(at, at + WINDOW, len(words))
                        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    left.append(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("tie"),
                        pa.array(total, pa.int64()),
                        pa.array([t - len(w) for t, w in zip(total, left, strict=True)], pa.int64()),
                        pa.array(map(digest, left), pa.string()),
                        pa.array([b" ".join(w) for w in left], pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "tie", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return docs.mapInArrow(kept, f"doc_id {key}, tie long, n_words long, n_removed long, kept_sha256 string, kept string")


def judge(docs: DataFrame, tie: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Settled documents, and those with shared anchors as ``removed`` gives them.

    Positions and starts are written by themselves: the shuffles of anchors and windows, the largest of all,
    are gone before texts are shuffled.
    """
    key = docs.schema[id_col].dataType.simpleString()
    own = keyed(docs, id_col, text_col, tie)
    shared = write_out(shared_positions(anchors(own, key)), "shared-anchors")
    looked = write_out(settle(beside(own, shared, "positions"), key), "anchored")
    still_open = looked.where("positions is not null")
    starts = write_out(later_starts(windows(still_open.select("doc_id", "tie", "text", "positions"), key)), "later-windows")
    return looked.where("positions is null"), removed(beside(still_open.select("doc_id", "tie", "text"), starts, "starts"), key)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256.

    Null, empty and wordless texts have no words; texts below ``WINDOW`` words keep all. A null
    doc_id comes before all others. Equal rows are one document, given more than once: each
    gets that document's result. Rows with the same doc_id and other texts are ordered by the texts'
    checksum. Other columns are not looked at. An empty table gives an empty result.
    """
    settled, rest = judge(docs, tie_of(docs, id_col, text_col), id_col, text_col)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return settled.withColumn("n_removed", F.lit(0).cast("long")).select(columns).unionAll(rest.select(columns))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the repeated words taken out, where there are any, and all their columns.

    What is left of such a text is joined by single spaces, and ``n_chars`` (where there is one)
    counts it; texts without a repeat stay as they are. Null ids come first; null, empty and wordless texts
    stay; repeated rows stay, each with the same text. Columns may have any names. Empty tables stay empty.
    """
    own = docs.select("doc_id", "text", F.struct("*").alias("row")).withColumn("own", tie_of(docs, "doc_id", "text"))
    changed = judge(own, F.col("own"))[1].where("n_removed > 0").select("doc_id", "tie", "kept").dropDuplicates(["doc_id", "tie"])
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("tie"))
    found = own.join(changed.toDF("id", "tie", "kept"), same, "left")
    columns = {f.name: F.col("row").getField(f.name) for f in docs.schema}
    columns["text"] = F.coalesce(F.col("kept"), columns["text"])
    if "n_chars" in columns:
        counted = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("kept").isNull(), columns["n_chars"]).otherwise(counted)
    return found.select([c.alias(name) for name, c in columns.items()])
