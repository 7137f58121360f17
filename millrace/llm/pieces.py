"""SentencePiece encoding and decoding with a given vocabulary; nothing is trained.

Each batch's distinct chunks are indexed by ``lattice``: suffix array, bisection of every piece,
edges sorted by position. The lattice is then relaxed in that order. For a byte-pair model the
encoding of a prefix is the encoding of a shorter prefix plus one piece, and exactly one edge
into each position goes with the last piece before it: the pair must merge to itself. So one
pass over the edges finds the very pieces that merging pair by pair would give.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from .common import MULTIPLIER, kept, slices
from .lattice import SPACE, Edges, Vocabulary, ragged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


class Numbers(dict):
    """Numbers the keys that are asked for, from 0 in the order of asking."""

    def __missing__(self, key: str) -> int:
        found = self[key] = len(self)
        return found


class Encoder:
    """Encodes batches of texts; chunks seen before are looked up, up to a bound."""

    BOUND = 200_000
    PAIRS = 600_000
    SLOT_BITS = 19
    #: Letters of new chunks whose edges are in memory together, but for one longer chunk.
    LETTERS = 1 << 17
    #: Chunks of more letters, and the last few of a batch, are walked one by one.
    LONG = 64
    FEW = 32

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.rank = {p.replace(SPACE, " "): (-s, i) for i, (p, s) in enumerate(zip(vocabulary.pieces, vocabulary.scores, strict=True)) if p}
        self.text = [None if p is None else p.replace(SPACE, " ") for p in vocabulary.pieces]
        self.size = len(vocabulary.pieces) + 1
        seen: set[float] = set()
        self.tied = {r for r, _ in self.rank.values() if r in seen or seen.add(r)}
        self.symbols: dict[int, tuple[list, list] | None] = {}
        self.fits: dict[int, bool] = {}
        self.lately = np.full(1 << self.SLOT_BITS, -4, np.int64)  # 2 * pair + whether it goes
        self.clear()
        self.bytes = [p.encode("utf-8", "surrogatepass") if p else b"" for p in self.text]
        for b, i in enumerate(vocabulary.byte_ids):
            self.bytes[i] = bytes([b])
        self.bytes[vocabulary.unknown] = " ⁇ ".encode()

    def clear(self) -> None:
        self.code = Numbers()
        self.ids = np.empty(0, np.int32)
        self.sizes = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = self.rank.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or found[0] < best):
                    best, at = found[0], k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def edge_symbols(self, piece: int) -> tuple[list, list] | None:
        """What merging a piece's text has at its left and right edge, each from when: (since, symbol).

        ``since`` is the worst rank merged so far: a merge across the border that ranks better comes
        before the symbol. None if the text merges to something else, or if ranks tie in it.
        """
        parts, worst = list(self.text[piece]), float("-inf")
        left, right, ranks = [(worst, parts[0])], [(worst, parts[-1])], []
        while len(parts) > 1:
            found = [(self.rank[t][0], k) for k in range(len(parts) - 1) if (t := parts[k] + parts[k + 1]) in self.rank]
            if not found:
                return None
            rank, at = min(found)
            ranks.append(rank)
            worst = max(worst, rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left.append((worst, parts[0]))
            if at == len(parts) - 1:
                right.append((worst, parts[-1]))
        return None if self.tied.intersection(ranks) else (left, right)

    def goes(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left``: merging their text gives these two pieces.

        -1 for ``left`` is a chunk's start, -2 an unknown letter, which merges with nothing.
        """
        if right < 0:
            return True
        if right not in self.symbols:
            self.symbols[right] = self.edge_symbols(right)
        if left < 0:
            return self.symbols[right] is not None or len(self.merged(self.text[right])) == 1
        a, b = self.symbols.get(left), self.symbols[right]
        if a is None or b is None:
            return self.merged(self.text[left] + self.text[right]) == [self.text[left], self.text[right]]
        # The two sides merge by themselves until a pair across the border ranks better than what is next.
        ours, theirs, i, j = a[1], b[0], 0, 0
        while True:
            ahead = ours[i + 1][0] if i + 1 < len(ours) else float("inf")
            beyond = theirs[j + 1][0] if j + 1 < len(theirs) else float("inf")
            across = self.rank.get(ours[i][1] + theirs[j][1])
            if across is not None:
                if across[0] in self.tied:
                    return self.merged(self.text[left] + self.text[right]) == [self.text[left], self.text[right]]
                if across[0] < ahead and across[0] <= beyond:  # of equal ranks the leftmost comes first
                    return False
            if ahead == beyond == float("inf"):
                return True
            i, j = (i + 1, j) if ahead <= beyond else (i, j + 1)

    def good(self, pairs: np.ndarray) -> np.ndarray:
        """``goes`` for many pairs, each (left + 2) * size + right: a table holds what was asked lately."""
        slots = (pairs.view(np.uint64) * MULTIPLIER) >> np.uint64(64 - self.SLOT_BITS)
        known = self.lately[slots]
        missing = np.flatnonzero((known >> 1) != pairs)
        if len(missing):
            asked, at = np.unique(pairs[missing], return_inverse=True)
            fits, size = self.fits, self.size
            found = []
            for pair in asked.tolist():
                good = fits.get(pair)
                if good is None:
                    left, right = divmod(pair + 1, size)  # right is -1 or a piece
                    good = fits[pair] = self.goes(left - 2, right - 1)
                found.append(2 * pair + good)
            known[missing] = self.lately[slots[missing]] = np.array(found, np.int64)[at]
        return (known & 1).astype(bool)

    def walk(self, edges: Edges, begin: np.ndarray, chunks: np.ndarray, path: np.ndarray, steps: np.ndarray) -> None:
        """Find the path of each chunk: its edges go to ``path``, from the chunk's first position on, their number to ``steps``.

        From each position the longest edge that goes with the piece before is followed; a position
        from which no edge goes on is left for good, since what leads to it is the only way there.
        All chunks take one step at a time.
        """
        stop = edges.first[chunks] + edges.sizes[chunks]
        first = edges.first[chunks]
        at = first.copy()
        last = np.full(len(chunks), -1)
        k, depth = begin[at], np.zeros(len(chunks), np.int64)
        dead = np.zeros(len(edges.text) + 1, bool)
        while len(chunks):
            if len(chunks) < self.FEW:
                self.walk_each(edges, begin, chunks, path, steps)
                return
            back = np.flatnonzero(k >= begin[at + 1])
            if len(back):
                dead[at[back]] = True
                depth[back] -= 1
                top = first[back] + depth[back]
                taken = path[top]
                at[back], k[back] = edges.start[taken], taken + 1
                before = edges.piece[path[np.maximum(top - 1, 0)]]
                last[back] = np.where(depth[back] > 0, np.where(before < 0, -2, before), -1)
            on = np.flatnonzero(k < begin[at + 1])
            edge = k[on]
            end, piece = edges.end[edge], edges.piece[edge]
            good = ~dead[end]
            tried = np.flatnonzero(good)
            good[tried] = self.good((last[on[tried]] + 2) * self.size + piece[tried])
            k[on] += 1
            taken, end, piece = edge[good], end[good], piece[good]
            on = on[good]
            path[first[on] + depth[on]] = taken
            depth[on] += 1
            at[on], k[on], last[on] = end, begin[end], np.where(piece < 0, -2, piece)
            ended = at == stop
            if ended.any():
                steps[chunks[ended]] = depth[ended]
                stay = ~ended
                chunks, stop, first, at, last, k, depth = (x[stay] for x in (chunks, stop, first, at, last, k, depth))

    def walk_each(self, edges: Edges, begin: np.ndarray, chunks: np.ndarray, path: np.ndarray, steps: np.ndarray) -> None:
        """What ``walk`` finds, one chunk after the other: for few chunks, which may be long."""
        begins, ends, pieces = memoryview(begin), memoryview(edges.end), memoryview(edges.piece)
        dead: set[int] = set()
        fits, size, goes = self.fits, self.size, self.goes
        for chunk in chunks.tolist():
            first = at = int(edges.first[chunk])
            last, stop = -1, first + int(edges.sizes[chunk])
            k = begins[at]
            taken: list[tuple[int, int, int]] = []
            while at != stop:
                for k in range(k, begins[at + 1]):  # noqa: B020
                    end = ends[k]
                    if end in dead:
                        continue
                    piece = pieces[k]
                    pair = (last + 2) * size + piece
                    good = fits.get(pair)
                    if good is None:
                        good = fits[pair] = goes(last, piece)
                    if good:
                        taken.append((at, last, k))
                        at, last = end, piece if piece >= 0 else -2
                        k = begins[at]
                        break
                else:
                    dead.add(at)
                    at, last, k = taken.pop()
                    k += 1
            path[first : first + len(taken)] = [k for _, _, k in taken]
            steps[chunk] = len(taken)

    def relax(self, edges: Edges) -> tuple[np.ndarray, np.ndarray]:
        """Per chunk the ids on its path, and their number."""
        if len(self.fits) > self.PAIRS:
            self.fits.clear()
        n = len(edges.text)
        begin = np.searchsorted(edges.start, np.arange(n + 2))
        path, steps = np.zeros(n + 1, np.int64), np.zeros(len(edges.first), np.int64)
        long = edges.sizes > self.LONG
        self.walk(edges, begin, np.flatnonzero(~long), path, steps)
        self.walk_each(edges, begin, np.flatnonzero(long), path, steps)
        taken = path[ragged(edges.first, steps)]
        ids = edges.piece[taken].astype(np.int32)
        alone = np.flatnonzero(ids < 0)
        if len(alone):
            # Unknown letters: the pieces of their bytes.
            to_bytes, unknown = self.vocabulary.byte_ids, self.vocabulary.unknown
            raws = [chr(c).encode("utf-8", "surrogatepass") for c in edges.text[edges.start[taken[alone]]].tolist()]
            own = [[to_bytes[b] for b in raw] if to_bytes else [unknown] for raw in raws]
            times = np.ones(len(ids), np.int64)
            times[alone] = list(map(len, own))
            ids = np.repeat(ids, times)
            ids[ids < 0] = [i for some in own for i in some]
            total = np.concatenate([[0], np.cumsum(times)])
            ends = np.cumsum(steps)
            steps = total[ends] - total[ends - steps]
        return ids, steps

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of each text's; none for null and empty texts."""
        if len(self.code) > self.BOUND:
            self.clear()
        code, chunks = self.code, self.vocabulary.chunks
        known = len(code)
        flat, counts = [], []
        for text in texts:
            parts = chunks(text) if text else []
            counts.append(len(parts))
            flat.extend(map(code.__getitem__, parts))
        new = list(islice(reversed(code), len(code) - known))[::-1]
        if new:
            # Some at a time: the edges of a slice's new chunks may take a hundred times its bytes.
            size = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
            cuts = [0, *(np.flatnonzero(np.diff(size // self.LETTERS)) + 1).tolist(), len(new)]
            done = [self.relax(self.vocabulary.index.edges(new[a:b])) for a, b in pairwise(cuts)]
            ids, sizes = (np.concatenate([x[k] for x in done]) for k in (0, 1))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        at = np.array(flat, np.int64)
        sizes = self.sizes[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(np.array(counts, np.int64))
        return self.ids[ragged(self.starts[at], sizes)], np.diff(total[np.concatenate([[0], ends])])

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, bytes put together, the space in front taken off."""
        raw = b"".join(map(self.bytes.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, ids, n_tokens, and round_trip: whether decoding the ids gives the text again.

    A null text has null ids, no tokens and a null round trip; an empty one has empty ids. Ids equal
    those of the SentencePiece library with the same byte-pair model. As there, U+2581 stands
    for a space, so only texts that hold it do not come back. Texts of any length are encoded
    whole; repeated rows and null doc_ids are kept; other columns are not looked at. An empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    key = docs.schema[id_col].dataType
    schema = StructType(
        [StructField("doc_id", key), StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()), StructField("round_trip", BooleanType())]
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = kept(Encoder, shared.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                ids, sizes = work.encode(texts)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                flat = ids.tolist()
                same = [None if t is None else work.decode(flat[a:b]) == t for t, a, b in zip(texts, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                null = pa.array([t is None for t in texts])
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=null)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), listed, pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "ids", "n_tokens", "round_trip"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encoded, schema)


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id and the text of its ids; null for null ids. Ids outside the vocabulary are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    key = encoded.schema[id_col].dataType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = kept(Encoder, shared.value)
        for batch in batches:
            found = [None if ids is None else work.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(decoded, f"doc_id {key}, text string")
