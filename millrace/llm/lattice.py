"""All occurrences of a vocabulary's pieces in a batch of words, through a suffix array.

The words of a batch are laid end to end, with a mark between them that no piece holds. The
positions are sorted by the text that starts there; every piece is searched in that order by
bisection, which gives the range of its occurrences; the occurrences, sorted by position, are
the edges of the words' segmentation lattices.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np

SPACE = "▁"
#: White space starts a chunk; a line end is one by itself.
CHUNK = re.compile(r"\n| *[^ \n]+| +")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, with ``None`` for ids that match no text (control, unknown and byte pieces)."""

    pieces: tuple[str | None, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]  # id of each byte's piece; empty without byte pieces
    unknown: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a SentencePiece model file; on the driver, the result is broadcast (one row per piece)."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        text = [None if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) else model.id_to_piece(i) for i in ids]
        by_byte = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        return Vocabulary(
            tuple(text), tuple(map(model.get_score, ids)), tuple(by_byte[b] for b in range(256)) if len(by_byte) == 256 else (), model.unk_id()
        )

    @cached_property
    def chunked(self) -> bool:
        """Whether no piece crosses the borders that ``chunks`` cuts at."""
        return not any(p and (("\n" in p and len(p) > 1) or SPACE in p.lstrip(SPACE)) for p in self.pieces)

    def chunks(self, text: str) -> list[str]:
        """Parts of the text that can be segmented each by itself; the text gets a space in front."""
        text = " " + text.replace(SPACE, " ")
        return CHUNK.findall(text) if self.chunked else [text]

    @cached_property
    def index(self) -> Index:
        return Index(self)


class Index:
    """The pieces as numbers, ready for the search."""

    MARK = 0x110000  # beyond Unicode: stands between words

    def __init__(self, vocabulary: Vocabulary) -> None:
        found = [(i, p.replace(SPACE, " ")) for i, p in enumerate(vocabulary.pieces) if p]
        self.ids = np.array([i for i, _ in found], np.int32)
        self.lengths = np.array([len(p) for _, p in found], np.int64)
        self.longest = int(self.lengths.max())
        letters = sorted({c for _, p in found for c in p})
        self.code = np.zeros(self.MARK + 1, np.uint16)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letters = len(letters)
        self.table = np.zeros((len(found), self.longest), np.int64)
        flat = codes("".join(p for _, p in found))
        row = np.repeat(np.arange(len(found)), self.lengths)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.table[row, column] = self.code[flat]

    def edges(self, words: Sequence[str], by_end: bool = False) -> Edges:
        """The occurrences of all pieces in ``words``, sorted by start (or end), longest first."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        text = np.full(int(sizes.sum()) + len(words), self.MARK, np.uint32)
        text[np.arange(len(word)) + word] = codes("".join(words))
        first = np.cumsum(sizes + 1) - sizes - 1
        known = self.code[text].astype(np.int64)

        # Letters that occur, numbered without gaps, so that many fit into one sort key.
        there = np.zeros(self.letters + 1, bool)
        there[known] = True
        there[0] = True
        rank = np.cumsum(there) - 1
        bits = max(1, int(rank[-1]).bit_length())
        depth = min(self.longest, 62 // bits)
        ranked = np.concatenate([rank[known], np.zeros(self.longest, np.int64)])
        key = np.zeros(len(text), np.int64)
        for k in range(depth):
            key = (key << bits) | ranked[k : k + len(text)]
        order = np.argsort(key)
        sorted_key = key[order]

        # Bisection: a piece's occurrences are one range of the order.
        use = np.flatnonzero(there[self.table].all(axis=1))
        letters, lengths = rank[self.table[use]], self.lengths[use]
        low = np.zeros(len(use), np.int64)
        for k in range(depth):
            low = (low << bits) | letters[:, k]
        high = low + (np.int64(1) << (bits * np.maximum(depth - lengths, 0)))
        start = np.searchsorted(sorted_key, low, "left")
        count = np.searchsorted(sorted_key, high, "left") - start
        hit = np.repeat(np.arange(len(use)), count)
        at = order[np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)]
        # The letters of long pieces beyond the sort key are compared one by one.
        long = np.flatnonzero(lengths[hit] > depth)
        if len(long):
            same = np.ones(len(long), bool)
            for k in range(depth, self.longest):
                same &= (lengths[hit[long]] <= k) | (letters[hit[long], k] == ranked[at[long] + k])
            stays = np.ones(len(hit), bool)
            stays[long[~same]] = False
            hit, at = hit[stays], at[stays]
        length = lengths[hit]
        piece = self.ids[use][hit]

        # Letters that are no piece: an edge of their own, as unknown.
        single = np.zeros(len(text), bool)
        single[at[length == 1]] = True
        alone = np.flatnonzero(~single & (text != self.MARK))
        start = np.concatenate([at, alone])
        length = np.concatenate([length, np.ones(len(alone), np.int64)])
        piece = np.concatenate([piece, np.full(len(alone), -1, np.int32)])
        at = start + length if by_end else start
        order = np.argsort(at * (self.longest + 1) + (self.longest - length))
        start, length, piece = start[order], length[order], piece[order]
        return Edges(text, first, sizes, start, start + length, piece)


@dataclass(frozen=True)
class Edges:
    """Edge k spans text[start[k]:end[k]] as piece[k], -1 for an unknown letter. Word w starts at first[w]."""

    text: np.ndarray
    first: np.ndarray
    sizes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray


def codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of many ranges, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
