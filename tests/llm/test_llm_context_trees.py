"""Context-tree weighting against a recursion over whole trees, and word frequencies against a count."""

import math
import zlib
from collections import Counter, defaultdict

import llm_cases as cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import context_trees


def log_estimate(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - 2 * math.lgamma(0.5)


class Recursive:
    """The model as its definition says it, node by node, in dictionaries."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        self.longer, self.memo = defaultdict(set), {}
        for text in texts:
            for context, byte in self.steps(text):
                for d in range(depth + 1):
                    short = context[len(context) - d :]
                    for decision, bit in self.decisions(byte):
                        self.n[short, decision][bit] += 1
                        if d < depth:
                            self.longer[short, decision].add(context[len(context) - d - 1 :])

    def steps(self, text):
        body = b"\xfe" * self.depth + b" ".join((text or "").encode().lower().split()) + b"\xff"
        for i in range(self.depth, len(body)):
            yield body[i - self.depth : i], body[i]

    def decisions(self, byte):
        bits = f"{byte:08b}"
        for k in range(8):
            yield bits[:k], int(bits[k])

    def evidence(self, context, decision):
        key = context, decision
        if key not in self.memo:
            a, b = self.n.get(key, (0, 0))
            found = log_estimate(a, b)
            if len(context) < self.depth:
                children = sum(self.evidence(c, decision) for c in self.longer.get(key, ()))
                found = np.logaddexp(math.log(0.5) + found, math.log(0.5) + children)
            self.memo[key] = found
        return self.memo[key]

    def chance(self, context, d, decision, bit):
        short = context[len(context) - d :]
        a, b = self.n.get((short, decision), (0, 0))
        if not a + b:
            return None
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        deeper = self.chance(context, d + 1, decision, bit) if d < self.depth else None
        if deeper is None:
            return own
        weight = math.exp(math.log(0.5) + log_estimate(a, b) - self.evidence(short, decision))
        return weight * own + (1 - weight) * deeper

    def log10(self, text):
        total = 0.0
        for context, byte in self.steps(text):
            for decision, bit in self.decisions(byte):
                total += math.log10(self.chance(context, 0, decision, bit) or 0.5)
        return total


def base(texts, learned):
    count = Counter()
    for t in learned:
        count.update((t or "").encode().lower().split())
        count[None] += 1
    n, v = sum(count.values()), len(count)
    out = []
    for t in texts:
        tokens = [*(t or "").encode().lower().split(), None]
        out.append((len(tokens), sum(count[w] > 0 for w in tokens), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)))
    return out


TEXTS = [
    "the thin thing", "The  THIN\tthing then", None, "", " \n ", "a" * 40, "abababab abab", "the thin thing", "Größe ½ 文字  x",
    "never seen zebra", "then thin the", "\x00 \x01", "the other thing in the hat " * 9,
]


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_scores_equal_the_recursion(spark, depth, monkeypatch):
    monkeypatch.setattr(context_trees, "TOGETHER", 7)
    docs = cases.documents(spark, TEXTS)
    learned = [t for k, t in enumerate(TEXTS) if k % 3]
    model = Recursive(learned, depth)
    got = {r.doc_id: r for r in context_trees.score(docs, F.col("doc_id") % 3 != 0, depth).collect()}
    for k, (text, (n, known, total, expected)) in enumerate(zip(TEXTS, base(TEXTS, learned), strict=True)):
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (n, known, total)
        assert got[k].base_score == pytest.approx(expected, abs=1e-9)
        assert got[k].score == pytest.approx(model.log10(text), rel=1e-9, abs=1e-9)
        assert got[k].bits_per_byte == pytest.approx(-got[k].score / math.log10(2) / got[k].n_bytes)


def test_chances_of_the_next_byte_add_up_to_one():
    learned = [t for t in TEXTS if t]
    depth = 3
    parts = [np.unique(context_trees.runs([b" ".join(context_trees.words_of(t.encode())) + b"\xff"], depth)[0], return_counts=True) for t in learned]
    held = context_trees.Gathered()
    for keys, counts in parts:
        held.add(keys, counts)
    keys, counts = held.result()
    whole = np.unique(np.concatenate([keys, (keys[5] >> 8 << 8) + np.arange(256), (keys[-1] >> 8 << 8) + np.arange(256)]))
    n = np.zeros(len(whole), np.int64)
    n[np.searchsorted(whole, keys)] = counts
    tree = context_trees.weighed(whole, n, depth, 2)
    up, at = np.unique(((tree.nodes >> 16) << 8) | (tree.nodes & 0xFF), return_inverse=True)
    sums = [np.bincount(at, x, len(up)) for x in (tree.zeros, tree.ones, tree.evidence)]
    top = context_trees.Top([dict(node=k, zeros=a, ones=b, evidence=e) for k, a, b, e in zip(up, *sums, strict=True)], depth)
    logs = top.logs(whole, tree.chance, depth)
    for context in (keys[5] >> 8, keys[-1] >> 8):
        assert (10 ** logs[whole >> 8 == context]).sum() == pytest.approx(1)


def test_blocks_change_nothing(spark, monkeypatch):
    docs = cases.documents(spark, cases.corpus(3, 25))
    one = sorted(map(tuple, context_trees.score_held_out(docs).collect()))
    monkeypatch.setattr(context_trees, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(context_trees.Block, "WORDS", 50)
    many = sorted(map(tuple, context_trees.score_held_out(docs).collect()))
    assert len(one) == len(many)
    for x, y in zip(one, many, strict=True):
        assert x[:4] == y[:4] and x[4:8] == pytest.approx(y[4:8]) and x[8] == y[8]


def test_held_out_documents_teach_nothing_and_repeats_count(spark):
    texts = ["one two"] * 6 + ["zebra zebra"] * 4
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 5 != 1][:6] + [k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 1][:4]
    got = context_trees.score_held_out(cases.documents(spark, texts, ids)).collect()
    assert [r.held_out for r in sorted(got, key=lambda r: ids.index(r.doc_id))] == [False] * 6 + [True] * 4
    assert all(r.n_known == 1 and r.train_tokens == 18 for r in got if r.held_out)
    assert len({r.score for r in got}) == 2


def test_null_ids_repeated_rows_and_nothing_learned(spark):
    docs = cases.documents(spark, ["x y", "x y", None], [None, None, 7])
    got = context_trees.score(docs, F.lit(False)).collect()
    assert len(got) == 3
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(3, 0, 0, 0.0), (1, 0, 0, 0.0)}
    assert all(r.bits_per_byte == pytest.approx(8) for r in got)
    assert context_trees.score_held_out(docs.limit(0)).collect() == []
