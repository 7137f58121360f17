"""Merkle manifests against a plain tree over sorted lists."""

import random
import zlib
from hashlib import sha256

import llm_cases as cases
import pytest
from pyspark.sql import functions as F

from millrace.llm import manifest


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row
    values = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(nodes, fanout):
    """(root, per node the siblings left and right of every level)."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(own):
            start = at - at % fanout
            paths[k].append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + fanout])))
        nodes = [h(*nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        own = [at // fanout for at in own]
    return nodes[0], paths


def expected(rows, fanout=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = own, *plain([leaf(r) for r in own], fanout)
    root, above = plain([trees[g][1] for g in names], fanout)
    out = []
    for g, top in zip(names, above, strict=True):
        own, subroot, paths = trees[g]
        for row, path in zip(own, paths, strict=True):
            path = path + top
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, 1) if hit else leaf(row)
            for left, right in path:
                node = h(left, node, right)
            out.append((row[0], leaf(row), subroot, root, h(*(x + y for x, y in path)), node, node == root))
    return sorted(out, key=repr)


def table(spark, n, seed, langs=("en", "de", None, "é", "z", "fr")):
    rng = random.Random(seed)
    texts = [None if rng.random() < 0.1 else "".join(rng.choice("ab é½\n") for _ in range(rng.randrange(9))) for _ in range(n)]
    ids = [None if rng.random() < 0.05 else rng.randrange(2 * n) for _ in range(n)]
    return cases.documents(spark, texts, ids, langs=[rng.choice(langs) if rng.random() < 0.6 else langs[0] for _ in range(n)])


def plain_rows(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]


@pytest.mark.parametrize("n, fanout, levels", [(1, 2, 2), (2, 2, 1), (45, 2, 1), (64, 2, 2), (83, 3, 1), (77, 4, 2), (60, 2, 12)])
def test_manifest_equals_plain_trees(spark, n, fanout, levels):
    docs = table(spark, n, n)
    got = manifest.manifest(docs, manifest.tampered_leaf(), fanout=fanout, levels=levels)
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == expected(plain_rows(docs), fanout)
    rows = plain_rows(docs)
    # A tampered row shows, unless nothing of it changed.
    changed = sum(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None for r in rows)
    assert sum(not r[6] for r in found) == changed


def test_one_group_holds_all_and_rows_repeat(spark):
    docs = table(spark, 30, 1, ("en",))
    docs = docs.unionAll(docs.limit(1)).unionAll(docs)
    got = sorted(map(tuple, manifest.manifest(docs, manifest.tampered_leaf(), levels=2).collect()), key=repr)
    assert got == expected(plain_rows(docs))


def test_empty_table_and_bad_parameters(spark):
    docs = cases.documents(spark, ["a"])
    assert manifest.manifest(docs.limit(0), manifest.tampered_leaf()).collect() == []
    with pytest.raises(ValueError, match="two nodes"):
        manifest.manifest(docs, F.lit(None).cast("string"), fanout=1)


def test_a_claimed_leaf_is_checked_against_the_manifest(spark):
    docs = cases.documents(spark, ["a", "b", "c"])
    got = manifest.manifest(docs, F.when(F.col("doc_id") == 1, F.lit("0" * 64))).collect()
    assert {r.doc_id: r.verified for r in got} == {0: True, 1: False, 2: True}
    assert len({r.root for r in got}) == 1


def test_rows_are_numbered_within_groups(spark):
    rows = spark.range(500).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), (F.col("id") % 7).alias("k"))
    got = manifest.numbered(rows, "g", ["k"], "numbers").collect()
    for g in "ab":
        own = sorted((r["__at"], r.k) for r in got if r.g == g)
        assert [at for at, _ in own] == list(range(len(own)))
        assert [k for _, k in own] == sorted(k for _, k in own)
        assert {r["__of"] for r in got if r.g == g} == {len(own)}
