"""Near-duplicates, fingerprints and repeated passages against brute force."""

import hashlib
import random

import pytest
from llm_cases import corpus, documents, near_components, repeats_removed, shingle_set, words

from millrace.llm import fingerprints, neardup, substrings


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates_equal_all_pairs(spark, seed):
    texts = corpus(seed)
    found = neardup.groups(documents(spark, texts)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got == near_components(list(enumerate(texts)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def hub(rng, copies):
    """A text and copies that are each close to it, but not to each other."""
    base = words(rng, 400, 10**6)
    out = []
    for _ in range(copies):
        own = list(base)
        at = rng.randrange(40, 360)
        # About a sixth of the shingles differ from the base, a third between copies.
        for k in range(0, 60, 5):
            own[(at + k) % 400] = f"x{rng.random()}"
        out.append(" ".join(own))
    return [*out[: copies // 2], " ".join(base), *out[copies // 2 :]]


def test_copies_linked_only_through_one_text(spark):
    texts = hub(random.Random(3), 30)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(documents(spark, texts)).collect()}
    assert got == near_components(list(enumerate(texts)))


def test_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    texts = [" ".join(words(random.Random(k // 3), 60)) + f" tail{k}" for k in range(30)]
    docs = documents(spark, texts)
    found = neardup.sets(docs)
    classes = found.select("set_id", "signature")
    shared = neardup.buckets(classes)
    nothing = spark.createDataFrame([], "node binary, root binary")
    full = neardup.full_sets(docs, found, found.select("set_id"))
    pairs = [(bytes(r.a), bytes(r.b)) for r in neardup.open_pairs(shared, nothing, classes, full).collect()]
    ids = [bytes(r.set_id) for r in found.orderBy("doc_id").collect()]
    assert sorted(pairs) == sorted(tuple(sorted((ids[i], ids[j]))) for i in range(30) for j in range(i) if i // 3 == j // 3)


def test_noisy_copies_of_one_text_are_not_paired(spark):
    """Copies too far from their base share nothing beyond it: exact bounds leave no pair to compare."""
    rng = random.Random(5)
    base = words(rng, 200, 10**6)
    texts = []
    for k in range(40):
        own = list(base)
        for at in rng.sample(range(0, 200, 5), 12):
            own[at] = f"x{k}-{at}"
        texts.append(" ".join(own))
    docs = documents(spark, texts)
    found = neardup.sets(docs)
    classes = found.select("set_id", "signature")
    full = neardup.full_sets(docs, found, found.select("set_id"))
    nothing = spark.createDataFrame([], "node binary, root binary")
    assert neardup.open_pairs(neardup.buckets(classes), nothing, classes, full).count() == 0
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(docs).collect()}
    assert got == near_components(list(enumerate(texts)))


def test_components_by_stars(spark):
    edges = [(k, k + 1) for k in range(1, 20)] + [(30, 31), (31, 40), (40, 30), (50, 50)]
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {k: 1 for k in range(1, 21)} | {30: 30, 31: 30, 40: 30}


def test_near_duplicates_without_rows_ids_or_unique_ids(spark):
    assert neardup.groups(documents(spark, [])).collect() == []
    long = " ".join(words(random.Random(1), 50))
    docs = documents(spark, [long, long, long, long, "a b"], ids=[None, 7, 7, 3, None])
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.groups(docs).collect()), key=repr)
    assert got == sorted([(None, 3, False), (7, 3, False), (7, 3, False), (3, 3, True), (None, None, True)], key=repr)


def test_near_copies_without_ids_are_linked(spark):
    own, other = words(random.Random(1), 80), words(random.Random(2), 80)
    docs = documents(spark, [" ".join(own), " ".join([*own[:-1], "changed"]), " ".join([*own[:-2], "end"]), " ".join(other), " ".join(other[1:])], ids=[5, None, None, None, None])
    got = sorted(((r.doc_id, r.component_id, r.kept, r.n_shingles) for r in neardup.groups(docs).collect()), key=repr)
    assert got == sorted([(5, 5, True, 76), (None, 5, False, 76), (None, 5, False, 75), (None, None, True, 76), (None, None, True, 75)], key=repr)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_repeated_windows_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "TOGETHER", 5000)
    texts = corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup(documents(spark, texts)).collect()}
    assert got == repeats_removed(list(enumerate(texts)))


def test_cover_holds_for_all_distances():
    for distance in range(substrings.PERIOD):
        assert any((c + distance) % substrings.PERIOD in substrings.COVER for c in substrings.COVER)
    assert substrings.ANCHOR + substrings.PERIOD - 1 == substrings.WINDOW


def test_repeats_without_rows_ids_or_unique_rows(spark):
    assert substrings.dedup(documents(spark, [])).collect() == []
    text = " ".join(words(random.Random(2), 30))
    # A null id comes first; equal rows are one document and keep its words.
    got = substrings.dedup(documents(spark, [text, text, text, text], ids=[None, 4, 2, None])).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in got), key=repr) == sorted([(None, 0), (None, 0), (4, 30), (2, 30)], key=repr)
    got = substrings.dedup(documents(spark, [text, text], ids=[4, 4])).collect()
    assert [r.n_removed for r in got] == [0, 0]


def test_anchors_and_windows_are_settled_before_texts_are_joined(spark):
    passage = " ".join(words(random.Random(4), 30))
    docs = documents(spark, [passage, f"x {passage}", "y"])
    changed = substrings.judge(docs, substrings.tie_of(docs, "doc_id", "text"))[1]
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("MapInArrow") == 1
    assert sorted((r.doc_id, r.n_removed) for r in changed.collect()) == [(0, 0), (1, 30)]


def test_texts_without_repeats_stay_as_they_are(spark):
    passage = " ".join(words(random.Random(3), 25))
    texts = ["a\n\n b", passage, f"x {passage}  y", None]
    got = {r.doc_id: (r.text, r.n_chars) for r in substrings.without_repeats(documents(spark, texts)).collect()}
    assert got == {0: ("a\n\n b", 5), 1: (passage, len(passage)), 2: ("x y", 3), 3: (None, None)}


def test_fingerprints_of_neighbours(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 3000)
    texts = corpus(4)
    got = {r.doc_id: r for r in fingerprints.fingerprint(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    by_text = {}
    for k, text in enumerate(texts):
        text, following = text or "", texts[(k + 1) % len(texts)] or ""
        n = len(text) // 4
        new = text[: len(text) - n] + following[:n]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        for likeness, other in ((r.near_edited, new), (r.near_next, following)):
            x, y = shingle_set(text), shingle_set(other)
            assert abs(likeness - (len(x & y) / len(x | y) if x | y else 1.0)) < 0.25
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint


def test_fingerprints_without_rows_or_with_one_or_repeated(spark):
    assert fingerprints.fingerprint(documents(spark, [])).collect() == []
    (one,) = fingerprints.fingerprint(documents(spark, ["a b c d e f g h"])).collect()
    assert (one.n_chars, one.near_next, one.edited_sha256) == (15, 1.0, hashlib.sha256(b"a b c d e f a b").hexdigest())
    got = fingerprints.fingerprint(documents(spark, ["a b", "a b", None, "c"], ids=[1, 1, None, None])).collect()
    assert len(got) == 4 and sorted(r.n_chars for r in got) == [0, 1, 3, 3]


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_similar_fingerprints_are_verified(spark, percent):
    rng = random.Random(percent)
    texts = corpus(5, 30)
    for _ in range(40):  # pairs around the percentage
        own = words(rng, 100, 5000)
        edits = rng.choice([1, 2, 4, 6, 8])
        texts += [" ".join(own), " ".join(w if k % (100 // edits) else f"x{k}" for k, w in enumerate(own))]
    got = {r.doc_id: r.component_id for r in fingerprints.similar(documents(spark, texts), percent).collect()}
    expected = {d: c for d, (_, c) in near_components(list(enumerate(texts)), percent).items()}
    assert got == expected
    assert {r.doc_id: r.component_id for r in neardup.groups(documents(spark, texts), percent).collect()} == expected


def test_bands_follow_the_percentage():
    assert neardup.banding(75) == (neardup.BANDS, neardup.ROWS)
    for percent in (30, 50, 60, 75, 90, 100):
        for minima in (128, 160):
            bands, rows = neardup.banding(percent, minima)
            assert bands * rows <= minima and (1 - (percent / 100) ** rows) ** bands <= neardup.MISSED
    with pytest.raises(ValueError, match="cannot find"):
        neardup.banding(3)
    assert neardup.least_agreeing(75, 160) < 0.571 < neardup.least_agreeing(80, 160)
