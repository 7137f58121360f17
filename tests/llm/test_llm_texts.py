"""Tokens, languages and quality: against the library, sums over all segmentations, and held-out accuracy."""

import random
import weakref

import numpy as np
import pytest
from llm_cases import corpus, documents
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from millrace.llm import common, language, lattice, pieces, quality
from millrace.llm.lattice import Vocabulary

ODD = ["", None, " ", "  a  b\n\tc ", "\n\n", "é\x00b", "e\u0301 ﬁ ﷺ", "a" * 700, " " * 90, "日本語 text 😀😀", "x\r\n  y", "\u2581x", "</s><unk><0x41>", "ÀÉÎ" * 50]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(pieces.MODEL)


def noise(rng, n):
    return "".join(rng.choice("aaabcdehinorst  \n.,%$é_0") for _ in range(n))


def test_ids_equal_the_librarys(vocabulary):
    rng = random.Random(1)
    texts = [*ODD, *corpus(1), *(noise(rng, rng.randrange(400)) for _ in range(300))]
    library, work = SentencePieceProcessor(model_file=pieces.MODEL), pieces.Encoder(vocabulary)
    ids, sizes = work.encode(texts)
    ends = np.cumsum(sizes)
    for text, size, end in zip(texts, sizes, ends, strict=True):
        assert ids[end - size : end].tolist() == (library.encode(text) if text else [])


def test_encode_and_decode_give_the_text_again(spark):
    texts = [*ODD, *corpus(2)]
    found = pieces.encode(documents(spark, texts))
    got = {r.doc_id: r for r in found.collect()}
    for k, text in enumerate(texts):
        assert (got[k].ids is None) == (text is None)
        assert got[k].n_tokens == len(got[k].ids or [])
        assert got[k].round_trip is (None if text is None else "\u2581" not in text)
    back = {r.doc_id: r.text for r in pieces.decode(found).collect()}
    assert back == {k: None if t is None else t.replace("\u2581", " ") for k, t in enumerate(texts)}
    assert pieces.encode(documents(spark, [])).collect() == []
    assert pieces.encode(documents(spark, ["a", "a", "b"], ids=[None, None, 1])).count() == 3


def test_memory_is_bounded_without_changing_ids(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces.Encoder, "BOUND", 5)
    monkeypatch.setattr(pieces.Encoder, "PAIRS", 5)
    whole, parts = pieces.Encoder(vocabulary), pieces.Encoder(vocabulary)
    texts = [t for t in corpus(3) if t][:12]
    assert whole.encode(texts)[0].tolist() == [i for t in texts for i in parts.encode([t])[0].tolist()]


def test_chunks_take_their_steps_together(vocabulary, monkeypatch):
    rng = random.Random(7)
    texts = [*ODD, *(noise(rng, rng.randrange(400)) for _ in range(200))]
    together = pieces.Encoder(vocabulary)
    ids, sizes = together.encode(texts)
    monkeypatch.setattr(pieces.Encoder, "LONG", 0)
    each = pieces.Encoder(vocabulary).encode(texts)
    assert (ids == each[0]).all() and (sizes == each[1]).all()
    # A full table of pairs forgets, and asks again.
    monkeypatch.undo()
    monkeypatch.setattr(pieces.Encoder, "SLOT_BITS", 4)
    again = pieces.Encoder(vocabulary).encode(texts)
    assert (ids == again[0]).all() and (sizes == again[1]).all()


def test_edges_of_a_bounded_number_of_letters_at_once(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces.Encoder, "LETTERS", 50)
    asked, plain = [], lattice.Index.edges

    def edges(index, words, by_end=False):
        asked.append(list(words))
        return plain(index, words, by_end)

    monkeypatch.setattr(lattice.Index, "edges", edges)
    rng = random.Random(8)
    texts = [noise(rng, 300) for _ in range(20)]
    ids, _ = pieces.Encoder(vocabulary).encode(texts)
    assert len(asked) > 5 and all(sum(map(len, words[1:])) <= 50 for words in asked)
    assert ids.tolist() == [i for t in texts for i in SentencePieceProcessor(model_file=pieces.MODEL).encode(t)]


def test_a_worker_keeps_one_model(vocabulary):
    # Spark reuses a worker: what an earlier operator remembered goes when the next one begins.
    first = common.kept(pieces.Encoder, vocabulary)
    assert common.kept(pieces.Encoder, vocabulary) is first
    gone = weakref.ref(first)
    del first
    model = language.fit(vocabulary, [("en", " the", 2), ("de", " der", 1)], rounds=1)
    second = common.kept(language.Scorer, model)
    assert gone() is None and common.kept(language.Scorer, model) is second
    common._kept.clear()


def segmentations(word, table):
    """The summed weight of all ways to cut a word into pieces, by recursion."""
    if not word:
        return 1.0
    total, known = 0.0, False
    for n in range(1, len(word) + 1):
        if word[:n] in table:
            known |= n == 1
            total += table[word[:n]] * segmentations(word[n:], table)
    return total if known else total + table[None] * segmentations(word[1:], table)


def test_forward_sums_all_segmentations(vocabulary):
    model = language.fit(vocabulary, [("aa", " the", 3), ("aa", " there", 2), ("bb", " other", 2), ("bb", "\u2603x", 1)])
    scale = language.PER_LETTER
    for word in (" the", " there", " \u2603the", " other", "q"):
        edges = vocabulary.index.edges([word], by_end=True)
        got = language.forward(edges, model.weights)[edges.first + edges.sizes][0] / scale ** len(word)
        for k in range(2):
            table = {p.replace("\u2581", " "): model.weights[i, k] / scale ** len(p) for i, p in enumerate(vocabulary.pieces) if p}
            table[None] = model.weights[-1, k] / scale
            assert got[k] == pytest.approx(segmentations(word, table), rel=1e-9)


def test_expected_uses_add_up(vocabulary):
    rng = random.Random(5)
    chunks = sorted({" " + noise(rng, rng.randrange(1, 12)).replace(" ", "").replace("\n", "") for _ in range(50)})
    edges = vocabulary.index.edges(chunks, by_end=True)
    weights = np.random.default_rng(1).random((len(vocabulary.pieces) + 1, 2))
    counts = np.ones((len(chunks), 2))
    used = language.expected(edges, weights, counts)
    length = np.array([len(p) if p else 1 for p in vocabulary.pieces] + [1])
    # Whatever the segmentation, its pieces cover each chunk's letters once.
    assert (used * length[:, None]).sum(axis=0) == pytest.approx([sum(map(len, chunks))] * 2)


def logs_by_position(vocabulary, word, weights):
    """The log of the summed weight of a word's segmentations, one position after the other, in logs."""
    table = {p.replace("\u2581", " "): w for p, w in zip(vocabulary.pieces, weights, strict=False) if p}
    at = [0.0]
    for end in range(1, len(word) + 1):
        terms = [at[k] + np.log(table[word[k:end]]) for k in range(max(0, end - vocabulary.index.longest), end) if word[k:end] in table]
        if word[end - 1] not in table:
            terms.append(at[end - 1] + np.log(weights[-1]))
        at.append(np.logaddexp.reduce(terms))
    return at[-1]


def test_long_chunks_are_summed_whole(vocabulary, monkeypatch):
    rng = random.Random(8)
    long = ["".join(rng.choice("thereandof\u2603") for _ in range(n)) for n in (31, 32, 33, 47, 48, 49, 90, 200, 1500)] + ["the" * 300, "q" * 65, "x" + "\u2603" * 400]
    model = language.fit(vocabulary, [("aa", " there", 3), ("aa", "the" * 40, 2), ("bb", " other", 2), ("bb", "\u2603x" * 30, 1)])
    for window in (language.WINDOW, 64, 40):
        monkeypatch.setattr(language, "WINDOW", window)
        got = language.log_sums(vocabulary.index, [" " + t for t in long], model.weights)
        for k, text in enumerate(long):
            for column in range(2):
                wanted = logs_by_position(vocabulary, " " + text, model.weights[:, column])
                assert got[k, column] == pytest.approx(wanted, rel=1e-9)


def test_expected_uses_of_long_chunks(vocabulary, monkeypatch):
    words = [" the" + "there" * 20, " " + "and" * 14 + "\u2603"]
    edges = vocabulary.index.edges(words, by_end=True)
    weights = np.random.default_rng(1).random((len(vocabulary.pieces) + 1, 2))
    counts = np.ones((2, 2))
    scaled = language.expected(edges, weights, counts, vocabulary.index.longest)
    monkeypatch.setattr(language, "RESCALE", 10_000)
    plain = language.expected(edges, weights, counts, vocabulary.index.longest)
    assert scaled == pytest.approx(plain, rel=1e-9)


LANGUAGES = {"en": "the of and to in that is was with".split(), "de": "der die und das ist nicht ein mit".split(), "fr": "les des une est dans pour que vous".split()}


def spoken(n=240):
    rng = random.Random(9)
    langs = [rng.choice(sorted(LANGUAGES)) for _ in range(n)]
    return [" ".join(rng.choice(LANGUAGES[x]) for _ in range(rng.randrange(4, 60))) for x in langs], langs


def test_held_out_languages(spark):
    texts, langs = spoken()
    texts += [None, "", "123 !? 456", "\n"]
    langs += ["en", "de", "fr", None]
    docs = documents(spark, texts, langs=langs)
    got = {r.doc_id: r for r in language.identify_held_out(docs).collect()}
    crc = {r.doc_id: r.c for r in docs.select("doc_id", F.crc32(F.col("doc_id").cast("string")).alias("c")).collect()}
    assert len(got) == len(texts)
    for k, (text, lang) in enumerate(zip(texts, langs, strict=True)):
        assert got[k].held_out == (crc[k] % 5 == 0)
        assert (got[k].lang_pred, got[k].score > 0) == ((lang, True) if k < 240 else ("und", False)), text


def test_languages_without_labels_or_rows(spark):
    docs = documents(spark, ["the house", None], langs=[None, None])
    assert [(r.lang_pred, r.score) for r in language.identify_held_out(docs).collect()] == [("und", 0.0)] * 2
    assert language.identify_held_out(documents(spark, [])).collect() == []


def test_scores_keep_columns_and_refuse_taken_names(spark):
    docs = documents(spark, ["a b"])
    with pytest.raises(ValueError):
        quality.score(docs, None)
    assert quality.score(docs.drop("score"), None).columns == [*docs.drop("score").columns, "score", "predicted"]


def judged(n=400):
    rng = random.Random(4)
    texts, marks = [], []
    for k in range(n):
        good = rng.random() < 0.8
        own = [rng.choice(LANGUAGES["en"]) for _ in range(rng.randrange(5, 120))]
        texts.append(" ".join(own) if good else rng.choice([" | ", "!! ", "%%% "]).join(own) if k % 2 else " ".join(own[:1] * 40))
        marks.append(int(good))
    return texts, marks


def test_held_out_quality(spark):
    texts, marks = judged()
    docs = documents(spark, [*texts, None, ""])
    labels = spark.createDataFrame([*((k, m, 0) for k, m in enumerate(marks)), (0, None, 1), (9999, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.score_held_out(docs, labels).collect()}
    assert len(got) == len(texts) + 2
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [k for k in range(len(texts)) if got[k].held_out]
    assert held and sum(got[k].predicted == marks[k] for k in held) >= 0.95 * len(held)


def test_quality_without_labels_rows_or_a_second_class(spark):
    docs = documents(spark, ["a b c", None])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score_held_out(docs, none).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in quality.score_held_out(docs, one).collect())
    assert quality.score_held_out(documents(spark, []), none).collect() == []


def test_a_rare_class_is_learned_from_a_bounded_sample(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(LANGUAGES["de" if k % 150 == 7 else "en"]) for _ in range(30)) for k in range(600)]
    labels = spark.createDataFrame([(k, int(k % 150 != 7)) for k in range(600)], "doc_id long, quality int")
    for seed in range(3):
        model = quality.train(documents(spark, texts), labels, sample=60, seed=seed)
        found = [model.score(quality.present(t.encode())) for t in texts]
        assert max(found[7::150]) < min(s for k, s in enumerate(found) if k % 150 != 7)
    # Scores are those of the whole table's shares, not of the sample's.
    noise = [" ".join(rng.choice(LANGUAGES["en"]) for _ in range(30)) for _ in range(600)]
    blind = quality.train(documents(spark, noise), labels, sample=60)
    assert np.mean([blind.score(quality.present(t.encode())) for t in noise]) > 0.85


def test_descent_finds_the_least_hinge_loss():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ np.array([1.0, -2.0, 0.5, 0.0, 1.0]) + 0.3 + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    rows = [np.arange(5)] * 60
    w, b = quality.descend(rows, list(x), y, 5, rounds=400)
    positive = (y > 0).sum()
    cost = np.where(y > 0, 60 / (2 * positive), 60 / (2 * (60 - positive)))

    def loss(w, b):
        return 0.5 * ((w * w).sum() + b * b) + (cost * np.maximum(0, 1 - y * (x @ w + b))).sum()

    for _ in range(200):
        assert loss(w, b) <= loss(w + 0.05 * rng.normal(size=5), b + 0.05 * rng.normal()) + 1e-3


def test_features_are_packed_without_loss():
    for text in (b"", b"a", b"aa aa aa aa aa aa aa aa aa aa", " ".join(t for t in corpus(1) if t).encode(), "\uffff\u00ff".encode()):
        found = quality.present(text)
        assert quality.unpacked(quality.pack(found)).tolist() == found.tolist()


def test_features_of_equal_words():
    def runs(text):
        return int((quality.present(text) >= quality.BUCKETS).sum())

    assert [runs(t) for t in (b"a b", b"a a", b"a a a b b", b"x " * 50, None, b"")] == [0, 1, 2, quality.REPEATS, 0, 0]
