import itertools
import math

import numpy as np
import pytest

from rivulet.llm import language_id as L
from tests.llm.cases import awkward

PIECES = ["▁", "a", "b", "ab", "ba", "▁a", "aba", "▁ab"]


def brute(word, probs, lattice):
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        p = 1.0
        for a, b in itertools.pairwise(edges):
            part = word[a:b]
            k = lattice.index.get(part, lattice.unknown if b - a == 1 else None)
            p *= 0 if k is None else probs[k]
        total += p
    return math.log(total)


def test_forward_sums_all_segmentations(monkeypatch):
    lattice = L.Lattice(PIECES)
    rng = np.random.default_rng(1)
    probs = rng.random((len(PIECES) + 1, 3))
    probs /= probs.sum(axis=0)
    words = ["▁", "▁a", "▁abab", "▁abaabba", "▁xaby", "▁bbabaab"]
    want = [[brute(w, probs[:, k], lattice) for k in range(3)] for w in words]
    assert np.allclose(lattice.log_likelihood(words, probs), want)
    monkeypatch.setattr(L, "_LONG", 0)
    assert np.allclose(lattice.log_likelihood(words, probs), want)


def test_long_words_do_not_underflow():
    lattice = L.Lattice(PIECES)
    probs = np.full((len(PIECES) + 1, 2), 1e-4)
    assert np.all(np.isfinite(lattice.log_likelihood(["▁" + "ab" * 3000], probs)))


def test_expected_counts_match_enumeration():
    lattice = L.Lattice(PIECES)
    probs = np.arange(1, len(PIECES) + 2) / 60
    word, n, total, want = "▁abab", 2.5, 0.0, np.zeros(len(probs))
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        ids = [lattice.index.get(word[a:b], lattice.unknown if b - a == 1 else None) for a, b in itertools.pairwise(edges)]
        if None not in ids:
            p = math.prod(probs[i] for i in ids)
            total += p
            np.add.at(want, ids, p)
    assert np.allclose(lattice.expected([word], np.array([n]), probs), n * want / total)


@pytest.fixture(scope="module")
def model():
    public = pytest.importorskip("public_tokenizers")
    return public.path("piece_bpe_32k.model")


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = L.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 30
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.95


def test_awkward_rows(spark, model):
    docs = awkward(spark)
    found = L.identify(docs, model, per_language=5).collect()
    assert len(found) == docs.count()
    by = {r.doc_id: r for r in found}
    for doc_id in (4, 5, 6):
        assert (by[doc_id].lang_pred, by[doc_id].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in found} <= {"und", "en", "de", "fr"}
    unlabelled = docs.withColumn("lang", docs.lang.substr(9, 1).cast("string")).where("lang is null")
    assert {r.lang_pred for r in L.identify(unlabelled, model).collect()} <= {"und"}
    assert L.identify(awkward(spark, []), model).count() == 0


def test_expected_counts_of_long_words(monkeypatch):
    lattice = L.Lattice(PIECES)
    probs = np.arange(1, len(PIECES) + 2) / 60
    words = ["▁abab", "▁", "▁xaby", "▁" + "abba" * 10, "▁" + "ba" * 17]
    n = np.array([2.5, 1, 3, 2, 4])
    monkeypatch.setattr(L, "_LONG", 100)
    want = lattice.expected(words, n, probs)
    for cells in (1, 1 << 18):
        monkeypatch.setattr(L, "_LONG", 3)
        monkeypatch.setattr(L, "_CELLS", cells)
        assert np.allclose(lattice.expected(words, n, probs), want)
    found = lattice.expected(["▁" + "x" * 3000], np.array([2.0]), np.full(len(PIECES) + 1, 1e-4))
    assert np.all(np.isfinite(found)) and np.isclose(found[lattice.unknown], 6000)


def test_languages_without_spaces_are_learned(spark):
    import random

    rng = random.Random(3)
    signs = {"xa": "天地玄黄宇宙洪荒", "xb": "宙洪荒日月盈昃辰"}
    rows = [(k, "".join(rng.choices(signs[lang], k=60 + k)), lang) for k in range(60) for lang in signs]
    docs = spark.createDataFrame([(2 * k + (c == "xb"), text, c) for k, text, c in rows], "doc_id long, text string, lang string")
    pieces = ["▁", *dict.fromkeys("".join(signs.values())), "天地", "日月", "洪荒"]
    langs, probs = L.fit(docs, pieces, rounds=2)
    assert langs == ["xa", "xb"]
    said = {r.doc_id: r.lang_pred for r in L.predict(docs, pieces, langs, probs).where("held_out").collect()}
    assert len(said) > 10
    assert all(said[d] == ("xb" if d % 2 else "xa") for d in said)


def test_unseen_characters_after_a_large_fit():
    """Forty unseen characters after 10^7 pieces: finite in every language, and learnable."""
    lattice = L.Lattice(PIECES)
    probs = np.full((len(PIECES) + 1, 3), 0.1)
    probs[lattice.unknown] = [0.05 / 1e7, 0.05 / 2e7, 0.05 / 5e6]
    probs /= probs.sum(axis=0)
    words = ["▁" + "ж" * 39, "▁ab", "▁" + "ж" * 34, "▁" + "ж" * 60]
    found = lattice.log_likelihood(words, probs)
    assert np.all(np.isfinite(found))
    assert found[0].argmax() == found[2].argmax() == found[3].argmax() == 2
    for k, n in ((0, 39), (2, 34), (3, 60)):
        want = np.log(probs[lattice.index["▁"]]) + n * np.log(probs[lattice.unknown])
        assert np.allclose(found[k], want)
    n = np.array([3.0, 2.0, 1.0, 1.0])
    counts = lattice.expected(words, n, probs[:, 0])
    assert np.all(np.isfinite(counts))
    assert np.isclose(counts[lattice.unknown], 3 * 39 + 34 + 60)


def test_scores_of_unseen_characters_stay_in_range(spark):
    docs = spark.createDataFrame([(1, "ж" * 39 + " " + "ж" * 39)], "doc_id long, text string")
    probs = np.full((len(PIECES) + 1, 2), 0.1)
    probs[-1] = [1e-10, 1e-9]
    row = L.predict(docs, PIECES, ["xa", "xb"], probs).first()
    assert (row.lang_pred, round(row.score, 6)) == ("xb", 1.0)
