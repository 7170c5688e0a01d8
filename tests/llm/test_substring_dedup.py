import hashlib
from collections import Counter

import numpy as np
import pytest

from rivulet.llm import substring_dedup as S
from rivulet.llm.substring_dedup import anchors
from tests.llm.cases import awkward, awkward_rows, prose, words


def brute(rows, size):
    count = Counter()
    for _, text, *_ in rows:
        w = words(text)
        count.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        keep = [True] * len(w)
        for k in range(len(w) - size + 1):
            if count[tuple(w[k : k + size])] > 1:
                keep[k : k + size] = [False] * size
        kept = " ".join(x for x, y in zip(w, keep, strict=True) if y)
        sha = hashlib.sha256(kept.encode()).hexdigest()
        out.append((doc_id, len(w), keep.count(False), sha, kept))
    return sorted(out, key=str)


def rows_for(size):
    extra = [(60, "la " * 90 + prose(7, 40), "x", "y", 1), (61, "p q r " * 50, "x", "y", 1)]
    shared = prose(8, 70).split(" ")
    for k in range(12):  # overlapping parts of one passage
        part = " ".join(shared[2 * k : 2 * k + size + k])
        extra.append((70 + k, f"{prose(100 + k, 20)} {part} {prose(200 + k, 25)}", "x", "y", 1))
    return awkward_rows() + extra


@pytest.mark.parametrize(("cold", "words_a_shard", "n_shards"), [(256, 50_000, 4), (1, 50_000, 4), (1, 90, 2), (3, 70, 1)])
def test_equals_brute_force_on_every_path(spark, monkeypatch, cold, words_a_shard, n_shards):
    monkeypatch.setattr(S, "COLD", cold)
    real = S.shards
    monkeypatch.setattr(S, "shards", lambda hot, size: real(hot, size, words_a_shard, n_shards))
    rows = rows_for(35)
    found = S.remove_repeated(awkward(spark, rows), 35).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, 35)


def test_empty(spark):
    assert S.remove_repeated(awkward(spark, []), 35).count() == 0


def test_automaton_gives_matching_statistics():
    texts = [[1, 2, 3, 1, 2, 4], [3, 1, 2, 3, 1], [9]]
    automaton = S.SuffixAutomaton(texts)
    stream = [2, 3, 1, 2, 3, 1, 2, 4, 9, 9, 7, 1]
    known = {tuple(t[a:b]) for t in texts for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    want = [max((n for n in range(1, i + 2) if tuple(stream[i + 1 - n : i + 1]) in known), default=0) for i in range(len(stream))]
    assert automaton.matches(stream) == want


def test_blocks_of_windows_give_the_same_anchors():
    values = np.random.default_rng(7).integers(0, 9, 5000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = anchors(values, 35)
    assert len(whole[0]) == 5000 - 35 + 1
    for block in (1, 2, 33, 1000, 4966, 4967):
        assert all(np.array_equal(a, b) for a, b in zip(whole, anchors(values, 35, block), strict=True))
    assert len(anchors(values[:34], 35)[0]) == 0
