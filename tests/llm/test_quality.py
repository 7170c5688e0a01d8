import math
from collections import Counter

import regex
import xxhash

from rivulet.llm import quality as Q
from tests.llm.cases import awkward, awkward_rows, prose, words

MASK = (1 << 64) - 1


def _bucket(h, buckets):
    h = h - (1 << 64) if h >= 1 << 63 else h
    return h % buckets


def grams(text, buckets):
    hashes = [xxhash.xxh64(t.encode(), seed=42).intdigest() for t in regex.findall(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0b\f\r]+", text or "")]
    out = [_bucket(h, buckets) for h in hashes]
    for k, h in enumerate(hashes):
        seed = xxhash.xxh64(h.to_bytes(8, "little"), seed=42).intdigest()
        if k + 1 < len(hashes):
            seed = xxhash.xxh64(hashes[k + 1].to_bytes(8, "little"), seed=seed).intdigest()
        out.append(_bucket(seed, buckets))
    return out


def base(text):
    text = text or ""
    w = words(text)
    runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    count, under = Counter(runs), set()
    for k, r in enumerate(runs):
        if count[r] > 1:
            under.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(under)


ROWS = awkward_rows() + [
    (80, "same line\nother\nsame line\n \nsame line\n\n", "x", "y", 1), (81, "a|b # * $ % & < > é" * 3, "x", "y", 1),
    (82, "u v w x y " * 2 + prose(3, 30) + " v w x y u", "x", "y", 1), (83, "a a a a a a a a a a a a", "x", "y", 1),
    (84, prose(9, 25) + " !! ** !!", "x", "y", 1),
]
LABELS = [(1, 1, 0), (10, 1, 0), (40, 1, 0), (41, 1, 1), (42, 0, 0), (43, 1, 0), (43, 0, 0), (None, 1, 0), (44, None, 0), (45, 1, None)]


def test_equals_brute_force(spark):
    buckets = 512
    docs = awkward(spark, ROWS)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    scored = Q.score_documents(docs, labels, threshold=0.0, buckets=buckets)
    assert scored.columns[:-8] == [c for c in docs.columns if c not in ("kept", "score")]
    good = {1, 10, 40, 45}
    raw, trusted = Counter(), Counter()
    for doc_id, text, *_ in ROWS:
        own = grams(text, buckets)
        raw.update(own)
        if doc_id in good:
            trusted.update(own)
    n, t = sum(raw.values()), sum(trusted.values())
    ratio = [
        round((math.log((trusted[b] + 1) / (t + buckets)) - math.log((raw[b] + 1) / (n + buckets))) * Q._POINT)
        for b in range(buckets)
    ]
    want = []
    for doc_id, text, *_ in ROWS:
        own = grams(text, buckets)
        score = sum(ratio[b] for b in own) / len(own) / Q._POINT if own else None
        counts = base(text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        kept = not failed and score is not None and score >= 0
        want.append((doc_id, *counts, failed, kept, None if score is None else round(score, 6)))
    got = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, None if r.score is None else round(r.score, 6))
        for r in scored.collect()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_no_labels_and_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = Q.score_documents(awkward(spark), labels).collect()
    assert {r.score for r in found} == {0.0, None}
    assert Q.score_documents(awkward(spark, []), labels).count() == 0


def test_bad_labelled_documents_go_and_good_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = Q.score_documents(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in found if r.quality == 1]
    bad = [r.kept for r in found if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1
