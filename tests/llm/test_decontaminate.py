from collections import Counter

import pytest

from rivulet.llm import decontaminate as D
from tests.llm.cases import awkward, lower, prose, words


def brute(rows, items, size=5, percent=80):
    out = set()
    for item_id, text in set(items):
        iw = words(lower(text))
        k = min(size, len(iw))
        own = Counter(tuple(iw[j : j + k]) for j in range(len(iw) - k + 1)) if iw else Counter()
        m = sum(own.values())
        for doc_id, doc, *_ in rows:
            w = words(lower(doc))
            runs = [tuple(w[j : j + k]) for j in range(len(w) - k + 1)] if k else []
            best = None
            for t in range(len(runs) - m + 1 if m else 0):
                n = sum((own & Counter(runs[t : t + m])).values())
                if 100 * n >= percent * (2 * m - n) and (best is None or n > best[0]):
                    best = n, t
            if best:
                out.add((doc_id, item_id, round(best[0] / (2 * m - best[0]), 9), best[1], len(iw)))
    return out


ITEMS = [
    (1, prose(300, 40)), (1, prose(300, 40)), (2, prose(301, 60).upper()), (3, None), (4, ""), (5, "tiny item"),
    (6, "same " * 12), (None, prose(302, 30)), (7, prose(300, 40) + " tail"),
]


def rows():
    changed = prose(301, 60).split(" ")
    changed[30] = "changed"
    a = prose(300, 40)
    turned = a.split(" ")[20:] + a.split(" ")[:20]
    texts = [
        f"{prose(1, 30)} {a} {prose(2, 30)}", f"{prose(3, 30)}\n{' '.join(changed)}\n{prose(4, 9)}", None, "", "a tiny item here",
        "same " * 30, prose(302, 30), " ".join(turned), a[: len(a) // 2], f"{a} {prose(5, 3)} {a}",
    ]
    return [(k, t, "en", "s", 1) for k, t in enumerate(texts)] + [(0, texts[0], "en", "s", 1), (None, texts[0], "en", "s", 1)]


@pytest.mark.parametrize("limit", [8 << 20, 300])
def test_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "ITEM_BYTES", limit)
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id long, text string, doc_id string")
    found = D.find_items(awkward(spark, rows()), items).collect()
    got = Counter((r.doc_id, r.item_id, round(r.similarity, 9), r.start, r.n_words) for r in found)
    assert set(got) == brute(rows(), ITEMS)
    assert got[0, 1, 1.0, 30, 40] == 2


def test_contaminated_rows_go(spark):
    docs = awkward(spark, rows())
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = D.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    bad = {r[0] for r in brute(rows(), ITEMS)}
    assert sorted(r.doc_id for r in left.collect()) == sorted({r[0] for r in rows()} - bad)


def test_empty_sides(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.find_items(awkward(spark, []), items).count() == 0
    assert D.find_items(awkward(spark, rows()), items.limit(0)).count() == 0


def test_blocks_find_all_within_the_radius():
    import random

    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(D.RADIUS + 1)):
            b ^= 1 << bit
        assert set(D.blocks(a)) & set(D.blocks(b))


def test_documents_shorter_than_the_item(spark):
    a = prose(300, 40).split(" ")
    texts = [a[:-1], a[1:], a[2:-2], a[4:-4], a[5:-4], a[:20] + a[21:], [*a[:30], "x"], prose(303, 39).split(" "), a[:3], []]
    docs = awkward(spark, [(k, " ".join(t), "en", "s", 1) for k, t in enumerate(texts)])
    items = spark.createDataFrame([(1, " ".join(a)), (2, "tiny item")], "item_id long, text string")
    found = D.find_items(docs, items).collect()
    got = {(r.doc_id, r.item_id, round(r.similarity, 9), r.start, r.n_words) for r in found}
    # 36 shingles: one fewer for each word off the ends, five fewer for one from the middle
    want = {(0, 1, 35 / 36, 0, 39), (1, 1, 35 / 36, 0, 39), (2, 1, 32 / 36, 0, 36), (5, 1, 31 / 36 * 36 / 40, 0, 39)}
    assert got == {(d, i, round(s, 9), t, n) for d, i, s, t, n in want if s >= 0.8}
    assert {r.doc_id for r in D.drop_contaminated(docs, items).collect()} == {3, 4, 5, 6, 7, 8, 9}
