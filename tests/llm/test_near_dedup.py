import random

import pytest

from rivulet.llm import near_dedup as N
from rivulet.operators.graph import components
from tests.llm.cases import awkward, awkward_rows, lower, words


def brute(rows, size, percent):
    sets, part = [], list(range(len(rows)))
    for _, text, *_ in rows:
        w = words(lower(text))
        runs = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
        sets.append(runs or ({tuple(w)} if w else set()))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                part[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if sets[i] and r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(
        ((r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


@pytest.mark.parametrize("size", [4, 5])
def test_groups_equal_brute_force(spark, size):
    rows = awkward_rows()
    found = N.near_duplicates(awkward(spark), size, 80).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    assert got == brute(rows, size, 80)


def test_large_family_with_a_hub(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(110)]
    rows = []
    for k in range(120):
        edited = list(base)
        for j in rng.sample(range(110), rng.randrange(0, 8) if k else 0):
            edited[j] = f"e{k}-{j}"
        rows.append((1000 - k, " ".join(edited), "en", "s", 1))
    found = N.near_duplicates(awkward(spark, rows), 4, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, 4, 80)


def test_one_of_each_group_stays(spark):
    docs = awkward(spark)
    kept = N.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 in ids  # only A-Z is lower-cased
    assert {4, 5, 6, 7, 9, 10, 11} <= set(ids) and 8 not in ids
    twice = awkward(spark, [(1, "a b c d e f", "x", "y", 1)] * 3 + [(2, None, "x", "y", 1)] * 2)
    assert sorted(r.doc_id for r in N.keep_one(twice, 5, 80).collect()) == [1, 2, 2]


def test_empty(spark):
    assert N.near_duplicates(awkward(spark, []), 5, 80).count() == 0
    assert N.keep_one(awkward(spark, []), 5, 80).count() == 0


def test_estimate_is_unbiased(spark):
    import numpy as np

    shared = N.mix(np.arange(1, 4001, dtype=np.uint64))
    a, b = shared[:3000], shared[1000:4000]
    lanes = [N.packed(N.minima(x, N.FINE_HASHES)[None], N.FINE_BITS)[0].view(np.int64).tolist() for x in (a, b)]
    columns = ", ".join(f"{f} long" for f in N._FINE)
    pair = spark.createDataFrame([(lanes[0], lanes[1])], f"a struct<{columns.replace(' ', ':').replace(',:', ',')}>, b struct<{columns.replace(' ', ':').replace(',:', ',')}>")
    found = pair.select(N.estimate("a", "b", N._FINE, N.FINE_HASHES, N.FINE_BITS)).first()[0]
    assert abs(found - 0.5) < 0.1


def test_components_of_paths_stars_and_loops(spark):
    edges = [(f"p{k:02}", f"p{k + 1:02}") for k in range(40)] + [("hub", f"l{k}") for k in range(30)]
    edges += [("self", "self"), ("x", "y"), ("y", "x")]
    found = components(spark.createDataFrame(edges, "x string, y string")).collect()
    roots = {r.node: r.root for r in found}
    assert {roots[f"p{k:02}"] for k in range(41)} == {"p00"}
    assert {roots[f"l{k}"] for k in range(30)} | {roots["hub"]} == {"hub"}
    assert roots["x"] == roots["y"] == "x" and "self" not in roots
    assert components(spark.createDataFrame([], "x string, y string")).count() == 0
