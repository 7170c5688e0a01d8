import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rivulet.llm.manifest import manifest
from tests.llm.cases import awkward, awkward_rows, lower


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_digest(doc_id, text, lang, source, n_chars, given):
    fields = (doc_id, source, lang, n_chars, given)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(digests):
    """The root over a list, and of every place the list of (run, slot) up to it."""
    paths, where, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for k, i in enumerate(where):
            paths[k].append((level[i // 16 * 16 : i // 16 * 16 + 16], i % 16))
            where[k] = i // 16
        level = [sha(*level[i : i + 16]) for i in range(0, len(level), 16)]
    return (level[0] if level else None), paths


def want(rows):
    trees = {}
    for row in rows:
        touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None
        leaf, changed = row_digest(*row[:5], row[1]), row_digest(*row[:5], lower(row[1]) if touched else row[1])
        trees.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf, changed, row[0]))
    sources = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: climb([x[2] for x in sorted(trees[s])]) for s in sources}
    root, upper = climb([below[s][0] for s in sources])
    out = []
    for s, more in zip(sources, upper):
        for (_, _, leaf, given, doc_id), path in zip(sorted(trees[s]), below[s][1]):
            siblings, folded = [], given
            for run, slot in path + more:
                siblings += run[:slot] + run[slot + 1 :]
                folded = sha(*run[:slot], folded, *run[slot + 1 :])
            out.append((doc_id, leaf, below[s][0], root, sha(*siblings), folded, folded == root))
    return sorted(out, key=str)


def got(spark, rows):
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return sorted(map(tuple, manifest(awkward(spark, rows), crc % 5 == 0).collect()), key=str)


def many(n, seed):
    rng = random.Random(seed)
    names = ["a", "b", "é", "Z", None, *(f"t{k}" for k in range(40))]
    rows = []
    for k in range(n):
        source = "a" if rng.random() < 0.4 else rng.choice(names)
        rows.append((rng.randrange(n), f"Text {rng.randrange(50)}", "en", source, k % 7))
    return rows


@pytest.mark.parametrize(
    "rows",
    [awkward_rows(), awkward_rows()[:1], awkward_rows()[6:7] * 5, many(900, 3),
     [(k, "Same", "en", f"s{k:03}", 1) for k in range(270)]],
    ids=["awkward", "one", "repeated", "levels", "lone leaves"],
)
def test_equals_brute_force(spark, rows):
    assert got(spark, rows) == want(rows)


def test_hot_source_is_spread(spark):
    from rivulet.llm.common import in_order
    rows = [(7, "same", "en", "hot", 1)] * 4000
    spread = in_order(awkward(spark, rows).repartition(4).select("doc_id", "source"), "source", "doc_id")
    parts = [r[0] for r in spread.groupBy(F.shiftright("at", 33)).count().select("count").collect()]
    assert sum(parts) == 4000 and spread.select("at").distinct().count() == 4000


def test_empty(spark):
    assert manifest(awkward(spark, []), F.lit(True)).count() == 0


def test_changed_texts_are_told(spark):
    rows = [(k, f"Text {k}" if k % 2 else f"text {k}", "en", "s", 1) for k in range(40)]
    found = manifest(awkward(spark, rows), F.lit(True)).collect()
    assert {r.doc_id for r in found if not r.verified} == {k for k in range(40) if k % 2}
