from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rivulet.llm import mixing as M
from tests.llm.cases import awkward, awkward_rows, prose, words


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    out, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def rows():
    out = awkward_rows()
    for k in range(150):
        out.append((500 + k, prose(500 + k, 5 + (k * 7) % 90), "en", f"s{k % 4}", 1))
    return out + [(900, prose(1, 9), "en", "Z", 1), (901, prose(2, 9), "en", "é", 1)]


@pytest.mark.parametrize("block", [4, 64])
def test_targets_sizes_and_totals(spark, block):
    table = rows()
    found = M.mix_sizes(awkward(spark, table), block=block).collect()
    size = Counter()
    for _, text, _, source, _ in table:
        size[source] += len(words(text))
    want = targets(size)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], len(words(r[1]))) for r in table)
    source_of = {r[0]: r[3] for r in table if r[0] is not None}
    taken, longest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        if r.doc_id is not None:
            s = source_of[r.doc_id]
            assert (r.source_size, round(r.target, 6)) == (size[s], round(want[s], 6))
            taken[s] += r.taken
            longest[s] = max(longest[s], r.size)
    for s in ("s0", "s2", "s3", "Z", "é"):
        assert abs(taken[s] - want[s]) <= max(2 * longest[s], 0.02 * want[s]), s
    again = M.mix_sizes(awkward(spark, table).repartition(3), block=block).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_pivotal_keeps_mass_and_expectation(spark):
    n, groups = 60, 120
    units = spark.range(n * groups).select(
        F.concat(F.lit("u"), "id").alias("uid"),
        (F.col("id") / n).cast("int").alias("group"),
        (1 + F.col("id") % n).alias("size"),
        (0.1 + 0.8 * (F.col("id") % 7) / 7).alias("p"),
    )
    found = M.pivotal(units, block=8).join(units, "uid")
    assert found.count() == n * groups
    sums = found.groupBy("group").agg(F.sum(F.col("size") * F.col("take")).alias("a"), F.sum(F.col("size") * F.col("p")).alias("b"))
    assert sums.where("abs(a - b) > 60").count() == 0
    means = found.groupBy(F.round("p", 6).alias("p")).agg(F.avg("take").alias("m")).collect()
    assert all(abs(r.m - r.p) < 0.06 for r in means)


def test_units_are_counted_once(spark, monkeypatch):
    names, stage = [], M.stage
    monkeypatch.setattr(M, "stage", lambda df, name: names.append(name) or stage(df, name))
    units = spark.range(300).select(
        F.col("id").cast("string").alias("uid"), (F.col("id") % 2).alias("group"),
        (1 + F.col("id") % 9).alias("size"), F.lit(0.4).alias("p"),
    )
    found = M.pivotal(units, block=4).join(units, "uid")
    assert names == ["units", "counts", "met", "met", "met", "met"]
    assert found.count() == found.select("uid").distinct().count() == 300
    sums = found.groupBy("group").agg(F.sum(F.col("size") * (F.col("take") - F.col("p"))).alias("d"))
    assert all(abs(r.d) < 9 for r in sums.collect())


def test_words_are_counted_without_a_list_of_them(spark, capsys):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", " a\tb ", "\x1c\x85 \u00a0 é", "😀 😀😁", "$1 \\ x$", "a" * 9000 + " b" * 9000]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    counted = table.select("text", M.word_count(F.col("text")).alias("n"))
    assert [(r.text, r.n) for r in counted.collect()] == [(t, len(words(t))) for t in texts]
    counted.explain()
    assert "split(" not in capsys.readouterr().out


def test_mix_repeats_and_drops_rows(spark):
    table = rows()
    docs = awkward(spark, table)
    mixed = M.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c != "copy"] + ["copy"]
    found = mixed.collect()
    got = Counter((r.doc_id, r.text) for r in found)
    total = Counter((r[0], r[1]) for r in table)
    want = Counter()
    for r in M.copies(docs).collect():
        want[r.doc_id, r.size] += r.total
    assert Counter((r.doc_id, len(words(r.text))) for r in found) == Counter({k: v for k, v in want.items() if v})
    assert all(got[k] <= 3 * total[k] for k in got)


def test_empty(spark):
    assert M.mix_sizes(awkward(spark, [])).count() == 0
    assert M.mix(awkward(spark, [])).count() == 0
    nothing = awkward(spark, [(1, None, "x", "a", 0), (2, "", "x", None, 0)])
    assert {r.taken for r in M.mix_sizes(nothing).collect()} == {0}
