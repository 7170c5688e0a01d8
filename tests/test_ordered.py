import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.operators.ordered import hot_groups, running, segments, slice_groups
from tests.replay import replay_batches, replay_runs


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = []
    for seq in rng.sample(range(100_000), 3000):
        # A third of the rows share one key, and one key is NULL.
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", "d", None])
        rows.append((seq, key, rng.randrange(1000), rng.choice([None, 1, 2])))
    return spark.createDataFrame(rows, "seq BIGINT, key STRING, v INT, w INT").cache()


def test_hot_groups_finds_only_groups_above_the_cap(skewed):
    assert hot_groups(skewed, ["key"], 5000) is None
    hot = hot_groups(skewed, ["key"], 800)
    assert [r[0] for r in hot.frame.collect()] == ["hot"]
    assert hot.groups == 1


def test_slices_are_bounded_and_ordered(skewed):
    cut = slice_groups(skewed, ["key"], "seq", 100)
    sizes = cut.frame.groupBy("key", "_slice").count().where("_slice >= 0")
    assert sizes.agg(F.max("count")).first()[0] <= 250
    spans = sizes.sparkSession.createDataFrame(
        cut.frame.where("key = 'hot'").groupBy("_slice").agg(F.min("seq"), F.max("seq")).collect()
    ).orderBy("_slice").collect()
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:], strict=False))


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("cap", [200])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_over_slices_equals_one_window(skewed, keys, cap, inclusive):
    end = Window.currentRow if inclusive else -1
    frame = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, end)
    values = {
        "top": ("max", F.col("v")),
        "pair": ("max", F.struct("w", "v")),
        "rare": ("max", F.when(F.col("v") == 7, F.col("seq"))),
    }
    want = skewed.select(
        "seq",
        F.max("v").over(frame).alias("top"),
        F.max(F.struct("w", "v")).over(frame).alias("pair"),
        F.max(F.when(F.col("v") == 7, F.col("seq"))).over(frame).alias("rare"),
        F.coalesce(F.sum("w").over(frame), F.lit(0)).alias("total"),
    )
    got = running(skewed, keys, "seq", {**values, "total": ("sum", F.col("w"))}, inclusive, cap)
    got = got.select("seq", "top", "pair", "rare", F.coalesce("total", F.lit(0)).alias("total"))
    assert sorted(got.collect(), key=lambda r: r[0]) == sorted(want.collect(), key=lambda r: r[0])


@pytest.mark.parametrize("cap", [97, 10_000])
def test_segments_of_commit_boundaries(spark, cap):
    rng = random.Random(cap)
    flags = [rng.random() < 0.2 for _ in range(700)] + [False] * 300 + [True, True]
    log = spark.createDataFrame(list(enumerate(flags)), "seq BIGINT, flag BOOLEAN")
    got = segments(log, "seq", F.col("flag"), lambda before, _: before, cap).orderBy("seq")
    want = replay_batches(flags, 1)
    assert [(r["segment"], r["position"]) for r in got.collect()] == want


@pytest.mark.parametrize("cap", [97, 10_000])
def test_segments_of_equal_neighbours(spark, cap):
    rng = random.Random(cap)
    words = [rng.choice("aab") for _ in range(500)] + ["a"] * 400 + ["b"]
    log = spark.createDataFrame(list(enumerate(words)), "seq BIGINT, word STRING")
    got = segments(
        log, "seq", F.col("word"), lambda before, now: ~before.eqNullSafe(now), cap
    ).orderBy("seq")
    want = replay_runs(words, 1, lambda _: True)
    assert [(r["segment"], r["position"]) for r in got.collect()] == want


def test_streams_are_refused(spark, tmp_path):
    stream = spark.readStream.schema("seq BIGINT, v INT").json(str(tmp_path))
    with pytest.raises(ValueError, match="batch frame"):
        running(stream, [], "seq", {"x": ("max", F.col("v"))})
