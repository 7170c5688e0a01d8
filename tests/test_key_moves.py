"""Moves between keys: what they write, and keys whose hashes meet."""

from pyspark.sql import functions as F

from rivulet.operators import apply_rows as A
from rivulet.operators import graph, key_moves, ordered
from rivulet.operators.apply_rows import Modes

ROW = "struct<k:bigint,v:bigint>"


def chains(spark, n):
    """n rows, each moved four times to a new key."""
    rows = spark.range(n, numPartitions=2).selectExpr("id", "explode(sequence(0, 3)) as t")
    changes = rows.selectExpr(
        "id * 4 + t as seq", "'update' as op",
        "named_struct('k', id + (t + 1) * 1000000, 'v', t + 1) as row", "named_struct('k', id + t * 1000000, 'v', t) as old",
    )
    return spark.range(n, numPartitions=2).selectExpr("id as k", "0L as v"), changes.select(
        "seq", "op", F.col("row").cast(ROW).alias("row"), F.col("old").cast(ROW).alias("old")
    )


def test_a_move_writes_few_bytes(spark, tmp_path, monkeypatch):
    def stage(df, name="stage"):
        path = f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    for module in (graph, key_moves, ordered):
        monkeypatch.setattr(module, "stage", stage)
    base, changes = chains(spark, 5_000)
    out = A.apply_fold(base, changes, ["k"], Modes()).agg(F.count("*"), F.min("k"), F.sum("v")).first()
    assert tuple(out) == (5_000, 4_000_000, 20_000)
    written = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert written < 250 * 20_000


def test_keys_of_one_hash_are_told_apart(spark, monkeypatch):
    asked = []

    def poor(image, kind, keys, salt, real=key_moves._node):
        asked.append(salt)
        return F.pmod(real(image, kind, keys, salt), F.lit(2 if salt < 2 else 5_003))

    monkeypatch.setattr(key_moves, "_node", poor)
    base, changes = chains(spark, 20)
    extra = spark.createDataFrame([(500 + n, "insert", (n, 7), None) for n in range(20)], f"seq bigint, op string, row {ROW}, old {ROW}")
    got = A.apply_fold(base, changes.unionByName(extra), ["k"], Modes())
    want = [(n, 7) for n in range(20)] + [(n + 4_000_000, 4) for n in range(20)]
    assert sorted(map(tuple, got.collect())) == want
    assert max(asked) >= 2
