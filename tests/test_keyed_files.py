"""The log that stream queries read: files of bounded size, each key in one of them."""

from pyspark.sql import functions as F

from rivulet.plans import queries_streams as Q


def test_files_hold_few_messages_and_whole_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "_FILE_MESSAGES", 100, raising=False)
    messages = spark.range(2_000, numPartitions=3).selectExpr(
        "'t' as topic", "cast(0 as int) as partition", "id as offset", "string(id % 200) as value", "id % 200 as key"
    )
    a_batch = Q._write_keyed(messages, f"{tmp_path}/log")
    read = spark.read.schema("partition int, offset bigint, value string").json(f"{tmp_path}/log")
    named = read.withColumn("file", F.col("_metadata.file_name"))
    sizes = [r[1] for r in named.groupBy("file").count().collect()]
    assert sum(sizes) == 2_000 and max(sizes) <= 400 and a_batch == 10
    assert named.groupBy("value").agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()
    rows = named.select("file", "offset").coalesce(1).collect()
    for name in {r["file"] for r in rows}:
        offsets = [r["offset"] for r in rows if r["file"] == name]
        assert offsets == sorted(offsets)
