import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.schemas import MESSAGE
from rivulet.sources.log import MessageLog, Pieces, _read, read_log


def rows(topic, partition, low, high):
    return [(topic, partition, n, f"{topic}{partition}:{n}") for n in range(low, high)]


def frame(spark, made):
    return spark.createDataFrame(made, MESSAGE)


def got(df):
    return sorted(tuple(r) for r in df.select("topic", "partition", "offset", "value").collect())


def test_batches_by_topics_and_tokens(spark, tmp_path):
    path = str(tmp_path / "log")
    assert got(read_log(spark, path)) == []
    log = MessageLog(spark, path, file_messages=7)
    first = rows("a", 0, 0, 30) + rows("a", 1, 5, 9) + rows("b.c", 0, 0, 12)
    second = rows("a", 0, 30, 50) + rows("a", 2, 0, 4)
    assert log.append(frame(spark, first).withColumn("extra", F.lit(1)), "one")
    tokens = spark.createDataFrame(log.ends().collect(), "token string, next_offset long")
    assert log.append(frame(spark, second), "two")
    assert not log.append(frame(spark, second), "two")
    assert log.append(frame(spark, []), "none")
    assert got(read_log(spark, path)) == sorted(first + second)
    assert got(read_log(spark, path, "b.c")) == rows("b.c", 0, 0, 12)
    assert got(read_log(spark, path, tokens=tokens)) == sorted(second)
    middle = spark.createDataFrame([("a.0", 13), ("a.1", 99), ("b.c.0", 12)], "token string, next_offset long")
    assert got(read_log(spark, path, ["a", "b.c"], tokens=middle)) == rows("a", 0, 13, 50) + rows("a", 2, 0, 4)
    assert read_log(spark, path, task_messages=7).rdd.getNumPartitions() > 6


def test_append_is_whole_or_not(spark, tmp_path):
    path = str(tmp_path / "log")
    log = MessageLog(spark, path)
    log.append(frame(spark, rows("a", 0, 0, 5)))
    with pytest.raises(ValueError, match="before the end"):
        log.append(frame(spark, rows("a", 0, 4, 9) + rows("a", 1, 0, 3)), "x")
    for bad in [(None, 0, 9, "v"), ("a", None, 9, "v"), ("a", 0, None, "v")]:
        with pytest.raises(ValueError, match="need a topic"):
            log.append(frame(spark, [bad, ("a", 0, 9, "v")]), "x")
    assert got(read_log(spark, path)) == rows("a", 0, 0, 5)
    assert log.append(frame(spark, [("a", 0, 5, None)]), "x")
    assert got(read_log(spark, path).where("value is null").fillna("-")) == [("a", 0, 5, "-")]
    with pytest.raises(ValueError, match="latest"):
        read_log(spark, path, earliest=False)


def stream_to(df, home, **trigger):
    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{home}/out/batch={number}")

    return df.writeStream.foreachBatch(keep).option("checkpointLocation", f"{home}/checkpoint").trigger(**trigger).start()


def run(df, home):
    query = stream_to(df, home, availableNow=True)
    query.awaitTermination()


def test_latest_survives_a_restart_before_the_first_message(spark, tmp_path):
    home = str(tmp_path)
    log = MessageLog(spark, f"{home}/log")
    log.append(frame(spark, rows("a", 0, 0, 9)))

    def again():
        run(read_log(spark, f"{home}/log", earliest=False, streaming=True, anchor=f"{home}/anchor"), home)

    again()
    log.append(frame(spark, rows("a", 0, 9, 12) + rows("a", 1, 0, 3)))
    again()
    log.append(frame(spark, rows("a", 1, 3, 5) + rows("b", 0, 0, 2)))
    again()
    again()
    out = spark.read.schema(MESSAGE).parquet(f"{home}/out")
    assert got(out) == rows("a", 0, 9, 12) + rows("a", 1, 0, 5) + rows("b", 0, 0, 2)


def test_a_running_stream_takes_bounded_batches(spark, tmp_path):
    home = str(tmp_path)
    log = MessageLog(spark, f"{home}/log")
    first, second, third = rows("a", 0, 0, 25) + rows("a", 1, 0, 3), rows("a", 2, 0, 11), rows("a", 3, 0, 24)
    log.append(frame(spark, first))
    tokens = spark.createDataFrame([("a.0", 2), ("a.2", 1)], "token string, next_offset long")

    def go(more):
        stream = read_log(
            spark, f"{home}/log", tokens=tokens, streaming=True, per_trigger=10, anchor=f"{home}/anchor"
        )
        query = stream_to(stream, home, processingTime="0 seconds")
        try:
            for made in more:
                query.processAllAvailable()
                log.append(frame(spark, made))
            query.processAllAvailable()
        finally:
            query.stop()

    go([second])
    log.append(frame(spark, third))
    go([])
    out = spark.read.schema(f"{MESSAGE}, batch int").parquet(f"{home}/out")
    assert got(out) == sorted(rows("a", 0, 2, 25) + rows("a", 1, 0, 3) + rows("a", 2, 1, 11) + third)
    sizes = [r["count"] for r in out.groupBy("batch").count().collect()]
    assert max(sizes) <= 10 and len(sizes) >= 7
    with pytest.raises(ValueError, match="anchor"):
        read_log(spark, f"{home}/log", streaming=True, per_trigger=10)


@pytest.mark.parametrize("n, size, distinct", [(240_000, 1 << 10, True), (60, 1 << 20, True), (2_000, 32 << 10, False)])
def test_a_task_holds_a_part_of_a_file(spark, tmp_path, n, size, distinct):
    log = MessageLog(spark, str(tmp_path / "log"))
    text = F.sha2((F.col("id") * int(distinct)).cast("string"), 256)
    log.append(
        spark.range(n).coalesce(1).select(
            F.lit("a").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
            F.repeat(text, size // 64).alias("value"),
        )
    )
    pieces = [(s["file"], "a", 0, s["first"], s["last"] + 1) for s in log.segments().orderBy("first").collect()]
    usual = pa.default_memory_pool()
    counted = pa.proxy_memory_pool(usual)
    pa.set_memory_pool(counted)
    try:
        offsets = [o for batch in _read(log.path, Pieces(pieces)) for o in batch["offset"].to_pylist()]
    finally:
        pa.set_memory_pool(usual)
    assert offsets == list(range(n))
    assert counted.max_memory() < 40 << 20


def test_pieces_are_read_by_offset_whatever_the_row_groups(spark, tmp_path):
    log = MessageLog(spark, str(tmp_path / "log"))
    made = rows("a", 0, 0, 30) + rows("a", 1, 5, 9) + rows("b", 0, 3, 12)
    log.append(frame(spark, made).coalesce(1))
    for topic, partition, low, high in [("a", 0, 7, 22), ("a", 1, 0, 7), ("b", 0, 11, 99), ("b", 0, 12, 99), ("b", 1, 0, 9)]:
        pieces = [(s["file"], topic, partition, low, high) for s in log.segments().dropDuplicates(["file"]).collect()]
        found = [tuple(r.values()) for b in _read(log.path, Pieces(pieces)) for r in b.to_pylist()]
        assert sorted(found) == [r for r in made if r[:2] == (topic, partition) and low <= r[2] < high]
