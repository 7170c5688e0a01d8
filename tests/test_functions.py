import math

from pyspark.sql import functions as F

from rivulet import functions as R


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r[1] for r in df.select("i", column(F.col("t"))).orderBy("i").collect()]


def test_to_int(spark):
    texts = ["1", "", "2", "2.0", "-2", " 7 ", "+3", "1_000", "1__0", "是", None, "9" * 30]
    got = values(spark, texts, lambda t: R.to_int(t, -9))
    assert got == [1, -9, 2, -9, -2, 7, 3, 1000, -9, -9, -9, -9]


def test_to_float(spark):
    texts = ["", "1", "-1", "1.2", "-1.2", "1.a", "1e5", " 3 ", "1.5d", ".5", "5.", None]
    got = values(spark, texts, lambda t: R.to_float(t))
    assert got == [None, 1.0, -1.0, 1.2, -1.2, None, 1e5, 3.0, None, 0.5, 5.0, None]
    odd = values(spark, ["nan", "inf", "-Infinity", "+INF", "infinit"], lambda t: R.to_float(t))
    assert math.isnan(odd[0]) and odd[1:] == [math.inf, -math.inf, math.inf, None]


def test_to_number(spark):
    texts = ["是", "否", "", "1", "1.0", "-1", "-1.0", "+5", "1e5", ".5", "a1", None, "9007199254740993"]
    got = values(spark, texts, lambda t: R.to_number(t))
    assert [r["value"] for r in got[:12]] == [
        None, None, None, 1.0, 1.0, -1.0, -1.0, 5.0, None, 0.5, None, None,
    ]
    assert [r["is_int"] for r in got[:8]] == [False, False, False, True, False, True, False, True]
    assert int(got[12]["int_value"]) == 9007199254740993


def test_text_and_bytes(spark):
    long = "x" * 300 + "é"
    df = spark.createDataFrame([(long,)], "t STRING")
    row = df.select(
        R.to_bytes(F.col("t")).alias("b"), R.b64_encode(R.to_bytes(F.col("t"))).alias("e")
    ).first()
    assert bytes(row["b"]) == long.encode() and "\n" not in row["e"]
    got = values(spark, [row["e"], "aGk=\r\n", "aG k=", "abc", None], lambda t: R.to_text(R.b64_decode(t)))
    assert got == [long, "hi", "hi", None, None]


def test_times(spark):
    texts = ["2018-01-01 10:00:00", "2018-1-1 1:0:0.25", "2018-01-01", "", "18-01-01 00:00:00",
             "2018-13-01 00:00:00", None]
    got = values(spark, texts, lambda t: R.format_seconds(R.parse_seconds(t)))
    assert got == ["2018-01-01 10:00:00", "2018-01-01 01:00:00", None, None, None, None, None]
    days = values(spark, texts, lambda t: R.to_day(t, is_text=True).cast("string"))
    assert days[:3] == ["2018-01-01", "2018-01-01", "1970-01-01"] and days[6] == "1970-01-01"
    only = values(spark, ["2018-02-03"], lambda t: R.parse_day(t, day_only=True).cast("string"))
    assert only == ["2018-02-03"]
    assert values(spark, ["2018-01-01 20:00:00"], R.shift_to_shanghai) == ["2018-01-02 04:00:00"]


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = set()
        for zone in ("UTC", "America/New_York", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            text = F.lit("2018-03-11 02:30:00")
            row = spark.range(1).select(
                R.format_seconds(R.parse_seconds(text)),
                R.shift_to_shanghai(text),
                R.format_seconds(R.to_utc(R.parse_seconds(text))),
                R.with_zone(R.parse_seconds(F.lit("2018-06-01 08:00:00")), R.dates.SHANGHAI).cast("bigint"),
            ).first()
            seen.add(tuple(row))
        assert seen == {
            ("2018-03-11 02:30:00", "2018-03-11 10:30:00", "2018-03-10 18:30:00", 1527811200)
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_positions(spark):
    texts = ["Timestamp(1560410354, 1)", '{"$timestamp":{"t":7,"i":2}}', '{"time":3,"inc":4}',
             "[5,6]", "soon", None]
    got = values(spark, texts, R.cluster_time)
    assert [tuple(r) if r else None for r in got] == [(1560410354, 1), (7, 2), (3, 4), (5, 6), None, None]
    df = spark.createDataFrame([(1930000001, 3)], "t BIGINT, i INT")
    text = R.position_to_json(F.col("t"), F.col("i"))
    row = df.select(text.alias("j"), R.position_from_json(text).alias("p")).first()
    assert row["j"] == '{"$timestamp":{"t":1930000001,"i":3}}' and tuple(row["p"]) == (1930000001, 3)


def test_tokens(spark):
    rows = [("log_file", "bin.7"), ("log_pos", "99"), ("auto_position", "a:1-2"), ("server_id", "x")]
    df = spark.createDataFrame(rows, "k STRING, v STRING")
    got = [tuple(r[0]) for r in df.select(R.decode_token(F.col("k"), F.col("v"))).collect()]
    assert got == [("bin.7", None), (None, 99), ("a:1-2", None), (None, None)]
