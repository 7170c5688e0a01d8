from pyspark.sql import functions as F

from rivulet import functions as R


def test_texts_are_searched_before_characters_are_replaced(spark):
    rows = [("aGk=",), ("aG k=",), ("aGk=\r\n",), ("abc",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string").select("t", R.to_text(R.b64_decode(F.col("t"))).alias("d"))
    assert "RLIKE" in df._jdf.queryExecution().analyzed().toString().upper()
    assert [r["d"] for r in df.collect()] == ["hi", "hi", "hi", None, "", None]
