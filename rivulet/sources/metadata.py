"""Column types and table definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def column_types(df: DataFrame) -> DataFrame:
    """(column_name, data_type) of a frame."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name STRING, data_type STRING")


def jdbc_column_types(
    spark: SparkSession, url: str, database: str, table: str, **options: str
) -> DataFrame:
    """(column_name, data_type) as a database's information schema gives them."""
    columns = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", "information_schema.columns")
        .options(**options)
        .load()
    )
    columns = columns.toDF(*[c.lower() for c in columns.columns])
    wanted = (F.col("table_schema") == database) & (F.col("table_name") == table)
    return columns.where(wanted).select("column_name", "data_type")


def columns_of_type(types: DataFrame, wanted: tuple[str, ...] | list[str]) -> list[str]:
    """Names of the columns with one of these types; a table's columns are few."""
    rows = types.where(F.col("data_type").isin(*wanted)).select("column_name").collect()
    return [row[0] for row in rows]


def create_table_text(df: DataFrame, name: str) -> str:
    """CREATE TABLE statement of a frame's schema."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
        for f in df.schema.fields
    )
    return f"CREATE TABLE {name} ({columns})"
