"""Snapshots of tables and collections."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table, read as it lies; Spark splits large files by itself."""
    return spark.read.parquet(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel ranges of `split_column`.

    Every range uses a connection of its own, so ranges may see different moments. Take
    the log position before the snapshot and replay from there with a keyed apply, or
    read with one partition where a single moment is required.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", fetch_rows)
        .options(**options)
    )
    if split_column:
        if bounds is None or partitions < 2:
            raise ValueError("a split column needs bounds and more than one partition")
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def bounded_snapshot(df: DataFrame, id_column: str, max_id: Any = None) -> DataFrame:
    """Rows up to the greatest id at this moment, so that later inserts stay out.

    The bound is one value, fetched now and pushed to the source as a plain filter. An
    empty source gives an empty snapshot.
    """
    bound = df.agg(F.max(id_column)).first()[0] if max_id is None else max_id
    if bound is None:
        return df.limit(0)
    return df.where(F.col(id_column) <= F.lit(bound))


def read_sql(spark: SparkSession, query: str, args: dict[str, Any] | None = None) -> DataFrame:
    """Rows of a parameterised query over catalog tables and views."""
    return spark.sql(query, args=args or {})


def jdbc_query(
    spark: SparkSession, url: str, query: str, fetch_rows: int = 10_000, **options: str
) -> DataFrame:
    """Rows of a query run by a database, streamed by `fetch_rows`."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("query", query)
        .option("fetchsize", fetch_rows)
        .options(**options)
        .load()
    )
