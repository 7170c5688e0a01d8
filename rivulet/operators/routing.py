"""Routing, filtering and repairing envelopes row by row; all work on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import b64_decode, shift_to_shanghai
from rivulet.operators.envelope import table_key
from rivulet.operators.ordered import small
from rivulet.schemas import DDL, DOC_DML, MARKERS, ROW_DML


def row_action(kind: Column) -> Column:
    """What a relational envelope of this type does.

    insert, update, delete, marker or ddl; `ignored` for unknown types and `malformed`
    where decoding found no type.
    """
    return (
        F.when(kind.isNull(), "malformed")
        .when(kind == "bootstrap-insert", "insert")
        .when(kind.isin(*MARKERS), "marker")
        .when(kind.isin(*ROW_DML), kind)
        .when(kind.isin(*DDL), "ddl")
        .otherwise("ignored")
    )


def document_action(kind: Column) -> Column:
    """What a document envelope of this type does; a replace acts as an update."""
    return (
        F.when(kind.isNull(), "malformed")
        .when(kind == "bootstrap-insert", "insert")
        .when(kind.isin(*MARKERS), "marker")
        .when(kind == "replace", "update")
        .when(kind.isin(*DOC_DML), kind)
        .otherwise("ignored")
    )


def route_rows(envelopes: DataFrame) -> DataFrame:
    return envelopes.withColumn("action", row_action(F.col("type")))


def route_documents(envelopes: DataFrame) -> DataFrame:
    return envelopes.withColumn("action", document_action(F.col("operationType")))


def only_changes(routed: DataFrame) -> DataFrame:
    """Envelopes that change a target."""
    return routed.where(F.col("action").isin("insert", "update", "delete"))


def keep_tables(
    df: DataFrame, tables: list[str], database: str = "database", table: str = "table"
) -> DataFrame:
    """Exact filter: `db.table` must be listed."""
    pairs: dict[str, list[str]] = {}
    for address in tables:
        db, name = address.split(".")
        pairs.setdefault(db, []).append(name)
    wanted = F.lit(False)
    for db, names in pairs.items():
        wanted = wanted | ((F.col(database) == db) & F.col(table).isin(*names))
    return df.where(wanted)


def keep_tables_in(df: DataFrame, tables: DataFrame) -> DataFrame:
    """Exact filter by a frame of (database, table) rows of any size."""
    return df.join(small(tables.select("database", "table")), ["database", "table"], "left_semi")


def keep_schemas(
    df: DataFrame, tables: list[str], database: str = "database", table: str = "table"
) -> DataFrame:
    """Coarse filter: database and table listed separately, so cross pairs pass."""
    split = [address.split(".") for address in tables]
    databases = sorted({db for db, _ in split})
    names = sorted({name for _, name in split})
    return df.where(F.col(database).isin(*databases) & F.col(table).isin(*names))


def resolve_row_target(
    df: DataFrame, database: str | None, table: str | None, forced: bool = False
) -> DataFrame:
    """`target` of each envelope: its own database and table, each falling back to the
    configured one; `forced` sends every table to the configured target."""
    own_db = F.lit(None).cast("string") if forced else F.col("database")
    own_table = F.lit(None).cast("string") if forced else F.col("table")
    blank_db = F.when(own_db != "", own_db)
    blank_table = F.when(own_table != "", own_table)
    return df.withColumn(
        "target",
        table_key(
            F.coalesce(blank_db, F.lit(database).cast("string")),
            F.coalesce(blank_table, F.lit(table).cast("string")),
        ),
    )


def resolve_document_target(df: DataFrame, database: str, coll: str) -> DataFrame:
    """`target` of each document envelope: its own namespace when both parts are there."""
    has_own = (F.coalesce(F.col("ns.db"), F.lit("")) != "") & (
        F.coalesce(F.col("ns.coll"), F.lit("")) != ""
    )
    own = table_key(F.col("ns.db"), F.col("ns.coll"))
    return df.withColumn("target", F.when(has_own, own).otherwise(F.lit(f"{database}.{coll}")))


def overlay(under: Column, over: Column) -> Column:
    """Map `under` with the entries of map `over` on top; NULL maps count as empty."""
    empty = F.create_map().cast("map<string,string>")
    top = F.coalesce(over, empty)
    kept = F.map_filter(F.coalesce(under, empty), lambda k, _: ~F.map_contains_key(top, k))
    return F.map_concat(kept, top)


def before_image(df: DataFrame) -> DataFrame:
    """Full before image in `before`: the after image with the changed fields put back."""
    return df.withColumn("before", overlay(F.col("data"), F.col("old")))


def _typed(data: Column, name: str, kind: str) -> Column:
    text = F.try_element_at(data, F.lit(name))
    # payloads carry bytes as base64
    return b64_decode(text) if kind.lower() == "binary" else text.try_cast(kind)


def project(data: Column, columns: dict[str, str]) -> list[Column]:
    """Typed columns of a payload map; a missing field or bad value is NULL.

    A BINARY column is decoded from base64, an empty text to no bytes.
    """
    return [_typed(data, name, kind).alias(name) for name, kind in columns.items()]


def bad_fields(data: Column, columns: dict[str, str]) -> Column:
    """Names of the fields that hold a value which does not fit the type."""
    names = [
        F.when(
            F.try_element_at(data, F.lit(name)).isNotNull() & _typed(data, name, kind).isNull(),
            F.lit(name),
        )
        for name, kind in columns.items()
    ]
    return F.array_compact(F.array(*names))


def _repair(df: DataFrame, names: list[str], fix) -> DataFrame:
    """Rewrite named payload fields; NULL and empty values and missing fields stay."""
    listed = F.array(*[F.lit(n) for n in names])

    def one(key: Column, value: Column) -> Column:
        wanted = F.array_contains(listed, key) & (F.coalesce(value, F.lit("")) != "")
        return F.when(wanted, fix(value)).otherwise(value)

    for image in ("data", "old"):
        if image in df.columns:
            df = df.withColumn(image, F.transform_values(image, one))
    return df


def shift_timestamps(df: DataFrame, names: list[str]) -> DataFrame:
    """Shift named UTC timestamp fields of `data` and `old` to Shanghai time."""
    return _repair(df, names, shift_to_shanghai) if names else df


def decode_binaries(df: DataFrame, names: list[str], image: str = "data") -> DataFrame:
    """Add `binaries`, a MAP<STRING,BINARY> of the named base64 fields of an image.

    NULL and empty values are left out, and so is bad input.
    """
    pairs = F.transform(
        F.array(*[F.lit(n) for n in names]),
        lambda name: F.struct(name, b64_decode(F.try_element_at(image, name))),
    )
    usable = F.filter(pairs, lambda p: p["col2"].isNotNull() & (F.length(p["col2"]) > 0))
    return df.withColumn("binaries", F.map_from_entries(usable))


def table_sets(wanted: DataFrame, known: DataFrame, column: str = "table") -> DataFrame:
    """Each wanted table with its set: `new` if no position is known, else `old`.

    Together they are the tables to follow.
    """
    have = known.select(F.col(column).alias("_known")).distinct()
    ask = wanted.select(column).distinct()
    joined = ask.join(have, F.col(column) == F.col("_known"), "left")
    return joined.select(
        column, F.when(F.col("_known").isNull(), "new").otherwise("old").alias("set")
    )
