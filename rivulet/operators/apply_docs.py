"""Applying a document change log to a collection.

A change frame has `seq`, `op` (insert, update, delete), `_id` STRING and `doc`
MAP<STRING,STRING>; a collection has `_id` and `doc`. An insert or update sets the fields
it holds and creates the document if needed; fields it does not hold stay. A field that
is present with NULL is set to NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.routing import overlay


def document_changes(routed: DataFrame, seq: Column) -> DataFrame:
    """Change frame of routed document envelopes."""
    images = routed.where(F.col("action").isin("insert", "update", "delete"))
    return images.select(
        seq.cast("bigint").alias("seq"),
        F.col("action").alias("op"),
        F.coalesce("_id", F.try_element_at("fullDocument", F.lit("_id"))).alias("_id"),
        F.col("fullDocument").alias("doc"),
    )


def row_changes_as_documents(routed: DataFrame, keys: list[str], seq: Column) -> DataFrame:
    """Change frame for a collection from relational envelopes; `_id` is the key text,
    or a JSON array of it when the key has several columns."""
    images = routed.where(F.col("action").isin("insert", "update", "delete"))
    parts = [F.try_element_at("data", F.lit(k)) for k in keys]
    key = parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))
    return images.select(
        seq.cast("bigint").alias("seq"),
        F.col("action").alias("op"),
        key.alias("_id"),
        F.when(F.col("action") != "delete", F.col("data")).alias("doc"),
    )


# Entries beside a document's fields. Field names get the prefix `.`.
_TOUCH, _DELETE = "touch", "delete"


def _newest_entries(changes: DataFrame) -> DataFrame:
    """(_id, _f, value, seq): the newest value of every field, touch and delete of a
    document. They combine before the shuffle, so a document with very many changes costs
    no more than others."""
    empty = F.create_map().cast("map<string,string>")
    named = F.transform_keys(F.coalesce("doc", empty), lambda k, _: F.concat(F.lit("."), k))
    nothing = F.lit(None).cast("string")
    entries = F.when(
        F.col("op") == "delete", F.create_map(F.lit(_DELETE), nothing)
    ).otherwise(F.map_concat(F.create_map(F.lit(_TOUCH), nothing), named))
    flat = changes.select("_id", "seq", F.explode(entries).alias("_f", "value"))
    return flat.groupBy("_id", "_f").agg(
        F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq")
    )


def document_deltas(changes: DataFrame) -> DataFrame:
    """Net effect per document: (_id, deleted, alive, fields).

    `deleted` tells that earlier content is gone, `alive` that the log leaves a document,
    and `fields` are the fields set after the last delete.
    """
    name = F.col("_f")
    field = F.when(
        name.startswith("."),
        F.struct(F.substring(name, 2, 2**31 - 1).alias("field"), "value", "seq"),
    )
    # One row per field of the document: the group is as wide as the document.
    per_id = _newest_entries(changes).groupBy("_id").agg(
        F.max(F.when(name == _DELETE, F.col("seq"))).alias("_dead"),
        F.max(F.when(name == _TOUCH, F.col("seq"))).alias("_seq"),
        F.collect_list(field).alias("_fields"),
    )
    since = F.coalesce(F.col("_dead"), F.lit(-(2**63)).cast("bigint"))
    kept = F.filter("_fields", lambda f: f["seq"] > since)
    pairs = F.transform(kept, lambda f: F.struct(f["field"], f["value"]))
    return per_id.select(
        "_id",
        F.col("_dead").isNotNull().alias("deleted"),
        (F.col("_seq").isNotNull() & (F.col("_seq") > since)).alias("alive"),
        F.map_from_entries(pairs).alias("fields"),
    )


def apply_documents(base: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The collection (_id, doc) after the log."""
    deltas = document_deltas(changes)
    if base is None:
        return deltas.where("alive").select("_id", F.col("fields").alias("doc"))
    both = base.select("_id", "doc").join(deltas, "_id", "full")
    untouched = F.col("deleted").isNull()
    doc = (
        F.when(untouched, F.col("doc"))
        .when(F.col("deleted"), F.col("fields"))
        .otherwise(overlay(F.col("doc"), F.col("fields")))
    )
    return both.where(untouched | F.col("alive")).select("_id", doc.alias("doc"))


def inserts_on_live_documents(base: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Document inserts whose `_id` exists at that point, which a store would refuse."""
    from rivulet.operators.apply_rows import duplicate_inserts

    as_rows = changes.select("seq", "op", F.struct("_id").alias("row"))
    return duplicate_inserts(base, as_rows, ["_id"], upserts=True)
