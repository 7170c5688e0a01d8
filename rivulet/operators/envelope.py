"""Building, encoding and decoding change envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions import b64_encode, cluster_time, format_day, format_seconds
from rivulet.schemas import DOC_WIRE, ROW_ENVELOPE

# How times travel in JSON.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd '00:00:00'",
}


def topic_name(database: Column, table: Column) -> Column:
    """`db-table`, the topic of a table."""
    return F.concat_ws("-", database, table)


def table_key(database: Column, table: Column) -> Column:
    """`db.table`, the address of a table."""
    return F.concat_ws(".", database, table)


def split_key(key: Column) -> Column:
    """STRUCT<database, table> of a `db.table` address."""
    parts = F.split(key, r"\.")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("database"),
        F.try_element_at(parts, F.lit(2)).alias("table"),
    )


def wire_value(value: Column, kind: T.DataType) -> Column:
    """Text form of one column value inside an envelope."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return format_seconds(value)
    if isinstance(kind, T.DateType):
        return format_day(value)
    if isinstance(kind, T.BinaryType):
        return b64_encode(value)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value, {**JSON_OPTIONS, "ignoreNullFields": "false"})
    return value.cast("string")


def payload(df: DataFrame, columns: list[str] | None = None) -> Column:
    """MAP<STRING,STRING> of the frame's columns in their text form."""
    pairs = []
    for field in df.schema.fields:
        if columns is None or field.name in columns:
            pairs += [F.lit(field.name), wire_value(df[field.name], field.dataType)]
    return F.create_map(*pairs)


def _empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def snapshot_envelopes(df: DataFrame, database: str, table: str, ts: int) -> DataFrame:
    """A table's snapshot as envelopes: a start marker, every row, a complete marker.

    `phase` (0, 1, 2) orders the three parts; all carry the snapshot time `ts`.
    """

    def part(source: DataFrame, kind: str, phase: int, data: Column) -> DataFrame:
        return source.select(
            F.lit(phase).alias("phase"),
            F.lit(f"bootstrap-{kind}").alias("type"),
            F.lit(database).alias("database"),
            F.lit(table).alias("table"),
            F.lit(f"{database}-{table}").alias("topic"),
            F.lit(ts).cast("bigint").alias("ts"),
            data.alias("data"),
        )

    one = df.sparkSession.range(0, 1, 1, 1)
    return (
        part(one, "start", 0, _empty_map())
        .unionByName(part(df, "insert", 1, payload(df)))
        .unionByName(part(one, "complete", 2, _empty_map()))
    )


def snapshot_documents(df: DataFrame, database: str, coll: str, id_column: str) -> DataFrame:
    """A collection's snapshot as document envelopes, framed by markers."""

    def part(source: DataFrame, kind: str, phase: int, key: Column, doc: Column) -> DataFrame:
        return source.select(
            F.lit(phase).alias("phase"),
            F.lit(f"bootstrap-{kind}").alias("operationType"),
            F.struct(F.lit(database).alias("db"), F.lit(coll).alias("coll")).alias("ns"),
            F.lit(f"{database}-{coll}").alias("topic"),
            key.alias("documentKey"),
            doc.alias("fullDocument"),
        )

    one = df.sparkSession.range(0, 1, 1, 1)
    no_key, no_doc = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    return (
        part(one, "start", 0, no_key, no_doc)
        .unionByName(part(df, "insert", 1, df[id_column].cast("string"), payload(df)))
        .unionByName(part(one, "complete", 2, no_key, no_doc))
    )


def explode_rows_events(events: DataFrame) -> DataFrame:
    """One envelope per row of a log event (works on streams).

    `row_no` is the 1-based row index; the last row carries `commit`, others `offset`.
    An update has both images, an insert or delete only `data`. Other columns of the
    input, such as a sequence number, are kept.
    """
    own = {"kind", "schema", "table", "timestamp", "rows"}
    kept = [c for c in events.columns if c not in own]
    # The outer form keeps Spark from testing the size of `rows` in a filter of its own,
    # which would build them a second time where they are derived.
    flat = events.select(
        *kept,
        "kind",
        F.col("schema").alias("database"),
        "table",
        F.col("timestamp").alias("ts"),
        F.size("rows").alias("_rows"),
        F.posexplode_outer("rows").alias("_pos", "_row"),
    ).where(F.col("_pos").isNotNull())
    last = F.col("_pos") + 1 == F.col("_rows")
    is_update = F.col("kind") == "update"
    return flat.select(
        *kept,
        F.when(F.col("kind") == "write", "insert").otherwise(F.col("kind")).alias("type"),
        "database",
        "table",
        topic_name(F.col("database"), F.col("table")).alias("topic"),
        "ts",
        F.when(last, F.lit(True)).alias("commit"),
        F.when(~last, F.col("_pos") + 1).alias("offset"),
        (F.col("_pos") + 1).alias("row_no"),
        F.when(is_update, F.col("_row.after_values")).otherwise(F.col("_row.values")).alias("data"),
        F.when(is_update, F.col("_row.before_values")).alias("old"),
    )


def stream_envelopes(records: DataFrame) -> DataFrame:
    """Change-stream records with their topic (works on streams)."""
    return records.withColumn("topic", topic_name(F.col("ns.db"), F.col("ns.coll")))


def encode(df: DataFrame, columns: list[str] | None = None, keep_nulls: bool = False) -> Column:
    """JSON text of an envelope. Empty envelope fields are left out, NULLs inside a
    payload map are kept; `keep_nulls` writes NULL fields of typed rows too."""
    chosen = columns or df.columns
    options = {**JSON_OPTIONS, "ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in chosen]), options)


def encode_messages(df: DataFrame, topic: str | None = None) -> DataFrame:
    """(topic, value) messages of envelopes: a fixed topic, or each envelope's own."""
    fields = [c for c in df.columns if c not in ("phase", "seq", "row_no", "log_pos")]
    own = F.col("topic") if "topic" in df.columns else F.lit(None).cast("string")
    return df.select(
        F.coalesce(F.lit(topic).cast("string"), own).alias("topic"),
        encode(df, fields).alias("value"),
    )


def snapshot_messages(df: DataFrame, database: str, table: str, ts: int) -> DataFrame:
    """A snapshot as (phase, topic, value) messages whose payload keeps JSON types."""
    markers = snapshot_envelopes(df.limit(0), database, table, ts)
    head = [
        F.lit("bootstrap-insert").alias("type"),
        F.lit(database).alias("database"),
        F.lit(table).alias("table"),
        F.lit(f"{database}-{table}").alias("topic"),
        F.lit(ts).cast("bigint").alias("ts"),
    ]
    # Decimals and bytes have no exact JSON number form, so they travel as text.
    as_text = (T.DecimalType, T.BinaryType)
    fields = [
        wire_value(df[f.name], f.dataType).alias(f.name)
        if isinstance(f.dataType, as_text)
        else df[f.name]
        for f in df.schema.fields
    ]
    options = {**JSON_OPTIONS, "ignoreNullFields": "false"}
    body = F.to_json(F.struct(*head, F.struct(*fields).alias("data")), options)
    rows = df.select(
        F.lit(1).alias("phase"), F.lit(f"{database}-{table}").alias("topic"), body.alias("value")
    )
    ends = markers.select("phase", "topic", encode(markers, markers.columns[1:]).alias("value"))
    return ends.unionByName(rows)


def _parse(messages: DataFrame, schema: str, fields: list[str] | None) -> DataFrame:
    """Message columns with the prefix `m_`, then the fields of the JSON value.

    The value is parsed in a generator, because a later filter on a parsed field would
    otherwise be pushed below the parsing and parse every message a second time.
    """
    kept = [F.col(c).alias(f"m_{c}") for c in messages.columns if c != "value"]
    wanted = T.StructType.fromDDL(schema)
    if fields is not None:
        wanted = T.StructType([f for f in wanted.fields if f.name in fields])
    envelope = F.from_json(F.col("value").cast("string"), wanted)
    return messages.select(*kept, F.inline(F.array(envelope)))


def decode_rows(messages: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Relational envelopes of messages (works on streams).

    Message columns other than `value` are kept with the prefix `m_`; malformed text
    gives an envelope without a type. Naming the `fields` that are needed saves parsing
    the others.
    """
    return _parse(messages, ROW_ENVELOPE, fields)


def document_id(key: Column) -> Column:
    """`_id` text of a document key, given bare or as a document holding `_id`."""
    inner = F.from_json(F.when(key.startswith("{"), key), "STRUCT<_id: STRING>")["_id"]
    return F.coalesce(inner, key)


def decode_documents(messages: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Document envelopes of messages (works on streams), with both key forms as `_id`
    and the cluster time as STRUCT<time, inc>. `fields` limits what is parsed, by the
    names used in messages."""
    parsed = _parse(messages, DOC_WIRE, fields)
    made = {
        "clusterTime": cluster_time(F.col("clusterTime")).alias("clusterTime"),
        "documentKey": document_id(F.col("documentKey")).alias("_id"),
    }
    return parsed.select(*[made.get(c, F.col(c)) for c in parsed.columns])
