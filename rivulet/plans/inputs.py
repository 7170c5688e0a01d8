"""Change logs derived row by row from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import format_seconds
from rivulet.operators.envelope import encode
from rivulet.sources.snapshot import parquet_table

# Columns and types of the replicated `shop.account` table.
ACCOUNT = {"user_id": "bigint", "event_type": "string", "value": "double", "created": "string"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_table(spark, f"{sf_dir}/{name}.parquet")


def epoch_seconds(value: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp."""
    since = value - F.lit("1970-01-01").cast("timestamp_ntz")
    return since.cast("interval second").cast("bigint")


def change_type() -> Column:
    """Change type of an event."""
    kind = F.col("event_type")
    return (
        F.when(kind == "signup", "insert")
        .when(kind == "error", "delete")
        .when(kind == "view", "replace")
        .otherwise("update")
    )


def late_seconds() -> Column:
    """Event time moved back by up to 100,000 seconds, so that late changes occur."""
    return epoch_seconds(F.col("ts")) - F.col("event_id") * 7919 % 100000


def account_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One relational envelope per event, with `seq`; `old` holds a changed field only."""
    events = table(spark, sf_dir, "events")
    data = F.create_map(
        F.lit("user_id"),
        F.col("user_id").cast("string"),
        F.lit("event_type"),
        F.col("event_type"),
        F.lit("value"),
        F.col("value").cast("string"),
        F.lit("created"),
        format_seconds(F.col("ts")),
    )
    old = F.create_map(F.lit("value"), (F.col("event_id") % 7).cast("string"))
    return events.select(
        F.col("event_id").alias("seq"),
        change_type().alias("type"),
        F.concat(F.lit("db"), (F.col("user_id") % 3).cast("string")).alias("database"),
        F.concat(F.lit("t"), (F.col("event_id") % 4).cast("string")).alias("table"),
        F.concat(F.lit("events-"), F.col("event_type")).alias("topic"),
        late_seconds().alias("ts"),
        F.col("event_id").alias("xid"),
        F.when(F.col("event_id") % 3 == 0, F.lit(True)).alias("commit"),
        data.alias("data"),
        F.when(change_type() == "update", old).alias("old"),
    )


def account_messages(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """The log as messages; every tenth view is broken text. With `keyed` they carry `key`."""
    log = account_log(spark, sf_dir)
    fields = [c for c in log.columns if c != "seq"]
    broken = (F.col("type") == "replace") & (F.col("seq") % 10 == 0)
    value = F.when(broken, F.concat(F.lit("not json "), F.col("seq").cast("string")))
    user = F.col("data")["user_id"]
    return log.select(
        "topic",
        (user.cast("bigint") % 4).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.coalesce(value, encode(log, fields)).alias("value"),
        *([user.alias("key")] if keyed else []),
    )


def document_messages(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """One document change message per event: `_id` is the user, and the event type names
    the field that is set. Snapshot inserts carry a bare key, other changes a key document,
    and cluster times travel as driver text. With `keyed` the messages carry `key`."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    kind = F.when(F.col("event_id") % 50 == 0, "bootstrap-insert").otherwise(change_type())
    key = F.when(F.col("event_id") % 50 == 0, user).otherwise(
        F.to_json(F.struct(user.alias("_id")))
    )
    time = F.concat(
        F.lit("Timestamp("),
        late_seconds().cast("string"),
        F.lit(", "),
        (F.col("event_id") % 9).cast("string"),
        F.lit(")"),
    )
    nothing = (F.col("event_id") % 11 == 0) & (F.col("event_type") == "purchase")
    doc = F.create_map(
        F.lit("_id"),
        user,
        F.col("event_type"),
        F.when(~nothing, F.col("value").cast("string")),
        F.concat(F.lit("p"), (F.col("event_id") % 3).cast("string")),
        F.get_json_object("props", "$.k"),
    )
    envelope = F.struct(
        kind.alias("operationType"),
        F.struct(F.lit("shop").alias("db"), F.lit("profile").alias("coll")).alias("ns"),
        F.lit("shop-profile").alias("topic"),
        time.alias("clusterTime"),
        key.alias("documentKey"),
        F.when(kind != "delete", doc).alias("fullDocument"),
    )
    return events.select(
        F.lit("shop-profile").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_json(envelope).alias("value"),
        *([user.alias("key")] if keyed else []),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native change frame keyed by customer: a small `state` value, whose before images
    match the current row only some of the time."""
    orders = table(spark, sf_dir, "orders")
    key, state = F.col("o_custkey").alias("k"), F.col("o_orderkey")
    turn = F.col("o_orderkey") % 10
    price = F.floor(F.col("o_totalprice")).cast("bigint")
    return orders.select(
        state.alias("seq"),
        F.when(turn < 3, "insert").when(turn < 8, "update").otherwise("delete").alias("op"),
        F.struct(key, F.when(price % 4 > 0, price % 4).alias("state")).alias("row"),
        F.struct(key, F.when(price % 3 > 0, price % 3).alias("state")).alias("old"),
    )


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base table for `order_changes`: all customers."""
    customers = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey").cast("bigint") % 3
    return customers.select(
        F.col("c_custkey").alias("k"), F.when(nation > 0, nation).alias("state")
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows-events as a log reader gives them: one to four row images per order."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    kind = F.when(status == "O", "write").when(status == "F", "update").otherwise("delete")

    def image(n: Column, extra: int) -> Column:
        return F.create_map(
            F.lit("id"),
            F.concat_ws("/", F.col("o_orderkey").cast("string"), n.cast("string")),
            F.lit("n"),
            (n + extra).cast("string"),
        )

    none = F.lit(None).cast("map<string,string>")
    is_update = kind == "update"

    def row(n: Column) -> Column:
        return F.struct(
            F.when(~is_update, image(n, 0)).otherwise(none).alias("values"),
            F.when(is_update, image(n, 0)).otherwise(none).alias("before_values"),
            F.when(is_update, image(n, 100)).otherwise(none).alias("after_values"),
        )

    return orders.select(
        kind.alias("kind"),
        F.concat(F.lit("db"), (F.col("o_custkey") % 3).cast("string")).alias("schema"),
        F.concat(F.lit("t"), (F.col("o_custkey") % 5).cast("string")).alias("table"),
        epoch_seconds(F.col("o_orderdate")).alias("timestamp"),
        F.col("o_orderkey").alias("log_pos"),
        F.transform(F.sequence(F.lit(1), 1 + F.col("o_orderkey") % 4), row).alias("rows"),
    )
