"""Spark schemas shared by every stage of a change-data job."""

ROW_ENVELOPE = (
    "type STRING, database STRING, `table` STRING, topic STRING, ts BIGINT, xid BIGINT, "
    "commit BOOLEAN, offset INT, data MAP<STRING,STRING>, old MAP<STRING,STRING>"
)

# As it travels: clusterTime is text or an object and documentKey has two forms,
# so both are read as text and normalised while decoding.
DOC_WIRE = (
    "operationType STRING, ns STRUCT<db: STRING, coll: STRING>, topic STRING, "
    "clusterTime STRING, documentKey STRING, fullDocument MAP<STRING,STRING>"
)

CLUSTER_TIME = "STRUCT<time: BIGINT, inc: INT>"

MESSAGE = "topic STRING, partition INT, offset BIGINT, value STRING"

ROWS_EVENT = (
    "kind STRING, schema STRING, `table` STRING, timestamp BIGINT, log_pos BIGINT, "
    "rows ARRAY<STRUCT<values: MAP<STRING,STRING>, before_values: MAP<STRING,STRING>, "
    "after_values: MAP<STRING,STRING>>>"
)

PROGRESS = "source STRING, `table` STRING, time BIGINT, inc INT"

# Action types found in envelopes.
MARKERS = ("bootstrap-start", "bootstrap-complete")
BOOTSTRAP = ("bootstrap-start", "bootstrap-insert", "bootstrap-complete")
ROW_DML = ("insert", "update", "delete")
DOC_DML = ("insert", "update", "delete", "replace")
DDL = (
    "database-create",
    "database-alter",
    "database-drop",
    "table-create",
    "table-alter",
    "table-drop",
)

# Source column types that need repair after a JSON hop.
BINARY_TYPES = ("blob", "binary", "varbinary")
TIMESTAMP_TYPES = ("timestamp",)
