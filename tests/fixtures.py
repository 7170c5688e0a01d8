"""Sample messages of a replicated account table. Names, times and ids are fixed values."""

import json

ACCOUNT_COLUMNS = {
    "id": "decimal(20,0)",
    "name": "string",
    "phone": "string",
    "tier": "string",
    "sponsor_id": "decimal(20,0)",
    "origin": "string",
    "joined_at": "timestamp_ntz",
    "changed_at": "timestamp",
}


def account(number, name=None, person=0, updated=None):
    day = f"2031-03-04 0{number}:0{number}:0{number}"
    return {
        "id": number,
        "name": name,
        "phone": str(number) * 5,
        "tier": "other",
        "sponsor_id": person,
        "origin": "poster",
        "joined_at": day,
        "changed_at": updated or day,
    }


def message(kind, data, table="Member", ts=1930000001, **extra):
    return {"database": "club", "table": table, "type": kind, "ts": ts, "data": data, **extra}


_FIRST = account(1, "alder")

INSERTS = [
    message("bootstrap-start", {}),
    message("bootstrap-insert", _FIRST),
    *[message("bootstrap-insert", account(n)) for n in (2, 3, 4)],
    message("bootstrap-complete", {}),
    message("insert", account(5), ts=1930000101, xid=501, commit=True),
    message("insert", account(6), ts=1930000201, xid=502, commit=True),
]

UPDATES = [
    message(
        "update",
        account(5, person=5, updated="2031-03-06 15:05:05"),
        ts=1930900000,
        xid=603,
        commit=True,
        old={"sponsor_id": 0, "changed_at": "2031-03-04 05:05:05"},
    ),
    message(
        "update",
        account(1, "alder", 1, "2031-03-06 11:01:01"),
        table="Patron",
        ts=1931500000,
        xid=604,
        commit=True,
        old={"sponsor_id": 0, "changed_at": "2031-03-04 01:01:01"},
    ),
]

DELETES = [
    message("delete", account(3), "Patron", 1931500000, xid=705, commit=True),
    message("delete", _FIRST, "Patron", 1931500001, xid=706, commit=True),
]


def as_messages(spark, values, topic="club-Member"):
    rows = [(topic, 0, i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, value STRING")
