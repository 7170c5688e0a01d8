"""Queries over gates, appliers, progress and batching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import batching, gates, gtid, progress, routing
from rivulet.operators.apply_docs import (
    apply_documents,
    document_changes,
    inserts_on_live_documents,
    row_changes_as_documents,
)
from rivulet.operators.apply_rows import (
    Modes,
    apply_bag,
    apply_changes,
    apply_fold,
    bag_violations,
    changes_from,
    duplicate_inserts,
)
from rivulet.operators.envelope import (
    decode_documents,
    decode_rows,
    explode_rows_events,
    snapshot_envelopes,
)
from rivulet.plans import sql_parts as S
from rivulet.plans.inputs import (
    ACCOUNT,
    account_log,
    account_messages,
    document_messages,
    epoch_seconds,
    order_base,
    order_changes,
    order_events,
    table,
)
from rivulet.plans.pipeline import read_tables
from rivulet.plans.registry import query
from rivulet.sources.chunks import ChunkedSnapshot
from rivulet.util import scratch_dir, stage

# --- gates ---------------------------------------------------------------------------

def _row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored positions of two of the three databases' tables: their median-like time."""
    log = account_log(spark, sf_dir).where(F.col("database") != "db2")
    return log.groupBy("database", "table").agg(
        (F.min("ts") + 50_000).alias("time"), F.lit(0).alias("inc")
    )


@query(
    f"""with {S.LOG},
p as (select db, tbl, min(ts_s) + 50000 as t from log where db <> 'db2' group by 1, 2),
g as (select log.*, max(ts_s) over (partition by log.db, log.tbl order by seq
        rows between unbounded preceding and 1 preceding) as seen, p.t
      from log left join p on p.db = log.db and p.tbl = log.tbl)
select seq, db as database, tbl as "table", ts_s as ts from g
where (seen is null or ts_s >= seen) and (t is null or ts_s >= t)"""
)
def late_gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = gates.gate_rows(
        account_log(spark, sf_dir),
        ["database", "table"],
        positions=_row_positions(spark, sf_dir),
    )
    return kept.select("seq", "database", "table", "ts")


_EVENT_ROWS = """e as (
  select o_orderkey as log_pos, 'db' || (o_custkey % 3) as db, 't' || (o_custkey % 5) as tbl,
    cast(epoch(o_orderdate) as bigint) as ts, 1 + o_orderkey % 4 as n_rows from orders),
r as (select e.*, unnest(range(1, n_rows + 1)) as n from e)"""


@query(
    f"""with {_EVENT_ROWS},
p as (select db, tbl, max(ts) - 2592000 as t, 3 as i from r group by 1, 2),
q as (select db, tbl, max(ts) as t, 3 as i from r where ts < (select max(t) from p) group by 1, 2)
select r.log_pos, r.n as row_no, r.db as database, r.tbl as "table" from r join q
  on q.db = r.db and q.tbl = r.tbl where r.ts > q.t or (r.ts = q.t and r.n >= q.i)"""
)
def late_gate_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that is replayed from the middle of an event, per table."""
    rows = explode_rows_events(order_events(spark, sf_dir))
    by = ["database", "table"]
    bound = rows.groupBy(*by).agg((F.max("ts") - 2592000).alias("t"))
    cut = rows.where(F.col("ts") < bound.agg(F.max("t")).scalar())
    stored = cut.groupBy(*by).agg(F.max("ts").alias("time"), F.lit(3).alias("inc"))
    return gates.gate_offsets(rows, by, stored).select(
        "log_pos", F.col("row_no").cast("bigint").alias("row_no"), "database", "table"
    )


@query(
    f"""with {S.DOCS},
c as (select *, 'c' || (seq % 3) as coll, t * 16 + i as pos from docs),
g as (select c.*, max(pos) over (partition by coll order by seq
        rows between unbounded preceding and 1 preceding) as seen from c)
select seq, coll, t as time, i as inc from g where seen is null or pos >= seen"""
)
def late_gate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = decode_documents(document_messages(spark, sf_dir), ["clusterTime"]).select(
        F.col("m_offset").alias("seq"),
        F.concat(F.lit("c"), (F.col("m_offset") % 3).cast("string")).alias("coll"),
        "clusterTime",
    )
    kept = gates.gate_documents(log, ["coll"])
    return kept.select(
        "seq", "coll", "clusterTime.time", F.col("clusterTime.inc").cast("bigint").alias("inc")
    )


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("sid"), (F.col("user_id") % 3).cast("string")).alias("sid"),
        F.col("event_id").alias("gno"),
        F.when(F.col("user_id") % 2 == 0, "new").otherwise("old").alias("kind"),
        "event_type",
    )


def _executed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GTID set of everything but the last fifth of the log and the clicks of one server."""
    log = _transactions(spark, sf_dir)
    end = log.agg(F.max("gno") * 4 / 5).scalar()
    early = (F.col("gno") < end) & ~((F.col("sid") == "sid1") & (F.col("event_type") == "click"))
    return stage(gtid.compact(log.where(early | (F.col("sid") == "sid2"))), "executed")


_TX = """tx as (select event_id as seq, 'sid' || (user_id % 3) as sid, event_id as gno,
  case when user_id % 2 = 0 then 'new' else 'old' end as kind, event_type from events),
flagged as (select *, ((gno < (select max(gno) * 4 / 5 from tx) and not (sid = 'sid1' and event_type = 'click'))
  or sid = 'sid2') as covered from tx)"""


@query(f"with {_TX} select seq, sid, gno, covered from flagged")
def gtid_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _transactions(spark, sf_dir)
    return gtid.covered(log, _executed(spark, sf_dir)).select("seq", "sid", "gno", "covered")


@query(
    f"""with {_TX}, g as (select sid, gno, gno - row_number() over (partition by sid order by gno) as grp
  from flagged where covered)
select sid, min(gno) as lo, max(gno) as hi from g group by sid, grp"""
)
def gtid_set_of_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _executed(spark, sf_dir).select("sid", "lo", "hi")


@query(
    f"""with {_TX}, f as (select sid, min(seq) as at from flagged where not covered group by sid)
select seq, tx.sid, kind from tx left join f on f.sid = tx.sid where kind = 'old' or seq >= f.at"""
)
def align_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _transactions(spark, sf_dir)
    kept = gates.gate_alignment(
        log, _executed(spark, sf_dir), F.col("kind") == "new", server="sid"
    )
    return kept.select("seq", "sid", "kind")


@query(
    """select event_id, 'sid' || user_id as sid, cast(1 as bigint) as lo, event_id + 1 as hi from events
union all select event_id, 'sid' || user_id, event_id + 5, event_id + 5 from events
union all select event_id, 'other', cast(7 as bigint), cast(9 as bigint) from events where event_type = 'view'"""
)
def gtid_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set texts with blanks, several intervals, single numbers and several sids."""
    return gtid.parse_sets(_set_texts(spark, sf_dir), "own").drop("other").select(
        "event_id", "sid", "lo", "hi"
    )


def _set_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    tail = F.when(F.col("event_type") == "view", F.lit(",\n other:7-9")).otherwise("")
    own = F.concat(F.format_string("sid%d:1-%d:%d", u, e + 1, e + 5), tail)
    extra = F.when(F.col("event_type") == "error", F.lit(":900000001")).otherwise("")
    other = F.concat(F.format_string("sid%d:1-%d:%d", u, e + 1, e + 5), extra)
    missing = F.when(F.col("event_type") == "click", F.concat(other, F.lit(",none:1")))
    return table(spark, sf_dir, "events").select(
        "event_id", own.alias("own"), F.coalesce(missing, other).alias("other")
    )


@query(
    "select event_id, event_type not in ('error', 'click') as is_equal from events"
)
def gtid_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _set_texts(spark, sf_dir)
    own = gtid.parse_sets(texts.select("event_id", "own"), "own")
    other = gtid.parse_sets(texts.select("event_id", "other"), "other")
    return gtid.sets_contain(own, other, ["event_id"])


@query(
    f"""with {S.LOG},
p as (select min(ts_s) + 50000 as t from log where db = 'db1' and tbl = 't2'),
snap as (select cast(floor(epoch(min(ts))) as bigint) as t from events),
w as (select log.*, case when db = 'db1' then (select t from p) else (select t from snap) end as start,
  max(ts_s) over (partition by db, tbl order by seq rows between unbounded preceding and 1 preceding) as seen
  from log where (db, tbl) in (('db0', 't1'), ('db1', 't2'))),
g as (select * from w where ts_s >= start and (seen is null or ts_s >= seen))
select 3 as phase, type, topic, user_id as id from g
union all select 0, 'bootstrap-start', 'db0-t1', null
union all select 1, 'bootstrap-insert', 'db0-t1', c_custkey from customer
union all select 2, 'bootstrap-complete', 'db0-t1', null"""
)
def read_new_and_known_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One new table is snapshotted and followed, one known table only followed."""
    log = account_log(spark, sf_dir)
    known = (F.col("database") == "db1") & (F.col("table") == "t2")
    positions = log.where(known).groupBy("database", "table").agg(
        (F.min("ts") + 50_000).alias("time"), F.lit(0).alias("inc")
    )
    begin = table(spark, sf_dir, "events").agg(F.min(epoch_seconds(F.col("ts")))).first()[0]
    whole = read_tables(
        {
            "db0.t1": table(spark, sf_dir, "customer"),
            "db1.t2": table(spark, sf_dir, "supplier"),
        },
        log,
        begin,
        positions,
    )
    data = F.col("data")
    key = F.coalesce(
        F.try_element_at(data, F.lit("c_custkey")), F.try_element_at(data, F.lit("user_id"))
    )
    return whole.select("phase", "type", "topic", key.cast("bigint").alias("id"))


@query(
    """with e as (
  select o_orderkey as log_pos, cast(floor(epoch(o_orderdate)) as bigint) as ts,
    'db' || (o_custkey % 3) as db, 't' || (o_custkey % 5) as tbl, 1 + o_orderkey % 4 as n from orders
), r as (
  select log_pos, ts, unnest(range(1, n + 1)) as row_no from e where db = 'db1' and tbl = 't2'
), f as (select arg_min(ts, log_pos) as t from r
), w as (
  select r.*, max(ts) over (order by log_pos, row_no rows between unbounded preceding and 1 preceding) as seen
  from r
)
select log_pos, cast(row_no as bigint) as row_no, ts from w, f
where ts >= t and (seen is null or ts >= seen) and (ts > t or row_no >= 2)"""
)
def resume_within_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known table, stopped at the second row of its first event, is followed on."""
    rows = explode_rows_events(order_events(spark, sf_dir))
    rows = rows.withColumn("seq", F.col("log_pos") * 10 + F.col("row_no"))
    known = (F.col("database") == "db1") & (F.col("table") == "t2")
    positions = rows.where(known).groupBy("database", "table").agg(
        F.min_by("ts", "log_pos").alias("time"), F.lit(2).alias("inc")
    )
    whole = read_tables({"db1.t2": table(spark, sf_dir, "orders")}, rows, 0, positions)
    return whole.select("log_pos", F.col("row_no").cast("bigint").alias("row_no"), "ts")


# --- applying row changes ------------------------------------------------------------


def _account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.route_rows(decode_rows(account_messages(spark, sf_dir)))
    return changes_from(routed, ACCOUNT, F.col("m_offset"))


@query(S.REPLACED)
def apply_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to the current state of every account: the last change wins."""
    modes = Modes(imode="replace", umode="replace", match="key")
    return apply_changes(None, _account_changes(spark, sf_dir), ["user_id"], modes)


_ACCOUNT_BASE = """base as (select c_custkey as user_id, 'base' as event_type, c_acctbal as value,
  c_name as created from customer)"""


def _account_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit("base").alias("event_type"),
        F.col("c_acctbal").alias("value"),
        F.col("c_name").alias("created"),
    )


_REPLACED_ON_BASE = f"""with {S.LOG}, {_ACCOUNT_BASE}, c as (select * from log where type <> 'replace'),
last as (select *, row_number() over (partition by user_id order by seq desc) as rn from c)
select user_id, event_type, value, created from last where rn = 1 and type <> 'delete'
union all
select * from base where user_id not in (select user_id from last)"""


@query(_REPLACED_ON_BASE)
def apply_replace_on_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = Modes(imode="replace", umode="replace", match="key")
    base = _account_base(spark, sf_dir)
    return apply_changes(base, _account_changes(spark, sf_dir), ["user_id"], modes)


@query(_REPLACED_ON_BASE)
def snapshot_by_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts read in 16 chunks while the log moves on, 13 of them in a second run, and
    the log from the first chunk's low mark: the same state as replaying the whole log."""
    modes = Modes(imode="replace", umode="replace", match="key")
    base = _account_base(spark, sf_dir)
    changes = stage(_account_changes(spark, sf_dir), "changes")
    end = changes.agg(F.max("seq")).first()[0] or 0
    step = max(end // 20, 1)
    moment = step

    def position() -> int:
        return moment

    def read() -> DataFrame:
        # the table moves on while it is read, and again before the next chunk
        nonlocal moment
        shown, moment = moment + step // 2, moment + step
        return apply_changes(base, changes.where(F.col("seq") <= shown), ["user_id"], modes)

    path = scratch_dir(spark, "chunks")
    for most in (3, None):
        ChunkedSnapshot(spark, path, "user_id", read, position, 16).run(most)
    whole = ChunkedSnapshot(spark, path, "user_id", read, position, 16)
    return apply_changes(None, whole.follow(changes), ["user_id"], modes)


@query(
    f"""with {S.LOG}, {_ACCOUNT_BASE}, c as (select * from log where type <> 'replace'),
d as (select user_id, max(seq) as dead from c where type = 'delete' group by 1),
i as (select c.user_id, min(seq) as born from c left join d on d.user_id = c.user_id
      where type = 'insert' and (dead is null or seq > dead) group by 1),
alive as (
  select b.user_id, -1 as born from base b where b.user_id not in (select user_id from d)
  union all
  select user_id, born from i where user_id in (select user_id from d)
     or user_id not in (select user_id from base)),
rows as (
  select c.user_id, c.event_type, c.value, c.created, c.seq from c join alive a on a.user_id = c.user_id
  where c.seq = a.born or (c.type = 'update' and c.seq > a.born)
  union all
  select b.*, -1 from base b join alive a on a.user_id = b.user_id and a.born = -1),
r as (select *, row_number() over (partition by user_id order by seq desc) as rn from rows)
select user_id, event_type, value, created from r where rn = 1"""
)
def apply_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = Modes(imode="ignore", match="key")
    base = _account_base(spark, sf_dir)
    return apply_changes(base, _account_changes(spark, sf_dir), ["user_id"], modes)


@query(
    f"""with {S.LOG}, c as (select * from log where type in ('insert', 'update')),
last as (select *, row_number() over (partition by user_id order by seq desc) as rn from c)
select user_id, event_type, value, created from last where rn = 1"""
)
def apply_ignore_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = Modes(imode="replace", umode="replace", dmode="ignore", match="key")
    return apply_changes(None, _account_changes(spark, sf_dir), ["user_id"], modes)


@query(
    """with i as (select l_orderkey as k, l_linenumber as n,
  l_partkey * 1000003 + l_suppkey * 101 + cast(l_quantity as bigint) as h, l_returnflag as f from lineitem),
s as (select k, n, row_number() over (partition by k, n order by h, f) as rn,
  lag(f) over (partition by k, n order by h, f) as before, f from i where f <> 'A')
select k, n, count(*) as n_bad from s where f <> 'R' and before is not null and before <> 'R' group by 1, 2"""
)
def native_dup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts on a live key, with line items as changes (R deletes, A updates)."""
    items = table(spark, sf_dir, "lineitem")
    rank = F.struct(
        (
            F.col("l_partkey") * 1000003
            + F.col("l_suppkey") * 101
            + F.col("l_quantity").cast("bigint")
        ).alias("h"),
        F.col("l_returnflag").alias("f"),
    )
    flag = F.col("l_returnflag")
    changes = items.select(
        (rank["h"] * 4 + F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2)).alias("seq"),
        F.when(flag == "R", "delete").when(flag == "A", "update").otherwise("insert").alias("op"),
        F.struct(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("n")).alias(
            "row"
        ),
    )
    bad = duplicate_inserts(None, changes, ["k", "n"])
    return bad.groupBy("k", "n").agg(F.count(F.lit(1)).alias("n_bad"))


_ORDER_CHANGES = """ch as (select o_custkey as k, o_orderkey as seq,
  case when o_orderkey % 10 < 3 then 'insert' when o_orderkey % 10 < 8 then 'update' else 'delete' end as op,
  nullif(cast(floor(o_totalprice) as bigint) % 4, 0) as state,
  nullif(cast(floor(o_totalprice) as bigint) % 3, 0) as old from orders),
base as (select c_custkey as k, nullif(c_nationkey % 3, 0) as state from customer),
ranked as (select *, row_number() over (partition by k order by seq) as rn from ch),
keys as (select k from base union select k from ch)"""


def _order_fold(insert: str, update: str, delete: str) -> str:
    """Row-by-row replay per key; `live` is 0 or 1."""
    return f"""with recursive {_ORDER_CHANGES},
s(k, rn, live, state) as (
  select keys.k, 0, case when base.k is null then 0 else 1 end, base.state
  from keys left join base on base.k = keys.k
  union all
  select s.k, s.rn + 1,
    case r.op when 'insert' then {insert[0]} when 'update' then {update[0]} else {delete[0]} end,
    case r.op when 'insert' then {insert[1]} when 'update' then {update[1]} else {delete[1]} end
  from s join ranked r on r.k = s.k and r.rn = s.rn + 1)
select k, state from (select *, row_number() over (partition by k order by rn desc) as z from s)
where z = 1 and live = 1"""


_IGNORE_INSERT = ("1", "case when s.live = 1 then s.state else r.state end")
_MATCH = "s.live = 1 and s.state is not distinct from "
_NATIVE_UPDATE = ("s.live", f"case when {_MATCH} r.old then r.state else s.state end")
_NATIVE_DELETE = (f"case when {_MATCH} r.state then 0 else s.live end", "s.state")


@query(_order_fold(_IGNORE_INSERT, _NATIVE_UPDATE, _NATIVE_DELETE))
def apply_before_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native updates and deletes that act only where the whole row matches."""
    return apply_fold(
        order_base(spark, sf_dir), order_changes(spark, sf_dir), ["k"], Modes(imode="ignore")
    )


@query(_order_fold(("1", "r.state"), _NATIVE_UPDATE, _NATIVE_DELETE))
def apply_replace_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing inserts with native updates and deletes."""
    return apply_fold(
        order_base(spark, sf_dir), order_changes(spark, sf_dir), ["k"], Modes(imode="replace")
    )


@query(
    """with base as (select l_orderkey, l_linenumber, l_linestatus, l_returnflag, l_quantity from lineitem)
select l_orderkey, l_linenumber, l_linestatus from base where l_returnflag = 'N'
union all select l_orderkey, l_linenumber, 'X' from base where l_returnflag = 'A'
union all select l_orderkey, l_linenumber, l_linestatus from base where l_quantity > 45"""
)
def apply_bag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a key: R rows are deleted, A rows updated, large ones inserted again."""
    items = table(spark, sf_dir, "lineitem")
    base = items.select("l_orderkey", "l_linenumber", "l_linestatus")
    return apply_bag(base, _item_changes(items))


def _item_changes(items: DataFrame) -> DataFrame:
    row = F.struct("l_orderkey", "l_linenumber", "l_linestatus")
    new = F.struct("l_orderkey", "l_linenumber", F.lit("X").alias("l_linestatus"))
    flag = F.col("l_returnflag")
    none = F.when(F.lit(False), row)
    return (
        items.where(flag != "N")
        .select(
            F.when(flag == "R", "delete").otherwise("update").alias("op"),
            F.when(flag == "R", row).otherwise(new).alias("row"),
            F.when(flag == "A", row).alias("old"),
        )
        .unionByName(
            items.where(F.col("l_quantity") > 45).select(
                F.lit("insert").alias("op"), row.alias("row"), none.alias("old")
            )
        )
    )


@query(
    """with w as (
  select l_orderkey, l_linenumber, l_linestatus, 1 as w from lineitem where l_quantity > 45
  union all select l_orderkey, l_linenumber, 'X', 1 from lineitem where l_returnflag = 'A'
  union all select l_orderkey, l_linenumber, l_linestatus, -1 from lineitem where l_returnflag <> 'N')
select l_orderkey, l_linenumber, l_linestatus, cast(sum(w) as bigint) as weight from w
group by 1, 2, 3 having sum(w) < 0"""
)
def bag_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the log removes more often than it adds them, without a base table."""
    return bag_violations(None, _item_changes(table(spark, sf_dir, "lineitem")))


# --- applying document changes -------------------------------------------------------


def _fields(docs: DataFrame) -> DataFrame:
    flat = docs.select("_id", F.explode_outer("doc").alias("field", "value"))
    return flat.where(F.col("field").isNotNull()).select("_id", "field", F.col("value").cast("double").alias("value"))


def _profile_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.route_documents(decode_documents(document_messages(spark, sf_dir)))
    return document_changes(routed, F.col("m_offset"))


@query(S.DOC_FIELDS)
def apply_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document messages to the collection, shown field by field."""
    return _fields(apply_documents(None, _profile_changes(spark, sf_dir)))


@query(
    S.DOC_FIELDS.replace("select id as _id, field, v as value from r where rn = 1", "")
    + """, base as (select cast(c_custkey as varchar) as id, c_acctbal as bal from customer),
kept as (select id as _id, field, v as value from r where rn = 1)
select * from kept
union all select id, 'balance', bal from base where id not in (select id from dead)
union all select id, 'click', -1 from base where id not in (select id from dead)
  and id not in (select _id from kept where field = 'click')"""
)
def apply_docs_on_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of existing documents survive unless the log sets or deletes them."""
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("_id"),
        F.create_map(
            F.lit("balance"), F.col("c_acctbal").cast("string"), F.lit("click"), F.lit("-1")
        ).alias("doc"),
    )
    return _fields(apply_documents(base, _profile_changes(spark, sf_dir)))


@query(
    """with r as (select cast(conv_id as varchar) as _id, role as field, text as value,
  row_number() over (partition by conv_id, role order by turn desc) as rn from conversations)
select _id, field, value from r where rn = 1"""
)
def apply_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn sets its role's field of the conversation document."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("turn").alias("seq"),
        F.lit("update").alias("op"),
        F.col("conv_id").cast("string").alias("_id"),
        F.create_map("role", "text").alias("doc"),
    )
    return apply_documents(None, turns).select("_id", F.explode("doc").alias("field", "value"))


@query(
    f"""with {S.DOCS}, b as (select *, lag(op) over (partition by id order by seq) as before from docs)
select id as _id, seq from b where (op = 'insert' or type = 'insert') and before is not null
  and before <> 'delete'"""
)
def live_document_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inserts_on_live_documents(None, _profile_changes(spark, sf_dir))


@query(
    f"""with {S.LOG}, c as (select * from log where type <> 'replace'),
dead as (select user_id, max(seq) as d from c where type = 'delete' group by 1),
r as (select c.*, row_number() over (partition by c.user_id order by seq desc) as rn
  from c left join dead on dead.user_id = c.user_id
  where type <> 'delete' and (d is null or seq > d))
select cast(user_id as varchar) as _id, event_type, value, created from r where rn = 1"""
)
def cross_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational messages replayed onto a document collection."""
    routed = routing.route_rows(decode_rows(account_messages(spark, sf_dir)))
    changes = row_changes_as_documents(routed, ["user_id"], F.col("m_offset"))
    doc = F.col("doc")
    return apply_documents(None, changes).select(
        "_id", doc["event_type"].alias("event_type"), doc["value"].cast("double").alias("value"),
        doc["created"].alias("created"),
    )


# --- progress ------------------------------------------------------------------------


@query(
    f"""with {S.LOG} select topic || '.' || (user_id % 4) as token, max(seq) + 1 as next_offset
from log group by 1"""
)
def consumer_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.progress_tokens(progress.consumer_progress(account_messages(spark, sf_dir)))


@query(
    f"""with {S.LOG}, half as (select topic || '.' || (user_id % 4) as token, max(seq) + 1 as nxt from log
  where seq < (select max(seq) / 2 from log) and event_type <> 'view' group by 1)
select log.topic, user_id % 4 as "partition", seq as "offset" from log left join half
  on half.token = log.topic || '.' || (user_id % 4) where seq >= coalesce(nxt, 0)"""
)
def resume_from_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages after the stored tokens; topics without a token start at 0."""
    messages = account_messages(spark, sf_dir)
    middle = messages.agg(F.max("offset") / 2).scalar()
    seen = messages.where((F.col("offset") < middle) & (F.col("topic") != "events-view"))
    tokens = progress.progress_tokens(progress.consumer_progress(seen))
    left = progress.resume_after(messages, tokens)
    return left.select("topic", F.col("partition").cast("bigint").alias("partition"), "offset")


@query(
    f"""with {_EVENT_ROWS}, z as (select *, row_number() over
  (partition by db, tbl order by log_pos desc, n desc) as rn from r)
select db as database, tbl as "table", ts as time, cast(0 as bigint) as inc from z where rn = 1"""
)
def table_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_rows_events(order_events(spark, sf_dir))
    last = progress.table_position(rows, ["database", "table"], F.struct("log_pos", "row_no"))
    return last.select("database", "table", "time", F.col("inc").cast("bigint").alias("inc"))


@query(
    f"""with {S.DOCS}, z as (select *, 'c' || (seq % 3) as coll from docs),
l as (select coll, t as time, i as inc, row_number() over (partition by coll order by seq desc) as rn from z)
select coll, time, inc from l where rn = 1"""
)
def document_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = progress.document_position(_collections(spark, sf_dir), ["coll"], F.col("seq"))
    return last.select("coll", "time", F.col("inc").cast("bigint").alias("inc"))


def _collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_documents(document_messages(spark, sf_dir), ["clusterTime"]).select(
        F.col("m_offset").alias("seq"),
        F.concat(F.lit("c"), (F.col("m_offset") % 3).cast("string")).alias("coll"),
        "clusterTime",
    )


@query(
    f"""with {S.DOCS}, z as (select *, 'c' || (seq % 3) as coll from docs),
l as (select coll, t, i, row_number() over (partition by coll order by seq desc) as rn from z)
select t as time, i as inc from l where rn = 1 order by t, i limit 1"""
)
def start_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a reader without a token starts: the least position over all collections."""
    last = progress.document_position(_collections(spark, sf_dir), ["coll"], F.col("seq"))
    return progress.start_time(last).select("time", F.col("inc").cast("bigint").alias("inc"))


@query(
    """select 'log.' || lpad(cast(max(event_id // 1000) as varchar), 6, '0') as log_file,
  max(event_id) % 1000 * 4 as log_pos from events"""
)
def log_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.floor(F.col("event_id") / 1000).cast("string")
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("log."), F.lpad(number, 6, "0")).alias("log_file"),
        (F.col("event_id") % 1000 * 4).alias("log_pos"),
    )
    return progress.log_position(log)


@query(
    """select 'shop' as database, 'customer' as "table", count(*) as n_rows from customer
union all select 'shop', 'orders', count(*) from orders
union all select 'shop', 'lineitem', count(*) from lineitem"""
)
def snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        snapshot_envelopes(table(spark, sf_dir, name), "shop", name, 1)
        for name in ("customer", "orders", "lineitem")
    ]
    counts = [progress.snapshot_counts(p) for p in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# --- batching ------------------------------------------------------------------------


@query(
    """with b as (select event_id, coalesce(sum(case when event_type = 'purchase' then 1 else 0 end) over
  (order by event_id rows between unbounded preceding and 1 preceding), 0) as batch from events),
p as (select *, row_number() over (partition by batch order by event_id) - 1 as pos from b)
select event_id as seq, cast(batch as bigint) as batch, pos // 4 as part from p"""
)
def commit_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases commit; a batch is flushed in parts of four rows."""
    log = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type")
    cut = batching.commit_batches(log, F.col("event_type") == "purchase", buffer_rows=4)
    return cut.select("seq", "batch", "part")


_RUNS = """g as (select *, sum(opens) over (order by seq) - 1 as run from o),
p as (select *, (row_number() over (partition by run order by seq) - 1) // 3 as part from g)
select cast(run as bigint) as run, part, stmt as statement, min(seq) as first_seq, max(seq) as last_seq,
  count(*) as n_rows from p group by run, part, stmt"""


@query(
    f"""with {S.LOG}, l as (select seq, type || ' t' || (user_id % 2) as stmt from log),
o as (select *, case when stmt = lag(stmt) over (order by seq) then 0 else 1 end as opens from l), {_RUNS}"""
)
def statement_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = account_log(spark, sf_dir)
    user = F.col("data")["user_id"].cast("bigint") % 2
    statement = F.concat("type", F.lit(" t"), user.cast("string"))
    return batching.statement_runs(log, statement, max_rows=3)


@query(
    f"""with {S.LOG}, l as (select seq, case type when 'replace' then 'update' else type end as stmt from log),
o as (select *, case when stmt = 'insert' and stmt = lag(stmt) over (order by seq) then 0 else 1 end as opens
  from l), {_RUNS}"""
)
def document_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only neighbouring inserts of documents are written together."""
    log = account_log(spark, sf_dir)
    statement = routing.document_action(F.col("type"))
    return batching.statement_runs(log, statement, max_rows=3, merges=statement == "insert")


@query(
    """with r as (select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
select user_id, event_id, event_type, value from r where rn = 1"""
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return batching.latest_per_key(events, ["user_id"], "event_id")


@query(
    """select distinct 'shop.c' || c_custkey as "table",
  case when c_custkey in (select o_custkey from orders where o_orderstatus = 'P') then 'old' else 'new' end as "set"
from customer"""
)
def table_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted tables split into new ones and ones with a stored position."""
    name = lambda c: F.concat(F.lit("shop.c"), F.col(c).cast("string")).alias("table")
    wanted = table(spark, sf_dir, "customer").select(name("c_custkey"))
    known = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(name("o_custkey"))
    return routing.table_sets(wanted, known)

