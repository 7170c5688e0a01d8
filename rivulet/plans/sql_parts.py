"""SQL forms of the derived inputs, for the twin queries."""

EPOCH = "cast(floor(epoch_us(ts) / 1000000) as bigint)"
LATE = "(epoch_us(ts) // 1000000 - event_id * 7919 % 100000)"
TYPE = (
    "case event_type when 'signup' then 'insert' when 'error' then 'delete' "
    "when 'view' then 'replace' else 'update' end"
)
CREATED = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
BROKEN = "(event_type = 'view' and event_id % 10 = 0)"

# The relational log; broken messages have no type.
LOG = f"""log as (
  select event_id as seq, {TYPE} as type, 'db' || (user_id % 3) as db,
         't' || (event_id % 4) as tbl, 'events-' || event_type as topic,
         {LATE} as ts_s, user_id, event_type, value, {CREATED} as created,
         event_id % 3 = 0 as is_commit
  from events)"""

# Last change per user of the replace mode, where 'replace' is an unknown type.
REPLACED = f"""with {LOG}, c as (select * from log where type <> 'replace'),
last as (select *, row_number() over (partition by user_id order by seq desc) as rn from c)
select user_id, event_type, value, created from last where rn = 1 and type <> 'delete'"""

# Document log: the snapshot inserts, key, field values and times of document_messages.
DOCS = f"""docs as (
  select event_id as seq,
         case when event_id % 50 = 0 then 'insert' when event_type = 'error' then 'delete'
              else 'set' end as op,
         case when event_id % 50 = 0 then 'bootstrap-insert' else {TYPE} end as type,
         cast(user_id as varchar) as id, {LATE} as t, event_id % 9 as i, event_type,
         case when not (event_id % 11 = 0 and event_type = 'purchase') then value end as value,
         cast(json_extract(props, '$.k') as bigint) as pk, 'p' || (event_id % 3) as pname
  from events)"""

# Fields of the documents after the log, one row per field.
DOC_FIELDS = f"""with {DOCS},
dead as (select id, max(seq) as d from docs where op = 'delete' group by id),
f as (
  select id, seq, event_type as field, value as v from docs where op <> 'delete'
  union all
  select id, seq, pname, cast(pk as double) from docs where op <> 'delete'
  union all
  select id, seq, '_id', cast(id as double) from docs where op <> 'delete'),
r as (
  select f.*, row_number() over (partition by f.id, f.field order by seq desc) as rn
  from f left join dead on dead.id = f.id where dead.d is null or f.seq > dead.d)
select id as _id, field, v as value from r where rn = 1"""
