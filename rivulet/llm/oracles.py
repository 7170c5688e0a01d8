"""SQL for DuckDB that some registered queries must agree with, built from small parts."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string expression, bit by bit."""
    byte = "xor(a >> 1, 3988292384 * (a & 1))"
    steps = f"list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, k: {byte})"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {codes}), lambda crc, b: {steps}), 4294967295)"


def _field(column: str) -> str:
    return f"case when {column} is null then '-' else strlen({column}::varchar) || ':' || {column}::varchar end"


def _row(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _levels(name: str, leaves: str) -> str:
    """Recursive `name`(tree, level, i, digest, run): all nodes of trees of up to 16 ways."""
    return f"""{name} as (
  select tree, 0 as level, i, digest,
    case when count(*) over t > 1 then string_agg(digest, '') over r end as run
  from {leaves}
  window t as (partition by tree), r as (partition by tree, i // 16 order by i rows between unbounded preceding and unbounded following)
  union all
  select tree, level, i, digest,
    case when count(*) over t > 1 then string_agg(digest, '') over r end
  from (
    select tree, level + 1 as level, i // 16 as i, sha256(any_value(run)) as digest
    from {name} where run is not null group by tree, level, i // 16
  )
  window t as (partition by tree), r as (partition by tree, i // 16 order by i rows between unbounded preceding and unbounded following)
)"""


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEFT, _RIGHT = "substr(s.run, 1, 64 * s.slot)", "substr(s.run, 64 * s.slot + 65)"
_FOLD = (
    "(list_reduce(list_prepend({'slot': 0::bigint, 'run': given}, path), "
    f"lambda a, s: {{'slot': s.slot, 'run': sha256({_LEFT} || a.run || {_RIGHT})}})).run"
)

MANIFEST = f"""with recursive rows_ as (
  select *, {_row("text")} as leaf, {_row("lowered")} as changed,
    {crc32("doc_id::varchar")} % 5 = 0 as touched
  from (select *, {_LOWERED} as lowered from documents)
), leaves as (
  select coalesce('s' || source, 'n') as tree, doc_id, leaf as digest,
    case when touched then changed else leaf end as given,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i
  from rows_
), {_levels("lower_", "leaves")},
subroots as (
  select 'all' as tree, tree as source, digest, row_number() over (order by tree) - 1 as i
  from lower_ where run is null
), {_levels("upper_", "subroots")},
root as (select digest as root from upper_ where run is null),
steps as (
  select l.doc_id, n.level, l.i // (16 ** n.level)::bigint % 16 as slot, n.run
  from leaves l join lower_ n on n.tree = l.tree and n.i = l.i // (16 ** n.level)::bigint
  where n.run is not null
  union all
  select l.doc_id, 100 + n.level, s.i // (16 ** n.level)::bigint % 16, n.run
  from leaves l join subroots s on s.source = l.tree
  join upper_ n on n.i = s.i // (16 ** n.level)::bigint
  where n.run is not null
), paths as (
  select doc_id, list({{'slot': slot, 'run': run}} order by level) as path from steps group by doc_id
), done as (
  select l.doc_id, l.digest as leaf, s.digest as subroot, root, coalesce(path, []) as path, given
  from leaves l join subroots s on s.source = l.tree cross join root left join paths p on p.doc_id = l.doc_id
)
select doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(path, lambda s: {_LEFT} || {_RIGHT}), '')) as proof_sha256,
  folded as folded_root, folded = root as verified
from (select *, {_FOLD} as folded from done)"""


def _add(value: str, cost: str, letter: str, line: str) -> str:
    """A value `cost(10) || audit || chr(1) || lines` with one more edit in front."""
    audit = f"split_part(substr({value}, 11), chr(1), 1)"
    return (
        f"(lpad((left({value}, 10)::bigint + {cost})::varchar, 10, '0') || '{letter}' || {audit} || chr(1)"
        f" || {line} || substr({value}, 12 + length({audit})))"
    )


def _inserted(value: str, role: str) -> str:
    return _add(value, "3", "I", f"chr(10) || '{role}:'")


_MOST = "'9999999999' || chr(1)"


def _consumed(state: int) -> str:
    """The best value before a row, in a state, by edits that consume the row."""
    nexts = [2, 2, 3, 2]
    kept = {0: "when 's' then 1 when 'u' then 2", 1: "when 'u' then 2", 2: "when 'a' then 3", 3: "when 'u' then 2"}
    role = "user" if nexts[state] == 2 else "assistant"
    keeps = " ".join(
        f"when initial = '{i}' then {_add(f'v{to}', 'more', 'K', 'chr(10) || role || chr(58) || text')}"
        for i, to in (("s", 1), ("u", 2), ("a", 3))
        if f"'{i}' then {to}" in kept[state]
    )
    return f"""least({_add(f"v{state}", "4", "D", "''")},
      case when gone then {_MOST} else {_add(f"v{nexts[state]}", "3 + more", "R", f"chr(10) || '{role}:' || text")} end,
      case when gone then {_MOST} {keeps} else {_MOST} end) as b{state}"""


def _nulls(column: str) -> str:
    return f"coalesce({column}::varchar, ' ')"


_TRIMMED = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_USER_FIRST = _inserted("c2", "user")

REPAIR = f"""with recursive hit as (
  select *, {crc32(f"({_nulls('conv_id')} || ':' || {_nulls('turn')})")} % 20 as fault from conversations
), damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else {_nulls("role")} end as role,
    case when fault = 1 then '' when fault = 2 then translate({_nulls("text")}, '.!?', '') else {_nulls("text")} end as text,
    unnest(case when fault = 3 then [0, 1] else [0] end) as copy
  from hit where fault <> 0
), placed as (
  select *, {_TRIMMED} as bare, left(role, 1) as initial,
    row_number() over w as i, count(*) over (partition by conv_id) - row_number() over w + 1 as j,
    lag(left(role, 1)) over w as previous
  from damaged window w as (partition by conv_id order by turn nulls first, role, sha256(text), copy)
), judged as (
  select *, bare = '' as blank,
    bare <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    right(bare, 1) not in ('.', '!', '?') as open_
  from placed
), faults as (
  select *, blank or again as gone, case when open_ and not (blank or again) then 3 else 0 end as more from judged
), counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (blank) as blank, count(*) filter (again) as duplicate, count(*) filter (more > 0) as truncated,
    count(*) filter (i > 1 and initial || previous not in ('us', 'au', 'ua')) as illegal, count(*) as n
  from faults group by conv_id
), dp as (
  select conv_id, 0::bigint as j, '0000000000' || chr(1) as v0,
    '0000000006II' || chr(1) || chr(10) || 'user:' || chr(10) || 'assistant:' as v1,
    '0000000003I' || chr(1) || chr(10) || 'assistant:' as v2, '0000000000' || chr(1) as v3
  from counts
  union all
  select conv_id, j, least(b0, {_USER_FIRST}), least(b1, {_USER_FIRST}), c2, c3
  from (
    select *, least(b2, {_inserted("b3", "assistant")}) as c2, least(b3, {_inserted("b2", "user")}) as c3
    from (
      select f.conv_id, f.j, {", ".join(map(_consumed, range(4)))}
      from dp join faults f on f.conv_id is not distinct from dp.conv_id and f.j = dp.j + 1
    )
  )
), best as (
  select c.*, left(v0, 10)::bigint as cost, split_part(substr(v0, 11), chr(1), 1) as audit,
    substr(v0, 12 + length(split_part(substr(v0, 11), chr(1), 1))) as lines
  from counts c join dp on dp.conv_id is not distinct from c.conv_id and dp.j = c.n
)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
  coalesce(audit, '') as audit, sha256(coalesce(substr(lines, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) a left join best b on b.conv_id is not distinct from a.conv_id"""
