"""Query 13: all conversations damaged and repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import conversations
from siltwork.llm.registry import query, table

# The automaton's tops by what was read: 0 nothing, 1 a system row, 2 an open user row,
# 3 whole pairs. Ways are (cost, audit) lists; a recursion step reads one row.
_ROW = "{'c': %s, 'a': %s}"


def _way(top: int, cost: str, edit: str) -> str:
    return _ROW % (f"w[{top + 1}].c + {cost}", f"w[{top + 1}].a || '{edit}'")


def _least(ways: list[str]) -> str:
    return f"list_min([{', '.join(ways)}])"


def _read() -> str:
    """The four tops after a row, before inserts."""

    def ways(top: int, befores: tuple[int, ...], symbol: str) -> str:
        found = [_way(top, "2", "D")]
        for before in befores:
            keep = f"case when not must_go and initial = '{symbol}' then {_way(before, 'extra', 'K')} end"
            found.append(keep)
            if symbol != "s":
                found.append(f"case when not must_go then {_way(before, '1 + extra', 'R')} end")
        return _least(found)

    return ", ".join([ways(0, (), "-"), ways(1, (0,), "s"), ways(2, (0, 1, 3), "u"), ways(3, (2,), "a")])


_OPEN = _least([_way(2, "0", ""), _way(0, "5", "I"), _way(1, "5", "I"), _way(3, "5", "I")])
_PAIRS = _least([_way(3, "0", ""), _way(2, "5", "I")])
# Two rounds: an insert may follow an insert, and a third never pays.
_INSERT = f"[{_way(0, '0', '')}, {_way(1, '0', '')}, {_OPEN}, {_PAIRS}]"
_FAR = "1000000000000::bigint"

SQL = rf"""
with recursive named as (
  select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name,
         coalesce(role, ' ') as role0, coalesce(text, ' ') as text0
  from conversations
), checked as (
  select *, xor(4294967295::bigint, list_reduce(
      list_transform(string_split(name, ''), lambda x: ascii(x)::bigint),
      lambda crc, byte: list_reduce(range(8)::bigint[], lambda c, i:
        xor(c >> 1, 3988292384::bigint * (c & 1)), xor(crc, byte)),
      4294967295::bigint)) % 20 as kind
  from named
), after as (
  select conv_id, turn,
         case when kind = 4 then 'user' else role0 end as role,
         case kind when 1 then '' when 2 then regexp_replace(text0, '[.!?]', '', 'g')
                   else text0 end as text
  from checked, range(2) copies(copy)
  where kind <> 0 and (copy = 0 or kind = 3)
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i
  from after
), placed as (
  select *, row_number() over (partition by conv_id, role, text order by i) as said,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') as shown,
         lag(role[1]) over (partition by conv_id order by i) as before
  from numbered
), rows_ as (
  select conv_id, i, turn, role, text, role[1] as initial,
         shown = '' as blank, shown <> '' and said > 1 as duplicate,
         shown = '' or said > 1 as must_go,
         shown <> '' and said = 1 and right(shown, 1) not in ('.', '!', '?') as truncated,
         case when shown <> '' and said = 1 and right(shown, 1) not in ('.', '!', '?')
              then 5 else 0 end as extra,
         before is not null and before || role[1] not in ('su', 'ua', 'au') as illegal
  from placed
), ids as (select distinct conv_id from conversations
), facts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
         count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal,
         count(*) as n
  from rows_ group by conv_id
), steps(conv_id, i, w) as (
  select conv_id, 0::bigint, [{_ROW % ("0::bigint", "''")}, {_ROW % (_FAR, "''")},
         {_ROW % ("5::bigint", "'I'")}, {_ROW % ("10::bigint", "'II'")}] from facts
  union all
  select conv_id, i, {_INSERT} from (
    select conv_id, i, {_INSERT} as w from (
      select steps.conv_id, rows_.i, [{_read()}] as w
      from steps join rows_ on steps.conv_id is not distinct from rows_.conv_id
                            and rows_.i = steps.i + 1))
), ends as (
  select facts.*, {_least(["w[1]", "w[4]"])} as best
  from steps join facts on steps.conv_id is not distinct from facts.conv_id and steps.i = n
), edits as (
  select conv_id, best.a as audit, j, substr(best.a, j::bigint, 1) as edit,
         length(replace(substr(best.a, 1, j::bigint), 'I', '')) as i
  from (select conv_id, best, unnest(range(1, length(best.a) + 1)) as j from ends)
), kept as (
  select edits.conv_id, j, edit, text, role, initial,
         row_number() over (partition by edits.conv_id order by j) as k,
         first_value(case when edit = 'K' and initial = 's' then 1 else 0 end)
           over (partition by edits.conv_id order by j) as lead
  from edits left join rows_ on edits.conv_id is not distinct from rows_.conv_id
                             and edits.i = rows_.i and edit <> 'I'
  where edit <> 'D'
), texts as (
  select conv_id, string_agg(
           case when edit = 'K' then role when (k - lead) % 2 = 1 then 'user' else 'assistant' end
             || ':' || coalesce(text, ''), chr(10) order by j) as whole
  from kept group by conv_id
)
select ids.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
       coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(best.c, 0) as cost,
       coalesce(best.a, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from ids left join ends on ids.conv_id is not distinct from ends.conv_id
         left join texts on ids.conv_id is not distinct from texts.conv_id
"""


@query(SQL)
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repaired(rows)
