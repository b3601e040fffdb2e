"""Query 11: collocations of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import phrases
from siltwork.llm.registry import query, table

SQL = r"""
with d as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), pieces as (
  select lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')),
                                              '[\x20\x09]+'), lambda x: x <> '') as w
  from d
), grams as (
  select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase
  from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
        from pieces, (select unnest([1, 2, 3, 4]) as size))
), counts as (
  select lang, size, phrase, count(*) as a from grams group by all
), total as (
  select lang, sum(a)::bigint as n from counts where size = 1 group by lang
), candidates as (
  select *, string_split(phrase, ' ') as w from counts where size > 1 and a >= 30
), cuts as (
  select lang, phrase, a, k, array_to_string(w[1:k], ' ') as head,
         array_to_string(w[k + 1:], ' ') as rest
  from (select *, unnest(range(1, size)) as k from candidates)
), scored as (
  select cuts.lang, cuts.phrase, cuts.a, k, x.a as l, y.a as r,
         ((2000000 * cuts.a::hugeint) // (x.a + y.a))::bigint as score
  from cuts join counts x on x.lang = cuts.lang and x.phrase = head
            join counts y on y.lang = cuts.lang and y.phrase = rest
), worst as (
  select * from scored
  qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_ as (
  select lang, array_to_string(w[i : i + m - 1], ' ') as phrase, max(a) as longer
  from (select lang, w, size, a, m, unnest(range(1, size - m + 2)) as i
        from candidates, (select unnest([2, 3]) as m) where m < size)
  group by all
), ranked as (
  select worst.*, row_number() over (partition by worst.lang
                                     order by score desc, a desc, worst.phrase) as rank
  from worst left join inner_ on inner_.lang = worst.lang and inner_.phrase = worst.phrase
  where coalesce(100 * longer < 80 * a, true)
)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""


@query(SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrases.collocations(table(spark, sf_dir, "documents"))
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
