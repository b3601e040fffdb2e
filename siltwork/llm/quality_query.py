"""Query 7: quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import quality
from siltwork.llm.registry import query, table

SQL = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), w as (
  select r, doc_id, text,
         regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from d
), windows as (
  select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as window_text
  from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)
), twice as (
  select r, i from (select r, i, count(*) over (partition by r, window_text) as n from windows)
  where n >= 2
), covered as (
  select r, count(distinct place) as n_repeat_words
  from (select r, unnest([i, i + 1, i + 2]) as place from twice) group by r
), m as (
  select doc_id, len(ws) as n_words, len(array_to_string(ws, '')) as word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(regexp_replace(text, '[^!?]', '', 'g')) as n_shouts,
         len(regexp_replace(text, '[^\p{Lu}]', '', 'g')) as n_upper,
         len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from w left join covered using (r)
), f as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 20 * n_words or 100 * n_shouts > 50 * n_words
            or 100 * n_upper > 60 * word_chars or 100 * n_dup_lines > 50 * n_lines
            or word_chars < 2 * n_words or word_chars > 25 * n_words) as kept
from f
"""


@query(SQL)
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))
