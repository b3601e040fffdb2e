"""Query 12: lines that at least five documents hold, over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import lines
from siltwork.llm.registry import query, table

SQL = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), l as (
  select r, doc_id, i, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select r, doc_id, generate_subscripts(s, 1) as i, unnest(s) as line
        from (select r, doc_id, string_split(text, chr(10)) as s from d))
), repeated as (
  select key, max(doc_id) as keeper from (select distinct r, doc_id, key from l)
  where length(key) >= 40 group by key having count(*) >= 5
), marked as (
  select l.*, repeated.key is not null and doc_id is distinct from keeper as gone
  from l left join repeated on l.key = repeated.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), ''))
         as kept_sha256
from marked group by r, doc_id
"""


@query(SQL)
def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", "kept_sha256")
