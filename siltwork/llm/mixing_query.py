"""Query 5: the mix over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm import mixing
from siltwork.llm.registry import query, table

SQL = r"""
with d as (
  select doc_id, source, coalesce(text, '') as t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('17:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) as ticket
  from documents
), drawn as (
  select doc_id, source, size, ticket,
         -ln((('0x' || substr(ticket, 1, 12))::bigint + 1) / 281474976710657.0::double)
           / (0.05::double + 0.95::double * len(regexp_replace(t, '[^\p{L}]', '', 'g'))
              / greatest(len(t), 1)) as key
  from d
), sources as (
  select source, size as source_size, 3 * size as most,
         [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from (select source, sum(size)::bigint as size from d group by source)
), levels as (
  select *, (sum(source_size) over () - coalesce(sum(most) over (order by most / weight, source
             nulls last rows between unbounded preceding and 1 preceding), 0))::double
           / sum(weight) over (order by most / weight, source nulls last
             rows between current row and unbounded following) as level
  from sources
), targets as (
  select source, source_size, least(most::double,
           (max(case when level <= most / weight then level end) over ()) * weight) as target
  from levels
), rests as (
  select source, source_size, target,
         case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs
  from targets
), placed as (
  select doc_id, size, source_size, target, epochs,
         target - epochs * source_size as rest,
         sum(size) over (partition by drawn.source order by key, ticket) as finish,
         sum(size) over (partition by drawn.source, key, ticket) as own
  from drawn join rests on drawn.source is not distinct from rests.source
)
select doc_id, size, source_size, target,
       (size * (epochs + case when rest > 0 and 2 * finish - own <= 2 * rest
                              then 1 else 0 end))::bigint as taken
from placed
"""


@query(SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)
