"""Query 10: licence digests over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import licenses
from siltwork.llm.registry import query, table


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """The canonical form in DuckDB's words."""
    made = f"regexp_replace(lower({text}), {_quoted(licenses.COPYRIGHT_LINE)}, '', 'g')"
    made = f"regexp_replace({made}, {_quoted(licenses.NOT_A_WORD)}, ' ', 'g')"
    for old, new in licenses.SPELLINGS:
        pattern = rf"\b{old}\b"
        made = f"regexp_replace({made}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    return made


_LISTED = ",\n".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licenses.LICENSES)
_DIGESTS = ",\n".join(f"({_quoted(name)}, {_quoted(digest)})" for name, digest in licenses.DIGESTS)
SQL = f"""
with listed(license, text) as (values {_LISTED}),
known as (
  select distinct license,
         sha256(trim(regexp_replace({_canonical("text")}, '[ \\n]+', ' ', 'g'))) as digest
  from listed
  union
  select * from (values {_DIGESTS})
), d as (
  select row_number() over () as r, doc_id, {_canonical("coalesce(text, '')")} as plain
  from documents
), lines as (
  select r, sha256(trim(unnest(string_split(plain, chr(10))))) as digest from d
), notices as (
  select r, string_agg(distinct license, ',' order by license) as notices
  from lines join known using (digest) group by r
), w as (
  select r, doc_id, sha256(trim(regexp_replace(plain, '[ \\n]+', ' ', 'g'))) as digest from d
)
select doc_id, digest as canonical_sha256, license, coalesce(notices, '') as notices
from w left join known using (digest) left join notices using (r)
"""


@query(SQL)
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))
