"""Queries of the record parser."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.session import table
from amalgrid.sources import delimited


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return delimited.parse_lines(delimited.with_delimiters(table(spark, sf, "raw_records"), table(spark, sf, "source_lists")))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return delimited.failing(_parsed(spark, sf)).select("line_id", "reason")


def p1_records(spark: SparkSession, sf: str) -> DataFrame:
    return delimited.valid(_parsed(spark, sf)).drop("start_at")


def p1_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The lists as texts of many records: how many are valid, and how many fail for which reason."""
    texts = delimited.list_texts(table(spark, sf, "raw_records"), table(spark, sf, "source_lists"))
    keyed = texts.select(F.struct("source_list", "block").alias("place"), "text", "delim")
    parsed = delimited.parse_lines(keyed.select(F.to_json("place").alias("place"), "text", "delim"), "place", "text", "delim", single=False)
    place = F.get_json_object("place", "$.source_list").alias("source_list")
    return parsed.select(place, F.coalesce("reason", F.lit("valid")).alias("outcome")).groupBy("source_list", "outcome").agg(F.count(F.lit(1)).alias("records"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_records": p1_records, "p1_lists": p1_lists}


# The same rules in SQL: a record's shape by one pattern per delimiter, its fields by the same pattern.
_FIELDS = r"""
WITH lines AS (
  SELECT r.line_id, coalesce(r.raw_line, '') AS raw, coalesce(d.delim, ',') AS delim
  FROM raw_records r LEFT JOIN (SELECT source_list, min(delim) AS delim FROM source_lists GROUP BY 1) d USING (source_list)),
shaped AS (
  SELECT *, '(?:"(?:[^"]|"")*"|[^"' || (CASE delim WHEN '|' THEN '|' WHEN chr(9) THEN '\t' ELSE delim END) || ']*)' AS f,
    CASE delim WHEN '|' THEN '\|' WHEN chr(9) THEN '\t' ELSE delim END AS d FROM lines),
cut AS (SELECT line_id, regexp_full_match(raw, f || '(?:' || d || f || ')*') AS whole,
  regexp_extract_all(delim || raw, d || '(' || f || ')', 1) AS q FROM shaped),
fields AS (SELECT line_id, whole, list_transform(q, lambda x: CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END) AS v FROM cut),
checked AS (
  SELECT line_id, v, CASE
    WHEN NOT whole THEN 'quoting'
    WHEN len(v) <> 7 THEN 'column_count'
    WHEN NOT coalesce(regexp_full_match(v[1], '[0-9]+') AND try_cast(v[1] AS HUGEINT) BETWEEN 1 AND 2147483647, false)
      OR NOT regexp_matches(v[2], '[\p{L}\p{Nd}]')
      OR regexp_matches(v[2], '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]')
      OR v[3] NOT IN ('', 'company', 'trust', 'government', 'security')
      OR NOT (v[5] = '' OR coalesce(regexp_full_match(v[5], '[0-9]+(\.[0-9]+)?|\.[0-9]+') AND try_cast(v[5] AS DOUBLE) BETWEEN 0 AND 1, false))
      OR NOT coalesce(regexp_full_match(v[6], '[0-9]+') AND try_cast(v[6] AS HUGEINT) BETWEEN 1 AND 2147483647, false)
      OR NOT (regexp_full_match(v[7], '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}') AND try_strptime(v[7], '%Y-%m-%d %H:%M:%S') IS NOT NULL)
    THEN 'value' END AS reason FROM fields)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _FIELDS + "SELECT line_id, reason FROM checked WHERE reason IS NOT NULL",
        "p1_records": _FIELDS
        + """SELECT line_id, CAST(v[1] AS BIGINT) AS record_id, v[2] AS record_name, v[3] AS type_hint, v[4] AS gliner_type,
          CASE WHEN v[5] = '' THEN NULL ELSE CAST(v[5] AS DOUBLE) END AS gliner_confidence, CAST(v[6] AS INTEGER) AS batch_id,
          CAST(strptime(v[7], '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS processed_at FROM checked WHERE reason IS NULL""",
    }
