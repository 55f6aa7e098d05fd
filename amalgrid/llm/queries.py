"""Queries of the llm operators over the driver's tables, and the SQL that checks what SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.llm import components, copies, encoding, garbled, leakage, lookalikes, sentences, variants
from amalgrid.session import table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    groups = p2_groups(spark, sf)
    return groups.filter("group_size > 1").select("internal_id", F.col("group_id").alias("first_id"))


def p2_groups(spark: SparkSession, sf: str) -> DataFrame:
    records, predictions = table(spark, sf, "all_records_clean_names"), table(spark, sf, "pairwise_predictions")
    return components.group_records(records, components.match_links(records, predictions))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    ledger, members = copies.collapse(table(spark, sf, "processed_records"), batch_col="batch_id", batches=4)
    return ledger.copies(members)


def p3_names(spark: SparkSession, sf: str) -> DataFrame:
    ledger, _ = copies.collapse(table(spark, sf, "processed_records"), batch_col="batch_id", batches=4)
    return ledger.names()


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return garbled.garbled_records(table(spark, sf, "processed_records")).select("record_id").distinct()


def p4_restored(spark: SparkSession, sf: str) -> DataFrame:
    return garbled.garbled_records(table(spark, sf, "processed_records"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.same_look_pairs(table(spark, sf, "processed_records"))


def p5_forms(spark: SparkSession, sf: str) -> DataFrame:
    rows = lookalikes.distinct_records(table(spark, sf, "processed_records"), "record_id", "record_name")
    return lookalikes.add_skeleton(rows, "name", "form").select(F.col("id").alias("record_id"), "form")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return variants.variant_pairs(table(spark, sf, "all_records_clean_names"))


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, sf, "documents"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.split_corpus(table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_groups, p3_found, p3_names, p4_found, p4_restored, p5_found, p5_forms, p6_found, p7_ids, p8_found, p9_found)}


_LINKS = """
WITH RECURSIVE ids AS (SELECT DISTINCT internal_id AS id FROM all_records_clean_names WHERE internal_id IS NOT NULL),
raw AS (
  SELECT internal_id AS a, unnest(matches) AS b FROM all_records_clean_names
  UNION SELECT idx1, idx2 FROM pairwise_predictions WHERE prediction = 1),
good AS (SELECT DISTINCT a, b FROM raw WHERE a <> b AND a IN (SELECT id FROM ids) AND b IN (SELECT id FROM ids)),
links AS (SELECT a, b FROM good UNION SELECT b, a FROM good),
reach(id, root) AS (SELECT id, id FROM ids UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id),
labels AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
sized AS (SELECT id, root, count(*) OVER (PARTITION BY root) AS size FROM labels)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _LINKS + "SELECT id AS internal_id, root AS first_id FROM sized WHERE size > 1",
        "p2_groups": _LINKS + "SELECT id AS internal_id, root AS group_id, size AS group_size FROM sized",
    }
