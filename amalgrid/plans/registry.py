"""The query modules of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from amalgrid.plans import clusters, names, records, reports

MODULES = [names, reports, clusters, records]


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return names.probable_duplicates(spark, sf)
