"""Files in and out: CSV with all-string columns, lines, terms, sheets, sinks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amalgrid.operators.tables import union_sheets

# What the data frame library of the original pipeline reads as missing.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def field_count(line: Column, delim: str = ",") -> Column:
    """The number of fields of one CSV record as it stands, quoted ones as one each."""
    bare = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delim), F.lit(""))) + 1


def read_csv(spark: SparkSession, path: str, skip_bad: bool = True, missing_as_null: bool = False, multi_line: bool = True) -> DataFrame:
    """All columns as text. Rows with too many fields are dropped (or raise), whatever these hold; short ones end in nulls.

    ``missing_as_null`` reads NA, null and the like as null; by default a company may be called NA. Without
    ``multi_line`` no field holds a line break, and large files are split among tasks.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, "_whole"]])
    # Every row that has not just as many fields is kept whole beside what could be read of it.
    rows = spark.read.schema(schema).options(**options, enforceSchema=True, columnPruning=False, columnNameOfCorruptRecord="_whole").csv(path)
    bad = F.coalesce(field_count(F.rtrim(F.col("_whole"), F.lit("\r\n"))) > len(header), F.lit(False))
    if not skip_bad:
        bad = F.when(bad, F.raise_error(F.lit("a row has too many fields"))).otherwise(F.lit(False))
    rows = rows.filter(~bad).select(*header)
    if missing_as_null:
        rows = rows.select(*[F.when(~F.col(f"`{c}`").isin(MISSING), F.col(f"`{c}`")).alias(c) for c in header])
    return rows


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(name): one trimmed lower-case name a line."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("name"))


def load_terms(spark: SparkSession, path: str) -> set[str]:
    """A short list of terms, lower case; a missing file gives none."""
    if "://" not in path and not Path(path).exists():
        return set()
    return {r[0] for r in read_lines(spark, path).filter("name <> ''").distinct().collect()}


def read_sheets(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(idx, company) of several tables, CSV or Parquet, as one sorted list of distinct names."""
    return union_sheets([spark.read.parquet(p) if p.rstrip("/").endswith(".parquet") else read_csv(spark, p) for p in paths])


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_pairs(df: DataFrame, original: str, clean: str, path: str) -> None:
    """``original;clean`` lines without quoting."""
    df.select(F.concat_ws(";", F.coalesce(original, F.lit("")), F.coalesce(clean, F.lit("")))).write.mode("overwrite").text(path)


def write_edges(df: DataFrame, path: str, a: str = "idx1", b: str = "idx2") -> None:
    """An adjacency list as Parquet: each node with its sorted distinct neighbours, both directions of every edge.

    Neighbours are split into rows of at most 100,000, so that no row grows with a hot node.
    """
    both = df.select(F.col(a).alias("node"), F.col(b).alias("other")).union(df.select(F.col(b).alias("node"), F.col(a).alias("other"))).filter("node is not null and other is not null and node <> other").distinct()
    sizes = both.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / 100_000).alias("parts"))
    placed = both.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("other"), "parts").cast("int"))
    placed.groupBy("node", "part").agg(F.sort_array(F.collect_list("other")).alias("neighbours")).write.mode("overwrite").parquet(path)


def write_names(df: DataFrame, name: str, path: str) -> None:
    """Distinct names, one a line."""
    df.select(name).filter(F.col(name).isNotNull()).distinct().write.mode("overwrite").text(path)


# Example pairs for training, simple and hard: name, name, label.
SIMPLE_PAIRS = (
    ("Microsoft Corporation", "Microsoft Corp", 1),
    ("Apple Inc", "Apple Incorporated", 1),
    ("Google LLC", "Google", 1),
    ("Amazon.com Inc", "Amazon", 1),
    ("Tesla Inc", "Tesla Motors", 1),
    ("Meta Platforms", "Facebook Inc", 1),
    ("Netflix Inc", "Netflix", 1),
    ("Adobe Inc", "Adobe Systems", 1),
    ("Microsoft", "Apple Inc", 0),
    ("Apple", "Google LLC", 0),
    ("Random Corp", "Microsoft Corp", 0),
    ("Different Company", "Amazon.com", 0),
)
HARD_PAIRS = (
    ("Delta Airlines", "Delta Air Lines", 1),
    ("Bank of America", "Bank of America Corp", 1),
    ("Ford Motor Company", "Ford Motor Co", 1),
    ("Delta Corp", "Delta Airlines", 0),
    ("American Bank", "Bank of America", 0),
    ("Ford Motors India", "Ford Motor Company", 0),
)


def example_pairs(spark: SparkSession, hard: bool = False) -> DataFrame:
    return spark.createDataFrame(HARD_PAIRS if hard else SIMPLE_PAIRS, "company1 string, company2 string, label int")
