"""Names as weighted letter triples, and all pairs above a cosine: exact, by rare prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amalgrid.functions.text import col, title
from amalgrid.session import cut


def char_ngrams(c: Column | str, n: int = 3) -> Column:
    """All runs of ``n`` characters in order; none for a shorter text."""
    s = F.coalesce(col(c), F.lit(""))
    last = F.length(s) - (n - 1)
    return F.when(last < 1, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(s, i, F.lit(n))))


def plain_trigrams(c: Column | str) -> Column:
    """Runs of three characters of the text in lower case, without blanks around it."""
    return char_ngrams(F.lower(col(c)), 3)


def gram_text(c: Column | str) -> Column:
    """The form names are cut from: ASCII, no brackets, dots, bars or apostrophes, title case, a blank on each side."""
    s = F.regexp_replace(F.translate(col(c), "“”", '""'), r"[^\x00-\x7F]", "")
    s = F.regexp_replace(F.lower(s), r"[)(.|\[\]{}']", "")
    s = F.translate(F.replace(s, F.lit("&"), F.lit("and")), ",-", "  ")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(title(s), " +", " ")), F.lit(" "))


def name_grams(c: Column | str, n: int = 3) -> Column:
    return char_ngrams(gram_text(c), n)


def matrix_gib(rows: Column, cols: Column, bytes_each: int) -> Column:
    """Memory of a dense matrix in GiB."""
    if bytes_each not in (1, 2, 4, 8):
        raise ValueError("1, 2, 4 or 8 bytes an element")
    return rows.cast("double") * cols.cast("double") * bytes_each / float(1024**3)


def tfidf(names: DataFrame, id_col: str = "idx", name_col: str = "company") -> DataFrame:
    """(idx, gram, df, weight): term counts times ln((1+N)/(1+df))+1, each name's weights of length 1. Null names have none."""
    # The text is a column of its own: written into the grams' lambda it would be made again for every gram.
    base = names.filter(F.col(name_col).isNotNull()).select(F.col(id_col).alias("idx"), gram_text(name_col).alias("_s")).filter(F.length("_s") > 2)
    tf = base.select("idx", F.explode(char_ngrams("_s")).alias("gram")).groupBy("idx", "gram").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    total = base.agg(F.count(F.lit(1)).alias("n"))
    raw = tf.join(df, "gram").crossJoin(F.broadcast(total)).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    return raw.withColumn("weight", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("idx")))).select("idx", "gram", "df", "weight")


def _above(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(idx1, idx2, g1, w1, g2, w2) -> the pairs above the threshold with their full dot product, batch-wise."""
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            grams, weights, owner = [], [], []
            for g, w in (("g1", "w1"), ("g2", "w2")):
                sizes = pc.list_value_length(batch.column(g)).to_numpy(zero_copy_only=False).astype(np.int64)
                pair = np.repeat(np.arange(n, dtype=np.uint64), sizes)
                # A gram of one pair and the same gram of another are two keys.
                grams.append(batch.column(g).flatten().to_numpy().view(np.uint64) ^ (pair + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                weights.append(batch.column(w).flatten().to_numpy())
                owner.append(pair.astype(np.int64))
            key, weight, pair = np.concatenate(grams), np.concatenate(weights), np.concatenate(owner)
            order = np.argsort(key, kind="stable")
            key, weight, pair = key[order], weight[order], pair[order]
            met = np.nonzero((key[1:] == key[:-1]) & (pair[1:] == pair[:-1]))[0]
            dot = np.bincount(pair[met], weights=weight[met] * weight[met + 1], minlength=n)
            keep = pa.array(dot > threshold)
            yield pa.RecordBatch.from_arrays([batch.column("idx1").filter(keep), batch.column("idx2").filter(keep), pa.array(dot[dot > threshold])], names=["idx1", "idx2", "similarity"])

    return run


def similar_pairs(names: DataFrame, threshold: float = 0.9, id_col: str = "idx", name_col: str = "company") -> DataFrame:
    """(idx1, idx2, similarity) of all pairs above the threshold, idx1 < idx2; equal names pair with 1.

    Distinct names only are compared. Of each name the rarest grams are indexed, until what is left is too
    short a vector to reach the threshold alone: two names above it share an indexed gram. What meets in the
    index is verified with all weights, so the result is exact.
    """
    spelled = names.filter(F.col(name_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(name_col).alias("t"))
    distinct = spelled.groupBy("t").agg(F.min("i").alias("idx"))
    order = Window.partitionBy("idx").orderBy(F.desc("df"), "gram").rowsBetween(Window.unboundedPreceding, 0)
    weights = cut(tfidf(distinct.withColumnRenamed("t", "company")))
    indexed = weights.withColumn("run", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(order))).filter(F.col("run") >= F.lit(threshold - 1e-9)).select("idx", "gram", "run")
    a, b = indexed.alias("a"), indexed.alias("b")
    # All that two names share is no rarer than their rarest shared gram, so the parts from there on bound the cosine.
    meet = a.join(b, F.expr(f"a.gram = b.gram and a.idx < b.idx and a.run * b.run >= {threshold - 1e-9}D"))
    met = meet.select(F.col("a.idx").alias("idx1"), F.col("b.idx").alias("idx2")).distinct()
    full = weights.groupBy("idx").agg(F.collect_list(F.xxhash64("gram")).alias("g"), F.collect_list("weight").alias("w"))
    left, right = full.select(F.col("idx").alias("idx1"), F.col("g").alias("g1"), F.col("w").alias("w1")), full.select(F.col("idx").alias("idx2"), F.col("g").alias("g2"), F.col("w").alias("w2"))
    close = met.join(left, "idx1").join(right, "idx2").mapInArrow(_above(threshold), "idx1 long, idx2 long, similarity double")
    ids = spelled.join(distinct, "t").select("idx", "i")
    x, y = ids.select(F.col("idx").alias("idx1"), F.col("i").alias("x")), ids.select(F.col("idx").alias("idx2"), F.col("i").alias("y"))
    apart = close.join(x, "idx1").join(y, "idx2").select(F.least("x", "y").alias("idx1"), F.greatest("x", "y").alias("idx2"), "similarity")
    p, q = ids.alias("p"), ids.alias("q")
    equal = p.join(q, F.expr("p.idx = q.idx and p.i < q.i")).select(F.col("p.i").alias("idx1"), F.col("q.i").alias("idx2"), F.lit(1.0).alias("similarity"))
    return apart.unionByName(equal.filter(F.lit(1.0) > threshold))


def best_matches(pairs: DataFrame, top: int = 100) -> DataFrame:
    """(idx, match, similarity, rank): each name's best matches in both directions."""
    both = pairs.select(F.col("idx1").alias("idx"), F.col("idx2").alias("match"), "similarity").union(pairs.select("idx2", "idx1", "similarity"))
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("idx").orderBy(F.desc("similarity"), "match"))).filter(F.col("rank") <= top)


def match_lists(pairs: DataFrame) -> DataFrame:
    """(idx, matches): all matches of a name as a sorted list."""
    both = pairs.select(F.col("idx1").alias("idx"), F.col("idx2").alias("match")).union(pairs.select("idx2", "idx1"))
    return both.groupBy("idx").agg(F.sort_array(F.collect_set("match")).alias("matches"))
