"""Relational operators of the toolkit: counts, profiles, histograms, rankings, ids, set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amalgrid.session import cut


# --- counts and profiles -------------------------------------------------------------------------


def value_counts(df: DataFrame, by: str, drop_null: bool = True) -> DataFrame:
    """(by, n), most frequent first; ties by value."""
    rows = df.filter(F.col(by).isNotNull()) if drop_null else df
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by)


def shares(df: DataFrame, by: str) -> DataFrame:
    """(by, n, percent) of all rows with a value."""
    counts = value_counts(df, by)
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(by, "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))  # one row


def profile(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, empties, distinct values (null is one), lengths, share of non-ASCII names; zeros for no rows."""
    c = F.coalesce(F.col(name), F.lit(""))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(c == "").alias("n_empty"),
        (F.count_distinct(name) + F.max(F.col(name).isNull().cast("int"))).alias("n_distinct"),
        F.min(F.length(c)).alias("len_min"),
        F.percentile(F.length(c), F.lit(0.5)).alias("len_median"),
        F.percentile(F.length(c), F.lit(0.9)).alias("len_p90"),
        F.max(F.length(c)).alias("len_max"),
        F.avg(c.rlike(r"[^\x00-\x7F]").cast("double")).alias("non_ascii_ratio"),
    ).fillna(0)


def describe(df: DataFrame, column: str) -> DataFrame:
    """Exact count, mean, sample deviation, minimum, quartiles (interpolated) and maximum, as one row.

    Quartiles come from running counts of the distinct values, range-partitioned: no task holds them all.
    """
    c = F.col("_v")
    values = df.select(F.col(column).cast("double").alias("_v")).filter(c.isNotNull())
    whole = values.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("lo"), F.max(c).alias("hi"))
    upto = running_totals(values.groupBy("_v").agg(F.count(F.lit(1)).alias("_k")), [c], {"_upto": "_k"})
    picks = []
    for name, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
        place = (F.col("n") - 1) * F.lit(q)
        for side, at in (("a", F.floor(place)), ("b", F.ceil(place))):
            picks.append(F.min(F.when(F.col("_upto") > at, c)).alias(f"_{name}{side}"))
    # One row.
    marks = upto.crossJoin(F.broadcast(whole.select("n"))).agg(*picks)
    out = whole.crossJoin(F.broadcast(marks))
    for name, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
        place = (F.col("n") - 1) * F.lit(q)
        low, high = F.col(f"_{name}a"), F.col(f"_{name}b")
        out = out.withColumn(name, low + (high - low) * (place - F.floor(place)))
    return out.select("n", "mean", "std", "lo", "q1", "q2", "q3", "hi")


def histogram(df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, n) of equal bins, the last one closed; without ``low`` and ``high`` over the column's own range."""
    c = F.col(column).cast("double")
    if low is None or high is None:
        ends = df.agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
        df = df.crossJoin(F.broadcast(ends))  # one row
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        lo, hi = F.lit(float(low)), F.lit(float(high))
        df = df.filter((c >= lo) & (c <= hi))
    width = (hi - lo) / bins
    at = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((c - lo) / width), F.lit(bins - 1)))
    return df.filter(c.isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin")


def pair_histogram(pairs: DataFrame, column: str, nodes: DataFrame, bins: int, id_col: str = "idx") -> DataFrame:
    """(bin, n) over [0, 1] of every unordered pair of ``nodes``; a pair that ``pairs(idx1, idx2, column)`` lacks is 0.

    Absent pairs are counted, never made: all pairs of n nodes less those at hand go to the first bin.
    """
    known = undirected_best(pairs, "idx1", "idx2", column)
    seen = histogram(known, column, bins, 0, 1)
    n = nodes.agg(F.count_distinct(id_col).alias("_n"))
    held = known.agg(F.count(column).alias("_k"))
    # One row each.
    absent = n.crossJoin(F.broadcast(held)).select(F.lit(0).alias("bin"), (F.col("_n") * (F.col("_n") - 1) / 2 - F.col("_k")).cast("long").alias("n"))
    return seen.unionByName(absent.filter("n > 0")).groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin")


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support) of each class, then their plain and their weighted mean; 0 where undefined."""
    rows = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = rows.select(F.col("y").alias("class"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"))
    sides = sides.unionByName(rows.select(F.col("p").alias("class"), F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said")))
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    by = sides.groupBy("class").agg(F.sum("hit").alias("hit"), F.sum("support").alias("support"), F.sum("said").alias("said"))
    by = by.withColumns({"precision": ratio(F.col("hit"), F.col("said")), "recall": ratio(F.col("hit"), F.col("support"))})
    by = by.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select("class", "precision", "recall", "f1", "support")
    figures = ("precision", "recall", "f1")
    plain = by.agg(*[F.avg(c).alias(c) for c in figures], F.sum("support").alias("support")).select(F.lit("macro avg").alias("class"), *figures, "support")
    weighted = by.agg(*[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in figures], F.sum("support").alias("support")).select(F.lit("weighted avg").alias("class"), *figures, "support")
    return by.unionByName(plain.filter("support is not null")).unionByName(weighted.filter("support is not null"))


def aligned_counts(df: DataFrame, first: str, second: str, key: str = "value") -> DataFrame:
    """(value, first, second): how often each value occurs in two columns, 0 where it does not."""
    a = df.groupBy(F.col(first).alias(key)).agg(F.count(F.lit(1)).alias("n_first")).filter(F.col(key).isNotNull())
    b = df.groupBy(F.col(second).alias(key)).agg(F.count(F.lit(1)).alias("n_second")).filter(F.col(key).isNotNull())
    return a.join(b, key, "full_outer").select(key, F.coalesce("n_first", F.lit(0)).alias("n_first"), F.coalesce("n_second", F.lit(0)).alias("n_second")).orderBy(key)


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str | None = None) -> DataFrame:
    """One row: confusion counts, accuracy, precision, recall, F1 (0 where undefined) and exact ROC-AUC.

    The AUC is the rank sum over score groups: distinct scores are aggregated first.
    """
    rows = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y, p = F.col(label) == 1, F.col(prediction) == 1
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    m = rows.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    m = m.withColumns({"accuracy": ratio(tp + tn, tp + fp + fn + tn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    m = m.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    if score is None:
        return m
    groups = rows.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    below = running_totals(groups, [F.col(score)], {"upto": "neg"}).withColumn("below", F.col("upto") - F.col("neg"))
    auc = below.withColumn("wins", F.col("pos") * (F.col("below") + F.col("neg") / 2)).agg((F.sum("wins") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("roc_auc"))
    return m.crossJoin(F.broadcast(auc))  # one row each


# --- rankings and ids ----------------------------------------------------------------------------


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, str]) -> DataFrame:
    """``df`` with running sums (target -> column) in a total order, without a single-task window.

    Rows are range-partitioned; windows run inside the partitions, and each adds the sums of those before it.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()))
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_p").agg(*[F.sum(c).alias(f"_s_{t}") for t, c in totals.items()])
    # One row a partition: as many as shuffle partitions, whatever the data.
    offsets = sums.select("_p", *[F.coalesce(F.sum(f"_s_{t}").over(before), F.lit(0)).alias(f"_o_{t}") for t in totals])
    out = placed.withColumns({t: F.sum(c).over(inside) for t, c in totals.items()}).join(F.broadcast(offsets), "_p")
    return out.withColumns({t: F.col(t) + F.col(f"_o_{t}") for t in totals}).drop("_p", *[f"_o_{t}" for t in totals])


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group; give a total order to have one result."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= n)


def rank_frequency(df: DataFrame, by: str) -> DataFrame:
    """(by, n, rank, cumulative_share) of the groups' sizes, largest first."""
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(counts, [F.desc("n"), F.col(by)], {"rank": "_one", "_run": "n"})
    total = ranked.agg(F.sum("n").alias("_all"))
    return ranked.crossJoin(F.broadcast(total)).select(by, "n", "rank", (F.col("_run") / F.col("_all")).alias("cumulative_share"))  # one row


def dense_ids(df: DataFrame, key: str, target: str = "id", start: int = 0) -> DataFrame:
    """(key, target): distinct keys numbered in order from ``start``, without a single-task sort.

    Keys are range-partitioned and sorted; each partition's first number is the size of those before it.
    """
    spark = df.sparkSession
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(keys.repartitionByRange(parts, key).sortWithinPartitions(key).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    # One row a partition: as many as shuffle partitions, whatever the data.
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before", "_first")
    return placed.join(F.broadcast(offsets), "_p").select(key, (F.col("_before") + F.col("_i") - F.col("_first") + start).alias(target))


def continued_ids(new: DataFrame, key: str, existing: DataFrame, existing_id: str, target: str = "id") -> DataFrame:
    """(key, target): new keys numbered after the largest existing id."""
    ids = dense_ids(new, key, "_k", 1)
    top = existing.agg(F.coalesce(F.max(existing_id), F.lit(0)).alias("_top"))
    return ids.crossJoin(F.broadcast(top)).select(key, (F.col("_top") + F.col("_k")).alias(target))  # one row


def batch_plan(df: DataFrame, record_id: str, size: int) -> DataFrame:
    """(batch, start_id, end_id, n): records in batches of ``size`` by position of their id."""
    ids = dense_ids(df, record_id, "_pos")
    return ids.groupBy(F.floor(F.col("_pos") / size).alias("batch")).agg(F.min(record_id).alias("start_id"), F.max(record_id).alias("end_id"), F.count(F.lit(1)).alias("n"))


def latest(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return top_n(df, [key], order, 1, "_latest").drop("_latest")


# --- sets and lookups ----------------------------------------------------------------------------


def first_occurrences(df: DataFrame, value: str, position: str) -> DataFrame:
    """(value, position): each value at its first position."""
    return df.groupBy(value).agg(F.min(position).alias(position))


def undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each edge once, the smaller end first."""
    return edges.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()


def undirected_best(edges: DataFrame, a: str, b: str, score: str) -> DataFrame:
    """Each edge once, the smaller end first, with its largest score."""
    return edges.filter(F.col(a) != F.col(b)).groupBy(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).agg(F.max(score).alias(score))


def symmetric(edges: DataFrame, a: str, b: str, *others: str) -> DataFrame:
    """Each edge in both directions."""
    return edges.select(a, b, *others).union(edges.select(b, a, *others)).distinct()


def without(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``done``."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def rows_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def shared_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns of ``df`` that a table with ``names`` has, in its order."""
    return df.select(*[n for n in names if n in df.columns])


def union_sheets(sheets: Sequence[DataFrame], hints: Sequence[str] = ("client_name", "company", "name")) -> DataFrame:
    """(idx, company): distinct trimmed names of the first fitting column of each sheet, in order."""
    parts = []
    for s in sheets:
        fit = next((c for c in s.columns if any(h in c.lower() for h in hints)), None)
        if fit is not None:
            parts.append(s.select(F.trim(F.col(f"`{fit}`").cast("string")).alias("company")))
    if not parts:
        raise ValueError("no sheet has a name column")
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return dense_ids(whole.filter("company <> ''"), "company", "idx")


# --- single predicates ---------------------------------------------------------------------------


def is_match(probability: Column, threshold: float = 0.7) -> Column:
    return F.coalesce(probability >= F.lit(threshold), F.lit(False))


def similar_companies(pairs: DataFrame, company: str, top: int = 10, least: float | None = None) -> DataFrame:
    """(similar_company, similarity_score): the other ends of one company's pairs, best first; none for an unknown name."""
    mine = pairs.filter((F.col("company1") == company) | (F.col("company2") == company))
    if least is not None:
        mine = mine.filter(F.col("prediction_proba") >= least)
    other = F.when(F.col("company1") == company, F.col("company2")).otherwise(F.col("company1"))
    return mine.filter("prediction_proba is not null").select(other.alias("similar_company"), F.col("prediction_proba").alias("similarity_score")).orderBy(F.desc("similarity_score"), "similar_company").limit(top)


def match_frame(pairs: DataFrame, top: int | None = 100, score: str = "similarity") -> DataFrame:
    """(left_side, right_side, similarity) of ``pairs(idx1, idx2, company1, company2, score)`` in the order of the ids, the first ``top`` (all where falsy)."""
    rows = pairs.orderBy("idx1", "idx2")
    rows = rows.limit(top) if top else rows
    return rows.select(F.col("company1").alias("left_side"), F.col("company2").alias("right_side"), F.col(score).alias("similarity"))


def without_exact(pairs: DataFrame, score: str = "similarity", below: float = 0.99999) -> DataFrame:
    """Pairs that are not the same text: those whose score is below one, but for rounding."""
    return pairs.filter(F.col(score) < below)


def head_and_tail(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first and the last ``n`` rows by descending ``order``, with ``side`` (head or tail); two bounded sorts, no full one."""
    head = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("side", F.lit("head"))
    tail = df.orderBy(*[F.asc(c) for c in order]).limit(n).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return df.orderBy(F.rand(seed)).limit(n)
