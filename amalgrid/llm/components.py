"""Pairwise matches into groups: union-find in edge partitions, forests merged level by level.

Every level splits the links into partitions of at most ``bound`` links (as they come or by round robin, so no
node, however often it occurs, makes a partition larger). A task runs union-find over its links and keeps only
the spanning forest as stars: node -> root, the node of its tree with the least hash. Hashes change from level to
level, so no order of the ids can keep a level from shrinking. A node is then contracted into the least of its
roots over all partitions, and the forests' links, renamed so, are the next level: a path of one-link trees
halves, everything denser shrinks faster. When what is left fits one bounded partition, a last union-find ends
it, and the levels are unwound with one join each. The smallest id is an aggregate that goes along.
No level collects links or nodes to the driver, and no task holds more than ``bound`` links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amalgrid.session import cut

#: Links one task may hold; about 150 bytes each in the union-find.
BOUND = 1_000_000


def _stars(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Links (a, hash of a, b, hash of b) -> (node, root, hash of root); roots have the least hash of their tree."""
    parent: dict = {}
    rank: dict = {}

    def find(x):
        root = x
        while (up := parent[root]) != root:
            root = up
        while (up := parent[x]) != root:
            parent[x], x = root, up
        return root

    for batch in batches:
        for a, ha, b, hb in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if a not in parent:
                parent[a], rank[a] = a, (ha, a)
            if b not in parent:
                parent[b], rank[b] = b, (hb, b)
            a, b = find(a), find(b)
            if a != b:
                if rank[a] < rank[b]:
                    parent[b] = a
                else:
                    parent[a] = b
    nodes = list(parent)
    step = 100_000
    for k in range(0, len(nodes), step):
        part = nodes[k : k + step]
        roots = [find(x) for x in part]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array(roots, kind), pa.array([rank[r][0] for r in roots], pa.int64())], names=["node", "root", "h"])


def _forest(edges: DataFrame, level: int) -> DataFrame:
    """(node, root, h) of the links of each partition on their own."""
    kind = edges.schema["a"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    hashed = edges.select("a", F.xxhash64(F.lit(level), "a").alias("ha"), "b", F.xxhash64(F.lit(level), "b").alias("hb"))
    schema = T.StructType([T.StructField("node", kind), T.StructField("root", kind), T.StructField("h", T.LongType())])
    return hashed.mapInArrow(lambda batches: _stars(batches, arrow), schema)


def connected(links: DataFrame, bound: int = BOUND, trace: list[int] | None = None) -> DataFrame:
    """(node, root): each node of ``links(a, b)`` with the smallest id of its component.

    Ids are of any one type that Spark can order and hash (long, string, binary). Links with a null end are
    ignored; a self link makes its node a component; repeats and either direction are the same link. An empty
    input gives an empty result. ``root`` is exact at any size. ``trace`` takes the links left after each level.
    """
    edges = cut(links.select("a", "b").filter("a is not null and b is not null"))
    count = edges.count()
    levels: list[tuple[DataFrame, DataFrame]] = []
    low = None
    while True:
        parts = math.ceil(count / bound)
        # The links of the input are taken where they lie; only too large partitions are dealt out anew.
        held = edges if not levels and edges.rdd.getNumPartitions() >= parts else edges.repartition(max(parts, 1))
        last = bool(levels) and count <= bound
        stars = _forest(held.coalesce(1) if last else held, len(levels))
        if last:
            ups = stars.select("node", F.col("root").alias("up"))
        else:
            # A node stands in at most one tree a partition.
            stars = cut(stars.groupBy("node").agg(F.min_by("root", F.struct("h", "root")).alias("up"), F.collect_set("root").alias("roots")))
            ups = stars.select("node", "up")
        known = ups if low is None else ups.join(low, "node", "left")
        smallest = known.groupBy("up").agg(F.min("node" if low is None else "low").alias("low"))
        if last:
            levels.append((ups, smallest))
            break
        renamed = stars.select("up", F.explode("roots").alias("root")).distinct().join(ups.withColumnRenamed("up", "to"), F.col("root") == F.col("node")).filter("up <> to")
        left = cut(renamed.select(F.least("up", "to").alias("a"), F.greatest("up", "to").alias("b")).distinct())
        smallest = cut(smallest)
        levels.append((ups, smallest))
        low = smallest.withColumnRenamed("up", "node")
        edges, count = left, left.count()
        if trace is not None:
            trace.append(count)
        if not count:
            break
    labels = None
    for ups, smallest in reversed(levels):
        tops = smallest if labels is None else smallest.join(labels.withColumnRenamed("node", "up"), "up", "left").select("up", F.coalesce("root", "low").alias("low"))
        labels = ups.join(tops, "up").select("node", F.col("low").alias("root"))
        if len(levels) > 1:
            labels = cut(labels)
    return labels


def group_records(
    records: DataFrame,
    links: DataFrame,
    id_col: str = "internal_id",
    bound: int = BOUND,
) -> DataFrame:
    """(id, group_id, group_size): every record once, with the smallest id linked to it, itself included.

    ``links(a, b)`` may name unknown ids and hold nulls or repeats: such ends link nothing.
    """
    ids = records.select(F.col(id_col).cast("long").alias("node")).filter("node is not null").distinct()
    known = ids.select(F.col("node").alias("a"))
    good = links.select("a", "b").filter("a is not null and b is not null and a <> b")
    good = good.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    good = good.join(known, "a", "left_semi").join(known.withColumnRenamed("a", "b"), "b", "left_semi")
    labels = connected(good, bound)
    # Only linked ids are counted by group, partially before the shuffle; lone records need no shuffle partner.
    sizes = labels.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    linked = labels.join(sizes, "root")
    return ids.join(linked, "node", "left").select(
        F.col("node").alias(id_col),
        F.coalesce("root", "node").alias("group_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
    )


def match_links(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """(a, b): what a record's ``matches`` list, and pairs that any row predicts as a match."""
    listed = records.select(F.col("internal_id").alias("a"), F.explode("matches").alias("b"))
    predicted = predictions.filter("prediction = 1").select(F.col("idx1").alias("a"), F.col("idx2").alias("b"))
    return listed.unionByName(predicted)
