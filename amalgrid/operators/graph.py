"""Groups and clusters of scored pairs, kept as edges: an absent pair has similarity 0."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgrid.functions.pairnames import first_letter
from amalgrid.operators.tables import dense_ids, symmetric, undirected, undirected_best
from amalgrid.session import cut


def components(edges: DataFrame, a: str = "idx1", b: str = "idx2") -> DataFrame:
    """(idx, root): every node of an edge with its component's smallest node, by alternating stars.

    Each round links every neighbour to the smallest of a neighbourhood, first upwards then downwards
    (large star, small star), and writes its edges to the checkpoint folder; rounds grow with the
    logarithm of the nodes. Neighbourhoods are aggregated, never collected.
    """
    now = cut(undirected(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v")), "u", "v"))
    state = None
    while True:
        both = now.select("u", "v").union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("x"), "m", "u")
        after = cut(small.select(F.col("x").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        seen = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state, now = seen, after
    roots = now.select(F.col("v").alias("idx")).distinct().withColumn("root", F.col("idx"))
    return now.select(F.col("u").alias("idx"), F.col("v").alias("root")).unionByName(roots).distinct()


def labelled(nodes: DataFrame, roots: DataFrame, lone: str = "own") -> DataFrame:
    """(idx, cluster_id): clusters numbered by their smallest member; ``lone`` nodes get an own number or -1."""
    all_ = nodes.select("idx").distinct().join(roots, "idx", "left")
    if lone == "own":
        all_ = all_.withColumn("root", F.coalesce("root", "idx"))
    ids = dense_ids(all_.filter("root is not null"), "root", "cluster_id")
    return all_.join(ids, "root", "left").select("idx", F.coalesce("cluster_id", F.lit(-1)).cast("long").alias("cluster_id"))


def threshold_clusters(nodes: DataFrame, pairs: DataFrame, threshold: float = 0.7, score: str = "similarity") -> DataFrame:
    """Connected components of pairs with at least the threshold; lone nodes are clusters of their own."""
    return labelled(nodes, components(pairs.filter(F.col(score) >= F.lit(threshold))))


def _core(nodes: DataFrame, near: DataFrame, min_samples: int) -> DataFrame:
    degree = symmetric(near, "idx1", "idx2").groupBy("idx1").agg((F.count(F.lit(1)) + 1).alias("n"))
    core = degree.filter(F.col("n") >= min_samples).select(F.col("idx1").alias("idx"))
    return nodes.select("idx").distinct() if min_samples <= 1 else core


def dbscan(nodes: DataFrame, pairs: DataFrame, eps: float = 0.3, min_samples: int = 2, score: str = "similarity") -> DataFrame:
    """(idx, cluster_id): density clusters of distance 1 - similarity; noise is -1.

    A node counts itself among its neighbours. A border node joins the lowest-numbered cluster it touches.
    """
    near = undirected(pairs.filter((1 - F.col(score)) <= F.lit(eps)), "idx1", "idx2")
    core = cut(_core(nodes, near, min_samples))
    inner = near.join(core.withColumnRenamed("idx", "idx1"), "idx1", "left_semi").join(core.withColumnRenamed("idx", "idx2"), "idx2", "left_semi")
    roots = components(inner)
    roots = core.join(roots, "idx", "left").select("idx", F.coalesce("root", "idx").alias("root"))
    around = symmetric(near, "idx1", "idx2").join(roots.select(F.col("idx").alias("idx2"), "root"), "idx2")
    border = around.join(core.withColumnRenamed("idx", "idx1"), "idx1", "left_anti").groupBy(F.col("idx1").alias("idx")).agg(F.min("root").alias("root"))
    return labelled(nodes, roots.unionByName(border), lone="noise")


def two_phase(names: DataFrame, pairs: DataFrame, eps: float = 0.3, min_samples: int = 2, score: str = "similarity") -> DataFrame:
    """``dbscan`` inside first-letter blocks (nameless rows are a block too); numbers follow block, then member."""
    blocks = cut(names.select("idx", first_letter("company").alias("block")))
    b1, b2 = blocks.select(F.col("idx").alias("idx1"), F.col("block").alias("k1")), blocks.select(F.col("idx").alias("idx2"), F.col("block").alias("k2"))
    same = pairs.select("idx1", "idx2", score).join(b1, "idx1").join(b2, "idx2").filter("k1 = k2").select("idx1", "idx2", score)
    flat = dbscan(names, same, eps, min_samples, score)
    # Blocks come in the order of their first member, clusters of a block in the order of theirs.
    first = blocks.groupBy("block").agg(F.min("idx").alias("block_first"))
    member = flat.filter("cluster_id >= 0").join(blocks, "idx").groupBy("cluster_id", "block").agg(F.min("idx").alias("cluster_first")).join(first, "block")
    order = member.withColumn("place", F.struct("block_first", "cluster_first"))
    ids = dense_ids(order, "place", "new_id").join(order, "place").select("cluster_id", "new_id")
    return flat.join(ids, "cluster_id", "left").select("idx", F.coalesce("new_id", F.lit(-1)).cast("long").alias("cluster_id"))


#: A component of more pairs than this is merged by all tasks, round by round, and not within one.
LARGEST = 200_000


def _similarity(linkage: str, total: float, low: float, high: float, count: int, possible: int) -> float:
    """Of two clusters, from the sum, least and largest of their pairs at hand; absent pairs are 0."""
    if linkage == "average":
        return total / possible
    return high if linkage == "single" else low if count == possible else 0.0


def _merge(n: int, pairs: list[tuple[int, int, float]], threshold: float | None, k: int | None, linkage: str) -> list[int]:
    """Flat labels of one component by merging the nearest pair, from sparse pairs and a heap; ties by the smaller members."""
    links: list[dict[int, tuple[float, float, float, int]]] = [{} for _ in range(n)]
    size, into, alive = [1] * n, list(range(n)), n
    heap = []
    for a, b, s in pairs:
        links[a][b] = links[b][a] = (s, s, s, 1)
        heap.append((1 - s, min(a, b), max(a, b)))
    heapq.heapify(heap)

    def distance(a: int, b: int) -> float:
        return 1 - _similarity(linkage, *links[a][b], size[a] * size[b])

    while heap and alive > (k or 1):
        d, a, b = heapq.heappop(heap)
        if into[a] != a or into[b] != b or d != distance(a, b):
            continue
        if threshold is not None and not d < threshold:
            break
        into[b], alive = a, alive - 1
        mine, theirs = links[a], links[b]
        del mine[b], theirs[a]
        for c, (t, lo, hi, m) in theirs.items():
            t2, lo2, hi2, m2 = mine.get(c, (0.0, lo, hi, 0))
            mine[c] = links[c][a] = (t + t2, min(lo, lo2), max(hi, hi2), m + m2)
            del links[c][b]
        links[b] = {}
        size[a] += size[b]
        for c in mine:
            heapq.heappush(heap, (distance(a, c), min(a, c), max(a, c)))
    if threshold is None or threshold > 1:
        # What is left has nothing in common: the first two are merged, again and again.
        rest = [i for i in range(n) if into[i] == i]
        for b in rest[1 : 1 + max(0, alive - (k or 1))]:
            into[b] = rest[0]
    out = []
    for i in range(n):
        while into[i] != i:
            i = into[i]
        out.append(i)
    return out


def _merge_rounds(edges: DataFrame, threshold: float, linkage: str) -> DataFrame:
    """(idx1, idx2): the merges of ``edges(idx1, idx2, s)`` below the threshold, by rounds of mutual nearest clusters.

    Merging two clusters brings neither nearer to a third (for all three linkages), so pairs that are each other's
    nearest merge in any order, all in one round. Ties go by the smaller members, as within one task.
    """
    now = cut(edges.select(F.col("idx1").alias("a"), F.col("idx2").alias("b"), F.lit(1).cast("long").alias("na"), F.lit(1).cast("long").alias("nb"), F.col("s").alias("t"), F.col("s").alias("lo"), F.col("s").alias("hi"), F.lit(1).cast("long").alias("m")))
    merges = None
    possible = F.col("na") * F.col("nb")
    by = {"average": F.col("t") / possible, "single": F.col("hi"), "complete": F.when(F.col("m") == possible, F.col("lo")).otherwise(0.0)}[linkage]
    while True:
        near = now.withColumn("d", 1 - by).filter(F.col("d") < F.lit(threshold)).select("a", "b", "d", (F.col("na") + F.col("nb")).alias("n"))
        place = F.struct("d", "a", "b", "n")
        best = near.select(F.col("a").alias("x"), place.alias("p")).union(near.select(F.col("b").alias("x"), place.alias("p"))).groupBy("x").agg(F.min("p").alias("p"))
        # Mutual: the pair is the nearest of both its ends.
        made = best.groupBy("p.a", "p.b", "p.n").agg(F.count(F.lit(1)).alias("_c")).filter("_c = 2").select("a", "b", "n")
        made = cut(made)
        if made.isEmpty():
            return merges if merges is not None else made.select(F.col("a").alias("idx1"), F.col("b").alias("idx2"))
        step = made.select(F.col("a").alias("idx1"), F.col("b").alias("idx2"))
        merges = step if merges is None else merges.unionByName(step)
        moved = made.select(F.col("b").alias("x"), F.col("a").alias("to"), "n").unionByName(made.select(F.col("a").alias("x"), F.col("a").alias("to"), "n"))
        for end, size in (("a", "na"), ("b", "nb")):
            m = moved.select(F.col("x").alias(end), F.col("to").alias("_to"), F.col("n").alias("_n"))
            now = now.join(m, end, "left").withColumns({end: F.coalesce("_to", end), size: F.coalesce("_n", size)}).drop("_to", "_n")
        now = now.filter("a <> b")
        turn = F.col("a") > F.col("b")
        now = now.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(turn, F.col("nb")).otherwise(F.col("na")).alias("na"), F.when(turn, F.col("na")).otherwise(F.col("nb")).alias("nb"), "t", "lo", "hi", "m")
        now = cut(now.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("t").alias("t"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("m").alias("m")))


def agglomerative(nodes: DataFrame, pairs: DataFrame, distance_threshold: float | None = 0.3, n_clusters: int | None = None, linkage: str = "average", score: str = "similarity", largest: int = LARGEST) -> DataFrame:
    """(idx, cluster_id): bottom-up merging while the linkage distance is below the threshold; absent pairs are 0.

    With a threshold of at most 1 every cluster lies in one component of closer pairs, so components are solved apart:
    one of at most ``largest`` pairs within a task, a larger one by all tasks in rounds, with the same result.
    ``n_clusters`` overrides the threshold and takes all nodes as one component; more than ``largest`` pairs raise.
    """
    if linkage not in ("average", "complete", "single"):
        raise ValueError(f"unknown linkage {linkage!r}")
    if n_clusters is None and not 0 <= distance_threshold <= 1:
        raise ValueError("a distance threshold lies between 0 and 1")
    ids = nodes.select("idx").distinct()
    edges = undirected_best(pairs.withColumnRenamed(score, "s"), "idx1", "idx2", "s").filter("s is not null")
    if n_clusters is None:
        roots = components(edges.filter((1 - F.col("s")) < F.lit(distance_threshold)))
    else:
        roots = ids.withColumn("root", F.lit(0).cast("long"))
    roots = cut(roots)
    r1, r2 = roots.select(F.col("idx").alias("idx1"), F.col("root").alias("c1")), roots.select(F.col("idx").alias("idx2"), F.col("root").alias("c2"))
    inside = cut(edges.join(r1, "idx1").join(r2, "idx2").filter("c1 = c2").select(F.col("c1").alias("root"), "idx1", "idx2", "s"))
    big = cut(inside.groupBy("root").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > largest).select("root"))
    many = not big.isEmpty()
    if many and n_clusters is not None:
        raise ValueError(f"more than {largest} pairs are beyond the limit of one task")
    small = inside.join(big, "root", "left_anti") if many else inside
    members = roots.join(big, "root", "left_anti") if many else roots
    rows = small.unionByName(members.select("root", F.col("idx").alias("idx1"), F.col("idx").alias("idx2"), F.lit(1.0).alias("s")))
    limit, by_number = (None if n_clusters else distance_threshold), n_clusters

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        own = part["idx1"] == part["idx2"]
        members = np.sort(part["idx1"][own].unique())
        pairs = part[~own]
        a, b = np.searchsorted(members, pairs["idx1"]), np.searchsorted(members, pairs["idx2"])
        groups = _merge(len(members), list(zip(a.tolist(), b.tolist(), pairs["s"].tolist())), limit, by_number, linkage)
        return pd.DataFrame({"idx": members, "root": [members[g] for g in groups]})

    solved = rows.groupBy("root").applyInPandas(solve, "idx long, root long")
    if many:
        merges = _merge_rounds(inside.join(big, "root", "left_semi"), distance_threshold, linkage)
        solved = solved.unionByName(components(merges).select(F.col("idx").cast("long").alias("idx"), F.col("root").cast("long").alias("root")))
    return labelled(ids, solved)


# --- quality -------------------------------------------------------------------------------------


def _inside(labels: DataFrame, pairs: DataFrame, score: str) -> DataFrame:
    """(cluster_id, idx1, idx2, s) of the pairs within a cluster, each once."""
    a, b = labels.select(F.col("idx").alias("idx1"), F.col("cluster_id").alias("k1")), labels.select(F.col("idx").alias("idx2"), F.col("cluster_id").alias("k2"))
    once = pairs.filter("idx1 <> idx2").groupBy(F.least("idx1", "idx2").alias("idx1"), F.greatest("idx1", "idx2").alias("idx2")).agg(F.max(score).alias("s"))
    return once.join(a, "idx1").join(b, "idx2").filter("k1 = k2").select(F.col("k1").alias("cluster_id"), "idx1", "idx2", "s")


def cluster_metrics(labels: DataFrame, pairs: DataFrame, score: str = "similarity") -> DataFrame:
    """(cluster_id, size, avg, min, max similarity), largest first; absent pairs count 0, a lone member 1, noise null."""
    sizes = labels.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    sums = _inside(labels, pairs, score).groupBy("cluster_id").agg(F.sum("s").alias("total"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.count(F.lit(1)).alias("k"))
    possible = F.col("size") * (F.col("size") - 1) / 2
    noise, lone = F.col("cluster_id") == -1, F.col("size") == 1
    m = sizes.join(sums, "cluster_id", "left").fillna({"k": 0, "total": 0.0})
    pick = lambda value: F.when(noise, F.lit(None).cast("double")).when(lone, F.lit(1.0)).otherwise(value)
    complete = F.col("k") == possible
    return m.select(
        "cluster_id", "size", pick(F.col("total") / possible).alias("avg_similarity"), pick(F.when(complete, F.col("lo")).otherwise(F.lit(0.0))).alias("min_similarity"), pick(F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.greatest("hi", F.lit(0.0)))).alias("max_similarity")
    ).orderBy(F.desc("size"), "cluster_id")


def cluster_summary(labels: DataFrame) -> DataFrame:
    """One row: clusters, noise, noise share, mean, median, smallest and largest size."""
    sizes = labels.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    real = F.when(F.col("cluster_id") != -1, F.col("n"))
    return sizes.agg(
        F.count(real).alias("n_clusters"), F.coalesce(F.sum(F.when(F.col("cluster_id") == -1, F.col("n"))), F.lit(0)).alias("n_noise"), (F.coalesce(F.sum(F.when(F.col("cluster_id") == -1, F.col("n"))), F.lit(0)) / F.sum("n")).alias("noise_ratio"),
        F.avg(real).alias("mean_size"), F.percentile(real, F.lit(0.5)).alias("median_size"), F.min(real).alias("min_size"), F.max(real).alias("max_size"),
    )


def member_similarity(labels: DataFrame, pairs: DataFrame, score: str = "similarity") -> DataFrame:
    """(idx, cluster_id, cluster_size, avg_similarity_in_cluster): each row's mean similarity to the others of its cluster."""
    sizes = labels.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
    both = symmetric(_inside(labels, pairs, score), "idx1", "idx2", "s").groupBy(F.col("idx1").alias("idx")).agg(F.sum("s").alias("total"))
    rows = labels.join(sizes, "cluster_id").join(both, "idx", "left")
    rows = rows.orderBy("cluster_id", "idx")
    return rows.select("idx", "cluster_id", "cluster_size", F.when(F.col("cluster_size") == 1, F.lit(1.0)).otherwise(F.coalesce("total", F.lit(0.0)) / (F.col("cluster_size") - 1)).alias("avg_similarity_in_cluster"))


def silhouette(labels: DataFrame, pairs: DataFrame, score: str = "similarity") -> DataFrame:
    """One row: the mean silhouette over distance 1 - similarity, noise left out; null unless there are two clusters.

    From sparse sums: the mean distance to a cluster is 1 less the similarities over its size.
    """
    known = labels.filter("cluster_id >= 0")
    sizes = known.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    once = pairs.filter("idx1 <> idx2").groupBy(F.least("idx1", "idx2").alias("idx1"), F.greatest("idx1", "idx2").alias("idx2")).agg(F.max(score).alias("s"))
    to = symmetric(once, "idx1", "idx2", "s").join(known.select(F.col("idx").alias("idx2"), F.col("cluster_id").alias("k")), "idx2").groupBy(F.col("idx1").alias("idx"), "k").agg(F.sum("s").alias("t"))
    to = to.join(sizes.select(F.col("cluster_id").alias("k"), "n"), "k").join(known, "idx")
    own = to.filter("k = cluster_id").select("idx", "t")
    other = to.filter("k <> cluster_id").groupBy("idx").agg(F.min(1 - F.col("t") / F.col("n")).alias("b"), F.count(F.lit(1)).alias("touched"))
    n_clusters = sizes.agg(F.count(F.lit(1)).alias("k_all"))
    rows = known.join(sizes, "cluster_id").join(own, "idx", "left").join(other, "idx", "left").crossJoin(F.broadcast(n_clusters))
    a = 1 - F.coalesce("t", F.lit(0.0)) / (F.col("n") - 1)
    b = F.least(F.coalesce("b", F.lit(1.0)), F.when(F.coalesce("touched", F.lit(0)) < F.col("k_all") - 1, F.lit(1.0)).otherwise(F.lit(2.0)))
    s = F.when(F.col("n") == 1, F.lit(0.0)).when(F.greatest(a, b) == 0, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return rows.agg(F.when(F.max("k_all") > 1, F.avg(s)).alias("silhouette"))


def compare_runs(runs: dict[str, DataFrame], pairs: DataFrame, score: str = "similarity") -> DataFrame:
    """One row a clustering run: its summary and silhouette."""
    out = None
    for name, labels in runs.items():
        row = cluster_summary(labels).crossJoin(silhouette(labels, pairs, score)).withColumn("run", F.lit(name))
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no runs")
    return out


def group_ids(records: DataFrame, links: DataFrame, id_col: str = "internal_id") -> DataFrame:
    """(id, group_id): components numbered from 0 by their smallest member, then the records without a link."""
    ids = records.select(F.col(id_col).alias("idx")).filter("idx is not null").distinct()
    known = links.join(ids.withColumnRenamed("idx", "idx1"), "idx1", "left_semi").join(ids.withColumnRenamed("idx", "idx2"), "idx2", "left_semi")
    roots = cut(components(known))
    grouped = roots.join(dense_ids(roots, "root", "group_id"), "root").select("idx", "group_id")
    rest = ids.join(grouped, "idx", "left_anti")
    lone = dense_ids(rest, "idx", "_k")
    count = grouped.agg(F.coalesce(F.max("group_id") + 1, F.lit(0)).alias("_n"))
    return grouped.unionByName(lone.crossJoin(F.broadcast(count)).select("idx", (F.col("_n") + F.col("_k")).alias("group_id"))).withColumnRenamed("idx", id_col)


def clean_matches(own: Column, matches: Column) -> Column:
    """A match list without the record itself and without repeats, in its order; null gives an empty list."""
    return F.array_distinct(F.filter(F.coalesce(matches, F.array().cast("array<bigint>")), lambda m: m.isNotNull() & (m != own)))
