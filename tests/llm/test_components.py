"""Groups against a plain union-find, at several bounds, with dirty links."""

import random

import pytest

from amalgrid.llm.components import connected, group_records, match_links


def brute(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a in parent and b in parent:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("bound", [7, 50, 10_000])
@pytest.mark.parametrize("shape", ["random", "chain", "star", "hot"])
def test_same_as_union_find(spark, bound, shape):
    r = random.Random(3)
    links = {
        "random": [(r.randrange(150), r.randrange(150)) for _ in range(120)],
        "chain": [(i, i + 1) for i in r.sample(range(100), 100)],
        "star": [(0, i) for i in range(1, 80)],
        "hot": [(99, r.randrange(99)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(30)],
    }[shape]
    nodes = {x for e in links for x in e}
    got = {row.node: row.root for row in connected(spark.createDataFrame(links, "a long, b long"), bound).collect()}
    assert got == brute(nodes, links)


def test_dirty_lists_and_predictions(spark):
    records = spark.createDataFrame([(1, [2, 2, 1, 99]), (1, [3]), (2, None), (3, []), (4, [None]), (5, [6]), (6, None), (7, None)], "internal_id long, matches array<long>")
    predictions = spark.createDataFrame([(4, 5, 1), (5, 4, 0), (7, 99, 1), (7, 6, 0), (None, 1, 1), (6, 7, None)], "idx1 long, idx2 long, prediction int")
    got = {r.internal_id: (r.group_id, r.group_size) for r in group_records(records, match_links(records, predictions)).collect()}
    assert got == {1: (1, 3), 2: (1, 3), 3: (1, 3), 4: (4, 3), 5: (4, 3), 6: (4, 3), 7: (7, 1)}


def test_empty(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
    records = spark.createDataFrame([(1, None)], "internal_id long, matches array<long>")
    none = spark.createDataFrame([], "a long, b long")
    assert [tuple(r) for r in group_records(records, none).collect()] == [(1, 1, 1)]


def test_levels_shrink_whatever_the_order_of_ids(spark):
    """A chain with ids in order, in partitions of one link in a hundred: each level halves it about."""
    from pyspark.sql import functions as F

    n = 200_000
    trace = []
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected(links, 2_000, trace)
    assert got.filter("root = 0").count() == n + 1
    assert len(trace) <= 12
    assert all(b <= 0.7 * a for a, b in zip([n, *trace], trace))


def test_other_kinds_of_ids(spark):
    links = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "x"), (None, "a")], "a string, b string")
    assert {tuple(r) for r in connected(links).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x")}
    assert connected(links.limit(0)).count() == 0
    binary = links.select(F_binary("a"), F_binary("b"))
    assert {bytes(r.root) for r in connected(binary).collect()} == {b"a", b"x"}


def F_binary(c):
    from pyspark.sql import functions as F

    return F.col(c).cast("binary").alias(c)
