"""Queries of groups, clusters and their quality, over all scored pairs of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from amalgrid.operators import graph, tables
from amalgrid.session import cut, table

_all: dict[str, tuple[Callable, str | None]] = {}


def query(sql: str | None = None):
    def keep(f):
        _all[f.__name__] = (f, sql)
        return f

    return keep


def queries():
    return {k: f for k, (f, _) in _all.items()}


def oracle_sql():
    return {k: sql for k, (_, sql) in _all.items() if sql}


def _inputs(spark, sf):
    """(nodes, pairs): all listed records, and every scored pair between two of them with its best score."""
    nodes = table(spark, sf, "all_records_clean_names").select(F.col("internal_id").alias("idx")).filter("idx is not null").distinct()
    p = table(spark, sf, "pairwise_predictions").filter("idx1 <> idx2 and prediction_proba is not null")
    p = p.groupBy(F.least("idx1", "idx2").alias("idx1"), F.greatest("idx1", "idx2").alias("idx2")).agg(F.max("prediction_proba").alias("similarity"))
    return nodes, p.join(nodes.withColumnRenamed("idx", "idx1"), "idx1", "left_semi").join(nodes.withColumnRenamed("idx", "idx2"), "idx2", "left_semi").select("idx1", "idx2", "similarity")


_IN = """WITH RECURSIVE nodes AS (SELECT DISTINCT internal_id AS idx FROM all_records_clean_names WHERE internal_id IS NOT NULL),
p AS (SELECT least(idx1, idx2) AS idx1, greatest(idx1, idx2) AS idx2, max(prediction_proba) AS s FROM pairwise_predictions
  WHERE idx1 <> idx2 AND prediction_proba IS NOT NULL AND idx1 IN (SELECT idx FROM nodes) AND idx2 IN (SELECT idx FROM nodes) GROUP BY 1, 2), """


def _cc(where: str) -> str:
    return _IN + f"""e AS (SELECT idx1 AS a, idx2 AS b FROM p WHERE {where} UNION SELECT idx2, idx1 FROM p WHERE {where}),
reach(idx, root) AS (SELECT idx, idx FROM nodes UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.idx),
roots AS (SELECT idx, min(root) AS root FROM reach GROUP BY 1), sized AS (SELECT idx, root, count(*) OVER (PARTITION BY root) AS n FROM roots), """


_DB = _cc("1 - s <= 0.3::DOUBLE") + "ranked AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS k FROM (SELECT DISTINCT root FROM sized WHERE n > 1)), labels AS (SELECT idx, coalesce(k, -1) AS cluster_id FROM sized LEFT JOIN ranked USING (root)) "


@query(_cc("s >= 0.7::DOUBLE") + "labels AS (SELECT idx, dense_rank() OVER (ORDER BY root) - 1 AS cluster_id FROM sized) SELECT * FROM labels")
def component_clusters(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    return graph.threshold_clusters(nodes, pairs, 0.7)


@query(_DB + "SELECT * FROM labels")
def density_clusters(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    return graph.dbscan(nodes, pairs, 0.3, 2)


_IN_PAIRS = """, inside AS (SELECT a.cluster_id, p.idx1, p.idx2, p.s FROM p JOIN labels a ON a.idx = p.idx1 JOIN labels b ON b.idx = p.idx2 WHERE a.cluster_id = b.cluster_id),
sizes AS (SELECT cluster_id, count(*) AS size FROM labels GROUP BY 1), sums AS (SELECT cluster_id, sum(s) AS t, min(s) AS lo, max(s) AS hi, count(*) AS k FROM inside GROUP BY 1) """


@query(_DB.rstrip() + _IN_PAIRS + """SELECT cluster_id, size, CASE WHEN cluster_id >= 0 THEN round(t / (size * (size - 1) / 2.0), 9) END AS avg_similarity,
  CASE WHEN cluster_id >= 0 THEN CASE WHEN k = size * (size - 1) / 2 THEN lo ELSE 0 END END AS min_similarity, CASE WHEN cluster_id >= 0 THEN greatest(hi, 0) END AS max_similarity FROM sizes LEFT JOIN sums USING (cluster_id)""")
def cluster_quality(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    return graph.cluster_metrics(cut(graph.dbscan(nodes, pairs)), pairs).withColumn("avg_similarity", F.round("avg_similarity", 9))


@query(_DB.rstrip() + _IN_PAIRS + """SELECT count(*) FILTER (WHERE cluster_id >= 0) AS n_clusters, coalesce(sum(size) FILTER (WHERE cluster_id = -1), 0)::BIGINT AS n_noise, round(coalesce(sum(size) FILTER (WHERE cluster_id = -1), 0) / sum(size), 9) AS noise_ratio,
  round(avg(size) FILTER (WHERE cluster_id >= 0), 9) AS mean_size, quantile_cont(size, 0.5) FILTER (WHERE cluster_id >= 0) AS median_size, min(size) FILTER (WHERE cluster_id >= 0) AS min_size, max(size) FILTER (WHERE cluster_id >= 0) AS max_size FROM sizes""")
def cluster_sizes(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    s = graph.cluster_summary(graph.dbscan(nodes, pairs))
    return s.withColumns({"noise_ratio": F.round("noise_ratio", 9), "mean_size": F.round("mean_size", 9)})


@query(_DB.rstrip() + _IN_PAIRS + """, ways AS (SELECT idx1 AS idx, s FROM inside UNION ALL SELECT idx2, s FROM inside), t AS (SELECT idx, sum(s) AS t FROM ways GROUP BY 1)
SELECT l.idx, l.cluster_id, size AS cluster_size, round(CASE WHEN size = 1 THEN 1 ELSE coalesce(t, 0) / (size - 1) END, 9) AS avg_similarity_in_cluster FROM labels l JOIN sizes USING (cluster_id) LEFT JOIN t ON t.idx = l.idx""")
def exported_clusters(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    return graph.member_similarity(cut(graph.dbscan(nodes, pairs)), pairs).withColumn("avg_similarity_in_cluster", F.round("avg_similarity_in_cluster", 9))


@query(_DB.rstrip() + _IN_PAIRS + """, known AS (SELECT idx, cluster_id, size AS n FROM labels JOIN sizes USING (cluster_id) WHERE cluster_id >= 0), kk AS (SELECT count(DISTINCT cluster_id) AS k FROM known),
ways AS (SELECT idx1 AS i, idx2 AS j, s FROM p UNION ALL SELECT idx2, idx1, s FROM p), sims AS (SELECT w.i, x.cluster_id AS c, x.n, sum(s) AS t FROM ways w JOIN known x ON x.idx = w.j GROUP BY ALL),
ab AS (SELECT o.idx, o.n, 1 - coalesce((SELECT t FROM sims WHERE i = o.idx AND c = o.cluster_id), 0) / (o.n - 1) AS a,
  least(CASE WHEN (SELECT count(*) FROM sims WHERE i = o.idx AND c <> o.cluster_id) < (SELECT k FROM kk) - 1 THEN 1 ELSE 2 END, coalesce((SELECT min(1 - t / n) FROM sims WHERE i = o.idx AND c <> o.cluster_id), 1)) AS b FROM known o)
SELECT round(avg(CASE WHEN greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 9) AS silhouette FROM ab""")
def cluster_silhouette(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    return graph.silhouette(cut(graph.dbscan(nodes, pairs)), pairs).withColumn("silhouette", F.round("silhouette", 9))


@query(_DB.rstrip() + """, big AS (SELECT cluster_id, count(*) AS size FROM labels WHERE cluster_id >= 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
SELECT cluster_id, size, rank, idx FROM (SELECT l.cluster_id, size, l.idx, row_number() OVER (PARTITION BY l.cluster_id ORDER BY l.idx) AS rank FROM labels l JOIN big USING (cluster_id)) WHERE rank <= 5""")
def largest_clusters(spark, sf):
    """The ten largest clusters with their first five members."""
    nodes, pairs = _inputs(spark, sf)
    labels = cut(graph.dbscan(nodes, pairs).filter("cluster_id >= 0"))
    big = labels.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "cluster_id").limit(10)
    return tables.top_n(labels.join(big, "cluster_id"), ["cluster_id"], [F.col("idx")], 5).select("cluster_id", "size", "rank", "idx")


@query()
def bottom_up_clusters(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    return graph.agglomerative(nodes, pairs, 0.3)


def _letters() -> str:
    from amalgrid.plans.names import _company

    return _IN + f"""named AS (SELECT internal_id AS idx, min(name) AS company FROM all_records_clean_names WHERE internal_id IS NOT NULL GROUP BY 1),
blocks AS (SELECT idx, substr({_company('company')}, 1, 1) AS block FROM named),
e0 AS (SELECT idx1 AS a, idx2 AS b FROM p JOIN blocks x ON x.idx = idx1 JOIN blocks y ON y.idx = idx2 WHERE x.block = y.block AND 1 - s <= 0.3::DOUBLE),
e AS (SELECT a, b FROM e0 UNION SELECT b, a FROM e0), reach(idx, root) AS (SELECT idx, idx FROM nodes UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.idx),
roots AS (SELECT idx, min(root) AS root FROM reach GROUP BY 1), sized AS (SELECT idx, root, count(*) OVER (PARTITION BY root) AS n FROM roots),
first AS (SELECT block, min(idx) AS f FROM blocks GROUP BY 1),
ranked AS (SELECT root, row_number() OVER (ORDER BY f, root) - 1 AS k FROM (SELECT DISTINCT root FROM sized WHERE n > 1) JOIN blocks ON idx = root JOIN first USING (block))
SELECT idx, coalesce(k, -1) AS cluster_id FROM sized LEFT JOIN ranked USING (root)"""


@query(_letters())
def letter_density_clusters(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    names = table(spark, sf, "all_records_clean_names").filter("internal_id is not null").groupBy(F.col("internal_id").alias("idx")).agg(F.min("name").alias("company"))
    return graph.two_phase(names, pairs)


def _run(name: str, labels: str) -> str:
    """A run's summary and silhouette in SQL, from a query that ends in a table ``labels``."""
    sizes = labels + """, sizes AS (SELECT cluster_id, count(*) AS size FROM labels GROUP BY 1) SELECT count(*) FILTER (WHERE cluster_id >= 0) AS n_clusters, coalesce(sum(size) FILTER (WHERE cluster_id = -1), 0)::BIGINT AS n_noise,
  round(coalesce(sum(size) FILTER (WHERE cluster_id = -1), 0) / sum(size), 9) AS noise_ratio, round(avg(size) FILTER (WHERE cluster_id >= 0), 9) AS mean_size, quantile_cont(size, 0.5) FILTER (WHERE cluster_id >= 0) AS median_size,
  min(size) FILTER (WHERE cluster_id >= 0) AS min_size, max(size) FILTER (WHERE cluster_id >= 0) AS max_size FROM sizes"""
    silhouette = labels + """, known AS (SELECT idx, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS n FROM labels WHERE cluster_id >= 0), kk AS (SELECT count(DISTINCT cluster_id) AS k FROM known),
ways AS (SELECT idx1 AS i, idx2 AS j, s FROM p UNION ALL SELECT idx2, idx1, s FROM p), sims AS (SELECT w.i, x.cluster_id AS c, x.n, sum(s) AS t FROM ways w JOIN known x ON x.idx = w.j GROUP BY ALL),
own AS (SELECT o.idx, t FROM known o JOIN sims ON i = o.idx AND c = o.cluster_id), other AS (SELECT o.idx, count(*) AS m, min(1 - t / sims.n) AS b FROM known o JOIN sims ON i = o.idx AND c <> o.cluster_id GROUP BY 1),
ab AS (SELECT o.n, 1 - coalesce(t, 0) / nullif(o.n - 1, 0) AS a, least(CASE WHEN coalesce(m, 0) < k - 1 THEN 1 ELSE 2 END, coalesce(b, 1)) AS b FROM known o CROSS JOIN kk LEFT JOIN own USING (idx) LEFT JOIN other USING (idx))
SELECT round(avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 9) AS silhouette FROM ab"""
    return f"SELECT s.*, q.silhouette, '{name}' AS run FROM ({sizes}) s, ({silhouette}) q"


_COMPONENT_LABELS = _cc("s >= 0.7::DOUBLE") + "labels AS (SELECT idx, dense_rank() OVER (ORDER BY root) - 1 AS cluster_id FROM sized)"


@query(_run("density", _DB.rstrip()) + " UNION ALL " + _run("components", _COMPONENT_LABELS))
def clustering_runs(spark, sf):
    nodes, pairs = _inputs(spark, sf)
    runs = {"density": cut(graph.dbscan(nodes, pairs)), "components": cut(graph.threshold_clusters(nodes, pairs))}
    rows = graph.compare_runs(runs, pairs)
    return rows.withColumns({c: F.round(c, 9) for c in ("noise_ratio", "mean_size", "silhouette")})


_LISTS = """WITH RECURSIVE nodes AS (SELECT DISTINCT internal_id AS idx FROM all_records_clean_names WHERE internal_id IS NOT NULL),
m AS (SELECT internal_id AS a, unnest(matches) AS b FROM all_records_clean_names), e0 AS (SELECT a, b FROM m WHERE a <> b AND a IN (SELECT idx FROM nodes) AND b IN (SELECT idx FROM nodes)),
e AS (SELECT a, b FROM e0 UNION SELECT b, a FROM e0), reach(idx, root) AS (SELECT idx, idx FROM nodes UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.idx),
roots AS (SELECT idx, min(root) AS root FROM reach GROUP BY 1), sized AS (SELECT idx, root, count(*) OVER (PARTITION BY root) AS n FROM roots),
linked AS (SELECT idx, dense_rank() OVER (ORDER BY root) - 1 AS g FROM sized WHERE n > 1), top AS (SELECT coalesce(max(g) + 1, 0) AS t FROM linked)
"""


@query(_LISTS + "SELECT idx AS internal_id, g AS group_id FROM linked UNION ALL SELECT idx, t + row_number() OVER (ORDER BY idx) - 1 FROM sized, top WHERE n = 1")
def match_groups(spark, sf):
    r = table(spark, sf, "all_records_clean_names")
    links = r.select(F.col("internal_id").alias("idx1"), F.explode("matches").alias("idx2")).filter("idx1 <> idx2")
    return graph.group_ids(r, links)


@query(_LISTS + "SELECT (SELECT count(*) FROM sized) - (SELECT count(*) FROM linked) = (SELECT count(*) FROM sized WHERE n = 1) AS holds")
def groups_are_complete(spark, sf):
    """Records less those in groups are those without a link."""
    r = table(spark, sf, "all_records_clean_names")
    ids = r.select(F.col("internal_id").alias("idx")).filter("idx is not null").distinct()
    links = r.select(F.col("internal_id").alias("idx1"), F.explode("matches").alias("idx2")).filter("idx1 <> idx2")
    known = links.join(ids.withColumnRenamed("idx", "idx1"), "idx1", "left_semi").join(ids.withColumnRenamed("idx", "idx2"), "idx2", "left_semi")
    ends = known.select(F.col("idx1").alias("idx")).union(known.select("idx2")).distinct()
    inside = graph.components(known)
    n = ids.agg(F.count(F.lit(1)).alias("n")).crossJoin(inside.agg(F.count(F.lit(1)).alias("k"))).crossJoin(ids.join(ends, "idx", "left_anti").agg(F.count(F.lit(1)).alias("lone")))
    return n.select((F.col("n") - F.col("k") == F.col("lone")).alias("holds"))
