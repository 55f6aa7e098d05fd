"""Queries of the relational operators and the batch ledger, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from amalgrid.functions.tfidf import similar_pairs
from amalgrid.operators import learning, pairs, tables
from amalgrid.session import table
from amalgrid.streaming import ledger

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


# --- counts and profiles -------------------------------------------------------------------------


@query("SELECT type_hint, count(*) AS n FROM processed_records WHERE type_hint IS NOT NULL GROUP BY 1")
def type_counts(spark, sf):
    return tables.value_counts(table(spark, sf, "processed_records"), "type_hint")


@query("SELECT type_hint, count(*) AS n FROM processed_records GROUP BY 1")
def stored_type_counts(spark, sf):
    return ledger.type_counts(table(spark, sf, "processed_records"))


@query("SELECT gliner_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS percent FROM processed_records WHERE gliner_type IS NOT NULL GROUP BY 1")
def type_shares(spark, sf):
    return tables.shares(table(spark, sf, "processed_records"), "gliner_type").withColumn("percent", F.round("percent", 9))


@query("""SELECT count(*) AS n_rows, count(*) FILTER (WHERE coalesce(record_name, '') = '') AS n_empty, count(DISTINCT record_name) + max((record_name IS NULL)::INT) AS n_distinct,
  min(length(coalesce(record_name, ''))) AS len_min, quantile_cont(length(coalesce(record_name, '')), 0.5) AS len_median, quantile_cont(length(coalesce(record_name, '')), 0.9) AS len_p90, max(length(coalesce(record_name, ''))) AS len_max,
  round(avg((octet_length(encode(coalesce(record_name, ''))) <> length(coalesce(record_name, '')))::INT), 9) AS non_ascii_ratio FROM processed_records""")
def name_profile(spark, sf):
    return tables.profile(table(spark, sf, "processed_records"), "record_name").withColumn("non_ascii_ratio", F.round("non_ascii_ratio", 9))


@query("SELECT gliner_type, round(avg(gliner_confidence), 9) AS mean, count(gliner_confidence) AS n FROM processed_records WHERE gliner_type IS NOT NULL GROUP BY 1")
def confidence_by_type(spark, sf):
    return table(spark, sf, "processed_records").filter("gliner_type is not null").groupBy("gliner_type").agg(F.round(F.avg("gliner_confidence"), 9).alias("mean"), F.count("gliner_confidence").alias("n")).orderBy(F.desc("mean"))


@query("SELECT round(avg(gliner_confidence), 9) AS mean_confidence, round(avg((gliner_confidence >= 0.6)::INT), 9) AS sure_share FROM processed_records")
def model_confidence(spark, sf):
    c = F.col("gliner_confidence")
    return table(spark, sf, "processed_records").agg(F.round(F.avg(c), 9).alias("mean_confidence"), F.round(F.avg((c >= 0.6).cast("int")), 9).alias("sure_share"))


@query("SELECT round(avg((type_hint = gliner_type AND type_hint IS NOT NULL AND gliner_type IS NOT NULL)::INT), 9) AS agreement FROM processed_records")
def type_agreement(spark, sf):
    same = F.coalesce(F.col("type_hint") == F.col("gliner_type"), F.lit(False))
    return table(spark, sf, "processed_records").agg(F.round(F.avg(same.cast("int")), 9).alias("agreement"))


@query("""SELECT count(prediction_proba) AS n, round(avg(prediction_proba), 9) AS mean, round(stddev_samp(prediction_proba), 9) AS std, min(prediction_proba) AS lo, round(quantile_cont(prediction_proba, 0.25), 9) AS q1,
  round(quantile_cont(prediction_proba, 0.5), 9) AS q2, round(quantile_cont(prediction_proba, 0.75), 9) AS q3, max(prediction_proba) AS hi FROM pairwise_predictions""")
def score_summary(spark, sf):
    d = tables.describe(table(spark, sf, "pairwise_predictions"), "prediction_proba")
    return d.select("n", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"), "lo", F.round("q1", 9).alias("q1"), F.round("q2", 9).alias("q2"), F.round("q3", 9).alias("q3"), "hi")


@query("SELECT least(floor(levenshtein / (1.0::DOUBLE / 50)), 49)::INT AS bin, count(*) AS n FROM pairwise_predictions WHERE levenshtein BETWEEN 0 AND 1 GROUP BY 1")
def similarity_histogram(spark, sf):
    return tables.histogram(table(spark, sf, "pairwise_predictions"), "levenshtein", 50, 0, 1)


@query("SELECT coalesce(a.value, b.value) AS value, coalesce(n_first, 0) AS n_first, coalesce(n_second, 0) AS n_second FROM (SELECT type_hint AS value, count(*) AS n_first FROM processed_records WHERE type_hint IS NOT NULL GROUP BY 1) a FULL JOIN (SELECT gliner_type AS value, count(*) AS n_second FROM processed_records WHERE gliner_type IS NOT NULL GROUP BY 1) b ON a.value = b.value")
def aligned_type_counts(spark, sf):
    return tables.aligned_counts(table(spark, sf, "processed_records"), "type_hint", "gliner_type")


@query("""WITH x AS (SELECT prediction AS p, prediction_proba AS s, (levenshtein >= 0.5)::INT AS y FROM pairwise_predictions WHERE prediction IS NOT NULL AND levenshtein IS NOT NULL),
m AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p <> 1) AS fn, count(*) FILTER (WHERE y <> 1 AND p <> 1) AS tn FROM x),
g AS (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM x WHERE s IS NOT NULL GROUP BY 1),
r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 9) AS accuracy, round(tp / (tp + fp)::DOUBLE, 9) AS precision, round(tp / (tp + fn)::DOUBLE, 9) AS recall, round(2.0 * tp / (2 * tp + fp + fn), 9) AS f1,
  (SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) FROM r) AS roc_auc FROM m""")
def match_metrics(spark, sf):
    rows = table(spark, sf, "pairwise_predictions").filter("levenshtein is not null").select("prediction", "prediction_proba", (F.col("levenshtein") >= 0.5).cast("int").alias("label"))
    m = tables.binary_metrics(rows, "label", "prediction", "prediction_proba")
    return m.select("tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")])


@query("SELECT count(*) AS n, round(avg(label), 9) AS positive_rate, count(*) FILTER (WHERE label = 1) AS positives FROM labelled_pairs WHERE company1 IS NOT NULL AND company2 IS NOT NULL AND label IS NOT NULL")
def training_labels(spark, sf):
    rows = learning.load_pairs(table(spark, sf, "labelled_pairs"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("label"), 9).alias("positive_rate"), F.count_if(F.col("label") == 1).alias("positives"))


@query("SELECT count(DISTINCT clean_name) AS n_distinct, (SELECT count(*) FROM (SELECT clean_name FROM all_records_clean_names WHERE clean_name IS NOT NULL GROUP BY 1 HAVING count(*) = 1)) AS n_single FROM all_records_clean_names")
def clean_name_counts(spark, sf):
    sizes = table(spark, sf, "all_records_clean_names").filter("clean_name is not null").groupBy("clean_name").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("n_distinct"), F.count_if(F.col("n") == 1).alias("n_single"))


# --- projections, filters, joins -----------------------------------------------------------------


@query("SELECT DISTINCT idx1, idx2, prediction_proba, coalesce(prediction_proba >= 0.7, false) AS is_match FROM pairwise_predictions")
def match_flags(spark, sf):
    p = table(spark, sf, "pairwise_predictions")
    return p.select("idx1", "idx2", "prediction_proba", tables.is_match(F.col("prediction_proba")).alias("is_match")).distinct()


@query("""WITH c AS (SELECT min(company1) AS name FROM pairwise_predictions), m AS (SELECT * FROM pairwise_predictions, c WHERE company1 = name OR company2 = name)
SELECT CASE WHEN company1 = name THEN company2 ELSE company1 END AS similar_company, prediction_proba AS similarity_score FROM m WHERE prediction_proba >= 0.1 ORDER BY similarity_score DESC, similar_company LIMIT 10""")
def similar_to_first(spark, sf):
    p = table(spark, sf, "pairwise_predictions")
    name = p.agg(F.min("company1")).first()[0]
    return tables.similar_companies(p, name, 10, 0.1)


@query("SELECT idx1, idx2, max(prediction_proba) AS score FROM (SELECT least(idx1, idx2) AS idx1, greatest(idx1, idx2) AS idx2, prediction_proba FROM pairwise_predictions WHERE idx1 <> idx2) GROUP BY 1, 2")
def undirected_scores(spark, sf):
    return tables.undirected_best(table(spark, sf, "pairwise_predictions").withColumnRenamed("prediction_proba", "score"), "idx1", "idx2", "score")


@query("SELECT idx1, idx2 FROM pairwise_predictions UNION SELECT idx2, idx1 FROM pairwise_predictions")
def symmetric_pairs(spark, sf):
    return tables.symmetric(table(spark, sf, "pairwise_predictions"), "idx1", "idx2")


@query("SELECT DISTINCT internal_id, name FROM all_records_clean_names WHERE internal_id IN (SELECT unnest(matches) FROM all_records_clean_names)")
def matched_rows(spark, sf):
    r = table(spark, sf, "all_records_clean_names")
    return tables.rows_of(r, r.select(F.explode("matches").alias("internal_id")), "internal_id").select("internal_id", "name").distinct()


@query("SELECT DISTINCT record_id FROM processed_records WHERE record_id NOT IN (SELECT internal_id FROM all_records_clean_names WHERE internal_id IS NOT NULL)")
def unlisted_records(spark, sf):
    return tables.without(table(spark, sf, "processed_records"), table(spark, sf, "all_records_clean_names").select(F.col("internal_id").alias("record_id")), "record_id").select("record_id").distinct()


@query("SELECT DISTINCT r.internal_id, r.name, p.batch_id FROM all_records_clean_names r JOIN processed_records p ON r.internal_id = p.record_id")
def records_with_batch(spark, sf):
    r, p = table(spark, sf, "all_records_clean_names"), table(spark, sf, "processed_records").select(F.col("record_id").alias("internal_id"), "batch_id")
    return r.select("internal_id", "name").join(p, "internal_id").distinct()


@query("SELECT DISTINCT internal_id, list_distinct(list_filter(coalesce(matches, []), lambda m: m IS NOT NULL AND m <> internal_id)).list_sort() AS matches FROM all_records_clean_names")
def clean_match_lists(spark, sf):
    from amalgrid.operators.graph import clean_matches

    r = table(spark, sf, "all_records_clean_names")
    return r.select("internal_id", F.sort_array(clean_matches(F.col("internal_id"), F.col("matches"))).alias("matches")).distinct()


@query("SELECT count(*) FILTER (WHERE group_id IS NULL) AS without_group, count(*) FILTER (WHERE len(coalesce(matches, [])) = 0) AS without_match FROM all_records_clean_names")
def open_records(spark, sf):
    r = table(spark, sf, "all_records_clean_names")
    return r.agg(F.count_if(F.col("group_id").isNull()).alias("without_group"), F.count_if(F.coalesce(F.size("matches"), F.lit(0)) <= 0).alias("without_match"))


def _suppliers(spark, sf):
    """Names for the operators that compare all with all by definition: a list that grows, and stays small."""
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("idx"), F.col("s_name").alias("company"))


@query("SELECT a.s_suppkey AS idx1, b.s_suppkey AS idx2, a.s_name AS company1, b.s_name AS company2 FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey")
def all_name_pairs(spark, sf):
    return pairs.all_pairs(_suppliers(spark, sf))


@query("SELECT a.p_partkey AS idx1, b.p_partkey AS idx2 FROM part a JOIN part b ON a.p_partkey < b.p_partkey AND lower(a.p_name[1]) = lower(b.p_name[1])")
def block_name_pairs(spark, sf):
    return pairs.block_pairs(table(spark, sf, "part").select(F.col("p_partkey").alias("idx"), F.col("p_name").alias("company")))


@query()
def listed_block_pairs(spark, sf):
    """How many pairs each first-letter block of the listed names has; a hot letter is split among tasks."""
    names = table(spark, sf, "all_records_clean_names").filter("internal_id is not null").groupBy(F.col("internal_id").alias("idx")).agg(F.min("name").alias("company"))
    made = pairs.block_pairs(names, keep_block=True)
    return made.groupBy("block").agg(F.count(F.lit(1)).alias("pairs"))


@query("SELECT a.s_suppkey AS i, b.s_suppkey AS j, levenshtein(a.s_name, b.s_name)::DOUBLE AS score FROM supplier a JOIN supplier b ON a.s_suppkey <> b.s_suppkey")
def compared_names(spark, sf):
    return pairs.compared(_suppliers(spark, sf), lambda a, b: F.levenshtein(a, b).cast("double"))


# --- rankings, ids, sets -------------------------------------------------------------------------


@query("WITH c AS (SELECT source_list, count(*) AS n FROM processed_records WHERE source_list IS NOT NULL GROUP BY 1) SELECT source_list, n, row_number() OVER (ORDER BY n DESC, source_list) AS rank, round(sum(n) OVER (ORDER BY n DESC, source_list) / sum(n) OVER (), 9) AS cumulative_share FROM c")
def list_rank_frequency(spark, sf):
    return tables.rank_frequency(table(spark, sf, "processed_records"), "source_list").withColumn("cumulative_share", F.round("cumulative_share", 9))


@query("SELECT clean_name, dense_rank() OVER (ORDER BY clean_name COLLATE \"C\") - 1 AS id FROM (SELECT DISTINCT clean_name FROM all_records_clean_names WHERE clean_name IS NOT NULL)")
def dense_name_ids(spark, sf):
    return tables.dense_ids(table(spark, sf, "all_records_clean_names"), "clean_name")


@query("WITH m AS (SELECT max(record_id) AS top FROM processed_records) SELECT line_id, top + row_number() OVER (ORDER BY line_id) AS id FROM raw_records, m")
def continued_record_ids(spark, sf):
    return tables.continued_ids(table(spark, sf, "raw_records"), "line_id", table(spark, sf, "processed_records"), "record_id")


@query("SELECT ((rn - 1) // 500)::BIGINT AS batch, min(record_id) AS start_id, max(record_id) AS end_id, count(*) AS n FROM (SELECT record_id, row_number() OVER (ORDER BY record_id) AS rn FROM (SELECT DISTINCT record_id FROM processed_records WHERE record_id IS NOT NULL)) GROUP BY 1")
def batch_bounds(spark, sf):
    return tables.batch_plan(table(spark, sf, "processed_records"), "record_id", 500)


@query("SELECT record_name, min(record_id) AS record_id FROM processed_records GROUP BY 1")
def first_spellings(spark, sf):
    return tables.first_occurrences(table(spark, sf, "processed_records"), "record_name", "record_id")


@query("SELECT row_number() OVER (ORDER BY company COLLATE \"C\") - 1 AS idx, company FROM (SELECT trim(n_name) AS company FROM nation UNION SELECT trim(c_name) FROM customer UNION SELECT trim(s_name) FROM supplier) WHERE company <> ''")
def sheet_names(spark, sf):
    return tables.union_sheets([table(spark, sf, t) for t in ("nation", "customer", "supplier")])


@query("SELECT source_list, record_id, processed_at, rank FROM (SELECT source_list, record_id, processed_at, row_number() OVER (PARTITION BY source_list ORDER BY processed_at DESC, record_id) AS rank FROM (SELECT DISTINCT source_list, record_id, processed_at FROM processed_records)) WHERE rank <= 3")
def latest_of_list(spark, sf):
    rows = table(spark, sf, "processed_records").select("source_list", "record_id", "processed_at").distinct()
    return tables.top_n(rows, ["source_list"], [F.col("processed_at").desc_nulls_last(), F.col("record_id")], 3)


# --- ledger --------------------------------------------------------------------------------------

_LATEST = """WITH b AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY coalesce(completed_at, started_at) DESC NULLS LAST, CASE status WHEN 'COMPLETED' THEN 2 WHEN 'FAILED' THEN 1 ELSE 0 END DESC, start_index DESC, end_index DESC, total_records DESC, config_hash DESC) AS r FROM processing_batches),
latest AS (SELECT * EXCLUDE r FROM b WHERE r = 1) """


@query(_LATEST + "SELECT batch_id, status FROM latest")
def batch_states(spark, sf):
    return ledger.latest_batches(table(spark, sf, "processing_batches")).select("batch_id", "status")


@query(_LATEST + "SELECT count(*) AS total_batches, count(*) FILTER (WHERE status = 'COMPLETED') AS completed, count(*) FILTER (WHERE status = 'FAILED') AS failed, count(*) FILTER (WHERE status = 'STARTED') AS open FROM latest")
def batch_statistics(spark, sf):
    return ledger.batch_status(ledger.latest_batches(table(spark, sf, "processing_batches")))


@query("SELECT record_id, record_name, orig, norm, display_name, canonical_name, match_key_strict, match_key_aggressive, type_hint, gliner_type, gliner_confidence, batch_id, processed_at FROM processed_records")
def exported_records(spark, sf):
    return ledger.export_columns(table(spark, sf, "processed_records"), True).orderBy("record_id")


@query("SELECT log_level, count(*) AS n FROM processing_logs GROUP BY 1")
def log_levels(spark, sf):
    return table(spark, sf, "processing_logs").groupBy("log_level").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH d AS (SELECT DISTINCT * FROM labelled_pairs WHERE company1 IS NOT NULL AND company2 IS NOT NULL AND label IS NOT NULL),
r AS (SELECT label, (row_number() OVER (PARTITION BY label ORDER BY company1, company2) - 1) / nullif(count(*) OVER (PARTITION BY label) - 1, 0)::DOUBLE AS place FROM d)
SELECT label, CASE WHEN coalesce(place, 0) < 0.2::DOUBLE THEN 'test' WHEN place < 0.2::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'train' END AS part, count(*) AS n FROM r GROUP BY ALL""")
def split_label_counts(spark, sf):
    """The exact counts of each label in each part of a stratified split of the distinct pairs."""
    rows = learning.stratified_split(learning.load_pairs(table(spark, sf, "labelled_pairs")).distinct())
    return rows.groupBy("label", "part").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH d AS (SELECT DISTINCT * FROM labelled_pairs), r AS (SELECT (row_number() OVER () - 1) / (count(*) OVER () - 1)::DOUBLE AS place FROM d)
SELECT CASE WHEN place < 0.2::DOUBLE THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM r GROUP BY 1""")
def plain_split_counts(spark, sf):
    return learning.plain_split(table(spark, sf, "labelled_pairs").distinct()).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query()
def pair_model_metrics(spark, sf):
    """Test metrics of a boosted classifier trained on the labelled pairs, with all its rounds."""
    return learning.train_and_evaluate(table(spark, sf, "labelled_pairs"))[1]


_BEST = "WITH best AS (SELECT least(idx1, idx2) AS idx1, greatest(idx1, idx2) AS idx2, max(levenshtein) AS score FROM pairwise_predictions WHERE idx1 <> idx2 GROUP BY 1, 2) "


def _best(spark, sf):
    p = table(spark, sf, "pairwise_predictions").withColumnRenamed("levenshtein", "score")
    return tables.undirected_best(p, "idx1", "idx2", "score")


@query(_BEST + "SELECT idx1, idx2, score FROM best WHERE score < 0.99999::DOUBLE")
def inexact_pairs(spark, sf):
    return tables.without_exact(_best(spark, sf), "score")


@query(_BEST + """SELECT * FROM (SELECT *, 'head' AS side FROM best WHERE score IS NOT NULL ORDER BY score DESC, idx1 DESC, idx2 DESC LIMIT 10) UNION ALL
SELECT * FROM (SELECT *, 'tail' AS side FROM best WHERE score IS NOT NULL ORDER BY score, idx1, idx2 LIMIT 10)""")
def score_ends(spark, sf):
    return tables.head_and_tail(_best(spark, sf).filter("score is not null"), ["score", "idx1", "idx2"], 10)


_NAMED = _BEST + ", named AS (SELECT internal_id, min(name) AS name FROM all_records_clean_names GROUP BY 1) SELECT a.name AS left_side, b.name AS right_side, score AS similarity FROM best JOIN named a ON a.internal_id = idx1 JOIN named b ON b.internal_id = idx2"


def _named(spark, sf):
    names = table(spark, sf, "all_records_clean_names").groupBy("internal_id").agg(F.min("name").alias("name"))
    a, b = (names.select(F.col("internal_id").alias(f"idx{k}"), F.col("name").alias(f"company{k}")) for k in (1, 2))
    return _best(spark, sf).join(a, "idx1").join(b, "idx2")


@query(_NAMED)
def match_frame(spark, sf):
    return tables.match_frame(_named(spark, sf), None, "score")


@query(_NAMED + " ORDER BY idx1, idx2 LIMIT 100")
def first_matches(spark, sf):
    return tables.match_frame(_named(spark, sf), 100, "score")


@query(_BEST + """, n AS (SELECT count(DISTINCT internal_id) AS n FROM all_records_clean_names), k AS (SELECT count(score) AS k FROM best),
seen AS (SELECT least(floor(score / (1.0::DOUBLE / 50)), 49)::INT AS bin, count(*) AS c FROM best WHERE score BETWEEN 0 AND 1 GROUP BY 1)
SELECT bin, sum(c)::BIGINT AS n FROM (SELECT * FROM seen UNION ALL SELECT 0, n * (n - 1) // 2 - k FROM n, k) GROUP BY 1""")
def pair_score_histogram(spark, sf):
    """The scores of all pairs of listed records, those that were never scored as 0."""
    nodes = table(spark, sf, "all_records_clean_names").select(F.col("internal_id").alias("idx"))
    return tables.pair_histogram(_best(spark, sf), "score", nodes, 50)


@query("""WITH x AS (SELECT (levenshtein >= 0.5)::INT AS y, prediction AS p FROM pairwise_predictions WHERE levenshtein IS NOT NULL AND prediction IS NOT NULL),
c AS (SELECT DISTINCT y AS k FROM x UNION SELECT p FROM x),
m AS (SELECT k, count(*) FILTER (WHERE y = k AND p = k) AS hit, count(*) FILTER (WHERE y = k) AS support, count(*) FILTER (WHERE p = k) AS said FROM c, x GROUP BY 1),
f AS (SELECT k::VARCHAR AS class, coalesce(hit / nullif(said, 0)::DOUBLE, 0) AS precision, coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS recall, coalesce(2.0 * hit / nullif(said + support, 0), 0) AS f1, support FROM m)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM f""")
def match_class_report(spark, sf):
    rows = table(spark, sf, "pairwise_predictions").filter("levenshtein is not null").select("prediction", (F.col("levenshtein") >= 0.5).cast("int").alias("label"))
    r = tables.class_report(rows)
    return r.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query()
def component_shares(spark, sf):
    """Explained and cumulative variance, and each feature's loading, of two principal components."""
    features = ["levenshtein", "jaccard", "cosine", "hamming", "damerau_levenshtein", "editex"]
    model, _ = learning.principal_components(table(spark, sf, "pairwise_predictions").dropna(subset=features), features)
    # A component's sign is arbitrary.
    rows = [(k, name, round(share, 9), round(upto, 9), round(v * v, 9)) for k, share, upto, loads in learning.component_report(model, features) for name, v in loads.items()]
    return spark.createDataFrame(rows, "component int, feature string, explained double, cumulative double, contribution double")


@query()
def predicted_matches(spark, sf):
    """Pairs of the labelled names that share letter triples, scored by a model trained on the labelled pairs."""
    labelled = table(spark, sf, "labelled_pairs")
    model, _ = learning.train_and_evaluate(labelled, rounds=20)
    names = tables.dense_ids(labelled.select(F.col("company1").alias("company")).union(labelled.select("company2")), "company", "idx")
    found = learning.predict_pairs(model, names, candidates=similar_pairs(names, 0.5))
    return found.filter("prediction = 1").select("idx1", "idx2", "company1", "company2", F.round("prediction_proba", 6).alias("prediction_proba"))


@query()
def feature_components(spark, sf):
    """The scored pairs' features projected on their first two principal components."""
    from pyspark.ml.functions import vector_to_array

    features = ["levenshtein", "jaccard", "cosine", "hamming", "damerau_levenshtein", "editex"]
    rows = table(spark, sf, "pairwise_predictions").dropna(subset=features)
    made = learning.principal_components(rows, features)[1].withColumn("pcs", vector_to_array("pcs"))
    return made.select("idx1", "idx2", F.col("pcs")[0].alias("pc1"), F.col("pcs")[1].alias("pc2"))
