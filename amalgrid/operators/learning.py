"""Pair scoring: splits, a boosted classifier, scoring, and a plug-in for entity types."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.functions.cleaning import route_type
from amalgrid.functions.similarity import BASE_FEATURES, add_features
from amalgrid.operators.pairs import all_pairs
from amalgrid.operators.tables import binary_metrics, is_match, running_totals

# Parameters of training and matching.
TEST_SIZE, VALIDATION_SIZE, SEED, MATCH_THRESHOLD = 0.2, 0.1, 42, 0.7


def load_pairs(df: DataFrame, label: str = "label") -> DataFrame:
    """Pairs with both names and a label; raises where a column is missing."""
    missing = [c for c in ("company1", "company2", label) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.filter(f"company1 is not null and company2 is not null and {label} is not null")


def _places(df: DataFrame, group: Column, seed: int) -> DataFrame:
    """``df`` with ``_at``: the share of its group's rows that come before it in the order of a seeded hash; equal rows share a place.

    Hashes are range-partitioned over all tasks, whatever the number of groups.
    """
    key = F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)], F.lit(seed))
    rows = df.withColumns({"_group": group, "_key": key})
    sizes = rows.groupBy("_group", "_key").agg(F.count(F.lit(1)).alias("_n"))
    upto = running_totals(sizes, [F.col("_group"), F.col("_key")], {"_upto": "_n"})
    whole = upto.groupBy(F.col("_group").alias("_whole")).agg(F.sum("_n").alias("_all"), F.min(F.col("_upto") - F.col("_n")).alias("_base"))
    before = F.col("_upto") - F.col("_n") - F.col("_base")
    at = upto.join(whole, F.col("_group").eqNullSafe(F.col("_whole"))).select(F.col("_group").alias("_g"), F.col("_key").alias("_k"), F.when(F.col("_all") > 1, before / (F.col("_all") - 1)).otherwise(0.0).alias("_at"))
    return rows.join(at, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_key") == F.col("_k"))).drop("_group", "_key", "_g", "_k")


def stratified_split(df: DataFrame, label: str = "label", test: float = TEST_SIZE, validation: float = VALIDATION_SIZE, seed: int = SEED) -> DataFrame:
    """``df`` with ``part``: each label's rows in the order of a seeded hash, so the shares are exact per label."""
    out = _places(df, F.col(label), seed)
    return out.withColumn("part", F.when(F.col("_at") < test, "test").when(F.col("_at") < test + validation, "validation").otherwise("train")).drop("_at")


def plain_split(df: DataFrame, test: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """``df`` with ``part`` (test or train), without regard to labels."""
    return _places(df, F.lit(0), seed).withColumn("part", F.when(F.col("_at") < test, "test").otherwise("train")).drop("_at")


def train(df: DataFrame, features: list[str] = BASE_FEATURES, label: str = "label", rounds: int = 100, seed: int = SEED):
    """A fitted pipeline over feature columns; rows whose ``part`` is validation stop it early."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = df.filter("part <> 'test'").withColumn("is_validation", F.col("part") == "validation").withColumn(label, F.col(label).cast("double"))
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, stepSize=0.05, maxDepth=5, minInstancesPerNode=20, subsamplingRate=0.8, featureSubsetStrategy="0.8", validationIndicatorCol="is_validation", seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), gbt]).fit(rows)


def score(model, pairs: DataFrame, threshold: float = MATCH_THRESHOLD) -> DataFrame:
    """``pairs`` with prediction (at one half), prediction_proba and is_match (at the threshold)."""
    from pyspark.ml.functions import vector_to_array

    made = model.transform(pairs).withColumn("prediction_proba", vector_to_array("probability")[1])
    return made.withColumns({"prediction": F.col("prediction").cast("int"), "is_match": is_match(F.col("prediction_proba"), threshold)}).drop("features", "rawPrediction", "probability")


def importance(model, features: list[str] = BASE_FEATURES) -> list[tuple[str, float]]:
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, values)), key=lambda x: -x[1])


def train_and_evaluate(pairs: DataFrame, features: list[str] = BASE_FEATURES, rounds: int = 100):
    """(model, metrics row of the test part) from raw labelled pairs."""
    rows = stratified_split(add_features(load_pairs(pairs)))
    model = train(rows, features, rounds=rounds)
    return model, binary_metrics(score(model, rows.filter("part = 'test'")), "label", "prediction", "prediction_proba")


def save_model(model, path: str) -> None:
    """The fitted pipeline at ``path``, in place of what was there."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """The pipeline saved at ``path``; FileNotFoundError where there is none."""
    from pyspark.ml import PipelineModel

    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(path)
    return PipelineModel.load(path)


def train_pipeline(pairs: DataFrame, model_path: str, features: list[str] = BASE_FEATURES, rounds: int = 100):
    """(model, metrics row) from raw labelled pairs; the model is saved."""
    model, metrics = train_and_evaluate(pairs, features, rounds)
    save_model(model, model_path)
    return model, metrics


def predict_pairs(model, names: DataFrame, threshold: float = MATCH_THRESHOLD, candidates: DataFrame | None = None) -> DataFrame:
    """Features, prediction_proba and prediction (1 from the threshold on) of pairs of ``names(idx, company)``.

    All pairs, by definition for small lists; ``candidates(idx1, idx2)``, from blocks or TF-IDF, keeps it to some.
    """
    if candidates is None:
        made = all_pairs(names)
    else:
        a = names.select(F.col("idx").alias("idx1"), F.col("company").alias("company1"))
        b = names.select(F.col("idx").alias("idx2"), F.col("company").alias("company2"))
        made = candidates.select("idx1", "idx2").join(a, "idx1").join(b, "idx2")
    scored = score(model, add_features(made), threshold)
    return scored.withColumn("prediction", F.col("is_match").cast("int")).drop("is_match")


def best_model(models: dict, validation: dict[str, DataFrame]) -> str:
    """The name of the model with the best F1 on its validation rows."""
    f1 = {k: binary_metrics(score(m, validation[k])).first().f1 for k, m in models.items()}
    return max(sorted(f1), key=lambda k: f1[k])


def principal_components(df: DataFrame, features: list[str], k: int = 2):
    """(model, transformed): centred and scaled features projected on their first components (column ``pcs``)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    stages = [VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True), PCA(k=k, inputCol="_std", outputCol="pcs")]
    model = Pipeline(stages=stages).fit(df)
    return model, model.transform(df).drop("_raw", "_std")


def component_report(model, features: list[str]) -> list[tuple[int, float, float, dict[str, float]]]:
    """(component, explained share of variance, share so far, loading of each feature) of ``principal_components``."""
    pca = model.stages[-1]
    shares = pca.explainedVariance.toArray()
    loadings = pca.pc.toArray()
    return [(k + 1, float(v), float(shares[: k + 1].sum()), {f: float(loadings[i, k]) for i, f in enumerate(features)}) for k, v in enumerate(shares)]


# --- entity types --------------------------------------------------------------------------------

# Prompts by strategy.
PROMPTS = {"neutral": "Classify the following: {}", "explicit": "{} could be a company name, person's name, address, financial instrument, or other type of entity.", "minimal": "Entity: {}", "none": "{}"}


def prompt(column: str, strategy: str = "neutral"):
    before, after = PROMPTS.get(strategy, PROMPTS["neutral"]).split("{}")
    return F.concat(F.lit(before), F.col(column), F.lit(after))


Found = list[tuple[str, float]]


def best_entity(found: Found | tuple[str, float] | None) -> tuple[str, float]:
    """The surest of a text's entities in lower case; ("ambiguous", 0.0) where the model found none."""
    if not found:
        return "ambiguous", 0.0
    label, sure = found if isinstance(found, tuple) else max(found, key=lambda e: e[1] or 0.0)
    return str(label).lower(), float(sure or 0.0)


def classify_one(text: str | None, model: Callable[[list[str]], list], strategy: str = "neutral") -> tuple[str, float]:
    """One text's type: ("unknown", 0.0) for an empty one."""
    if not text or not isinstance(text, str):
        return "unknown", 0.0
    return best_entity(model([PROMPTS.get(strategy, PROMPTS["neutral"]).replace("{}", text, 1)])[0])


def classify(df: DataFrame, load: Callable[[], Callable[[list[str]], list]], column: str = "norm", strategy: str = "neutral", unknown: bool = True) -> DataFrame:
    """``df`` with gliner_type and gliner_confidence of a model that each worker loads once.

    The model gets Arrow batches of prompts and gives a (label, confidence), or a list of these, for each; nothing
    found is ("ambiguous", 0.0). Empty texts are ("unknown", 0.0) and never reach the model; without ``unknown``
    they go to it like any other.
    """

    @F.pandas_udf("struct<gliner_type:string,gliner_confidence:double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for s in parts:
            asked = s.notna()
            out = [("unknown", 0.0)] * len(s)
            for at, found in zip(asked[asked].index, model(s[asked].tolist()) if asked.any() else ()):
                out[s.index.get_loc(at)] = best_entity(found)
            yield pd.DataFrame(out, columns=["gliner_type", "gliner_confidence"])

    text = F.coalesce(F.col(column), F.lit(""))
    made = df.withColumn("_p", text).withColumn("_p", F.when((text != "") | F.lit(not unknown), prompt("_p", strategy)))
    made = made.withColumn("_m", run("_p"))
    return made.withColumns({"gliner_type": F.col("_m.gliner_type"), "gliner_confidence": F.col("_m.gliner_confidence")}).drop("_m", "_p")


def classify_by_rules(df: DataFrame, column: str = "norm") -> DataFrame:
    """The deterministic stand-in for a model: the rule's type with confidence 1, ("unknown", 0) for an empty text."""
    empty = F.coalesce(F.col(column), F.lit("")) == ""
    return df.withColumns({"gliner_type": F.when(empty, "unknown").otherwise(route_type(column)), "gliner_confidence": F.when(empty, F.lit(0.0)).otherwise(F.lit(1.0))})
