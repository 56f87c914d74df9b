"""Sampling, training and use of pair classifiers on pyspark.ml."""

from __future__ import annotations

import random

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import evaluate


def order_hash(*keys: str, seed: int = 42) -> Column:
    """A hash of the keys that orders rows at random, the same on every run."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def sample_rows(df: DataFrame, n: int, *keys: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, those of the smallest hashes of their keys.

    Rows are counted by the first digits of the hash: all below the border go in as they are, and only those on the border are
    ordered, so no task sorts the sample.
    """
    digits = F.substring("__h", 1, 3)  # 4096 counts
    marked = df.withColumn("__h", order_hash(*keys, seed=seed))
    total = 0
    for border, count in sorted(map(tuple, marked.groupBy(digits).agg(F.count("*")).collect())):
        if total + count > n:
            below, edge = marked.where(digits < border), marked.where(digits == border).orderBy("__h", *keys).limit(n - total)
            return below.unionByName(edge).drop("__h")
        total += count
    return df


def training_set(pairs: DataFrame, *keys: str, ratio: int = 10, cap: int = 1_200_000, hard_share: float = 0.5, hard_at: float = 0.92, mixed_times: int = 2, seed: int = 42) -> DataFrame:
    """All positives, then hard, random and organisation-person negatives; a negative may be drawn more than once.

    Negatives are ratio to one, and with the positives at most cap: half of them, as far as there are any, pairs with similar
    names, and half from all. Organisation-person pairs, twice as many as hard ones are meant, come on top.
    """
    positives = pairs.where("y = 1").withColumn("origin", F.lit("positive"))
    negatives = pairs.where("y = 0")
    n_pos = positives.count()
    total = max(0, min(ratio * n_pos, cap - n_pos))
    n_hard = int(total * hard_share)
    alike = (F.col("sim_jw_lastname") >= hard_at) | (F.col("sim_jw_fullname") >= hard_at)
    parts = (
        ("hard", negatives.where(alike), n_hard, seed),
        ("random", negatives, total - n_hard, seed + 1),
        ("org_person", negatives.where("org_vs_person_conflict = 1"), mixed_times * n_hard, seed + 3),
    )
    out = positives
    for origin, pool, n, own_seed in parts:
        out = out.unionByName(sample_rows(pool, n, *keys, seed=own_seed).withColumn("origin", F.lit(origin)))
    return out


def fold(group: str, folds: int, seed: int = 42) -> Column:
    """Fold of a group, from its hash, so that no group is in two folds."""
    return (F.conv(F.substring(order_hash(group, seed=seed), 1, 7), 16, 10).cast("long") % folds).cast("int")


def holdout(df: DataFrame, group: str, parts: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows; a group is in one of them only."""
    marked = df.withColumn("__f", fold(group, parts, seed))
    return marked.where("__f <> 0").drop("__f"), marked.where("__f = 0").drop("__f")


def balanced(df: DataFrame) -> DataFrame:
    """df with weight, so that both classes weigh as much."""
    counts = df.groupBy("y").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"), F.count("*").alias("k"))
    weights = counts.crossJoin(F.broadcast(total)).select("y", (F.col("t") / (F.col("k") * F.col("n"))).alias("weight"))  # a row per class
    return df.join(F.broadcast(weights), "y")


def estimators(features: list[str], seed: int = 42) -> dict[str, Pipeline]:
    """The three classifiers, each with its assembly of features."""
    assemble = VectorAssembler(inputCols=features, outputCol="raw")
    scale = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
    own = dict(labelCol="y", weightCol="weight")
    trees = dict(featuresCol="raw", seed=seed, **own)
    return {
        "logreg": Pipeline(stages=[assemble, scale, LogisticRegression(maxIter=50, regParam=0.01, **own)]),
        "random_forest": Pipeline(stages=[assemble, RandomForestClassifier(numTrees=20, maxDepth=6, **trees)]),
        "grad_boost": Pipeline(stages=[assemble, GBTClassifier(maxIter=10, maxDepth=4, **trees)]),
    }


def search(df: DataFrame, pipeline: Pipeline, grid: dict, group: str, iterations: int, folds: int = 3, seed: int = 42):
    """Randomised search by PR area over folds of groups; grid: parameter name of the last stage to values."""
    last = pipeline.getStages()[-1]
    build = ParamGridBuilder()
    for name, values in grid.items():
        build = build.addGrid(last.getParam(name), values)
    every = build.build()
    chosen = random.Random(seed).sample(every, min(iterations, len(every)))
    score = BinaryClassificationEvaluator(labelCol="y", metricName="areaUnderPR")
    tuner = CrossValidator(estimator=pipeline, estimatorParamMaps=chosen, evaluator=score, numFolds=folds, foldCol="fold", parallelism=2)
    return tuner.fit(df.withColumn("fold", fold(group, folds, seed)))


def predict(model: Model, df: DataFrame) -> DataFrame:
    """df with score, the probability of label 1."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        score = vector_to_array("probability")[1]
    elif "rawPrediction" in scored.columns:
        score = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    else:
        score = F.col("prediction").cast("double")
    return scored.withColumn("score", score).select(*df.columns, "score")


def out_of_fold(df: DataFrame, pipeline: Pipeline, group: str, folds: int = 3, seed: int = 42) -> DataFrame:
    """df with score from models that did not see the row's group."""
    marked = df.withColumn("fold", fold(group, folds, seed)).cache()
    parts = []
    for k in range(folds):
        model = pipeline.fit(balanced(marked.where(F.col("fold") != k)))
        parts.append(predict(model, marked.where(F.col("fold") == k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def calibrate(scored: DataFrame, kind: str) -> Model:
    """A map from out-of-fold score to probability: 'sigmoid' or 'isotonic'."""
    if kind == "isotonic":
        return IsotonicRegression(featuresCol="score", labelCol="y", predictionCol="calibrated").fit(scored.withColumn("y", F.col("y").cast("double")))
    margin = VectorAssembler(inputCols=["margin"], outputCol="m")
    safe = scored.withColumn("margin", _logit(F.col("score")))
    return Pipeline(stages=[margin, LogisticRegression(featuresCol="m", labelCol="y", probabilityCol="cp", rawPredictionCol="cr", predictionCol="cpred")]).fit(safe)


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(inside / (1 - inside))


def apply_calibration(model: Model, scored: DataFrame) -> DataFrame:
    """scored with its score calibrated."""
    out = model.transform(scored.withColumn("margin", _logit(F.col("score"))))
    value = F.col("calibrated") if "calibrated" in out.columns else vector_to_array("cp")[1]
    return out.withColumn("score", value).select(*scored.columns)


def select_model(df: DataFrame, features: list[str], group: str, seed: int = 42) -> DataFrame:
    """model, pr_auc, roc_auc of each classifier on the held-out groups, best first."""
    train, test = holdout(df, group, seed=seed)
    train, test = balanced(train).cache(), test.cache()
    out = None
    for name, pipeline in estimators(features, seed).items():
        scored = predict(pipeline.fit(train), test)
        row = evaluate.average_precision(scored).crossJoin(evaluate.roc_auc(scored)).select(F.lit(name).alias("model"), "pr_auc", "roc_auc")
        out = row if out is None else out.unionByName(row)
    return out.orderBy(F.desc("pr_auc"), "model")


def permutation_importance(model: Model, df: DataFrame, features: list[str], key: str, repeats: int = 5, seed: int = 42) -> DataFrame:
    """feature, drop: mean loss of average precision when a feature's values are dealt anew among the rows.

    Values change places by joining two hash orders of the rows; number by number, within blocks of the hash.
    """
    base = evaluate.average_precision(predict(model, df)).first().pr_auc
    rows = []
    for f in features:
        lost = 0.0
        for r in range(repeats):
            block = F.substring(order_hash(key, seed=seed), 1, 2)
            spot = lambda s, b=block: F.row_number().over(W.partitionBy(b).orderBy(order_hash(key, seed=s), key))
            here = df.withColumns({"__b": block, "__i": spot(seed + 1)}).drop(f)
            there = df.select(block.alias("__b"), spot(seed + 2 + r).alias("__i"), f)
            shuffled = here.join(there, ["__b", "__i"]).drop("__b", "__i")
            lost += base - evaluate.average_precision(predict(model, shuffled)).first().pr_auc
        rows.append((f, lost / repeats))
    return df.sparkSession.createDataFrame(rows, "feature string, drop double")


def uncertain(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n rows with scores nearest one half."""
    return df.orderBy(F.abs(F.col("score") - 0.5), *keys).limit(n)


def review_queue(scored: DataFrame, n: int, *keys: str) -> DataFrame:
    """Distinct rows to review: most uncertain (60 %), highest and lowest scores (20 % each)."""
    near = uncertain(scored, int(n * 0.6), *keys)
    high = scored.orderBy(F.desc("score"), *keys).limit(int(n * 0.2))
    low = scored.orderBy("score", *keys).limit(int(n * 0.2))
    return near.unionByName(high).unionByName(low).distinct()


def active_learning(pool: DataFrame, pipeline: Pipeline, test: DataFrame, key: str, rounds: int = 3, batch: int = 100, seed: int = 42) -> DataFrame:
    """round, n_labels, pr_auc: train on a small seed set, then add the rows the model is least sure of."""
    n_pos = pool.where("y = 1").count()
    start = max(30, int(0.15 * n_pos))
    known = sample_rows(pool.where("y = 1"), start, key, seed=seed).unionByName(sample_rows(pool.where("y = 0"), 3 * start, key, seed=seed)).cache()
    rows = []
    for r in range(rounds):
        model = pipeline.fit(balanced(known))
        rows.append((r, known.count(), evaluate.average_precision(predict(model, test)).first().pr_auc))
        rest = predict(model, pool.join(known.select(key), key, "left_anti"))
        known = known.unionByName(uncertain(rest, batch, key).drop("score")).cache()
    return pool.sparkSession.createDataFrame(rows, "round int, n_labels long, pr_auc double")
