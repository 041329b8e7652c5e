"""Models (M1–M9): MLlib estimators with the study's settings, scoring with a
stored linear model, feature importances, the split of a tree stump and the
early-stopping rule.

Training is MLlib's distributed training; prediction is ``model.transform``
inside the plan. Nothing is scored on the driver.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The reference's model settings.
RF_SETTINGS = {"large": (8, 16, 64), "small": (3, 4, 32), "medium": (5, 7, 32)}  # trees, depth, bins
RF_SWEEP = (50, 10)  # trees, depth of the partition sweep
CV_SETTINGS = [(1, 1, 8), (2, 2, 16), (4, 8, 32), (8, 16, 64)]
LR_SWEEP = {"maxIter": 10, "regParam": 0.01}
SVM_ITERATIONS = 100
MLP_HIDDEN = (5, 4)
MLP_ITERATIONS = 100
EARLY_STOP_PATIENCE = 50


def train_rf(df: DataFrame, num_trees: int, max_depth: int, max_bins: int, seed: int = 42,
             features: str = "features", label: str = "label", **kw):
    """M1: random forest, gini impurity, feature subsets chosen automatically. Each row's node ids are
    kept from pass to pass (the same trees): else every pass ships the trees so far to every task, which
    walks each row down from their roots again."""
    rf = RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins,
        impurity="gini", featureSubsetStrategy=kw.pop("featureSubsetStrategy", "auto"), seed=seed,
        cacheNodeIds=kw.pop("cacheNodeIds", True), **kw,
    )
    return rf.fit(df)


def train_lr(df: DataFrame, fit_intercept: bool = True, reg: float = 0.0, max_iter: int = 100,
             tol: float = 1e-6, features: str = "features", label: str = "label"):
    """M2: logistic regression by L-BFGS. ``fit_intercept=False, reg=0`` is the RDD
    script's model; ``max_iter=10, reg=0.01`` the sweep's."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, fitIntercept=fit_intercept,
                            regParam=reg, maxIter=max_iter, tol=tol)
    return lr.fit(df)


def train_svm(df: DataFrame, reg: float = 0.01, max_iter: int = SVM_ITERATIONS, fit_intercept: bool = False,
              features: str = "features", label: str = "label"):
    """M3: linear SVM (hinge loss, no intercept; the L2 penalty acts on the raw weights)."""
    svm = LinearSVC(featuresCol=features, labelCol=label, regParam=reg, maxIter=max_iter,
                    fitIntercept=fit_intercept, standardization=False)
    return svm.fit(df)


def train_mlp(df: DataFrame, n_features: int, hidden=MLP_HIDDEN, max_iter: int = MLP_ITERATIONS,
              seed: int = 42, features: str = "features", label: str = "label"):
    """M4: multilayer perceptron with layers [n, *hidden, 2]; scale inputs first."""
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=[n_features, *hidden, 2],
                                         maxIter=max_iter, seed=seed)
    return mlp.fit(df)


def train_gbt(df: DataFrame, max_depth: int = 3, learning_rate: float = 0.1, n_estimators: int = 100,
              min_child_weight: int = 1, subsample: float = 1.0, seed: int = 42,
              validation_col: str | None = None, features: str = "features", label: str = "label"):
    """Boosted trees by MLlib: first-order gradients, a row count for ``min_child_weight`` and rows
    sampled by partition. ``boosting.fit`` is M5 as the study trains it. With
    ``validation_col`` MLlib stops when the validation loss stops improving.
    """
    kw = {"validationIndicatorCol": validation_col} if validation_col else {}
    gbt = GBTClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth, stepSize=learning_rate,
                        maxIter=n_estimators, minInstancesPerNode=min_child_weight,
                        subsamplingRate=subsample, seed=seed, **kw)
    return gbt.fit(df)


def fit_on(df: DataFrame, train, *args, **kwargs):
    """``train(df, ...)`` with ``df`` held in memory for the fit and released after it."""
    held = df.persist()
    try:
        return train(held, *args, **kwargs)
    finally:
        held.unpersist()


def predict(model, df: DataFrame) -> DataFrame:
    """M7: class per row, inside the plan."""
    return model.transform(df)


def score_linear(df: DataFrame, weights: dict, intercept: float = 0.0, kind: str = "lr") -> DataFrame:
    """M8: margin, probability and class from a stored linear model.

    The weights are literals in the expression (a handful of numbers), so the
    scoring is one codegen'd projection. LR: class 1 at probability > 0.5;
    SVM: class 1 at margin > 0 (the same cut).
    """
    margin = F.lit(float(intercept))
    for c, w in weights.items():
        margin = margin + F.lit(float(w)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    out = df.withColumn("margin", margin).withColumn("probability", 1 / (1 + F.exp(-F.col("margin"))))
    cut = (F.col("probability") > 0.5) if kind == "lr" else (F.col("margin") > 0)
    return out.withColumn("prediction", F.when(cut, 1).otherwise(0))


def feature_importance(model, names: list[str], n: int = 10) -> DataFrame:
    """M9: importances (impurity gain for trees), highest first, first ``n``."""
    spark = SparkSession.getActiveSession()
    vals = model.featureImportances.toArray().tolist()
    rows = [(names[i], float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(n)


_SPLIT = re.compile(r"If \(feature (\d+) <= ([-0-9.Ee]+)\)")


def stump_split(model) -> tuple[int, float]:
    """Feature and threshold of the root split of the first tree."""
    m = _SPLIT.search(model.trees[0].toDebugString)
    if not m:
        raise ValueError("first tree has no split")
    return int(m.group(1)), float(m.group(2))


def gini_gain(df: DataFrame, col, threshold: float, label: str = "label") -> DataFrame:
    """Gini gain of the split ``col <= threshold`` computed from the data (one pass)."""
    x = F.col(col) if isinstance(col, str) else col
    y = F.col(label)
    c = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("p"),
        F.count_if(x <= threshold).alias("nl"), F.sum(F.when(x <= threshold, y).otherwise(0)).alias("pl"),
    )

    def gini(n, p):  # an empty side has impurity 0
        q = p / F.nullif(n, F.lit(0.0))
        return F.coalesce(1 - q * q - (1 - q) * (1 - q), F.lit(0.0))

    n, p, nl, pl = (F.col(k).cast("double") for k in ("n", "p", "nl", "pl"))
    nr, pr = n - nl, p - pl
    return c.select((gini(n, p) - nl / n * gini(nl, pl) - nr / n * gini(nr, pr)).alias("gain"))


def early_stop(scores: DataFrame, patience: int = EARLY_STOP_PATIENCE, group: str = "model",
               round_col: str = "round", score: str = "score", higher_better: bool = True) -> DataFrame:
    """M6: the patience rule over per-round validation scores.

    A round improves when its score beats every earlier one. Training stops at
    the first round that is ``patience`` rounds past the last improvement (or
    at the last round); the best round is the last improvement before the stop.
    Windows are partitioned by model and run over its rounds only.
    """
    s = F.col(score) if higher_better else -F.col(score)
    in_order = Window.partitionBy(group).orderBy(round_col)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(group)
    best = F.max("_key").over(before)
    marked = scores.select(group, round_col, score, s.alias("_key")).withColumn(
        "_improves", best.isNull() | (F.col("_key") > best))
    marked = marked.withColumn("_best", F.max(F.when(F.col("_improves"), F.struct(round_col, score))).over(so_far))
    stale = F.when(F.col(round_col) - F.col(f"_best.{round_col}") >= patience, F.col(round_col))
    marked = marked.withColumn("stop_round", F.coalesce(F.min(stale).over(whole), F.max(round_col).over(whole)))
    return marked.where(F.col(round_col) == F.col("stop_round")).select(
        group, F.col(f"_best.{round_col}").alias("best_round"), F.col(f"_best.{score}").alias("best_score"), "stop_round")


def round_log_losses(model, df: DataFrame) -> list[float]:
    """Mean log-loss (negative log-likelihood per row) on ``df`` after each
    boosting round, from one distributed pass. Spark's own per-round figure for
    the logistic loss is twice this value."""
    return [float(x) / 2 for x in model.evaluateEachIteration(df)]


def gbt_round_losses(model, df: DataFrame) -> DataFrame:
    """Validation log-loss after each boosting round (for the patience rule)."""
    spark = df.sparkSession
    losses = round_log_losses(model, df)
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(losses)], "round int, loss double")
