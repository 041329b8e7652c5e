"""Tuning (H1–H5): cross-validation over a list of settings, parameter grids,
grid search, picking the best point and the final report.

Cross-validation caches its input once; folds are a column, so no plan grows with the number
of folds. Its forests, like the points of a boosting grid, are trained together in shared passes.
"""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.operators import boosting, evaluate, forests, models
from tabkit.operators.splits import training_folds

# The reference's boosting grid (3 x 3 x 3 x 3 x 3 = 243 points).
GBT_GRID = {
    "max_depth": [3, 6, 9],
    "learning_rate": [0.01, 0.1, 0.3],
    "n_estimators": [100, 200, 500],
    "min_child_weight": [1, 3, 5],
    "subsample": [0.8, 0.9, 1.0],
}


def param_grid(spark: SparkSession, grid: dict) -> DataFrame:
    """H2: every combination, numbered from 1 in nested-loop order (first key outermost)."""
    keys = list(grid)
    rows = [(i + 1, *combo) for i, combo in enumerate(itertools.product(*[grid[k] for k in keys]))]
    fields = ["combo int"] + [f"{k} {'double' if any(isinstance(v, float) for v in grid[k]) else 'int'}" for k in keys]
    return spark.createDataFrame(
        [tuple(float(x) if f.endswith("double") else x for x, f in zip(r, fields)) for r in rows], ", ".join(fields)
    )


def cross_validate(df: DataFrame, settings: list[tuple], k: int, fold_col: str = "fold",
                   features: str = "features", label: str = "label", seed: int = 42,
                   parallelism: int = 4, **rf_kwargs) -> DataFrame:
    """H1: mean held-out accuracy of a random forest for each (trees, depth, bins)
    setting over ``k`` folds of the ``fold_col`` column. All forests grow in shared passes
    (``forests.held_out``, the library's own trees); what that does not cover is fitted one by one."""
    spark = df.sparkSession
    data = df.select(features, label, fold_col).persist()
    jobs = [(s_i, setting, fold) for s_i, setting in enumerate(settings) for fold in range(k)]
    try:
        if forests.grows(data, settings, features, label, rf_kwargs):
            scored = forests.held_out(data, settings, k, seed, parallelism, **rf_kwargs)
            accuracies = [1 - wrong / n if n else None for n, wrong in scored]  # an empty fold has none
        else:
            accuracies = _fitted_one_by_one(data, jobs, seed, parallelism, rf_kwargs)
    finally:
        data.unpersist()
    rows = [(s_i, nt, md, mb, fold, acc) for (s_i, (nt, md, mb), fold), acc in zip(jobs, accuracies)]
    folds = spark.createDataFrame(
        rows, "setting int, num_trees int, max_depth int, max_bins int, fold int, accuracy double"
    )
    return evaluate.fold_mean(folds, ["setting", "num_trees", "max_depth", "max_bins"], "accuracy", "mean_accuracy")


def _fitted_one_by_one(data: DataFrame, jobs: list, seed: int, parallelism: int, rf_kwargs: dict) -> list:
    features, label, fold_col = data.columns
    data.count()

    def run(job):
        _, (nt, md, mb), fold = job
        model = models.train_rf(training_folds(data, fold, fold_col), nt, md, mb, seed,
                                features=features, label=label, **rf_kwargs)
        held = data.where(F.col(fold_col) == fold)
        acc = evaluate.accuracy(model.transform(held), label, "prediction").first()["accuracy"]
        return None if acc is None else float(acc)  # an empty fold has none

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:  # each fit is a distributed job
        return list(pool.map(run, jobs))


def grid_search(train: DataFrame, val: DataFrame, grid: DataFrame, patience: int = models.EARLY_STOP_PATIENCE,
                metric: str = "auc", features: str = "features", label: str = "label", key: str | None = None,
                seed: int = 42) -> DataFrame:
    """H3: fit boosted trees at each grid point with early stopping on ``val``.

    All points are trained in the same passes over the data (``boosting.fit_many``), and points
    that differ only in ``n_estimators`` are one model of the largest count (81 models for the 243-point
    grid): a run's first rounds are the run with fewer. Every round is scored; the patience rule (M6)
    runs over a point's rounds, and its score is that of the best round. ``metric``: "auc", or
    "loss" (score = exp(-log-loss)). A point whose validation set has one class only has
    no AUC: its score is NULL and never wins. ``seconds``: when the point's model was done.
    """
    spark = train.sparkSession
    shared: dict = {}
    for p in grid.collect():  # the grid is parameters, a few hundred rows at most
        point = (int(p["max_depth"]), float(p["learning_rate"]), float(p["min_child_weight"]), float(p["subsample"]))
        shared.setdefault(point, []).append(p)
    settings = [boosting.Settings(d, rate, max(int(p["n_estimators"]) for p in points), weight, sub)
                for (d, rate, weight, sub), points in shared.items()]
    _, scores, seconds = boosting.fit_many(train, settings, val, patience, metric, features, label, key, seed)
    curves: dict = {}
    for m, r, value in scores:
        curves.setdefault(m, []).append((r, value))
    rows = [(p["combo"], r, value, seconds[m]) for m, points in enumerate(shared.values()) for p in points
            for r, value in curves.get(m, []) if r <= int(p["n_estimators"])]
    curve = spark.createDataFrame(rows, "combo int, round int, value double, seconds double")
    stops = models.early_stop(curve, patience, group="combo", score="value", higher_better=metric == "auc")
    secs = curve.groupBy("combo").agg(F.max("seconds").alias("seconds"))
    out = grid.join(stops, "combo").join(secs, "combo")
    score = F.col("best_score") if metric == "auc" else F.exp(-F.col("best_score"))
    shown = [] if metric == "auc" else [F.col("best_score").alias("val_loss")]
    return out.select(*grid.columns, "best_round", "stop_round", *shown, score.alias("score"), "seconds")


def pick_best(results: DataFrame, score: str = "score", order: str = "combo") -> DataFrame:
    """H4: the highest score, the first point among equals; scores <= 0 never win."""
    return results.where(F.col(score) > 0).orderBy(F.desc(score), F.asc(order)).limit(1)


def best_model(train: DataFrame, val: DataFrame, best: dict, patience: int = models.EARLY_STOP_PATIENCE,
               features: str = "features", label: str = "label", key: str | None = None, seed: int = 42) -> boosting.Booster:
    """H5, first half: refit at the best point with early stopping on ``val``'s AUC; the
    model has the trees up to the best round."""
    settings = boosting.Settings(int(best["max_depth"]), float(best["learning_rate"]), int(best["n_estimators"]),
                                 float(best["min_child_weight"]), float(best["subsample"]))
    (model,), scores, _ = boosting.fit_many(train, [settings], val, patience, "auc", features, label, key, seed)
    rows = [("best", r, value) for _, r, value in scores]
    curve = train.sparkSession.createDataFrame(rows, "model string, round int, score double")
    stop = models.early_stop(curve, patience).first()
    return model if stop is None or stop["best_round"] is None else model.first(stop["best_round"])


def best_model_report(train: DataFrame, val: DataFrame, best: dict, feature_names: list[str],
                      test: DataFrame | None = None, path: str | None = None, id_col: str = "id",
                      patience: int = models.EARLY_STOP_PATIENCE, features: str = "features", label: str = "label",
                      key: str | None = None, seed: int = 42):
    """H5: refit at the best point with early stopping, report on ``val`` (class report with
    accuracy), importances, and predictions of ``test`` (which needs no label), written to
    ``path`` when that is given."""
    model = best_model(train, val, best, patience, features, label, key, seed)
    scored = model.transform(val, features)
    report = evaluate.classification_report(scored, label, "prediction")
    importance = boosting.gain_importance(model, feature_names, 10)
    predictions = None
    if test is not None:
        from tabkit.sources.csv import write_predictions

        predictions = write_predictions(model.transform(test, features), path, id_col, label)
    return report, importance, predictions
