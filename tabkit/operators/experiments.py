"""Experiments (X1–X4): training at several partition counts, best and worst
runs, time gains, and phase timings.

Inputs are materialised (cached and counted) before a clock starts, so a
timing measures the fit, not the scan that feeds it.
"""

from __future__ import annotations

import time
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.scalar import relative_gain
from tabkit.operators import evaluate

PARTITION_COUNTS = [1, 2, 4, 8, 16, 32]  # fixed value: the reference's sweep
# fixed values: the result columns of a run
RUN_METRICS = ["accuracy", "precision", "recall", "training_time"]


def partition_sweep(estimators: dict, train: DataFrame, test: DataFrame, counts: list[int],
                    label: str = "label") -> DataFrame:
    """Fit each estimator on ``train`` repartitioned to each of ``counts``; accuracy,
    weighted precision and recall on ``test`` (one pass per fit) and the fit's seconds. A
    count of 1 puts the whole training table in one task: leave it out for large tables.

    Fits run side by side as far as each of their partitions has a core of its own, so that the
    fits of few partitions do not leave the others' cores idle. Copies of the training table are
    made before the clocks of the fits beside them start, and models are scored after the last one."""
    spark = train.sparkSession
    cores = max(1, spark.sparkContext.defaultParallelism)
    train, test = train.persist(), test.persist()
    fitted: dict = {}

    def timed_fit(n, name, part):
        t0 = time.time()
        model = estimators[name].fit(part)
        fitted[n, name] = model, time.time() - t0

    def score(run):
        n, name = run
        model, seconds = fitted[run]
        m = evaluate.summary(model.transform(test), label).first()
        return name, n, float(m["accuracy"]), float(m["weighted_precision"]), float(m["weighted_recall"]), seconds

    try:
        for wave in ([n for n in counts if n <= cores], *([n] for n in counts if n > cores)):
            parts = {n: train.repartition(n).persist() for n in wave}
            try:
                for part in parts.values():
                    part.count()  # materialise before timing
                side_by_side([(min(n, cores), partial(timed_fit, n, name, parts[n])) for n in wave for name in estimators], cores)
            finally:
                for part in parts.values():
                    part.unpersist()
        runs = [(n, name) for n in counts for name in estimators]
        with ThreadPoolExecutor(max_workers=4) as pool:
            rows = list(pool.map(score, runs))
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(
        rows, "model string, partitions int, accuracy double, precision double, recall double, training_time double"
    )


def side_by_side(jobs: list[tuple], cores: int) -> None:
    """Run the ``(cores it takes, callable)`` jobs, each begun as soon as that many of ``cores``
    are free, in the order given among those that can begin. After an error no more are begun;
    it is raised once the running ones are done."""
    waiting, running = list(jobs), {}
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        while waiting or running:
            free = cores - sum(running.values())
            begun = []
            for i, (takes, fn) in enumerate(waiting):
                if takes <= free or not (running or begun):
                    running[pool.submit(fn)] = takes
                    begun.append(i)
                    free -= takes
            waiting = [job for i, job in enumerate(waiting) if i not in begun]
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                del running[done]
                done.result()


def best_worst_runs(results: DataFrame, metrics=RUN_METRICS, lower_better=("training_time",),
                    group: str = "model", x: str = "partitions") -> DataFrame:
    """Per model and metric, the best and the worst run (max, but min for
    lower-is-better metrics; the first partition count among equals). One aggregate."""
    long = results.select(group, x, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [group, x], list(metrics), "metric", "value"
    )
    key = F.when(F.col("metric").isin(list(lower_better)), F.col("value")).otherwise(-F.col("value"))
    best = F.min(F.struct(key.alias("k"), F.col(x).alias("x"), F.col("value").alias("v")))
    worst = F.min(F.struct((-key).alias("k"), F.col(x).alias("x"), F.col("value").alias("v")))
    return long.groupBy(group, "metric").agg(best.alias("b"), worst.alias("w")).select(
        group, "metric", F.col("b.x").alias(f"best_{x}"), F.col("b.v").alias("best_value"),
        F.col("w.x").alias(f"worst_{x}"), F.col("w.v").alias("worst_value"))


def improvement_summary(results: DataFrame, time_col: str = "training_time", group: str = "model") -> DataFrame:
    """Per model the best (min) and worst (max) time and the gain in percent of the worst."""
    agg = results.groupBy(group).agg(F.min(time_col).alias("best_time"), F.max(time_col).alias("worst_time"))
    return agg.withColumn("improvement_pct", relative_gain("worst_time", "best_time"))


def timed_phases(spark, phases: dict) -> DataFrame:
    """Run each named phase (a callable that ends in an action and returns the rows it
    worked on) and record its rows and seconds."""
    rows: list = []
    for name, fn in phases.items():
        t0 = time.time()
        n = fn()
        rows.append((name, n, time.time() - t0))
    return spark.createDataFrame(rows, "phase string, rows long, seconds double")
