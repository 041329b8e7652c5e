import pytest
from pyspark.sql.functions import col as F_col

from tabkit.operators import charts, experiments, tuning

# Fixed small result tables (stand-ins for recorded runs and grid scores).
RUNS = [
    ("LR", 1, 0.90, 0.89, 0.90, 12.0), ("LR", 2, 0.91, 0.90, 0.91, 8.0), ("LR", 4, 0.91, 0.90, 0.91, 6.0),
    ("LR", 8, 0.89, 0.88, 0.89, 6.0), ("LR", 16, 0.88, 0.87, 0.88, 7.0), ("LR", 32, 0.88, 0.87, 0.88, 9.0),
    ("RF", 1, 0.93, 0.92, 0.93, 30.0), ("RF", 2, 0.93, 0.92, 0.93, 18.0), ("RF", 4, 0.94, 0.93, 0.94, 11.0),
    ("RF", 8, 0.94, 0.93, 0.94, 9.5), ("RF", 16, 0.93, 0.92, 0.93, 10.0), ("RF", 32, 0.92, 0.91, 0.92, 12.0),
    ("MLP", 1, 0.80, 0.79, 0.80, 20.0), ("MLP", 2, 0.81, 0.80, 0.81, 15.0), ("MLP", 4, 0.82, 0.81, 0.82, 12.0),
    ("MLP", 8, 0.82, 0.81, 0.82, 11.0), ("MLP", 16, 0.80, 0.79, 0.80, 13.0), ("MLP", 32, 0.79, 0.78, 0.79, 16.0),
]
SCHEMA = "model string, partitions int, accuracy double, precision double, recall double, training_time double"


@pytest.fixture()
def runs(spark):
    return spark.createDataFrame(RUNS, SCHEMA)


def test_best_worst_first_of_equals(runs):
    got = {(r.model, r.metric): r for r in experiments.best_worst_runs(runs).collect()}
    lr_time = got[("LR", "training_time")]
    assert (lr_time.best_partitions, lr_time.best_value) == (4, 6.0)  # tie with 8: first wins
    assert (lr_time.worst_partitions, lr_time.worst_value) == (1, 12.0)
    lr_acc = got[("LR", "accuracy")]
    assert lr_acc.best_partitions == 2 and lr_acc.worst_partitions == 16


def test_improvement_summary(runs):
    got = {r.model: r for r in experiments.improvement_summary(runs).collect()}
    assert got["RF"].best_time == 9.5 and got["RF"].worst_time == 30.0
    assert got["RF"].improvement_pct == pytest.approx((30 - 9.5) / 30 * 100)


def test_metric_series_flags(runs):
    rows = charts.metric_series(runs, experiments.RUN_METRICS).collect()
    assert len(rows) == 18 * 4
    best = {(r.model, r.metric): r.partitions for r in rows if r.is_best}
    assert best[("LR", "training_time")] == 4 and best[("MLP", "accuracy")] == 4


def test_pick_best_ties_and_nonpositive(spark):
    rows = [(1, 0.8), (2, 0.9), (3, 0.9), (4, -1.0)]
    df = spark.createDataFrame(rows, "combo int, score double")
    assert tuning.pick_best(df).first().combo == 2
    neg = spark.createDataFrame([(1, 0.0), (2, -0.5)], "combo int, score double")
    assert tuning.pick_best(neg).count() == 0


def test_param_grid_order(spark):
    g = tuning.param_grid(spark, tuning.GBT_GRID).orderBy("combo").collect()
    assert len(g) == 243
    assert (g[0].max_depth, g[0].learning_rate, g[0].n_estimators, g[0].min_child_weight, g[0].subsample) == (3, 0.01, 100, 1, 0.8)
    assert g[1].subsample == 0.9 and g[3].min_child_weight == 3
    assert (g[-1].max_depth, g[-1].subsample) == (9, 1.0)


def test_timed_phases(spark):
    out = experiments.timed_phases(spark, {"a": lambda: None, "b": lambda: spark.range(10).count()}).collect()
    assert [(r.phase, r.rows) for r in out] == [("a", None), ("b", 10)] and all(r.seconds >= 0 for r in out)


def test_shared_rounds_grid(spark, sf_dir):
    from pyspark.sql import functions as F

    from tabkit.operators import features
    from tabkit.plans import fixtures as fx

    s = fx.survey(spark, sf_dir)
    prep = features.PrepModel.fit(s, "label", fx.SURVEY_NUMERIC, fx.SURVEY_ONE_HOT, fx.SURVEY_ORDINAL, ["id", "name"])
    out = prep.transform(s).withColumn("label", F.col("label").cast("double"))
    data = features.assemble(out, [c for c in out.columns if c != "label"]).select("features", "label")
    grid = tuning.param_grid(spark, {"max_depth": [2], "learning_rate": [0.3], "n_estimators": [3, 6],
                                     "min_child_weight": [1], "subsample": [1.0]})
    res = {r.combo: r for r in tuning.grid_search(data, data, grid, patience=2, metric="loss").collect()}
    assert set(res) == {1, 2}
    assert res[1].stop_round <= 3 and res[2].stop_round <= 6
    # the first three rounds are the same run, so the shorter point can only be equal or worse
    assert res[2].val_loss <= res[1].val_loss + 1e-12
    assert 0 < res[1].score <= 1


def test_single_class_validation_scores_nothing(spark):
    """No AUC on one class: the point's score is NULL and it never wins."""
    from pyspark.sql import functions as F

    from tabkit.operators import features

    df = spark.range(60).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 4).cast("double").alias("f"))
    data = features.assemble(df, ["f"])
    grid = tuning.param_grid(spark, {"max_depth": [2], "learning_rate": [0.3], "n_estimators": [2], "min_child_weight": [1], "subsample": [1.0]})
    res = tuning.grid_search(data, data.where("label = 1"), grid, patience=1)
    assert res.first().score is None and tuning.pick_best(res).count() == 0


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest

    from tabkit import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_sweep_fits_side_by_side_within_the_cores(spark):
    """Fits of few partitions run together; partitions in work never outnumber the cores."""
    import threading
    import time

    from tabkit.operators import features

    df = spark.range(40).select((F_col("id") % 2).cast("double").alias("label"), (F_col("id") % 2).cast("double").alias("f"))
    data = features.assemble(df, ["f"])
    cores, lock, now, seen = spark.sparkContext.defaultParallelism, threading.Lock(), [], []

    class Slow:
        def fit(self, part):
            n = part.rdd.getNumPartitions()
            with lock:
                now.append(n)
                seen.append(list(now))
            time.sleep(1)
            with lock:
                now.remove(n)
            return self

        def transform(self, df):
            return df.withColumn("prediction", F_col("label"))

    counts = [1, 2, 2 * cores]
    out = experiments.partition_sweep({"A": Slow(), "B": Slow()}, data, data, counts).collect()
    assert [(r.model, r.partitions) for r in out] == [(m, n) for n in counts for m in "AB"]
    assert all(r.accuracy == r.precision == r.recall == 1 and 1 <= r.training_time < 3 for r in out)
    assert max(len(s) for s in seen) > 1
    assert all(sum(s) <= cores or len(s) == 1 for s in seen)


def test_side_by_side_raises_and_begins_no_more():
    ran = []

    def fail():
        raise ValueError("a fit")

    with pytest.raises(ValueError):
        experiments.side_by_side([(2, fail), (2, lambda: ran.append(1))], 2)
    assert ran == []
