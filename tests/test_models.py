import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabkit.operators import features, models
from tabkit.plans import fixtures as fx


def _round_scores(spark):
    # peak at round 3, a plateau longer than the patience, then a higher value
    # (round 10) that training must not reach; model "b" keeps improving.
    a = [0.5, 0.6, 0.7, 0.7, 0.69, 0.7, 0.65, 0.6, 0.6, 0.9, 0.95, 0.97]
    b = [0.1 * i for i in range(1, 9)]
    rows = [("a", i + 1, s) for i, s in enumerate(a)] + [("b", i + 1, s) for i, s in enumerate(b)]
    return spark.createDataFrame(rows, "model string, round int, score double")


def test_early_stop_patience(spark):
    got = {r.model: (r.best_round, r.best_score, r.stop_round) for r in models.early_stop(_round_scores(spark), 3).collect()}
    assert got["a"] == (3, 0.7, 6)
    assert got["b"][0] == 8 and got["b"][2] == 8


def test_early_stop_lower_is_better(spark):
    rows = [("m", i + 1, v) for i, v in enumerate([0.9, 0.5, 0.6, 0.55, 0.7, 0.4])]
    df = spark.createDataFrame(rows, "model string, round int, loss double")
    r = models.early_stop(df, 3, score="loss", higher_better=False).first()
    assert (r.best_round, r.best_score, r.stop_round) == (2, 0.5, 5)


def test_score_linear(spark):
    df = spark.createDataFrame([(1.0, None), (-2.0, 3.0)], "a double, b double")
    out = models.score_linear(df, {"a": 2.0, "b": -1.0}, 0.5).collect()
    assert [r.margin for r in out] == [2.5, -6.5]
    assert out[0].probability == pytest.approx(1 / (1 + np.exp(-2.5)))
    assert [r.prediction for r in out] == [1, 0]
    svm = models.score_linear(df, {"a": 2.0, "b": -1.0}, 0.5, kind="svm").collect()
    assert [r.prediction for r in svm] == [1, 0]


@pytest.fixture(scope="module")
def assembled(spark, sf_dir):
    s = fx.survey(spark, sf_dir)
    prep = features.PrepModel.fit(s, "label", fx.SURVEY_NUMERIC, fx.SURVEY_ONE_HOT, fx.SURVEY_ORDINAL, ["name"])
    out = prep.transform(s).withColumn("label", F.col("label").cast("double"))
    names = [c for c in out.columns if c not in ("id", "label")]
    return features.assemble(out, names).select("id", "label", "features").persist(), names


def test_unpenalised_lr_score_equations(assembled):
    df, names = assembled
    model = models.train_lr(df, fit_intercept=True, reg=0.0, max_iter=200, tol=1e-10)
    scored = model.transform(df).select("label", vector_to_array("probability")[1].alias("p"),
                                        vector_to_array("features").alias("x"))
    rows = scored.collect()
    resid = np.array([r.p - r.label for r in rows])
    x = np.array([r.x for r in rows])
    assert abs(resid.mean()) < 1e-4
    assert np.abs(resid @ x / len(rows)).max() < 1e-3


def test_models_beat_majority(assembled):
    df, names = assembled
    majority = max(df.where("label = 1").count(), df.where("label = 0").count()) / df.count()
    for model in (models.train_rf(df, 3, 4, 32), models.train_gbt(df, 3, 0.1, 10)):
        acc = model.transform(df).select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
        assert acc > majority + 0.1
    svm = models.train_svm(df, 0.01, 20)
    assert np.isfinite(svm.coefficients.toArray()).all()


def test_feature_importance_and_stump(assembled, spark):
    df, names = assembled
    rf = models.train_rf(df, 3, 4, 32)
    imp = models.feature_importance(rf, names, 5).collect()
    assert len(imp) == 5 and imp[0].importance >= imp[-1].importance
    stump = models.train_rf(df, 1, 1, 32, featureSubsetStrategy="all", bootstrap=False)
    f, t = models.stump_split(stump)
    assert 0 <= f < len(names)
    gain = models.gini_gain(df.select("label", vector_to_array("features")[f].alias("x")), "x", t).first().gain
    assert gain > 0


def test_gbt_patience_on_validation_loss(assembled):
    df, names = assembled
    model = models.train_gbt(df, 2, 0.5, 8)
    losses = models.gbt_round_losses(model, df)
    got = models.early_stop(losses.withColumn("model", F.lit("g")), 2, score="loss", higher_better=False).first()
    curve = [r.loss for r in losses.orderBy("round").collect()]
    assert got.best_score == min(curve[:got.stop_round])
    assert got.stop_round == len(curve) or got.stop_round - got.best_round >= 2


def test_forest_keeps_node_ids_and_grows_the_same_trees(spark):
    """Kept node ids change no tree: those of a plain forest, whose passes walk from the roots."""
    from pyspark.ml.classification import RandomForestClassifier

    df = spark.range(3000).select(((F.col("id") * 7919) % 101 > 50).cast("double").alias("label"),
                                  ((F.col("id") * 31) % 97).cast("double").alias("a"), ((F.col("id") * 17) % 89).cast("double").alias("b"))
    v = features.assemble(df, ["a", "b"]).repartition(3).persist()
    kept = models.train_rf(v, 3, 8, 32)
    plain = RandomForestClassifier(numTrees=3, maxDepth=8, maxBins=32, seed=42).fit(v)
    v.unpersist()
    assert kept.getCacheNodeIds() and kept.totalNumNodes > 50
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]
