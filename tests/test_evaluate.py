import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from tabkit.operators import evaluate


def _ref_auc(scores, labels):
    pairs = sorted(zip(scores, labels), key=lambda t: -t[0])
    P, N = sum(labels), len(labels) - sum(labels)
    tp = fp = 0
    roc = [(0.0, 0.0)]
    pr = []
    distinct = sorted(set(scores), reverse=True)
    for s in distinct:
        tp += sum(y for x, y in pairs if x == s)
        fp += sum(1 - y for x, y in pairs if x == s)
        roc.append((fp / N, tp / P))
        pr.append((tp / P, tp / (tp + fp)))
    pr = [(0.0, pr[0][1])] + pr
    auroc = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(roc, roc[1:]))
    aupr = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pr, pr[1:]))
    return auroc, aupr


@pytest.mark.parametrize("rounding", [1, 2])
def test_auc_matches_reference_and_mllib(spark, rounding):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(y * 0.3 + rng.random(400) * 0.7, 0, 1), rounding)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)], "score double, label double")
    got = evaluate.auc(df, "score", "label").first()
    auroc, aupr = _ref_auc(s.tolist(), y.tolist())
    assert got.auroc == pytest.approx(auroc, abs=1e-12)
    assert got.aupr == pytest.approx(aupr, abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert got.auroc == pytest.approx(ev.setMetricName("areaUnderROC").evaluate(df), abs=1e-12)
    assert got.aupr == pytest.approx(ev.setMetricName("areaUnderPR").evaluate(df), abs=1e-12)


def test_auc_partitioned_running_totals(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 300)
    s = rng.random(300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)], "score double, label double")
    small = evaluate.auc(df.coalesce(1), "score", "label").first()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        big = evaluate.auc(df, "score", "label").first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert big.auroc == pytest.approx(small.auroc, abs=1e-12)
    assert big.aupr == pytest.approx(small.aupr, abs=1e-12)


@pytest.fixture()
def preds(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 6 + [(1, 0)] * 3 + [(2, 2)] * 1 + [(2, 0)] * 1
    return spark.createDataFrame(rows, "label int, prediction int")


def test_accuracy_and_mismatches(preds):
    a = evaluate.accuracy(preds).first()
    assert (a.n, a.mismatches) == (18, 6)
    assert a.accuracy == pytest.approx(12 / 18)
    assert evaluate.mismatches(preds).count() == 6


def test_report_and_weighted(preds):
    rep = {r["class"]: r for r in evaluate.classification_report(preds).collect()}
    # class 0: tp 5, support 7, predicted 9
    assert rep["0"].precision == pytest.approx(5 / 9) and rep["0"].recall == pytest.approx(5 / 7)
    assert rep["0"].f1 == pytest.approx(2 * (5 / 9) * (5 / 7) / (5 / 9 + 5 / 7))
    assert rep["accuracy"].f1 == pytest.approx(12 / 18) and rep["accuracy"].support == 18
    precisions = [5 / 9, 6 / 8, 1.0]
    supports = [7, 9, 2]
    assert rep["macro avg"].precision == pytest.approx(np.mean(precisions))
    wp = evaluate.weighted_precision_recall(preds).first()
    assert wp.weighted_precision == pytest.approx(np.dot(precisions, supports) / 18)
    assert wp.weighted_recall == pytest.approx(12 / 18)  # weighted recall = accuracy


def test_undefined_precision_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "label int, prediction int")
    wp = evaluate.weighted_precision_recall(df).first()
    assert wp.weighted_precision == pytest.approx((1 / 3) * (1 / 3))  # class 1 never predicted
    rep = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].f1 == 0.0


def test_fold_mean(spark):
    df = spark.createDataFrame([("a", 0, 0.5), ("a", 1, 0.7), ("b", 0, 0.1)], "s string, fold int, acc double")
    got = {r.s: r.mean for r in evaluate.fold_mean(df, ["s"], "acc").collect()}
    assert got == pytest.approx({"a": 0.6, "b": 0.1})


def test_one_class_data(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    a = evaluate.accuracy(df).first()
    assert a.accuracy == pytest.approx(2 / 3)
    rep = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert set(rep) == {"1.0", "accuracy", "macro avg", "weighted avg"}  # only classes with support
    assert rep["1.0"].recall == pytest.approx(2 / 3) and rep["1.0"].precision == 1.0
    auc = evaluate.auc(df, "prediction").first()
    assert auc.auroc is None  # no negatives: the ROC curve is undefined
