"""Forests grown in shared passes: the library's trees, without a fit of the library for each."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabkit.operators import evaluate, forests, models, tuning
from tabkit.operators.splits import training_folds


@pytest.fixture(scope="module")
def data(spark):
    """Three classes, a constant feature, equal values, mirrored features (equal gains) and a row in no fold."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        a, b, c = rng.normal(), rng.integers(0, 12), rng.integers(0, 2)
        label = 2.0 if b > 9 else float(a + c + rng.normal() * 0.7 > 0.5)
        rows.append((Vectors.dense([float(v) for v in (a, b, c, 1 - c, 7, round(a, 1), rng.normal())]), label, i % 3 if i != 40 else None))
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), ["features", "label", "fold"])


def by_library(data, settings, k, **kw):
    out = []
    for nt, md, mb in settings:
        for j in range(k):
            model = models.train_rf(training_folds(data, j), nt, md, mb, 42, **kw)
            r = evaluate.accuracy(model.transform(data.where(F.col("fold") == j))).first()
            out.append((r["n"], r["mismatches"]))
    return out


def grown(data, settings, k, **kw):
    return [tuple(x) for x in forests.held_out(data.select("features", "label", "fold"), settings, k, 42, **kw)]


def test_the_librarys_forests(spark, data):
    settings = [(1, 0, 4), (1, 2, 8), (6, 9, 32)]
    assert grown(data, settings, 3) == by_library(data, settings, 3)


def test_without_bootstrap_and_all_features(spark, data):
    kw = dict(bootstrap=False, featureSubsetStrategy="all")
    assert grown(data, [(2, 4, 16)], 2, **kw) == by_library(data, [(2, 4, 16)], 2, **kw)


def test_sampled_cuts(spark, data):
    """Above 10,000 rows the library samples those that cuts are read from."""
    more = data
    for _ in range(4):
        more = more.unionByName(more)
    more = more.coalesce(2)
    assert more.count() == 24000
    assert grown(more, [(2, 3, 16)], 2) == by_library(more, [(2, 3, 16)], 2)


@pytest.mark.parametrize("mb", [0, 1])
def test_nodes_that_do_not_fit_a_group(spark, data, monkeypatch, mb):
    """The stack goes on in the library's order where a group is full (at 0 MB after every node)."""
    monkeypatch.setattr(forests, "GROUP_BYTES", mb << 20)
    setting = [(5, 2, 8)] if mb == 0 else [(6, 9, 200)]
    assert grown(data, setting, 1) == by_library(data, setting, 1, maxMemoryInMB=mb)


def test_chunks_and_passes(spark, data, monkeypatch):
    """Counts dealt over many chunks, and forests that take turns."""
    settings = [(3, 5, 16), (2, 6, 16)]
    once = grown(data, settings, 2)
    monkeypatch.setattr(forests, "CHUNK_CELLS", 50)
    monkeypatch.setattr(forests, "PASS_CELLS", 2000)
    assert grown(data, settings, 2) == once


def test_cross_validate_fits_no_forest_by_itself(spark, data, monkeypatch):
    settings = [(1, 1, 8), (3, 4, 16)]
    expected = by_library(data, settings, 3)
    monkeypatch.setattr(models, "train_rf", lambda *a, **k: pytest.fail("a fit for itself"))
    got = {r["setting"]: r["mean_accuracy"] for r in tuning.cross_validate(data, settings, 3).collect()}
    for i in range(2):
        assert got[i] == pytest.approx(np.mean([1 - wrong / n for n, wrong in expected[3 * i: 3 * i + 3]]), abs=1e-12)


def test_what_is_left_to_the_library(spark, data):
    ok = dict(bootstrap=False, featureSubsetStrategy="all")
    assert forests.grows(data, [(2, 4, 16)], "features", "label", ok)
    assert not forests.grows(data, [(2, 4, 16)], "features", "label", {"minInstancesPerNode": 5})
    assert not forests.grows(data, [(2, 17, 16)], "features", "label", {})
    got = tuning.cross_validate(data, [(2, 3, 8)], 2, minInstancesPerNode=5).first()["mean_accuracy"]
    expected = by_library(data, [(2, 3, 8)], 2, minInstancesPerNode=5)
    assert got == pytest.approx(np.mean([1 - wrong / n for n, wrong in expected]), abs=1e-12)


def test_a_fold_without_rows(spark, data):
    few = data.where("fold < 2")
    rows = grown(few, [(1, 2, 8)], 3)
    assert rows[2] == (0, 0) and rows[0][0] > 0
    assert tuning.cross_validate(few, [(1, 2, 8)], 3).first()["mean_accuracy"] == pytest.approx(np.mean([1 - w / n for n, w in rows[:2]]))
