"""Second-order boosting against a plain trainer, at several partition counts and in batches."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabkit.operators import boosting, evaluate, models, tuning
from tabkit.operators.boosting import LAMBDA, SCALE, Settings


def rows_of(n=700, seed=3, missing=True):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.integers(0, 6, n), r.normal(size=n).round(1), r.integers(0, 2, n)]).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 0.3) ^ (r.random(n) < 0.15)).astype(float)
    if missing:
        x[r.random(n) < 0.2, 1] = np.nan
        x[(r.random(n) < 0.3) & (y > 0), 0] = np.nan
    return x, y


def frame(spark, x, y, partitions=3):
    data = [(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x.tolist(), y))]
    return spark.createDataFrame(data, ["id", "label", "features"]).repartition(partitions)


def hashes(spark, n):
    from tabkit.functions.scalar import portable_hash

    return np.array([r.h for r in spark.range(n).select(portable_hash("id").alias("h")).orderBy("id").collect()])


def plain_margins(x, y, u, s: Settings, seed=42):
    """Every cut of every node tried by its definition, one row at a time where that matters."""
    edges = [np.unique(c[~np.isnan(c)]) for c in x.T]
    edges = [np.append(e[:-1] + (e[1:] - e[:-1]) / 2, np.inf) for e in edges]  # the last one parts known from missing
    margin = np.zeros(len(y))
    trees = []

    def score(g, h):
        return g / SCALE * (g / SCALE) / (h / SCALE + LAMBDA)

    for round_ in range(1, s.n_estimators + 1):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * SCALE), np.rint(np.maximum(p * (1 - p), 1e-16) * SCALE)
        drawn = boosting.draws(u.astype(np.uint32), seed, round_) < s.subsample * 2.0 ** 32
        step = np.zeros(len(y))

        def grow(rows, depth):
            used = rows & drawn
            gt, ht = g[used].sum(), h[used].sum()
            best = None
            for f in range(x.shape[1]) if depth < s.max_depth else ():
                for cut in edges[f]:
                    for missing_left in (False, True):
                        with np.errstate(invalid="ignore"):
                            left = (x[:, f] <= cut) | (np.isnan(x[:, f]) & missing_left)
                        if not any(used & (x[:, f] <= cut)):
                            continue
                        gl, hl = g[used & left].sum(), h[used & left].sum()
                        gain = score(gl, hl) + score(gt - gl, ht - hl) - score(gt, ht)
                        least = np.ceil(s.min_child_weight * SCALE)
                        if hl > 0 and ht - hl > 0 and hl >= least and ht - hl >= least and gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, left)
            if best is None:
                step[rows] = -(gt / SCALE) / (ht / SCALE + LAMBDA) * s.learning_rate if used.any() else 0.0
            else:
                grow(rows & best[1], depth + 1)
                grow(rows & ~best[1], depth + 1)

        grow(np.ones(len(y), bool), 0)
        margin = margin + step
        trees.append(step)
    return margin


def margins(model, df):
    return np.array([r.margin for r in model.transform(df).orderBy("id").select("margin").collect()])


@pytest.mark.parametrize("settings", [Settings(3, 0.3, 3, 2, 0.8), Settings(1, 0.5, 2, 0, 1.0), Settings(4, 0.1, 2, 5.5, 0.9)])
def test_margins_against_a_plain_trainer(spark, settings):
    x, y = rows_of()
    df = frame(spark, x, y)
    got = margins(boosting.fit(df, settings, key="id"), df)
    want = plain_margins(x, y, hashes(spark, len(y)), settings)
    assert np.abs(got - want).max() < 1e-9


def test_same_model_at_any_partition_count_and_in_any_batch(spark):
    x, y = rows_of(600, 5)
    s = Settings(2, 0.3, 4, 3, 0.9)
    want = margins(boosting.fit(frame(spark, x, y, 1), s, key="id"), frame(spark, x, y, 1))
    for partitions in (4, 32):
        df = frame(spark, x, y, partitions)
        other = Settings(3, 0.1, 3, 1, 0.8)  # a deeper and shorter model in the same passes
        models_, _, seconds = boosting.fit_many(df, [other, s], key="id", rounds_per_write=1 if partitions == 4 else 3)
        assert (margins(models_[1], df) == want).all()
        assert [len(m.trees) for m in models_] == [3, 4] and all(t > 0 for t in seconds)


def test_scores_and_early_stopping(spark):
    x, y = rows_of(800, 7, missing=False)
    df = frame(spark, x, y)
    train, val = df.where("id < 600"), df.where("id >= 600")
    (model,), scores, _ = boosting.fit_many(train, [Settings(3, 0.5, 60, 1, 0.9)], val, patience=4, key="id", rounds_per_write=2)
    assert len(model.trees) == len(scores) < 60
    curve = {r: v for _, r, v in scores}
    for rounds in (1, len(scores)):
        auc = evaluate.auc(model.first(rounds).transform(val), "margin").first()["auroc"]
        assert abs(auc - curve[rounds]) < 1e-12
    best = max(curve.values())
    first = min(r for r, v in curve.items() if v == best)
    assert len(scores) - first >= 4  # it went on until the patience was over, and by less than two writes more
    chosen = tuning.best_model(train, val, dict(max_depth=3, learning_rate=0.5, n_estimators=60, min_child_weight=1, subsample=0.9), patience=4, key="id")
    assert len(chosen.trees) == models.early_stop(spark.createDataFrame([("m", r, v) for r, v in curve.items()], "model string, round int, score double"), 4).first()["best_round"]
    _, losses, _ = boosting.fit_many(train, [Settings(2, 0.3, 3)], val, metric="loss", key="id")
    m = boosting.fit(train, Settings(2, 0.3, 3), key="id").transform(val)
    want = m.agg(F.avg(-F.log(F.when(F.col("label") == 1, F.col("probability")).otherwise(1 - F.col("probability"))))).first()[0]
    assert abs(losses[-1][2] - want) < 1e-5


def test_odd_tables(spark):
    x, y = rows_of(50, 1)
    one = frame(spark, x, np.ones(50))  # one class: the leaf pulls every margin up, no cut gains much
    assert (margins(boosting.fit(one, Settings(2, 0.3, 2)), one) > 0).all()
    x[:, 1] = np.nan  # nothing known of a feature
    df = frame(spark, x, y)
    model = boosting.fit(df, Settings(2, 0.3, 2, 0.1))
    assert all(1 not in t.feature for t in model.trees)
    same = frame(spark, np.zeros((20, 2)), np.arange(20) % 2.0)  # equal rows: a leaf of value 0
    assert (margins(boosting.fit(same, Settings(2, 0.3, 2)), same) == 0).all()
    assert boosting.gain_importance(boosting.fit(same, Settings(2, 0.3, 1)), ["a", "b"]).where("importance = 0").count() == 2
    with pytest.raises(ValueError):
        boosting.fit(df.limit(0), Settings())
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        boosting.fit(frame(spark, x, y + 1), Settings(1, 0.1, 1))


def test_many_distinct_values_are_binned_by_quantiles():
    r = np.random.default_rng(0)
    values = r.normal(size=(20_000, 1))
    edges = boosting.bin_edges(values)
    counts = np.bincount(boosting.binned(values, edges)[:, 0], minlength=boosting.BINS)
    assert len(edges[0]) <= boosting.BINS - 1 and counts.max() < 3 * 20_000 / boosting.BINS
    assert boosting.binned(np.array([[np.nan], [1e9], [-1e9]]), edges)[:, 0].tolist() == [boosting.MISSING_BIN, len(edges[0]), 0]


def test_draws_are_even_and_nested():
    u = np.random.default_rng(1).integers(0, 1 << 32, 100_000).astype(np.uint32)
    a, b = (boosting.draws(u, 42, r) for r in (1, 2))
    for d in (a, b):
        assert abs((d < 0.9 * 2.0 ** 32).mean() - 0.9) < 0.01
    assert abs(((a < 2.0 ** 31) & (b < 2.0 ** 31)).mean() - 0.25) < 0.01  # rounds are drawn on their own
