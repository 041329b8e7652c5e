import numpy as np
import pandas as pd
import pytest

from tabkit.operators import charts, profile


@pytest.fixture()
def small(spark):
    rows = [
        (1, "a", 1.0, 0), (2, "b", None, 1), (3, "a", float("nan"), 0), (4, None, 4.0, 1),
        (5, "a", 1.0, 0), (6, "c", 10.0, 1), (7, None, 4.0, 1),
    ]
    return spark.createDataFrame(rows, "id bigint, cat string, x double, y int")


def test_shape_and_nulls(small):
    assert small.transform(profile.table_shape).first().asDict() == {"rows": 7, "columns": 4}
    nulls = {r.column: r.nulls for r in profile.null_counts(small).collect()}
    assert nulls == {"id": 0, "cat": 2, "x": 2, "y": 0}  # NaN counts as missing


def test_duplicates_nulls_equal(small):
    assert profile.duplicate_rows(small, ["cat", "y"]).first().duplicates == 3  # (a,0)x3, (None,1)x2
    assert profile.duplicate_rows(small).first().duplicates == 0


def test_value_counts_and_top_values(small):
    vc = [(r.value, r["count"]) for r in profile.value_counts(small, "cat").collect()]
    assert vc == [("a", 3), ("b", 1), ("c", 1)]
    top = profile.top_values(small, ["cat"], 2).orderBy("rank").collect()
    assert [(r.value, r.rank) for r in top] == [("a", 1), ("b", 2)]


def test_distinct_values_keep_null(small):
    vals = {r.value for r in profile.distinct_values(small, ["cat"]).collect()}
    assert vals == {"a", "b", "c", None}
    assert profile.distinct_counts(small, ["cat"]).first().n_distinct == 3


def test_skewness_matches_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.gamma(2.0, 3.0, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = profile.skewness(df, ["x"]).first().skewness
    assert got == pytest.approx(pd.Series(x).skew(), rel=1e-9)


def test_cross_tab_leaves_out_nulls(small):
    ct = {r.cat: (r["0"], r["1"]) for r in profile.cross_tab(small, "cat", "y", [0, 1]).collect()}
    assert ct == {"a": (3, 0), "b": (0, 1), "c": (0, 1)}


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(50, 10, 300), 1)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = {r.bin: r["count"] for r in charts.histogram(df, ["x"], 20).collect()}
    want, _ = np.histogram(x, bins=20)
    assert [got.get(i, 0) for i in range(20)] == want.tolist()


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    got = charts.histogram(df, ["x"], 20).collect()
    want, _ = np.histogram(np.array([3.0] * 4), bins=20)
    assert sorted((r.bin, r["count"]) for r in got) == list(enumerate(want.tolist()))


def test_histogram_edges_as_numpy(spark):
    """Values that lie on bin edges: 0.00 .. 0.10 in steps of a hundredth."""
    vals = [i / 100 for i in range(11)] * 3 + [0.055, 0.0999999]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for bins in (7, 10, 20):
        want, edges = np.histogram(np.array(vals), bins=bins)
        got = sorted((r.bin, r["count"], r.left, r.right) for r in charts.histogram(df, ["x"], bins).collect())
        assert [g[1] for g in got] == want.tolist()
        assert [g[2] for g in got] == [round(e, 6) for e in edges[:-1]] and got[-1][3] == round(edges[-1], 6)


def test_class_shares(small):
    rows = charts.class_shares(small, "y", {0: "no", 1: "yes"}).collect()
    assert [(r["class"], r["count"], r.label, r.name) for r in rows] == [(0, 3, "42.9%", "no"), (1, 4, "57.1%", "yes")]


def test_violin_density_integrates_to_one(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i % 2), float(v)) for i, v in enumerate(rng.normal(0, 1, 400))]
    df = spark.createDataFrame(rows, "y int, x double")
    dens = charts.violin_density(df, "y", ["x"], grid=200).collect()
    for cls in (0, 1):
        pts = sorted((r.x, r.density) for r in dens if r["class"] == cls)
        xs, ds = zip(*pts)
        assert np.trapezoid(ds, xs) == pytest.approx(1.0, abs=0.01)
