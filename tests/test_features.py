import numpy as np
import pandas as pd
import pytest

from tabkit.operators import features


@pytest.fixture()
def table(spark):
    rows = [
        (1, "x", "lo", 1.0, None), (2, "y", "hi", 2.0, 5), (3, None, "hi", 3.0, 5),
        (4, "x", None, None, 7), (5, "y", "mid", 10.0, 5),
    ]
    return spark.createDataFrame(rows, "id bigint, c1 string, c2 string, a double, b int")


def test_median_even_count_interpolates(table):
    assert features.fit_median(table, ["a", "b"]) == {"a": 2.5, "b": 5.0}


def test_median_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "a double")
    assert features.fit_median(df, ["a"]) == {"a": 2.0}


def test_scale_population_and_zero_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, z double")
    out = features.standard_scale(df, ["a", "z"]).collect()
    assert [r.a for r in out] == [-1.0, 1.0]  # population deviation is 1
    assert [r.z for r in out] == [0.0, 0.0]  # zero deviation divides by 1


def test_one_hot_sorted_and_unseen_zero(spark, table):
    filled = features.fill_constant(table, ["c1"])
    cats = features.fit_one_hot(filled, ["c1"])
    assert cats == {"c1": ["missing", "x", "y"]}
    new = spark.createDataFrame([(9, "z")], "id bigint, c1 string")
    row = features.apply_one_hot(new, cats).first().asDict()
    assert row == {"id": 9, "c1_missing": 0.0, "c1_x": 0.0, "c1_y": 0.0}


@pytest.mark.parametrize("inline", [256, 0])
def test_ordinal_unseen_minus_one(spark, table, monkeypatch, inline):
    monkeypatch.setattr(features, "INLINE_DICT", inline)  # 0: dictionary join path
    filled = features.fill_constant(table, ["c2"])
    dicts = features.fit_ordinal(filled, ["c2"])
    new = spark.createDataFrame([(1, "hi"), (2, "zzz"), (3, "missing"), (4, None)], "id bigint, c2 string")
    got = {r.id: r.c2 for r in features.apply_ordinal(new, dicts).collect()}
    assert got == {1: 0, 2: -1, 3: 3, 4: -1}  # hi < lo < mid < missing


def test_category_codes_null_minus_one(table):
    got = {r.id: r.c1 for r in features.apply_category_codes(table, ["c1"]).collect()}
    assert got == {1: 0, 2: 1, 3: -1, 4: 0, 5: 1}


def test_index_label_frequency_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "s string")
    out, _ = features.index_label(df, "s", "idx")
    got = {r.s: r.idx for r in out.distinct().collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_prepare_column_order_and_refit(spark, table):
    out, model = features.prepare(table, "b", ["a"], ["c1"], ["c2"], ["id"])
    assert out.columns == ["b", "c2", "a", "c1_missing", "c1_x", "c1_y"]
    assert out.where("a is null").count() == 0
    test = spark.createDataFrame([(9, "w", "new", None, 1)], table.schema)
    row = model.transform(test).first().asDict()
    assert row["c2"] == -1 and row["c1_x"] == 0.0 and row["c1_missing"] == 0.0
    # the fill value is the training median, scaled with training moments
    mean, sd = model.scale["a"]
    assert row["a"] == pytest.approx((2.5 - mean) / sd)


def test_numbers_are_categories_in_their_own_order(spark):
    df = spark.createDataFrame([(10,), (2,), (1,), (2,), (None,)], "n int")
    d = features.category_dictionary(df, "n")
    assert d.inline == {"1": 0, "2": 1, "10": 2}
    assert features.fit_one_hot(df, ["n"]) == {"n": ["1", "2", "10"]}


def test_large_numeric_dictionary_in_its_own_order(spark, monkeypatch):
    monkeypatch.setattr(features, "INLINE_DICT", 2)
    df = spark.createDataFrame([(float(x),) for x in (10, 9, -3, 200, 9)], "n double")
    got = {r.value: r.code for r in features.category_dictionary(df, "n").table.collect()}
    assert got == {"-3.0": 0, "9.0": 1, "10.0": 2, "200.0": 3}


def test_one_hot_without_a_cap(spark):
    """More categories than columns are sensible: the sparse vector form."""
    df = spark.createDataFrame([(f"c{i:05d}",) for i in range(3000)] + [(None,)], "c string")
    fitted = features.category_dictionary(df, "c")
    out = features.one_hot_vector(df, "c", "v", fitted).collect()
    for r in out:
        assert r.v.size == 3000
        assert r.v.indices.tolist() == ([] if r.c is None else [int(r.c[1:])])
    unseen = features.one_hot_vector(spark.createDataFrame([("new",)], "c string"), "c", "v", fitted).first()
    assert unseen.v.numNonzeros() == 0
    assert len(features.fit_one_hot(df, ["c"])["c"]) == 3000


def test_nan_is_missing_everywhere(spark):
    from tabkit.operators import profile

    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (float("nan"),), (None,)], "x double")
    assert profile.schema_profile(df).first().non_null == 4 and profile.null_counts(df).first().nulls == 2
    assert abs(profile.skewness(df, ["x"]).first().skewness - pd.Series([1.0, 2.0, 4.0, 9.0]).skew()) < 1e-12
    mean, sd = features.fit_scale(df, ["x"])["x"]
    assert mean == 4.0 and abs(sd - np.std([1, 2, 4, 9])) < 1e-12


def test_filled_moments_are_those_of_the_filled_column(spark):
    vals = [1.0, 5.0, None, 2.5, None, float("nan"), 40.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    medians = features.fit_median(df, ["x"])
    mean, sd = features.filled_moments(df, ["x"], medians)["x"]
    seen = [v for v in vals if v is not None and v == v]
    filled = np.array(seen + [np.median(seen)] * 3)
    assert abs(mean - filled.mean()) < 1e-12 and abs(sd - filled.std()) < 1e-12
