"""Profile states: merged files against a profile from scratch, and what an update scans."""

import math

import pytest
from pyspark.sql import functions as F

from tabkit.operators import profile, profile_state
from tabkit.session import drop_path, scratch_path, table

COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_comment"]


def rows_of(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    cols = [c for c in COLS if c in df.columns]
    price = F.when(F.col("l_orderkey") % 7 == 0, None).when(F.col("l_orderkey") % 11 == 0, float("nan")).otherwise(F.col("l_extendedprice"))
    return df.select("l_orderkey", *cols).withColumn("l_extendedprice", price).withColumn("nothing", F.lit(None).cast("double"))


@pytest.fixture
def folder(spark, sf_dir):
    path = scratch_path(spark, "profiled")
    df = rows_of(spark, sf_dir)
    df.where("l_orderkey % 3 = 0").repartition(3).write.parquet(path)
    yield path, df
    drop_path(spark, path)


def saved(spark, state):
    path = scratch_path(spark, "profile-state")
    state.write.parquet(path)
    return spark.read.parquet(path)


def test_merged_state_equals_a_profile_from_scratch(spark, folder):
    path, df = folder
    state = saved(spark, profile_state.update_profile(spark, path))
    df.where("l_orderkey % 3 > 0").repartition(4).write.mode("append").parquet(path)
    got = {r.column: r for r in profile_state.profile_from_state(profile_state.update_profile(spark, path, state)).collect()}
    assert sorted(got) == sorted(df.columns) and {r.files for r in got.values()} == {7}
    total = df.count()
    nulls = {r.column: r.nulls for r in profile.null_counts(df).collect()}
    exact = {r.column: r.n_distinct for r in profile.distinct_counts(df, df.columns).collect()}
    for c, r in got.items():
        assert (r.rows, r.missing, r.present) == (total, nulls[c], total - nulls[c])
    numeric = ["l_quantity", "l_extendedprice", "l_discount"]
    skew = {r.column: r.skewness for r in profile.skewness(df, numeric).collect()}
    for c in numeric:
        v = sorted(x for (x,) in df.select(c).collect() if x is not None and not math.isnan(x))
        mean = math.fsum(v) / len(v)
        assert got[c].mean == pytest.approx(mean) and got[c].least == v[0] and got[c].greatest == v[-1]
        assert got[c].stddev == pytest.approx(math.sqrt(math.fsum((x - mean) ** 2 for x in v) / (len(v) - 1)))
        assert got[c].skewness == pytest.approx(skew[c], abs=1e-9)
        for q, x in zip((0.25, 0.5, 0.75), got[c].quantiles):  # the rank of the estimate, ties included
            low, high = sum(y < x for y in v) / len(v), sum(y <= x for y in v) / len(v)
            assert low - 0.01 <= q <= high + 0.01
    for c in ("l_orderkey", "l_extendedprice", "l_returnflag"):
        n = exact[c] - (c == "l_extendedprice")  # NaN is no value here
        assert got[c].n_distinct == pytest.approx(n, rel=0.06)
    assert got["nothing"].mean is None and got["nothing"].quantiles is None and got["nothing"].n_distinct == 0
    assert got["l_returnflag"].mean is None and got["l_returnflag"].quantiles is None


def test_only_new_files_are_scanned(spark, folder):
    path, df = folder
    state = saved(spark, profile_state.update_profile(spark, path).withColumn("least", F.lit(-5.0)))  # a mark on known files
    df.where("l_orderkey % 3 = 1").repartition(2).write.mode("append").parquet(path)
    now = profile_state.update_profile(spark, path, state)
    per_file = now.where("column = 'l_quantity'").groupBy(F.col("least").eqNullSafe(F.lit(-5.0)).alias("known")).count().collect()
    assert {r.known: r["count"] for r in per_file} == {True: 3, False: 2}
    # nothing new: no scan at all, and the state stays as it is
    now = saved(spark, now)  # quantile sketches draw at random, so one written version is compared
    same = profile_state.update_profile(spark, path, now)
    assert same.exceptAll(now).count() == 0 and same.count() == now.count()


def test_gone_changed_and_empty_files(spark, folder):
    path, df = folder
    state = saved(spark, profile_state.update_profile(spark, path))
    df.where("l_orderkey % 3 = 2").coalesce(1).write.mode("overwrite").parquet(path)  # the old files go
    df.limit(0).coalesce(1).write.mode("append").parquet(path)
    now = profile_state.update_profile(spark, path, state)
    got = {r.column: r for r in profile_state.profile_from_state(now).collect()}
    want = df.where("l_orderkey % 3 = 2")
    assert got["l_orderkey"].rows == want.count()
    assert got["l_orderkey"].files == profile_state.listed_files(spark, path).count()
    again = profile_state.update_profile(spark, path, saved(spark, now))
    assert again.count() == now.count()
