import math

from pyspark.sql import functions as F

from tabkit.operators import splits
from tabkit.plans import fixtures as fx


def test_exact_split_size(spark, sf_dir):
    s = fx.survey(spark, sf_dir)
    n = s.count()
    out = splits.exact_split(s, "id", 0.2)
    assert out.where(F.col("split") == "test").count() == math.ceil(0.2 * n)
    assert out.count() == n


def test_exact_split_small_table(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "id bigint")
    assert splits.exact_split(df, "id", 0.2).where("split = 'test'").count() == 2
    empty = spark.createDataFrame([], "id bigint")
    assert splits.exact_split(empty, "id").count() == 0


def test_exact_split_with_repeated_and_null_keys(spark):
    """The size is exact whatever the keys: two keys, one key, NULL keys, one hot key among many."""
    tables = {
        "two": [(i % 2, i) for i in range(100)],
        "one": [(7, i) for i in range(101)],
        "nulls": [(None, i) for i in range(40)] + [(i, i) for i in range(11)],
        "hot": [(5 if i % 3 else i, i) for i in range(500)],
        "copies": [(3, 0)] * 60,
    }
    for name, rows in tables.items():
        df = spark.createDataFrame(rows, "k long, v long")
        for parts in (1, 7):
            out = splits.exact_split(df.repartition(parts), "k", 0.2)
            got = out.collect()
            assert sum(r.split == "test" for r in got) == math.ceil(0.2 * len(rows)), name
            assert sorted((r.k is None, r.k or 0, r.v) for r in got) == sorted((k is None, k or 0, v) for k, v in rows), name
            mixed = [k for k in {r.k for r in got} if len({r.split for r in got if r.k == k}) == 2]
            assert len(mixed) <= 1, name  # only the key at the cut is on both sides


def test_folds_disjoint_cover_and_partition_invariant(spark, sf_dir):
    s = fx.survey(spark, sf_dir).select("id")
    results = []
    for parts in (1, 3, 8):
        f = splits.assign_folds(s.repartition(parts), "id", 4)
        results.append(sorted((r.id, r.fold) for r in f.collect()))
    assert results[0] == results[1] == results[2]
    ids = [i for i, _ in results[0]]
    assert len(ids) == len(set(ids))
    assert {fold for _, fold in results[0]} == {0, 1, 2, 3}


def test_training_folds_and_union(spark, sf_dir):
    f = splits.assign_folds(fx.survey(spark, sf_dir).select("id"), "id", 4)
    a = splits.training_folds(f, 0)
    b = splits.union_folds([f.where(F.col("fold") == k) for k in (1, 2, 3)])
    assert sorted(a.collect()) == sorted(b.collect())


def test_null_keys_have_a_fold(spark):
    df = spark.createDataFrame([(i,) for i in range(20)] + [(None,)] * 3, "id long")
    folded = splits.assign_folds(df, "id", 4)
    assert folded.where("fold is null").count() == 0
    assert sum(splits.training_folds(folded, k).count() for k in range(4)) == 3 * 23
