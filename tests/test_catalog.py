"""Every catalog query against its DuckDB oracle on the smallest test tables,
the rows-only queries for running, and partition-count invariance."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tabkit.plans.catalog import ORACLE, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "label"


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, sf_dir, name):
    sdf = QUERIES[name](spark, sf_dir)
    got = [r.asDict() for r in sdf.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    want = [dict(zip(ocols, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(ocols)
    types = dict(zip(ocols, (str(t) for t in con.sql(ORACLE[name]).types)))
    assert {c: SQL_TYPES.get(t, t) for c, t in sdf.dtypes} == types
    cols = sorted(ocols)
    assert _rows(got, cols) == _rows(want, cols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", ["auc_prob", "violin_quartiles", "exact_split", "classification_report", "top_values",
                                  "histogram", "violin_density", "prep_apply_test", "pick_best", "best_worst_runs"])
def test_invariant_to_shuffle_partitions(spark, sf_dir, name):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = QUERIES[name](spark, sf_dir)
            results.append(_rows([r.asDict() for r in df.collect()], sorted(df.columns)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("name", ["violin_quartiles", "impute_median", "prep_apply_test", "auc_prob",
                                  "category_dictionary", "dictionary_lookup"])
def test_wide_brackets_and_joined_dictionaries_match_oracle(spark, con, sf_dir, name, monkeypatch):
    from tabkit.functions import distributed as D
    from tabkit.operators import features

    monkeypatch.setattr(D, "ACCURACY", 20)
    monkeypatch.setattr(features, "INLINE_DICT", 3)
    test_query_matches_oracle(spark, con, sf_dir, name)


@pytest.mark.parametrize("name", ["violin_quartiles", "impute_median", "prep_apply_test", "auc_prob", "classification_report",
                                  "lr_saturated", "exact_split", "dictionary_lookup"])
def test_queries_release_what_they_persist(spark, sf_dir, name):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    QUERIES[name](spark, sf_dir).count()
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


FORBIDDEN_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                   "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_plan_stays_in_the_jvm(spark, sf_dir, name):
    """No Python evaluation and no pairwise (cartesian / nested-loop) joins in the plan."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN_NODES if n in plan]
