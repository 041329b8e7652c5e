"""The registered queries: oracles where SQL expresses them, brute force where not, and the
pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from tabkit.llm import minhash, quality, queries
from tabkit.llm.common import parquet

from . import cases

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, result.fetchall()))


def test_thirteen_queries():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_dedup_queries_against_brute_force(spark, con):
    rows = con.execute("select doc_id, text from documents").fetchall()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op5_minhash"](spark, SMALL).collect()}
    assert got == cases.near_groups(rows)
    assert sorted(tuple(r) for r in queries.QUERIES["op6_phrase_dedup"](spark, SMALL).collect()) == sorted(cases.phrase_dedup(rows))
    assert sorted(tuple(r) for r in queries.QUERIES["op10_suffix_dedup"](spark, SMALL).collect()) == sorted(cases.substring_dedup(rows))


def test_leak_query_against_brute_force(spark, con):
    rows = con.execute("select doc_id, text from documents where length(text) < 1500").fetchall()
    items = con.execute("select item_id, text from benchmark").fetchall()
    want = cases.leaks(rows, items)
    got = {r.doc_id: r.n_items for r in queries.QUERIES["op7_decontaminate"](spark, SMALL).collect()}
    assert all(got[i] == len(s) for i, s in want.items())


def test_pipeline_against_its_parts(spark, con):
    """Every stage's decision, taken anew from plain versions of its operator."""
    out = corpus_pipeline.run(spark, SMALL).collect()
    rows = con.execute("select doc_id, text from documents").fetchall()
    scores = {r.doc_id: r.predicted for r in quality.scores(parquet(spark, SMALL, "documents"), parquet(spark, SMALL, "labels")).collect()}
    rows = [(i, t) for i, t in rows if scores[i]]
    groups = cases.near_groups(rows)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    bad = {r.doc_id for r in queries.QUERIES["op7_decontaminate"](spark, SMALL).collect() if r.contaminated}
    rows = [(i, t) for i, t in rows if i not in bad]
    assert {r.doc_id for r in out} == {i for i, _ in rows}
    for i, t in rows:
        spans = cases.base_spans(t)
        if not spans:
            continue
        parts, at = [], 0
        for s, _, e in spans:
            if s >= at:
                parts += [t[at:s], "[secret]"]
            at = max(at, e)
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(queries.VOCABULARY)
        want = len(tok.encode("".join(parts) + t[at:], add_special_tokens=False).ids) + 1
        assert {r.doc_tokens for r in out if r.doc_id == i} == {want}


def test_stages_keep_the_columns_of_documents(spark):
    docs = cases.frame(spark, cases.documents())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "packing"]


def test_stages_on_empty_and_odd_tables(spark):
    for rows in ([], cases.documents() + [(None, None), (None, "x"), (3, "again")]):
        docs = cases.frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        assert docs.count() >= (1 if rows else 0)


def test_near_dedup_stage_keeps_the_smallest(spark):
    rows = cases.documents()
    kept = {r.doc_id for r in minhash.keep_one(cases.frame(spark, rows)).collect()}
    assert kept == {i for i, (_, c) in cases.near_groups(rows).items() if i == c}
