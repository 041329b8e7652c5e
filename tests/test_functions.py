import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.functions import distributed as D
from tabkit.functions.scalar import decimal_label, number_or, percent_label, portable_hash

# Edge cases of the number grammar (one text field each) and the value expected.
FIELDS = [
    ("1", 1.0), ("-2.5", -2.5), ("", -1.0), ("abc", -1.0), ("nan", -1.0), ("inf", -1.0),
    ("1d", -1.0), ("0x10", -1.0), ("1_000", -1.0), (" 2 ", 2.0), (".5", 0.5), ("5.", 5.0),
    ("1e3", 1000.0), ("007", 7.0), ("1/2", -1.0), ("+3", 3.0), (None, -1.0),
]


def test_number_grammar(spark):
    df = spark.createDataFrame([(f,) for f, _ in FIELDS], "f string")
    got = [r.n for r in df.select(number_or("f").alias("n")).collect()]
    assert got == [v for _, v in FIELDS]


def test_portable_hash_matches_duckdb(spark):
    ids = list(range(1, 200)) + [10 ** 12, 7]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r.id: r.h for r in df.select("id", portable_hash("id").alias("h")).collect()}
    con = duckdb.connect()
    for i in ids:
        want = con.execute(f"select ('0x' || substr(md5('42|' || {i}::varchar), 1, 8))::bigint").fetchone()[0]
        assert got[i] == want
        assert 0 <= got[i] < 2 ** 32


def test_percent_label(spark):
    df = spark.createDataFrame([(51.25,), (3.0,), (12345.678,), (None,)], "x double")
    got = [r.s for r in df.select(percent_label("x").alias("s")).collect()]
    assert got == ["51.2%", "3.0%", "12345.7%", None]  # ties to even, no thousands separator


def test_labels_round_as_printf(spark):
    """Ties, near-ties and random values against the C format of the exact double."""
    rng = np.random.default_rng(4)
    xs = [k / 8 for k in range(-400, 400)] + [k / 20 for k in range(2000)] + [k / 200 for k in range(2000)]
    xs += rng.uniform(-1e4, 1e4, 2000).round(3).tolist() + [1e15, 1e17, 0.05, 0.15, 0.005, 1.005, 2.675]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = df.select("x", decimal_label("x", 1).alias("a"), decimal_label("x", 2).alias("b")).collect()
    for r in got:
        if r.x < 0 and round(r.x, 1) == 0:
            continue
        assert (r.a, r.b) == (f"{r.x:.1f}", f"{r.x:.2f}"), r.x


def _pandas_quantile(values, p):
    return float(np.quantile(np.array(values, dtype=float), p))


@pytest.mark.parametrize("accuracy,held,grid", [(D.ACCURACY, D.HELD, D.GRID), (8, D.HELD, D.GRID), (200, 3, 20)])
def test_exact_quantiles(spark, accuracy, held, grid, monkeypatch):
    monkeypatch.setattr(D, "ACCURACY", accuracy)  # 8: wide brackets
    monkeypatch.setattr(D, "HELD", held)  # 3: several rounds
    monkeypatch.setattr(D, "GRID", grid)
    rng = np.random.default_rng(3)
    rows = []
    for g in ("a", "b", "c"):
        n = {"a": 101, "b": 40, "c": 7}[g]
        vals = np.round(rng.lognormal(3, 1.5, n), 2).tolist()
        vals += [vals[0]] * 5  # ties
        rows += [(g, float(v)) for v in vals]
    rows += [(None, 1.5), (None, 2.5)]  # a NULL group is a group
    rows += [("a", None), ("b", float("nan"))]  # skipped
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.25, 0.5, 0.75, 0.0, 1.0]
    q = D.exact_quantiles(df, "v", probs, ["g"]).collect()
    assert len(q) == 4 * len(probs)
    for r in q:
        vals = [v for g, v in rows if g == r.g and v is not None and not math.isnan(v)]
        assert r.value == pytest.approx(_pandas_quantile(vals, r.prob), rel=1e-12, abs=1e-9)


def test_selection_over_ten_million_values_holds_few(spark, monkeypatch):
    """Every value inside a bracket that a task may hold is counted beforehand: under 1 % of the rows,
    also where the bound asks for more rounds."""
    n, prime = 10_000_000, 7_919_111
    df = spark.range(0, n, 1, 16).select(((F.col("id") * prime) % n).cast("double").alias("v"))  # every value once
    bounds, narrow = [], D._narrow

    def spied(data, state, entries, g, groups, last):
        out = narrow(data, state, entries, g, groups, last)
        bounds.append((last, out[1]))
        return out

    monkeypatch.setattr(D, "_narrow", spied)
    for held in (D.HELD, 500):
        monkeypatch.setattr(D, "HELD", held)
        got = {r.prob: r.value for r in D.exact_quantiles(df, "v", [0.0, 0.3, 0.5, 0.999]).collect()}
        assert got == {0.0: 0.0, 0.3: pytest.approx(0.3 * (n - 1)), 0.5: (n - 1) / 2, 0.999: pytest.approx(0.999 * (n - 1))}
    assert [b[0] for b in bounds] == [True, False, True] and bounds[1][1] <= 500 < 0.01 * n


def test_exact_quantiles_even_count_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    assert D.exact_quantiles(df, "v", [0.5]).first().value == 2.5


def test_exact_quantiles_over_the_whole_double_range(spark):
    """Values that no equal-width histogram separates: both ends of the range, and powers of two."""
    vals = [1.7e308, -1.7e308] * 500 + [2.0 ** -k for k in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(4)
    got = {r.prob: r.value for r in D.exact_quantiles(df, "v", [0.0, 0.25, 0.3, 0.5, 0.9, 1.0]).collect()}
    s = sorted(vals)
    for p, v in got.items():
        i = (len(s) - 1) * p
        a, b = s[math.floor(i)], s[min(math.floor(i) + 1, len(s) - 1)]
        assert v == pytest.approx(a if a == b else a + (b - a) * (i - math.floor(i)), rel=1e-12)


def test_exact_quantiles_constant_group(spark):
    df = spark.createDataFrame([("k", 5.0)] * 30, "g string, v double")
    r = D.exact_quantiles(df, "v", [0.5], ["g"]).first()
    assert r.value == 5.0


def test_running_totals_by_group(spark):
    rows = [(g, float(k), k % 3) for g in ("a", "b", None) for k in range(40)]
    df = spark.createDataFrame(rows, "g string, k double, x int")
    got = {(r.g, r.k): (r.cum_x, r.tot_x) for r in D.running_totals(df, "k", ["x"], group_cols=["g"]).collect()}
    assert got == {(g, float(k)): (sum(j % 3 for j in range(k + 1)), sum(j % 3 for j in range(40))) for g, k in
                   [(g, k) for g in ("a", "b", None) for k in range(40)]}


def test_running_totals(spark):
    n = 60
    df = spark.createDataFrame([(float(i * 3 % 61), i % 5) for i in range(n)], "k double, x int")
    out = D.running_totals(df, "k", ["x"], descending=True).collect()
    rows = sorted(((r.k, r.x) for r in df.collect()), reverse=True)
    cum, want = 0, {}
    for k, x in rows:
        cum += x
        want[k] = cum
    assert {r.k: r.cum_x for r in out} == want
    assert {r.tot_x for r in out} == {sum(x for _, x in rows)}


def test_dense_index(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "v string")
    got = {r.v: r.code for r in D.dense_index(df, "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_top_k_per_group(spark):
    rows = [("x", f"v{i:03d}", i % 17) for i in range(200)] + [("y", "only", 1)]
    df = spark.createDataFrame(rows, "g string, value string, c int").repartition(5)
    got = D.top_k_per_group(df, ["g"], [F.desc("c"), F.asc("value")], 3).collect()
    xs = sorted([r for r in got if r.g == "x"], key=lambda r: r.rank)
    want = sorted([r for r in rows if r[0] == "x"], key=lambda r: (-r[2], r[1]))[:3]
    assert [(r.value, r.c) for r in xs] == [(w[1], w[2]) for w in want]
    assert [r.rank for r in got if r.g == "y"] == [1]


def test_number_grammar_property(spark):
    """Every string of the grammar reads as Python reads it; strings outside it give -1."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from tabkit.functions.scalar import NUMBER_PATTERN

    seen = []

    @settings(max_examples=40, deadline=None)
    @given(st.lists(st.from_regex(NUMBER_PATTERN, fullmatch=True).filter(lambda x: len(x) < 40), min_size=1, max_size=20),
           st.lists(st.text(min_size=1, max_size=8), min_size=1, max_size=20))
    def collect(good, other):
        seen.extend((g, float(g)) for g in good)
        seen.extend((o, -1.0) for o in other if not _matches(o))

    collect()
    df = spark.createDataFrame(seen, "s string, want double")
    got = df.select("want", number_or("s").alias("n")).collect()
    for r in got:
        assert r.n == r.want or (math.isinf(r.want) and math.isinf(r.n))


def _matches(text):
    import re

    from tabkit.functions.scalar import NUMBER_PATTERN

    return re.match(NUMBER_PATTERN, text.strip()) is not None


def test_exact_quantiles_with_infinities(spark):
    inf = float("inf")
    vals = [-inf, -inf, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, inf]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    got = {r.prob: r.value for r in D.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.75, 1.0], ["g"]).collect()}
    assert got[0.0] == -inf and got[0.1] == -inf and got[1.0] == inf
    assert got[0.5] == pytest.approx(np.quantile(np.array(vals[2:9]), (0.5 * 9 - 2) / 6))
    assert got[0.75] == pytest.approx(5.75)


def test_top_k_above_group_limit_threshold(spark):
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        test_top_k_per_group(spark)
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
