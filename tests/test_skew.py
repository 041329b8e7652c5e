"""One key holding a third of all rows: results stay exact on the code paths
meant for large inputs (refined quantile brackets, shuffled dictionary joins,
two-round top-k)."""

import numpy as np
import pytest

from tabkit.functions import distributed as D
from tabkit.operators import features, profile


@pytest.fixture()
def skewed(spark):
    rng = np.random.default_rng(11)
    n = 3000
    keys = np.where(np.arange(n) < n // 3, "hot", np.char.add("k", (rng.integers(0, 400, n)).astype(str)))
    vals = rng.normal(0, 1, n).round(4)
    rows = [(int(i), str(k), float(v)) for i, (k, v) in enumerate(zip(keys, vals))]
    return spark.createDataFrame(rows, "id bigint, key string, v double").repartition(6), rows


def test_top_values_with_hot_key(skewed):
    df, rows = skewed
    top = profile.top_values(df, ["key"], 3).orderBy("rank").collect()
    assert top[0].value == "hot" and top[0]["count"] == 1000


def test_quantiles_of_hot_group(skewed):
    df, rows = skewed
    got = {r.prob: r.value for r in D.exact_quantiles(df.where("key = 'hot'"), "v", [0.1, 0.5, 0.9]).collect()}
    hot = np.array([v for _, k, v in rows if k == "hot"])
    for p, v in got.items():
        assert v == pytest.approx(float(np.quantile(hot, p)), abs=1e-12)


def test_shuffled_dictionary_join_with_hot_key(spark, skewed, monkeypatch):
    df, rows = skewed
    monkeypatch.setattr(features, "INLINE_DICT", 2)
    monkeypatch.setattr(features, "BROADCAST_ROWS", 2)  # no broadcast: a shuffled left join
    d = features.category_dictionary(df, "key")
    assert d.inline is None
    out = features.dictionary_lookup(df, "key", d, -1, out="code")
    codes = dict(out.select("id", "code").collect())
    values = sorted({k for _, k, _ in rows})
    want = {i: values.index(k) for i, k, _ in rows}
    assert codes == want


def test_duplicates_with_hot_key(skewed):
    df, rows = skewed
    dup = profile.duplicate_rows(df, ["key"]).first().duplicates
    assert dup == len(rows) - len({k for _, k, _ in rows})
