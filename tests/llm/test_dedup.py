"""Near, phrase and substring dedup against brute force, on odd cases and skewed groups."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tabkit.llm import anchors, minhash, substrings, suffix_dedup
from tabkit.llm.common import ship_package

from . import cases


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def near(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(df).collect()}


@pytest.mark.parametrize("extra", [False, True])
def test_near_groups_on_odd_cases(spark, extra):
    rows = cases.documents()
    got = near(cases.frame(spark, rows, extra))
    assert got == cases.near_groups(rows)
    assert got[24] == (0, 24) and got[28][1] == 28 and got[29][1] == 28 and got[30][1] == 28


def test_near_groups_of_a_chain_and_a_crowd(spark):
    """Neighbours in a chain are linked, its ends are not; a crowd of edited copies shares
    every bucket."""
    base = cases.words(100, 9)
    rows = [(100 + i, " ".join(base[2 * i: 2 * i + 60])) for i in range(20)]
    rows += [(i, " ".join(base[:40] + [f"own{i}"] + base[41:])) for i in range(60)]
    rows += [(500 + i, " ".join(base[:30] + cases.words(40, 1000 + i))) for i in range(20)]
    assert near(cases.frame(spark, rows)) == cases.near_groups(rows)


def test_near_groups_null_id_repeats_and_empty(spark):
    text = " ".join(cases.words(50, 4))
    rows = [(None, text), (None, text), (7, text), (7, text), (9, text)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_groups(cases.frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(7, 7, True)] * 2 + [(9, 7, False)], key=str)
    assert minhash.near_groups(cases.frame(spark, [])).count() == 0
    kept = minhash.keep_one(cases.frame(spark, rows, extra=True))
    assert kept.count() == 4 and set(cases.CLASHES) <= set(kept.columns)


def test_contracted_paths(spark):
    """A long path, a star and a ring."""
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)]
    got = {r.node: r.root for r in minhash.contracted(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(50))
    assert all(got[2000 + i] == 2000 for i in range(30))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (600, 200, 200))
    s = minhash.signatures([np.union1d(shared, a), np.union1d(shared, b)], 512)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.1


def phrases(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.drop_repeats(df).collect()), key=str)


def cuts(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.drop_substrings(df).collect()), key=str)


@pytest.mark.parametrize("hot", [8192, 2])
def test_phrases_and_substrings_on_odd_cases(spark, hot, monkeypatch):
    """Also with every shared anchor treated as one with too many contents for a shard."""
    monkeypatch.setattr(anchors, "HOT_CONTENTS", hot)
    rows = cases.documents() + [(None, " ".join(cases.words(120, 1))), (None, " ".join(cases.words(120, 1))), (1, " ".join(cases.words(120, 1)))]
    df = cases.frame(spark, rows, extra=True)
    assert phrases(df) == sorted(cases.phrase_dedup(rows), key=str)
    assert cuts(df) == sorted(cases.substring_dedup(rows), key=str)


def test_empty_tables(spark):
    assert phrases(cases.frame(spark, [])) == [] and cuts(cases.frame(spark, [])) == []


def test_shards_do_not_matter(spark, monkeypatch):
    rows = cases.documents(5)
    df = cases.frame(spark, rows, partitions=7)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    assert phrases(df) == sorted(cases.phrase_dedup(rows), key=str)
    assert cuts(df) == sorted(cases.substring_dedup(rows), key=str)


@given(st.lists(st.integers(1, 3), max_size=80), st.sampled_from([0, 256]))
@settings(deadline=None, max_examples=200)
def test_suffix_array(symbols, dense):
    s = np.array([*symbols, 0], np.int64)
    suffix_dedup.DENSE, old = dense, suffix_dedup.DENSE
    try:
        sa = suffix_dedup.suffix_array(s)
    finally:
        suffix_dedup.DENSE = old
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    shared = suffix_dedup.permuted_prefixes(s, sa)
    for a, b in zip(sa[1:].tolist(), sa[:-1].tolist()):
        n = 0
        while s[a + n] == s[b + n]:
            n += 1
        assert shared[a] == n


def by_suffixes(s):
    return sorted(range(len(s)), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("dense", [0, 1 << 30])
def test_a_level_of_the_suffix_array_is_induced_once(dense, monkeypatch):
    """Long runs of one type are ordered by their symbols too, not by the plain loop."""
    rng = np.random.default_rng(1)
    part = rng.integers(1, 9, 400)
    s = np.concatenate([part, np.full(90, 5), part, np.arange(1, 120), part[::-1], np.arange(120, 1, -1), part, [0]])
    expected, calls = by_suffixes(s), {"levels": 0, "induced": 0}

    def counted(name, fn):
        def call(*args):
            calls[name] += 1
            return fn(*args)
        return call

    monkeypatch.setattr(suffix_dedup, "DENSE", dense)
    monkeypatch.setattr(suffix_dedup, "is_small", counted("levels", suffix_dedup.is_small))  # asked once a level
    monkeypatch.setattr(suffix_dedup, "induce", counted("induced", suffix_dedup.induce))
    monkeypatch.setattr(suffix_dedup, "induce_plain", None)
    assert suffix_dedup.suffix_array(s).tolist() == expected
    assert calls["levels"] > 1 and calls["induced"] == calls["levels"]


@pytest.mark.parametrize("s", [[1] * 5000, list(range(1, 2000)), [3] + [2] * 1500 + [3] + [2] * 1500 + [1], [1, 2] * 700, [7], []])
def test_suffix_array_of_long_runs(s):
    s = np.array([*s, 0], np.int64)
    assert suffix_dedup.suffix_array(s).tolist() == by_suffixes(s)


@given(st.lists(st.text("ab\u00e9", max_size=40), min_size=1, max_size=6), st.integers(1, 6), st.data())
@settings(deadline=None, max_examples=200)
def test_repeated_starts(texts, width, data):
    contents = [t.encode() for t in texts]
    copies = np.array(data.draw(st.lists(st.integers(1, 2), min_size=len(texts), max_size=len(texts))))
    count = Counter()
    for c, n in zip(contents, copies.tolist()):
        count.update({w: n * k for w, k in Counter(c[i: i + width] for i in range(len(c) - width + 1)).items()})
    got = suffix_dedup.repeated_starts(contents, copies, width)
    for c, runs in zip(contents, got):
        found = [first + i for first, n, _ in np.frombuffer(runs or b"", np.int64).reshape(-1, 3).tolist() for i in range(n)]
        assert found == [i for i in range(len(c) - width + 1) if count[c[i: i + width]] > 1]


def test_leftmost_min():
    v = np.array([5, 3, 3, 9, 1, 1, 7, 3], np.uint64)
    for w in range(1, 9):
        assert anchors.leftmost_min(v, w).tolist() == [i + int(np.argmin(v[i:i + w])) for i in range(len(v) - w + 1)]


def test_every_window_lies_in_one_segment():
    from tabkit.llm.anchors import segments, unit_hashes

    texts = [b"", b"a b", b"x " * 50, " ".join(cases.words(200, 1)).encode(), b"q"]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    for kind, width, gram in (("word", 13, 4), ("byte", 50, 10)):
        text, lo, n, h = segments(*unit_hashes(data, bounds, kind), width, gram)
        seen = sorted((t, w) for t, a, k in zip(text.tolist(), lo.tolist(), n.tolist()) for w in range(a, a + k))
        units = [len(t.split()) if kind == "word" else len(t) for t in texts]
        assert seen == [(i, w) for i, u in enumerate(units) for w in range(u - width + 1)]


def test_word_hash_has_no_structured_collisions(spark):
    """Words that polynomials modulo 2**64 cannot tell apart, whatever their base, and plain ones."""
    import itertools

    from tabkit.llm.common import Words

    word = "a"
    for _ in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
    pairs = [word[:n] for n in (8, 16, 64, 128, 256, 257, 512, 1024, 2048, 4096)]
    pairs += [w.translate(str.maketrans("ab", "ba")) for w in pairs]
    pairs += ["".join(w) for k in range(1, 9) for w in itertools.product("ab", repeat=k)] + ["x\0"[:1], "x\0y", "x"]
    data = " ".join(pairs).encode()
    found = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower=False).hash
    assert len(set(found.tolist())) == len(set(pairs))
    twice = np.frombuffer(b"A" + data.upper() + b" " + data, np.uint8)[1:]
    both = Words(twice, np.array([0, len(twice)]), lower=True).hash
    assert (both[: len(found)] == both[len(found):]).all() and (both[: len(found)] == found).all()
    for n in (1024, 2048):
        a = word[:n]
        b = a.translate(str.maketrans("ab", "ba"))
        rows = cases.frame(spark, [(1, a), (2, b)])
        assert all(r.kept for r in minhash.near_groups(rows).collect())


def test_keep_one_loses_no_text_of_a_shared_doc_id(spark):
    one, two = " ".join(cases.words(40, 1)), " ".join(cases.words(40, 2))
    rows = [(3, one), (7, one), (7, two), (7, two), (9, two)]
    kept = sorted((r.doc_id, r.text) for r in minhash.keep_one(cases.frame(spark, rows, extra=True)).collect())
    assert kept == sorted([(3, one), (7, two), (7, two)])
