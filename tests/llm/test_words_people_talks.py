"""Spelling variants, personal data and conversation tries against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.llm import pii, prefix_trie, queries, spelling
from tabkit.llm.common import parquet, ship_package

from . import cases

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# ------------------------------------------------------------------ spelling variants
def brute_variants(counts, ratio):
    near, spots = collections.defaultdict(set), collections.defaultdict(list)
    for w in counts:
        for i in range(len(w)):
            spots[w[:i], w[i + 1:]].append(w)
            if w[:i] + w[i + 1:] in counts:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for group in spots.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


@pytest.mark.parametrize("ratio", [2, 10])
def test_variants_with_runs_ties_and_chains(spark, ratio):
    r = random.Random(ratio)
    words = {"".join(r.choice("aabé") for _ in range(r.randrange(1, 7))) for _ in range(400)}
    counts = {w: r.choice([1, 1, 2, 3, 20, 20, 400, 8000, 160000]) for w in words}
    counts |= {"aaa": 1, "aa": 10, "a": 100, "b": 100, "日本語": 3, "日本": 50, "😀x": 2, "😀": 90}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("key", F.lit("clash")).repartition(4)
    assert sorted(tuple(x) for x in spelling.variants(df, ratio).collect()) == brute_variants(counts, ratio)


def test_variants_of_nothing_and_of_one_word(spark):
    kind = "word string, n long"
    assert spelling.variants(spark.createDataFrame([], kind)).collect() == []
    assert [tuple(r) for r in spelling.variants(spark.createDataFrame([("alone", 3)], kind)).collect()] == [("alone", None, "alone", 3, 0, None)]


def test_word_table_against_brute_force(spark):
    long_run = "x" * 50_000
    rows = cases.documents() + [(None, "Straßen Ärgerlich ärgerlich ÄRGERLICH"), (7, "repeated-repeated repeated"), (7, "repeated-repeated repeated"),
                                (50, long_run + " " + long_run[:-1] + " " + long_run), (51, "a×÷b" * 3)]
    seen = collections.Counter()
    low = str.maketrans(spelling.UPPER, spelling.LOWER)
    for i, t in rows:
        for m in re.finditer("[A-Za-zÀ-ÿ]+", t or ""):
            w = m[0].translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            w = w[: h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w
            seen[w] += len(w) >= 7
    words = spelling.count_words(queries.occurrences(cases.frame(spark, rows, extra=True)), 7, 2)
    assert {r.word: r.n for r in words.collect()} == {w: n for w, n in seen.items() if n >= 2}
    assert queries.occurrences(cases.frame(spark, [])).collect() == []


# ------------------------------------------------------------------ personal data
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(t):
    """The patterns as written, without any shortcut."""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(x) for x in re.sub("[^0-9]", "", m[0])][::-1]
        if 14 <= len(d) <= 19 and sum(d[::2] + [x for y in d[1::2] for x in divmod(2 * y, 10)]) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_and_windows():
    r = random.Random(1)
    parts = ["a", ".", "@", "1", "25", "9", "+", "-", " ", "(", ")", "é", "٣", "4111111111111111", "x@y.z", "1.2.3.4", "007"]
    for _ in range(20_000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(1, 30)))
        assert pii.base_spans(t)[0] == plain_spans(t), t
    for _ in range(500):
        t = "".join(r.choice("ab1@" if r.random() < 0.04 else "abc   ") for _ in range(r.randrange(0, 700)))
        assert pii.candidates(t) == [s for s in pii.starts(len(t)) if pii.TRIGGER.search(t, s, s + pii.WINDOW)]


def test_base_spans_are_linear_in_hostile_texts():
    for t in ("a" * 2_000_000, "1" * 2_000_000, "a@" * 500_000, "+1" + "(" * 1_000_000, "1." * 500_000, "@" * 1_000_000):
        pii.base_spans(t)


def test_gradients_by_differences():
    p = {k: v.astype(np.float64) for k, v in pii.fresh(1).items()}
    codes = np.random.default_rng(0).integers(0, pii.CLASSES, (2, pii.WINDOW)).astype(np.int16)
    tags = np.stack([pii.tags_of([(5, 0, 20), (30, 2, 50), (90, 3, 120)], 0, pii.WINDOW)] * 2)
    _, g = pii.loss_and_gradients(p, codes, tags)
    r = np.random.default_rng(2)
    for k in p:
        at = tuple(r.integers(0, s) for s in p[k].shape)
        at = (int(codes[0, 7]), at[1]) if k == "embed" else at
        own, losses = p[k][at], []
        for step in (1e-5, -1e-5):
            p[k][at] = own + step
            losses.append(pii.loss_and_gradients(p, codes, tags)[0])
        p[k][at] = own
        assert abs((losses[0] - losses[1]) / 2e-5 - g[k][at]) < 1e-4 * (1 + abs(g[k][at])), k


def test_viterbi_against_all_paths(monkeypatch):
    monkeypatch.setattr(pii, "TAGS", 3)
    r = np.random.default_rng(5)
    e, move, first = r.normal(size=(5, 4, 3)), r.normal(size=(3, 3)), r.normal(size=3)
    best = pii.viterbi(e, move, first)
    import itertools

    for i in range(4):
        score = lambda y: first[y[0]] + sum(e[t, i, y[t]] for t in range(5)) + sum(move[a, b] for a, b in zip(y, y[1:]))  # noqa: E731,B023
        assert tuple(best[i]) == max(itertools.product(range(3), repeat=5), key=score)


def test_reconcile_joins_cut_spans_and_takes_the_best_set():
    text = "x" * 20 + " " + "1" * 80 + " " + "y" * 100
    cut = [(0, [(21, 2, 96, 9.0)]), (48, [(0, 2, 53, 8.0)])]  # seen in part by both windows
    assert pii.reconcile(cut, text) == [(21, 2, 101)]
    plain = "a 12 34 b"
    assert pii.reconcile([(0, [(2, 0, 7, 3.0), (2, 1, 4, 2.0), (5, 3, 7, 2.5)])], plain) == [(2, 1, 4), (5, 3, 7)]
    assert pii.reconcile([(0, [(2, 0, 7, 5.0), (2, 1, 4, 2.0), (5, 3, 7, 2.5)])], plain) == [(2, 0, 7)]
    assert pii.reconcile([(0, [(2, 0, 3, 5.0), (8, 1, 9, 5.0), (2, 2, 4, -1.0)])], plain) == []  # inside a run, no digit, no margin


def personal(seed, n):
    """Texts with one item each; a third of the card numbers fail the Luhn sum."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        card = "".join(str(r.randrange(10)) for _ in range(15))
        card += next(str(d) for d in range(10) if pii.luhn(card + str(d)) == bool(i % 3))
        item = r.choice([f"{r.choice('abcdef')}{r.randrange(99)}@mail{r.randrange(9)}.example.org", ".".join(str(r.randrange(256)) for _ in range(4)),
                         card, f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}", f"version {r.randrange(9)}.{r.randrange(9)}"])
        words = [r.choice(["the", "of", "über", "thing", "nd"]) for _ in range(30)]
        words[r.randrange(30)] = item
        out.append((i, " ".join(words)))
    return out


def test_the_model_generalises_to_held_out_texts(spark):
    model = pii.fit(cases.frame(spark, personal(1, 900)))
    hits = total = missed_cards = found_cards = false = 0
    for _, t in personal(2, 400):
        base, doubtful = pii.base_spans(t)
        got = pii.model_spans(model, [t])[0]
        hits, total = hits + len(set(base) & set(got)), total + len(base)
        found_cards += sum((s, 2, e) in got for s, e in doubtful)
        missed_cards += len(doubtful)
        false += "version" in t and len(got)
    assert hits >= 0.95 * total and found_cards >= 0.9 * missed_cards > 0 and false <= 4


def test_report_on_odd_rows(spark):
    rows = cases.documents() + personal(3, 60) + [(None, "a@b.cd"), (3, "a@b.cd"), (3, "a@b.cd"), (500, "z " * 300_000 + "4111 1111 1111 1111")]
    got = pii.report(cases.frame(spark, rows, extra=True)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.base_sha256)
    want = []
    for i, t in rows:
        spans = plain_spans(t or "")
        want.append((i, *[sum(k == x for _, k, _ in spans) for x in range(4)], hashlib.sha256(pii.label(spans).encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got], key=str) == sorted(want, key=str)
    assert all(r.n_added == r.spans.count(":") // 2 - (r.n_email + r.n_ip + r.n_card + r.n_phone) for r in sorted(got, key=key))
    assert pii.report(cases.frame(spark, [])).collect() == []
    assert [r.spans for r in pii.report(cases.frame(spark, [(1, "no data 12")])).collect()] == [""]  # nothing to learn from


def test_pii_query_base_columns(spark):
    docs = parquet(spark, SMALL, "documents").collect()
    got = {r.doc_id: r.base_sha256 for r in queries.QUERIES["op12_pii"](spark, SMALL).collect()}
    assert got == {r.doc_id: hashlib.sha256(pii.label(plain_spans(r.text or "")).encode()).hexdigest() for r in docs}


# ------------------------------------------------------------------ conversation trie
def brute_trie(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32], role, text))
    seqs = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    nodes = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    out = []
    for k, members in nodes.items():
        below = [x for x in nodes if x[:len(k)] == k]
        ends = ",".join(map(str, sorted(c for c in members if len(seqs[c]) == len(k))))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], sum(not kids[x] for x in below),
                    sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in below if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TALK = "conv_id long, turn long, role string, text string, key string, seq string, n int"


@pytest.mark.parametrize("container", [100_000, 20, 1])
def test_trie_with_bursts_against_brute_force(spark, container):
    r = random.Random(container)
    rows = []
    for c in range(-3, 150):
        seq = ["start", "é"][: r.randrange(3)] + [r.choice("ab") for _ in range(r.choice([0, 1, 2, 3, 3, 9]))]
        rows += [(c, t, "user", x) for t, x in enumerate(seq)]
    rows += [(1000 + c, t, "user", "copy" * t) for c in range(40) for t in range(6)]  # a group of copies
    rows += [(None, 0, "user", "x"), (900, None, None, None), (900, 4, "user", "a"), (901, 0, None, None), (901, 0, "", ""), (902, 0, "user", "z" * 500_000)]
    df = spark.createDataFrame([(*x, "k", "s", 1) for x in rows], TALK).repartition(5)
    got = prefix_trie.trie(prefix_trie.conversations(df), container).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_trie(rows)


def test_member_digests_from_pieces(monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    import pyarrow as pa

    rows = [("k1", i) for i in range(10)] + [("k2", 5)] + [("k3", i) for i in range(3)]
    table = pa.table({"key": [k for k, _ in rows], "conv_id": [i for _, i in rows]})
    parts = [b for b in prefix_trie.pieces(iter(table.to_batches(max_chunksize=4)))]
    assert sum(b.num_rows for b in parts) == 4 + 1 + 1
    got = {r["key"]: r["ends"] for b in prefix_trie.digests(iter(parts)) for r in b.to_pylist()}
    assert got == {k: hashlib.sha256(",".join(str(i) for x, i in rows if x == k).encode()).hexdigest() for k in ("k1", "k2", "k3")}


def test_trie_of_no_conversations(spark):
    assert prefix_trie.trie(prefix_trie.conversations(spark.createDataFrame([], TALK))).collect() == []
