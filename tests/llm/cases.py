"""Documents that hold every odd case at once, and plain-Python versions of the operators."""

from __future__ import annotations

import collections
import hashlib
import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as extra columns of the input.
CLASHES = ["rid", "did", "h", "row", "score", "shard", "key", "content", "z", "hits", "base", "weak", "all", "unit", "size", "comp", "n"]


def words(n, seed):
    r = random.Random(seed)
    return [r.choice(["ab", "tion", "the", "of", "über", "x1", "Zed", "re,", "日本"]) + str(r.randrange(40)) for _ in range(n)]


def documents(seed=0):
    """(doc_id, text) rows: copies, near copies, shared passages, short, empty, NULL, long."""
    r = random.Random(seed)
    base = words(120, 1)
    passage = words(60, 2)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, "  ".join(base)), (4, " ".join(base[:60] + ["changed"] + base[61:]))]
    for i in range(5, 12):
        w = list(base)
        for _ in range(2):
            w[r.randrange(len(w))] = f"edit{i}"
        rows.append((i, "\n".join(w)))
    for i in range(12, 24):
        rows.append((i, " ".join(words(30 + i, 100 + i) + passage[: 60 - i] + words(10, 200 + i))))
    rows += [(24, None), (25, ""), (26, " \t\n "), (27, "one"), (28, "one two three four"), (29, "one two three four"),
             (30, "ONE two Three four"), (31, "a" * 5000), (32, " ".join(["same"] * 900)), (33, " ".join(words(20_000, 3))),
             (34, " ".join(passage)), (35, " ".join(passage * 3)), (36, "\u00a0 \u2003 thin\u2009space \x1c sep"), (37, "x\u0301 \U0001f600 y" * 60)]
    return rows


def frame(spark, rows, extra=False, partitions=3):
    data = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(data, DOCS).repartition(partitions)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(c).alias(c) for c in CLASHES])
    return df


def shingle_sets(rows, k=5):
    out = {}
    for i, t in rows:
        w = [x.lower() for x in WORD.findall((t or "").encode())]
        out[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    return out


def near_groups(rows):
    """doc_id -> (set size, smallest linked doc_id), by comparing all pairs that share a shingle."""
    sets = shingle_sets(rows)
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        common = collections.Counter(j for x in s for j in holders[x] if j < i)
        for j, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def phrase_dedup(rows, k=13):
    top = float("inf")
    docs = [(top if i is None else i, WORD.findall((t or "").encode())) for i, t in rows]
    low = {}
    for i, w in docs:
        for j in range(len(w) - k + 1):
            x = tuple(w[j:j + k])
            low[x] = min(low.get(x, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if low[tuple(w[j:j + k])] < i:
                gone[j:j + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((None if i == top else i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def substring_dedup(rows, k=200):
    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(d[j:j + k] for _, d in docs for j in range(len(d) - k + 1))
    out = []
    for i, d in docs:
        gone = bytearray(len(d))
        for j in range(len(d) - k + 1):
            if seen[d[j:j + k]] > 1:
                gone[j:j + k] = b"\1" * k
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append((i, len(d), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


# The base patterns of the secret scan.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def base_spans(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(t) if len(m[0]) >= 16]
    return sorted(found)


def label(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'secret', 'endpoint')[k]}:{s}:{e}" for s, k, e in spans)


def similarity(a, b, k=5):
    """Weighted Jaccard of the word shingles of two word lists."""
    def bag(w):
        return collections.Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else collections.Counter([tuple(w)] if w else [])

    x, y = bag(a), bag(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 0.0


def leaks(docs, items):
    """doc_id -> set of item_ids that some item-sized window matches at 0.75 or more."""
    split = lambda t: [x.lower() for x in WORD.findall((t or "").encode())]
    out = {}
    for i, t in docs:
        w = split(t)
        hit = set()
        for item, text in items:
            v = split(text)
            if not v or not w:
                continue
            n = min(len(v), len(w))
            if len(w) < len(v) or any(similarity(w[s:s + n], v) >= 0.75 for s in range(len(w) - n + 1)):
                if len(w) >= len(v) or similarity(w, v) >= 0.75:
                    hit.add(item)
        out[i] = hit
    return out
