"""Personal data: patterns, and a character-level BiLSTM with a CRF that adds what they miss.

Base spans (``email``, ``ip``, ``card``, ``phone``) are matched leftmost and non-overlapping per
kind over the whole text; a match that fails its check is dropped. They label the training data:
a window of text with its base spans. A match that fails only a value check (the Luhn sum, a part
above 255) is neither a positive nor a negative, so windows that hold one are not learnt from.

The model reads characters as classes, runs one LSTM in each direction and scores tag sequences
(outside, begin and inside of each kind) with a linear-chain CRF. It is trained in numpy, with the
gradients written out, from at most ``SAMPLE`` windows: those with the smallest hashes of all, a
documented bound. Windows of ``WINDOW`` characters overlap by half. A span of the model must hold
a digit or ``@``, as every labelled span does, so windows without one need no decoding. The
windows of a document are decoded each, spans cut by a window's edge are joined with what the next
window saw of them, and of all spans of the document those without overlap and of the largest
total margin are kept. A span of the model that starts or ends inside a run of letters and digits
is dropped, and so is one that meets a base span: base spans stay.

Positions are code points, end exclusive.

Defined results: a NULL text counts as empty and has no spans; a NULL doc_id is kept; repeated rows
get equal results; spans of equal total are settled by the earlier end; a text of any length is
read whole, its windows in blocks of ``BLOCK``; without a single labelled window (an empty table, a
table without personal data) no model is trained and only base spans are given; only ``doc_id``
and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of the scan: the kinds and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Characters of a window; windows overlap by half.
WINDOW = 96
STEP = WINDOW // 2
#: Windows that the model is trained on, at most.
SAMPLE = 3000
#: Windows decoded at once.
BLOCK = 1024
HIDDEN, EMBED, EPOCHS, BATCH, RATE = 16, 12, 24, 64, 0.01
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
NEVER = -1e4
TRIGGER = re.compile(r"[0-9@]")
#: Character classes: ASCII by itself, other letters, other digits, other space, the rest; 0 pads.
CLASSES = 128 + 5


# ------------------------------------------------------------------ base spans
def emails(text: str):
    """The email pattern without its quadratic search: a local part ends at its ``@``."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_LETTERS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str):
    """(spans, doubtful): (start, kind, end) by start, then kind; and the (start, end) of matches
    that fail a value check only."""
    found, doubtful = [], []
    if "@" in text:
        found += [(s, 0, e) for s, e in emails(text)]
    if "." in text:
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
            elif all(len(p) <= 3 for p in parts):
                doubtful.append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() < 14:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19:
            if luhn(digits):
                found.append((m.start(), 2, m.end()))
            else:
                doubtful.append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found), doubtful


def label(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ------------------------------------------------------------------ windows
def starts(size: int):
    """Window starts of a text: every STEP, the last one flush with the end."""
    if size <= WINDOW:
        return [0]
    last = size - WINDOW
    return [*range(0, last, STEP), last]


def candidates(text: str):
    """Starts of the windows that hold a digit or ``@``, in order."""
    out, last = [], len(text) - WINDOW
    for m in re.finditer(r"[0-9@][0-9@\x20().+-]*", text):
        lo, hi = m.start(), m.end()
        first = max(0, (lo - WINDOW) // STEP + 1) if last > 0 else 0
        for k in range(first, (hi - 1) // STEP + 1) if last > 0 else (0,):
            s = min(k * STEP, max(last, 0))
            if (not out or s > out[-1]) and TRIGGER.search(text, s, s + WINDOW):
                out.append(s)
        if hi > last > 0 and last > out[-1] and TRIGGER.search(text, last):
            out.append(last)
    return out


def encode(texts) -> np.ndarray:
    """Class of every character of the windows, padded to WINDOW with 0."""
    out = np.zeros((len(texts), WINDOW), np.int16)
    for i, t in enumerate(texts):
        out[i, : len(t)] = [1 + ord(c) if c < "\x7f" else 128 + (0 if c.isalpha() else 1 if c.isdigit() else 2 if c.isspace() else 3) for c in t]
    return out


def tags_of(spans, start: int, size: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int8)
    for s, kind, e in spans:
        lo, hi = max(s - start, 0), min(e - start, size)
        if lo < hi:
            out[lo:hi] = 2 + 2 * kind
            if s >= start:
                out[lo] = 1 + 2 * kind
    return out


# ------------------------------------------------------------------ the network
def sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def lstm(x, w, u, b, keep=False):
    """Hidden states (T, n, H) of an LSTM over x (T, n, E)."""
    size, n, h_size = len(x), x.shape[1], u.shape[0]
    h = c = np.zeros((n, h_size), x.dtype)
    gates = x @ w + b
    out, saved = np.empty((size, n, h_size), x.dtype), []
    for t in range(size):
        z = gates[t] + h @ u
        s = sigmoid(z[:, : 3 * h_size])
        i, f, o, g = s[:, :h_size], s[:, h_size: 2 * h_size], s[:, 2 * h_size:], np.tanh(z[:, 3 * h_size:])
        before, previous = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = out[t] = o * squashed
        if keep:
            saved.append((i, f, o, g, before, previous, squashed))
    return out, saved


def lstm_back(d_out, x, w, u, saved):
    """Gradients of an LSTM: of x, w, u and b."""
    size, n, h_size = d_out.shape
    dz_all = np.empty((size, n, 4 * h_size), x.dtype)
    dh, dc, du = np.zeros((n, h_size), x.dtype), np.zeros((n, h_size), x.dtype), np.zeros_like(u)
    for t in reversed(range(size)):
        i, f, o, g, before, previous, squashed = saved[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - squashed * squashed)
        dz = dz_all[t]
        dz[:, :h_size] = dc * g * i * (1 - i)
        dz[:, h_size: 2 * h_size] = dc * before * f * (1 - f)
        dz[:, 2 * h_size: 3 * h_size] = dh * squashed * o * (1 - o)
        dz[:, 3 * h_size:] = dc * i * (1 - g * g)
        du += previous.T @ dz
        dh, dc = dz @ u.T, dc * f
    flat = dz_all.reshape(-1, 4 * h_size)
    return dz_all @ w.T, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0)


def legal():
    """Scores of transitions that no span allows (inside without its begin), else 0. The first
    character of a window may be inside: its span may have begun before."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = NEVER
        out[inside, inside] = out[inside - 1, inside] = 0
    return out


def fresh(seed: int = 7) -> dict:
    r = np.random.default_rng(seed)
    scaled = lambda *shape: (r.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"embed": scaled(CLASSES, EMBED) * 3, "out": scaled(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32),
         "move": np.zeros((TAGS, TAGS), np.float32), "first": np.zeros(TAGS, np.float32)}
    for side in ("l", "r"):
        p |= {side + "w": scaled(EMBED, 4 * HIDDEN), side + "u": scaled(HIDDEN, 4 * HIDDEN), side + "b": np.zeros(4 * HIDDEN, np.float32)}
        p[side + "b"][HIDDEN: 2 * HIDDEN] = 1  # remember by default
    return p


def emissions(p: dict, codes: np.ndarray, keep=False):
    """Tag scores (T, n, TAGS) of windows (n, T)."""
    x = p["embed"][codes.T]
    left, kept_left = lstm(x, p["lw"], p["lu"], p["lb"], keep)
    right, kept_right = lstm(x[::-1], p["rw"], p["ru"], p["rb"], keep)
    both = np.concatenate([left, right[::-1]], 2)
    return both @ p["out"] + p["bias"], (x, both, kept_left, kept_right)


def log_sum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def loss_and_gradients(p: dict, codes: np.ndarray, tags: np.ndarray):
    """Mean negative log-likelihood of the tag sequences, and its gradients. Padding is tagged
    outside and read like text."""
    e, (x, both, kept_left, kept_right) = emissions(p, codes, True)
    size, n, _ = e.shape
    y, rows, move = tags.T.astype(np.int64), np.arange(n), p["move"] + legal()
    ahead, behind = np.empty_like(e), np.zeros_like(e)
    ahead[0] = e[0] + p["first"]
    for t in range(1, size):
        ahead[t] = e[t] + log_sum(ahead[t - 1][:, :, None] + move, 1)
    for t in range(size - 2, -1, -1):
        behind[t] = log_sum(move + (e[t + 1] + behind[t + 1])[:, None, :], 2)
    total = log_sum(ahead[-1], 1)
    gold = p["first"][y[0]] + e[0, rows, y[0]]
    for t in range(1, size):
        gold = gold + e[t, rows, y[t]] + move[y[t - 1], y[t]]
    de = np.exp(ahead + behind - total[None, :, None])
    g = {"first": de[0].sum(0), "move": np.zeros_like(p["move"])}
    np.subtract.at(g["first"], y[0], 1)
    for t in range(1, size):
        g["move"] += np.exp(ahead[t - 1][:, :, None] + move + (e[t] + behind[t] - total[:, None])[:, None, :]).sum(0)
        np.subtract.at(g["move"], (y[t - 1], y[t]), 1)
    steps = np.arange(size)[:, None]
    de[steps, rows, y] -= 1
    g["out"], g["bias"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, TAGS), de.reshape(-1, TAGS).sum(0)
    d_both = de @ p["out"].T
    dx, g["lw"], g["lu"], g["lb"] = lstm_back(d_both[:, :, :HIDDEN], x, p["lw"], p["lu"], kept_left)
    back, g["rw"], g["ru"], g["rb"] = lstm_back(d_both[::-1, :, HIDDEN:], x[::-1], p["rw"], p["ru"], kept_right)
    g["embed"] = np.zeros_like(p["embed"])
    np.add.at(g["embed"], codes.T, dx + back[::-1])
    return float((total - gold).mean()), {k: v / n for k, v in g.items()}


def train(codes: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Adam over shuffled batches, gradients clipped to a norm of 5; the same input gives the same model."""
    p, r = fresh(seed), np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step, steps = 0, epochs * -(-len(codes) // BATCH)
    for _ in range(epochs):
        order = r.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            part = order[at: at + BATCH]
            _, g = loss_and_gradients(p, codes[part], tags[part])
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            step += 1
            rate = RATE * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k in p:
                d = g[k] * min(1.0, 5 / (norm + 1e-9))
                m[k] += 0.1 * (d - m[k])
                v[k] += 0.001 * (d * d - v[k])
                p[k] -= (rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
    return p


# ------------------------------------------------------------------ decoding
def viterbi(e: np.ndarray, move: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags (n, T) of scores e (T, n, TAGS)."""
    size, n, _ = e.shape
    best, back = first + e[0], np.empty((size, n, TAGS), np.int8)
    for t in range(1, size):
        scores = best[:, :, None] + move
        back[t] = scores.argmax(1)
        best = scores.max(1) + e[t]
    out = np.empty((n, size), np.int8)
    out[:, -1] = best.argmax(1)
    rows = np.arange(n)
    for t in range(size - 1, 0, -1):
        out[:, t - 1] = back[t][rows, out[:, t]]
    return out


def window_spans(p: dict, texts):
    """Per window the (start, kind, end, margin) of its spans; the margin is what the characters'
    own scores give the span over leaving it outside."""
    out = []
    for at in range(0, len(texts), BLOCK):
        part = texts[at: at + BLOCK]
        e, _ = emissions(p, encode(part))
        tags = viterbi(e, p["move"] + legal(), p["first"])
        for i, t in enumerate(part):
            row, spans, k = tags[i], [], 0
            hit = np.flatnonzero(row[: len(t)])
            while k < len(hit):
                s, kind = int(hit[k]), (int(row[hit[k]]) - 1) // 2
                j = s + 1
                while j < len(t) and row[j] == 2 + 2 * kind:
                    j += 1
                margin = float((e[np.arange(s, j), i, row[s:j]] - e[s:j, i, 0]).sum())
                spans.append((s, kind, j, margin))
                k += j - s
            out.append(spans)
    return out


def reconcile(found, text: str):
    """One set of spans for a document from those of its windows, [(window start, spans)].

    Spans of one kind that overlap, one of them cut by its window's edge, are parts of one span:
    they are joined and the larger margin is theirs. Then the set without overlaps that has the
    largest total margin is chosen."""
    parts = []
    for start, spans in found:
        size = min(WINDOW, len(text) - start)
        for s, kind, e, margin in spans:
            cut = (s == 0 and start > 0) or (e == size and start + size < len(text))
            parts.append((kind, start + s, start + e, margin, cut))
    parts.sort()
    joined: list = []
    for kind, s, e, margin, cut in parts:
        last = joined[-1] if joined else None
        if last and last[0] == kind and s < last[2] and (cut or last[4]):
            joined[-1] = (kind, last[1], max(e, last[2]), max(margin, last[3]), cut and e >= last[2] or last[4] and last[2] > e)
        elif not last or last[:3] != (kind, s, e):
            joined.append((kind, s, e, margin, cut))
    spans = []
    for kind, s, e, margin, _ in joined:
        while s < e and text[s].isspace():
            s += 1
        while s < e and text[e - 1].isspace():
            e -= 1
        whole = not (text[s - 1: s].isalnum() and text[s: s + 1].isalnum() or text[e - 1: e].isalnum() and text[e: e + 1].isalnum())
        if margin > 0 and whole and TRIGGER.search(text, s, e):
            spans.append((e, s, kind, margin))
    spans.sort()
    ends, total, chosen = [0], [0.0], [None]  # best total of the spans that end by then
    for e, s, kind, margin in spans:
        before = np.searchsorted(ends, s, "right") - 1
        if total[before] + margin > total[-1]:
            ends.append(e)
            total.append(total[before] + margin)
            chosen.append((int(before), (s, kind, e)))
    out, k = [], len(chosen) - 1
    while k > 0:
        k, span = chosen[k]
        out.append(span)
    return sorted(out)


def model_spans(p: dict, texts):
    """Reconciled spans of each text; windows of several texts share a block."""
    out, held, owners = [[] for _ in texts], [], []

    def flush():
        per: dict = {}
        for (i, s), spans in zip(owners, window_spans(p, held)):
            per.setdefault(i, []).append((s, spans))
        for i, found in per.items():
            gathered[i].extend((s, spans) for s, spans in found if spans)
        held.clear()
        owners.clear()

    gathered = [[] for _ in texts]
    for i, t in enumerate(texts):
        for s in candidates(t):
            held.append(t[s: s + WINDOW])
            owners.append((i, s))
            if len(held) >= BLOCK:
                flush()
    flush()
    for i, t in enumerate(texts):
        out[i] = reconcile(gathered[i], t) if gathered[i] else []
    return out


# ------------------------------------------------------------------ on Spark
def labelled(batches):
    """doc text batches -> training windows (hash, text, tags)."""
    for b in batches:
        rows = []
        for t in b.column(0).to_pylist():
            if not t or not TRIGGER.search(t):
                continue
            spans, doubtful = base_spans(t)
            for s in candidates(t):
                w = t[s: s + WINDOW]
                if any(lo < s + WINDOW and hi > s for lo, hi in doubtful):
                    continue
                near = [x for x in spans if x[0] < s + WINDOW and x[2] > s]
                rows.append((hashlib.sha256(w.encode()).hexdigest()[:16], w, tags_of(near, s, len(w)).tobytes(), bool(near)))
        yield pa.RecordBatch.from_pydict({"h": pa.array([r[0] for r in rows], pa.string()), "w": pa.array([r[1] for r in rows], pa.string()),
                                          "tags": pa.array([r[2] for r in rows], pa.binary()), "hit": pa.array([r[3] for r in rows], pa.bool_())})


def training_windows(docs: DataFrame, bound: int = SAMPLE):
    """(codes, tags) of at most ``bound`` labelled windows: half with a span and half without,
    each half those with the smallest hashes over all documents."""
    windows = docs.select("text").mapInArrow(labelled, "h string, w string, tags binary, hit boolean")
    windows = windows.groupBy("h").agg(F.first("w").alias("w"), F.first("tags").alias("tags"), F.first("hit").alias("hit"))
    rows = [r for hit in (True, False) for r in windows.filter(F.col("hit") == hit).orderBy("h").limit(bound // 2).collect()]
    if not any(r.hit for r in rows):
        return None
    return encode([r.w for r in rows]), np.stack([np.frombuffer(r.tags, np.int8) for r in rows])


def fit(docs: DataFrame, bound: int = SAMPLE) -> dict | None:
    data = training_windows(docs, bound)
    return None if data is None else train(*data)


def find(docs: DataFrame, model: dict | None = None, fitted: bool = True) -> DataFrame:
    """(doc_id, base, all): spans (start, kind, end) of every row of ``docs``. Without a ``model``
    one is fitted on ``docs``; ``fitted=False`` gives base spans alone."""
    model = model or (fit(docs) if fitted else None)

    def scan(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            found = [base_spans(t)[0] if TRIGGER.search(t) else [] for t in texts]
            extra = model_spans(model, texts) if model else [[]] * len(texts)
            every = [sorted(base + [x for x in more if not any(x[0] < e and x[2] > s for s, _, e in base)]) if more else base
                     for base, more in zip(found, extra)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
            as_rows = lambda all_spans: pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in x] for x in all_spans], kind)
            yield pa.RecordBatch.from_arrays([b.column(0), as_rows(found), as_rows(every)], names=["doc_id", "base", "all"])

    span = "array<struct<start:bigint,kind:int,end:bigint>>"
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(scan, f"doc_id long, base {span}, all {span}")


def report(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(c):
        return F.array_join(F.transform(c, lambda x: F.concat_ws(
            ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def n(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return find(docs, model).select("doc_id", *[n(k) for k in KINDS], F.sha2(joined("base"), 256).alias("base_sha256"),
                                    joined("all").alias("spans"), (F.size("all") - F.size("base")).cast("long").alias("n_added"))
