"""Exact substring removal with suffix arrays by induced sorting.

Texts are UTF-8 bytes. A byte goes if a ``width``-byte string covers it that also starts
anywhere else, in the same document or another; strings are judged on the input.

Candidates come from ``anchors``; the distinct contents of a shard are joined with
separators and its suffix array is built by induced sorting: suffixes are classified as S or
L, the leftmost S suffixes are sorted by their substrings (recursively, where names repeat),
and the others are induced from them bucket by bucket in linear work. Common prefixes are
computed in text order: only at positions where the preceding bytes differ is a prefix
measured, the others follow from their predecessor less one. Neighbours in the array that
share ``width`` bytes form the classes of equal strings. An anchor with one distinct content stays out
of the array: its windows recur all or not at all (``answered``).

Substrings are compared by keys of as many symbols as fit into 64 bits, so that every level is
induced once. Both passes of the induction run in array operations. Over a small alphabet the
entries of a bucket are induced together. Over a large one (names, in the recursion) the suffixes of a
type are ordered at once, by the symbols up to the next suffix whose order is known and by
that suffix's rank.

Defined results: a NULL text is empty; texts shorter than ``width`` lose nothing; equal rows
repeat each other, so both lose all bytes from ``width`` on. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tabkit.llm import anchors
from tabkit.llm.common import NULL_ID

WIDTH, GRAM = 200, 32
#: Content bytes of one shard: its arrays, some 60 times that, stay near the processor.
SHARD_BYTES = 1 << 18
#: Symbols per bucket, on average, from which buckets are induced one by one.
DENSE = 256
#: Longest run of one type, and mean length of the runs from all positions, that are compared by their
#: symbols; longer ones are left to a plain loop.
LONGEST_RUN, MEAN_RUN = 1024, 16


def is_small(s: np.ndarray) -> np.ndarray:
    """Which suffixes are S: smaller than the next one (the sentinel is)."""
    n = len(s)
    differs = np.flatnonzero(s[:-1] != s[1:])
    rises = s[differs] < s[differs + 1]
    out = np.ones(n, bool)
    # a run of equal symbols has the type of its last one
    out[: n - 1] = np.repeat(rises, np.diff(np.append(-1, differs)))[: n - 1] if len(differs) else True
    return out


class Symbols:
    """The symbols of a text with the types of their suffixes, as many to a 64-bit key as fit.

    Runs of them end at the first leftmost S (or L) suffix, so of two runs neither is the beginning of the other."""

    def __init__(self, s: np.ndarray, small: np.ndarray):
        n = len(s)
        symbol = s.astype(np.uint64) * np.uint64(2) + small  # the sentinel is 1: 0 stands for none
        self.bits = int(symbol.max()).bit_length()
        self.per = 64 // self.bits
        self.keys = np.zeros(n + self.per, np.uint64)
        for t in range(min(self.per, n)):
            self.keys[: n - t] |= symbol[t:] << np.uint64(self.bits * (self.per - 1 - t))

    def key(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first symbols from ``at``, none beyond ``end``."""
        beyond = (np.maximum(at + (self.per - 1) - end, 0) * self.bits).astype(np.uint64)
        return self.keys[at] >> beyond << beyond

    def places(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each run ``at`` to ``end`` the number of smaller ones."""
        key = self.key(at, end)
        order = np.argsort(key)
        ranked = key[order]
        place = np.empty(len(at), np.int64)
        place[order] = first_of_equals(ranked[1:] != ranked[:-1])
        more = np.flatnonzero(at + self.per <= end)
        done = self.per
        while len(more):
            key, own = self.key(at[more] + done, end[more]), place[more]
            order = np.lexsort((key, own))
            key, own, more = key[order], own[order], more[order]
            other = own[1:] != own[:-1]
            # runs that are equal so far go on together: their places are next to each other
            place[more] = own + first_of_equals(other | (key[1:] != key[:-1])) - first_of_equals(other)
            done += self.per
            more = more[at[more] + done <= end[more]]
        return place


def first_of_equals(differs: np.ndarray) -> np.ndarray:
    """For each of a row of entries the first of those equal to it; ``differs``: whether each but the first differs from the one before."""
    at = np.arange(len(differs) + 1)
    at[1:][~differs] = 0
    return np.maximum.accumulate(at)


def induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, buckets: np.ndarray, symbols: Symbols) -> np.ndarray:
    """Suffix array of ``s`` induced from its leftmost S suffixes, given in order.
    ``buckets``: first place of every symbol, and the length at the end."""
    if len(s) < DENSE * (len(buckets) - 1):
        return induce_by_rank(s, small, lms, buckets, symbols)
    n, k = len(s), len(buckets) - 1
    sa = np.full(n, -1, np.int64)
    head, tail = buckets[:-1].copy(), buckets[1:].copy()

    def put(at, ascending):
        """Place suffixes, in the order given, into their buckets' free ends."""
        c = s[at]
        order = np.argsort(c, kind="stable")
        at, c = at[order], c[order]
        starts = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        sizes = np.diff(np.append(starts, len(c)))
        rank = np.arange(len(c)) - np.repeat(starts, sizes)
        own = c[starts]
        if ascending:
            sa[np.repeat(head[own], sizes) + rank] = at
            head[own] += sizes
        else:
            sa[np.repeat(tail[own], sizes) - 1 - rank] = at
            tail[own] -= sizes

    put(lms[::-1], False)
    s_from = tail.copy()
    for c in range(k):
        done = buckets[c]
        while done < head[c]:
            upto = head[c]
            prev = sa[done:upto] - 1
            prev = prev[prev >= 0]
            prev = prev[~small[prev]]
            done = upto
            if len(prev):
                put(prev, True)
        prev = sa[s_from[c]: buckets[c + 1]] - 1
        prev = prev[prev >= 0]
        prev = prev[~small[prev]]
        if len(prev):
            put(prev, True)
    tail[:] = buckets[1:]
    for c in range(k - 1, -1, -1):
        done = buckets[c + 1]
        while done > tail[c]:
            upto = tail[c]
            prev = sa[upto:done][::-1] - 1
            prev = prev[prev >= 0]
            prev = prev[small[prev]]
            done = upto
            if len(prev):
                put(prev, False)
        prev = sa[buckets[c]: head[c]][::-1] - 1
        prev = prev[prev >= 0]
        prev = prev[small[prev]]
        if len(prev):
            put(prev, False)
    sa[0] = n - 1
    return sa


def next_true(flags: np.ndarray) -> np.ndarray:
    """The first position at or after each one whose flag is set (the length where none is)."""
    n = len(flags)
    at = np.where(flags, np.arange(n), n)
    return np.minimum.accumulate(at[::-1])[::-1]


def induce_by_rank(s, small, lms, buckets, symbols) -> np.ndarray:
    n = len(s)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ends = {False: next_true(is_lms), True: next_true(~small)}
    # (the sentinel's own run has no end)
    length = (np.where(small, ends[True], ends[False]) - np.arange(n))[:-1]
    if int(length.max()) >= LONGEST_RUN or int(length.sum()) > MEAN_RUN * n:
        return induce_plain(s, small, lms, buckets)
    rank = np.zeros(n, np.uint64)
    rank[lms] = np.arange(len(lms))
    sa = np.empty(n, np.int64)
    larges = np.bincount(s[~small], minlength=len(buckets) - 1)
    smalls = np.diff(buckets) - larges
    for kind in (False, True):
        own = np.flatnonzero(small == kind)
        if kind:
            own = own[:-1]  # the sentinel comes first of all
        end = ends[kind][own]
        # equal runs end together, at suffixes whose order is known
        order = own[np.argsort(symbols.places(own, end).astype(np.uint64) << np.uint64(32) | rank[end])]
        if not kind:
            rank[order] = np.arange(len(order))
            first = np.append(0, np.cumsum(larges))[:-1]
            sa[buckets[:-1][s[order]] + np.arange(len(order)) - first[s[order]]] = order
        else:
            first = np.append(0, np.cumsum(smalls))[:-1]
            # the sentinel is the first S suffix of all
            sa[buckets[:-1][s[order]] + larges[s[order]] + np.arange(1, len(order) + 1) - first[s[order]]] = order
    sa[0] = n - 1
    return sa


def induce_plain(s, small, lms, buckets) -> np.ndarray:
    text, is_s = s.tolist(), small.tolist()
    n = len(text)
    sa = [-1] * n
    tail = buckets[1:].tolist()
    for p in reversed(lms.tolist()):
        tail[text[p]] -= 1
        sa[tail[text[p]]] = p
    head = buckets[:-1].tolist()
    for i in range(n):
        p = sa[i] - 1
        if p >= 0 and not is_s[p]:
            sa[head[text[p]]] = p
            head[text[p]] += 1
    tail = buckets[1:].tolist()
    for i in range(n - 1, -1, -1):
        p = sa[i] - 1
        if p >= 0 and is_s[p]:
            tail[text[p]] -= 1
            sa[tail[text[p]]] = p
    sa[0] = n - 1
    return np.array(sa, np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s``, whose last symbol is its only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    buckets = np.append(0, np.cumsum(np.bincount(s)))
    small = is_small(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    # leftmost S suffixes in the order of their substrings, and a name for each substring
    symbols = Symbols(s, small)
    place = symbols.places(lms, np.append(lms[1:], n - 1))
    used = np.zeros(len(lms), bool)
    used[place] = True
    if used.all():
        order = np.empty(len(lms), np.int64)
        order[place] = lms
    else:
        order = lms[suffix_array((np.cumsum(used) - 1)[place])]
    return induce(s, small, order, buckets, symbols)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the prefix that each suffix shares with its predecessor in the array."""
    n = len(s)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    padded = np.concatenate([s.astype(np.uint8), np.zeros(8, np.uint8)])
    chunk = np.ndarray(n + 1, "<u8", padded, strides=(1,)).copy()  # the eight bytes from each position on
    position = np.arange(n)
    follows = (position > 0) & (before > 0)
    follows[follows] = s[position[follows] - 1] == s[before[follows] - 1]
    first = np.flatnonzero(~follows & (before >= 0))
    measured = np.zeros(n, np.int64)
    a, b, at = first, before[first], first
    while len(at):
        x = chunk[np.minimum(a, n)] ^ chunk[np.minimum(b, n)]
        equal = (x == 0) & (a < n) & (b < n)
        part = ~equal
        low = x[part] & (~x[part] + np.uint64(1))
        measured[at[part]] += np.where(x[part] == 0, 0, np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64)
        measured[at[equal]] += 8
        a, b, at = a[equal] + 8, b[equal] + 8, at[equal]
    source = np.maximum.accumulate(np.where(follows, 0, position))
    return np.where(before < 0, 0, measured[source] - (position - source))


def repeated_starts(contents: list[bytes], copies: np.ndarray, width: int = WIDTH) -> list[bytes | None]:
    """For each content the runs (first, length, 1) of the positions at which a ``width``-byte
    string starts that occurs more than once in all contents, each counted ``copies`` times."""
    size = np.array([len(c) for c in contents], np.int64)
    start = np.append(0, np.cumsum(size + 1))
    # bytes of UTF-8 stay below 0xF8: 0 ends the whole, 1 ends a content
    s = np.ones(int(start[-1]) + 1, np.uint8)
    joined = np.frombuffer(b"\xfe".join(contents) + b"\xfe", np.uint8)
    s[:-1] = np.where(joined == 0xFE, 1, joined + 2)
    s[-1] = 0
    sa = suffix_array(s)
    shared = permuted_prefixes(s, sa)[sa]
    group = np.cumsum(shared < width)
    fits = np.zeros(len(s), bool)
    fits[:-1] = np.arange(len(s) - 1) <= np.repeat(start[:-1] + size - width, size + 1)
    weight = np.zeros(len(s), np.int64)
    weight[:-1] = np.repeat(copies, size + 1)
    in_order = fits[sa]
    total = np.bincount(group, weights=weight[sa] * in_order)
    again = np.zeros(len(s), bool)
    again[sa] = in_order & (total[group] > 1.5)
    # runs do not go on from one content to the next: no window starts at a separator
    edges = np.diff(again.astype(np.int8), prepend=0)
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    cuts = np.searchsorted(first, start)
    begin = np.repeat(start[:-1], np.diff(cuts))
    runs = np.stack([first - begin, last - first, np.ones(len(first), np.int64)], axis=1)
    return [runs[a:b].tobytes() if b > a else None for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def answered(contents: list[bytes], copies: np.ndarray, anchor: np.ndarray, width: int = WIDTH) -> list[bytes | None]:
    """``repeated_starts`` of a shard. Equal windows have equal anchors, so where an anchor has one content
    only, either all of its windows recur, in its copies, or none does: those need no sorting."""
    _, index, contents_of = np.unique(anchor, return_inverse=True, return_counts=True)
    alone = contents_of[index] == 1
    rest = np.flatnonzero(~alone)
    out: list[bytes | None] = [
        np.array([[0, len(c) - width + 1, 1]], np.int64).tobytes() if a and n > 1 else None for c, n, a in zip(contents, copies, alone)]
    if len(rest):
        for i, runs in zip(rest.tolist(), repeated_starts([contents[i] for i in rest], copies[rest], width)):
            out[i] = runs
    return out


def drop_substrings(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    rows = anchors.keyed(docs)
    found = anchors.with_segments(rows, "byte", width, gram)
    told = anchors.answers(
        found, "byte", width, lambda contents, lowest, highest, copies, anchor: answered(contents, copies, anchor, width), SHARD_BYTES,
        lambda rel, lowest, highest, copies: anchors.runs_of(rel, np.ones(len(rel), np.int64)))

    def finish(did, text, hits):
        n = len(text)
        lo, runs = hits
        first, last = anchors.merged_spans(lo + runs[:, 0], lo + runs[:, 0] + runs[:, 1] - 1 + width)
        kept = hashlib.sha256()
        at = 0
        for a, b in zip(first.tolist(), last.tolist()):
            kept.update(text[at:a])
            at = b
        kept.update(text[at:])
        return did, n, int((last - first).sum()), len(first), kept.hexdigest()

    out = anchors.per_text(rows, found, told, finish, "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.nullif("did", F.lit(NULL_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
