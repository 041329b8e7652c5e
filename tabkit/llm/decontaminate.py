"""Benchmark decontamination with SimHash on item-sized windows.

A benchmark item of L words is compared with every run of L words of every document (with
the whole document where that is shorter). Words are lower-cased; a window is the bag of its
5-word shingles, each weighted by how often it occurs. Windows are fingerprinted with a
64-bit SimHash; a multi-index over four 16-bit blocks finds every item whose fingerprint
lies within RADIUS: at least one block differs in at most RADIUS // 4 bits, so a table of
all block values lists the items near each. The candidates are then verified by the exact
weighted Jaccard similarity, at THRESHOLD or more.

Windows are judged only where they share a shingle with an item of their length: others have
similarity 0. Items are handled in chunks of bounded size, one pass over the documents each,
so that nothing unbounded is broadcast. The result needs no shuffle.

RADIUS is set so that a window at the threshold (expected distance 11 of 64, deviation 3)
is missed with a chance below 1e-6.

Defined results: a NULL or empty document, or one without words, matches nothing; so does an
item without words. Items and documents of fewer than five words count as one shingle. A NULL
item_id is reported as -1. Repeated rows are judged alike; ties go to the smaller item_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabkit.llm.common import Words, give_back, mix, slices, window_hash

SHINGLE = 5
THRESHOLD = 0.75
RADIUS = 27
#: Items and words of one chunk: its tables and shingles are shipped whole (under 40 MB).
CHUNK_ITEMS, CHUNK_WORDS = 1024, 500_000


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the 5-word shingles of one text; the whole text as one if it is shorter."""
    if not len(words):
        return np.zeros(0, np.uint64)
    k = min(SHINGLE, len(words))
    return window_hash(words, k) + np.uint64(k)


def weights(hashes: np.ndarray) -> np.ndarray:
    """SimHash votes of each shingle: a row of 64 values -1 / 1."""
    bits = np.unpackbits(mix(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int16) * 2 - 1


def fingerprints(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1).view(np.uint64).reshape(-1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Exact weighted Jaccard of two bags of shingles."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[ia], cb[ib]).sum())
    return common / (len(a) + len(b) - common) if common else 0.0


class Index:
    """Fingerprints of one chunk of items, their shingles, and the multi-index tables."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.lengths, self.bags = [], [], []
        for item, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            words = Words(data, np.array([0, len(data)]), lower=True).hash
            if len(words):
                self.ids.append(-1 if item is None else item)
                self.lengths.append(len(words))
                self.bags.append(shingles(words))
        self.prints = fingerprints(np.stack([weights(b).sum(axis=0) for b in self.bags])) if self.bags else np.zeros(0, np.uint64)
        blocks = self.prints.view(np.uint16).reshape(-1, 4)
        self.near = []
        values = np.arange(1 << 16, dtype=np.uint16)
        for j in range(4):
            table = np.zeros((1 << 16, (len(self.ids) + 7) // 8), np.uint8)
            for i, v in enumerate(blocks[:, j]):
                table[np.bitwise_count(values ^ v) <= RADIUS // 4, i >> 3] |= np.uint8(1 << (i & 7))
            self.near.append(table)
        pairs = sorted((s, n) for b, n in zip(self.bags, self.lengths) for s in set(b.tolist()))
        self.shared = np.array(sorted({s for s, _ in pairs}), np.uint64)
        self.sizes: dict[int, set[int]] = {}
        for s, n in pairs:
            self.sizes.setdefault(s, set()).add(n)
        self.of_length: dict[int, np.ndarray] = {n: np.flatnonzero(np.array(self.lengths) == n) for n in set(self.lengths)}
        self.short = sorted(n for n in set(self.lengths) if n < SHINGLE)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.shared >> np.uint64(44)).astype(np.int64)] = True

    def within(self, prints: np.ndarray, items: np.ndarray):
        """(window, item) pairs with fingerprints within RADIUS, by the block tables."""
        blocks = prints.view(np.uint16).reshape(-1, 4)
        some = np.zeros((len(prints), self.near[0].shape[1]), np.uint8)
        for j in range(4):
            some |= self.near[j][blocks[:, j]]
        w, i = np.nonzero(np.unpackbits(some, axis=1, bitorder="little")[:, items])
        i = items[i]
        close = np.bitwise_count(prints[w] ^ self.prints[i]) <= RADIUS
        return w[close], i[close]

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        at = np.flatnonzero(self.filter[(grams >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.shared):
            return at[:0]
        k = np.minimum(np.searchsorted(self.shared, grams[at]), len(self.shared) - 1)
        return at[self.shared[k] == grams[at]]

    def matches(self, grams: np.ndarray, n_words: int, hit: np.ndarray):
        """(item, first word, similarity) of every verified window of one document."""
        starts: dict[int, list] = {}
        for p in hit.tolist():
            for n in self.sizes[int(grams[p])]:
                starts.setdefault(n, []).append(p)
        for n, at in starts.items():
            width = n - SHINGLE + 1  # shingles of a window
            if n_words <= n or len(grams) <= width:
                firsts = np.zeros(1, np.int64)
                width = len(grams)
            else:
                cover = np.zeros(len(grams) + 1, np.int64)
                at = np.array(at)
                np.add.at(cover, np.maximum(at - width + 1, 0), 1)
                np.add.at(cover, at + 1, -1)
                firsts = np.flatnonzero(np.cumsum(cover[: len(grams) - width + 1]) > 0)
            for i in range(0, len(firsts), 4096):
                part = firsts[i:i + 4096]
                # votes of the runs of shingles that these windows cover
                need = np.unique((part[:, None] + np.arange(width)).ravel())
                total = np.zeros((len(need) + 1, 64), np.int32)
                np.cumsum(weights(grams[need]), axis=0, out=total[1:])
                lo = np.searchsorted(need, part)
                prints = fingerprints(total[lo + width] - total[lo])
                for w, item in zip(*self.within(prints, self.of_length[n])):
                    s = similarity(grams[part[w]: part[w] + width], self.bags[item])
                    if s >= THRESHOLD:
                        yield self.ids[item], int(part[w]), s


def chunks(benchmark: DataFrame, most: int = CHUNK_ITEMS, size: int = CHUNK_WORDS):
    """Indexes of bounded chunks of the benchmark."""
    held, words = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator():
        n = len((r[1] or "").split()) + 1
        if held and (words + n > size or len(held) == most):
            yield Index(held)
            held, words = [], 0
        held.append((r[0], r[1]))
        words += n
    yield Index(held)


def found_by(spark, index: Index):
    """Column function on a text: struct (n_items, item_id, word, similarity) of its matches."""
    shipped = spark.sparkContext.broadcast(index)

    def run(batches):
        import pandas as pd

        give_back()
        own = shipped.value
        for texts in batches:
            column = pa.array(texts, pa.large_string(), from_pandas=True)
            n_items, item, word, sim = (np.zeros(len(column), t) for t in (np.int64, np.int64, np.int64, np.float64))
            for first, last, data, bounds in slices(column):
                words = Words(data, bounds, lower=True)
                grams = window_hash(words.hash, SHINGLE) + np.uint64(SHINGLE)
                # a shingle that runs into the next text is none
                at = own.hits(grams)
                row = np.searchsorted(words.first, at, "right") - 1
                at, row = (x[words.first[row + 1] >= at + SHINGLE] for x in (at, row))
                found: dict[int, dict[int, tuple]] = {}
                for r in np.unique(row).tolist():
                    lo, hi = words.first[r], words.first[r + 1]
                    for i, w, s in own.matches(grams[lo:hi - SHINGLE + 1], int(hi - lo), at[row == r] - lo):
                        best = found.setdefault(r, {})
                        if i not in best or (-s, w) < best[i]:
                            best[i] = (-s, w)
                for n in own.short:  # items of fewer words than a shingle: one shingle, equal or not
                    runs = window_hash(words.hash, n) + np.uint64(n)
                    for p in own.hits(runs).tolist():
                        r = int(np.searchsorted(words.first, p, "right")) - 1
                        if words.first[r + 1] >= p + n:
                            for k in own.of_length[n]:
                                if own.bags[k][0] == runs[p]:
                                    found.setdefault(r, {}).setdefault(own.ids[k], (-1.0, int(p - words.first[r])))
                for r, best in found.items():
                    s, i, w = min((s, i, w) for i, (s, w) in best.items())
                    n_items[first + r], item[first + r], word[first + r], sim[first + r] = len(best), i, w, -s
            yield pd.DataFrame({"n_items": n_items, "item_id": item, "word": word, "similarity": sim})
            give_back()

    from typing import Iterator

    import pandas as pd

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "n_items long, item_id long, word long, similarity double")


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, n_items, item_id, word, similarity): ``row`` holds all columns of ``docs``; the
    best match of each document over all items (item_id NULL where there is none)."""
    spark = docs.sparkSession
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    best, n = None, F.lit(0).cast("long")
    for k, index in enumerate(chunks(benchmark)):
        out = out.withColumn(f"m{k}", found_by(spark, index)(F.col("row.text")))
        m = F.col(f"m{k}")
        mine = F.when(m["n_items"] > 0, F.struct((-m["similarity"]).alias("order"), m["item_id"].alias("item_id"), m["word"].alias("word")))
        best = mine if best is None else F.when(best.isNull() | (mine < best), mine).otherwise(best)
        n = n + m["n_items"]
    return out.select("row", n.alias("n_items"), best.alias("best")).select(
        "row", "n_items", F.col("best.item_id").alias("item_id"), F.col("best.word").alias("word"),
        F.coalesce(-F.col("best.order"), F.lit(0.0)).alias("similarity"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_id, word, similarity) for every row of ``docs``."""
    return judged(docs, benchmark).select(
        F.col("row.doc_id").alias("doc_id"), (F.col("n_items") > 0).alias("contaminated"),
        "n_items", "item_id", "word", "similarity")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns."""
    return judged(docs, benchmark).filter("n_items = 0").select("row.*")
