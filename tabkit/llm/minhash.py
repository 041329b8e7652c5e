"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document's set are its distinct 5-word shingles (64-bit hashes). Documents with equal sets
form a class, which goes on as one. The signature needs two permutations only: the first
scatters the shingles, the second, shifted circularly by k, gives coordinate k. Coordinates
are banded; classes that agree in a band are candidates.

Inside a bucket pairs are not expanded. The member of a bucket that meets most others is its
hub, and all others are verified against it on their full sets; the links merge components.
Members of different components that share a hub are then compared in blocks, through
their differences to the hub (see ``unlinked_pairs``): exactly, and without a row per pair.

With 40 bands of 4 coordinates a pair at the threshold of 0.75 is missed with a chance
of 3e-7.

Defined results: without words (or text) a document has an empty set and is linked with
nothing; with fewer than 5 words the whole sequence is its one shingle. Each row has the component of
its own text; a component's id is its smallest doc_id. Rows that share a doc_id may have different
texts: sets whose smallest doc_id is the same are one node in links, for which one of them is compared. A
NULL doc_id is linked with nothing, has a NULL component and is kept. Texts of any length are read whole.
Ties between hubs go to the larger id, which changes no result. An empty table gives an empty result.
``near_groups`` reads only ``doc_id`` and ``text``; ``keep_one`` gives back every column, whatever its name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabkit.llm.common import BASE, Words, discard, give_back, mix, slices, window_hash, written

SHINGLE = 5
BANDS, ROWS = 40, 4
#: Links: 100 * intersection >= 75 * union.
PERCENT = 75
#: Members of one block of a hub's group, on average.
BLOCK_MEMBERS = 256


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text in a buffer."""
    words = Words(data, bounds, lower=True)
    grams = window_hash(words.hash, SHINGLE)
    out = []
    for lo, hi in zip(words.first[:-1], words.first[1:]):
        if hi - lo >= SHINGLE:
            out.append(np.unique(grams[lo: hi - SHINGLE + 1]))
        elif hi > lo:
            out.append(window_hash(words.hash[lo:hi], int(hi - lo)) ^ np.uint64(hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def scatter(x: np.ndarray) -> np.ndarray:
    """Second permutation, of 32-bit values."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash signatures of non-empty sets: a row per set."""
    starts = np.cumsum([0] + [len(s) for s in sets])[:-1]
    first = (mix(np.concatenate(sets) + np.uint64(BASE)) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), coordinates), np.uint32)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(scatter(first + np.uint32(k)), starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    pairs = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(BASE)
    for j in range(ROWS):
        key = mix(key + pairs[:, :, j] * np.uint64(0xD6E8FEB86659FD93))
    return key


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, k1, k2, bands): size, 128-bit key and band keys of each document's set."""

    def run(batches):
        give_back()
        for b in batches:
            ids, column = b.column("doc_id"), b.column("text")
            for first, last, data, bounds in slices(column):
                sets = shingle_sets(data, bounds)
                some = [i for i, s in enumerate(sets) if len(s)]
                keys = np.zeros((len(sets), BANDS), np.uint64)
                if some:
                    keys[some] = band_keys(signatures([sets[i] for i in some]))
                k1 = np.array([mix(s + np.uint64(1)).sum(dtype=np.uint64) for s in sets], np.uint64)
                k2 = np.array([mix(s ^ np.uint64(BASE)).sum(dtype=np.uint64) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, last - first).cast(pa.int64()), b.column("t1").slice(first, last - first), b.column("t2").slice(first, last - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))],
                    names=["doc_id", "t1", "t2", "n", "k1", "k2", "bands"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *text_keys()).mapInArrow(
        run, "doc_id long, t1 long, t2 long, n long, k1 long, k2 long, bands array<long>")


def text_keys():
    """128 bits that tell the rows of one doc_id apart by their text."""
    t = F.coalesce("text", F.lit(""))
    return F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, shingles): the full set, as sorted bytes, of each wanted (rep, k1) class. The texts are
    moved, which are smaller than the sets; of several rows of one rep the first with that set counts."""

    def run(batches):
        last_rep = None
        for b in batches:
            for first, last, data, bounds in slices(b.column("text")):
                reps = b.column("rep").slice(first, last - first)
                want = b.column("k1").slice(first, last - first).to_numpy()
                rep, out = reps.to_numpy(), []
                sets = shingle_sets(data, bounds)
                for i, s in enumerate(sets):
                    if rep[i] != last_rep and np.int64(mix(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) == want[i]:
                        out.append(i)
                        last_rep = rep[i]
                yield pa.RecordBatch.from_arrays([reps.take(pa.array(out, pa.int64())), pa.array([sets[i].tobytes() for i in out], pa.binary())],
                                                 names=["rep", "shingles"])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted.hint("merge"), "rep")  # sorted by rep
    return rows.mapInArrow(run, "rep long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total) for distinct pairs: sizes of intersection and union."""

    def run(batches):
        for batch in batches:
            common, total = [], []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                u, v = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                at[at == len(v)] = 0
                c = int((v[at] == u).sum())
                common.append(c)
                total.append(len(u) + len(v) - c)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(total, pa.int64())],
                                             names=["a", "b", "common", "total"])
        give_back()

    left = sets.withColumnsRenamed({"rep": "a", "shingles": "sa"})
    right = sets.withColumnsRenamed({"rep": "b", "shingles": "sb"})
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(
        run, "a long, b long, common long, total long")


def contracted(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the smallest node it is connected with.

    Every node is merged into the neighbour with the smallest hash and the links are
    contracted, which halves the graph or better each time, whatever its shape.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    roots = None
    while True:
        to = edges.groupBy("a").agg(F.min(order("b")).alias("m"))
        step = written(to.select(F.col("a").alias("node"), F.least(order("a"), F.col("m"))["v"].alias("root")), "merge")
        if roots is None:
            roots = step
        else:
            held = roots.select("node", F.col("root").alias("r"))
            moved = step.select(F.col("node").alias("r"), F.col("root").alias("r2"))
            roots = written(held.join(moved, "r", "left").select("node", F.coalesce("r2", "r").alias("root")), "roots")
        end = lambda c: step.select(F.col("node").alias(c), F.col("root").alias(f"{c}2"))
        edges = written(edges.join(end("a"), "a").join(end("b"), "b").filter("a2 <> b2")
                        .select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            break
    least = roots.groupBy("root").agg(F.min("node").alias("least"))
    return roots.join(least, "root").select("node", F.col("least").alias("root"))


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, comp) after the linked components have been joined."""
    if links.isEmpty():
        return components
    roots = contracted(links).select(F.col("node").alias("comp"), "root")
    return written(components.join(roots, "comp", "left").select("rep", F.coalesce("root", "comp").alias("comp")), "components")


def components(docs: DataFrame, sketch: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(rep, comp) for the classes that share a band with another one."""
    classes = sketch.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = written(classes.select("rep", "k1", "n", "bands"), "classes")
    # the band number is part of the key; most keys have one member and go no further than their count
    banded = classes.select("rep", F.explode("bands").alias("key"))
    full = banded.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    shared = written(banded.join(full, "key"), "shared")
    # one hub per bucket: the member that meets most others
    chosen = classes.groupBy("rep").agg(F.min(F.struct("k1", "n")).alias("c")).select("rep", "c.k1", "c.n")  # one set stands for a rep
    met = written(shared.groupBy("rep").agg(F.sum("m").alias("met")).join(chosen, "rep"), "met")
    members = written(shared.join(met.select("rep", "n", "met"), "rep").select("key", "rep", "n", "met"), "members")
    discard(classes, shared)
    hubs = members.groupBy("key").agg(F.max(F.struct("met", F.col("rep").alias("hub"), F.col("n").alias("hub_n"))).alias("h")).select(
        "key", "h.hub", "h.hub_n")
    joined = written(members.join(hubs, "key").filter("rep <> hub").select("hub", "hub_n", "rep", "n").distinct(), "joined")
    discard(members)

    sets = written(full_sets(docs, met.select("rep", "k1")), "sets")
    # sets whose sizes differ by more than the threshold allows are no link: they need not be moved
    near = joined.filter(F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent)
    pairs = near.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    done = written(verified(pairs, sets), "verified")
    is_link = F.col("common") * 100 >= F.col("total") * percent
    comps = written(met.select("rep", F.col("rep").alias("comp")), "components")
    comps = merged(comps, done.filter(is_link))

    # Members of different components that share a hub are left to compare.
    groups = joined.join(comps, "rep")
    open_ = groups.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("hub")
    groups = written(groups.join(open_, "hub", "left_semi"), "open")
    discard(joined, done)
    if groups.isEmpty():
        discard(sets)
        return comps
    links = unlinked_pairs(groups, sets, percent)
    discard(sets)
    return merged(comps, links)


def unlinked_pairs(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): linked components among the members (hub, rep, n, comp) of each hub's group.

    The symmetric difference of two members is that of their differences D to the hub:
    |x ^ y| = |Dx| + |Dy| - 2 |Dx & Dy|, so that all members outside a group's largest
    component are compared with all others by counting shared elements of D, in blocks of
    members. No row is made per pair, and a pair of blocks returns each link of two
    components once.
    """
    def differences(batches):
        for batch in batches:
            d = [np.setxor1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True).tobytes()
                 for x, y in zip(batch.column("sa"), batch.column("sb"))]
            kept = [batch.column(c) for c in ("hub", "rep", "n", "comp")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(d, pa.binary())], names=["hub", "rep", "n", "comp", "d"])
        give_back()

    rows = (groups.join(sets.withColumnsRenamed({"shingles": "sa"}), "rep")
            .join(sets.withColumnsRenamed({"rep": "hub", "shingles": "sb"}), "hub")
            .select("hub", "rep", "n", "comp", "sa", "sb")
            .mapInArrow(differences, "hub long, rep long, n long, comp long, d binary"))
    rows = written(rows, "differences")
    sizes = rows.groupBy("hub", "comp").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("hub").agg(F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("members")).select(
        "hub", F.col("top.comp").alias("top"), "members")
    rows = rows.join(largest, "hub").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.ceil(F.col("members") / BLOCK_MEMBERS).cast("long")))
    packed = lambda df, side: df.groupBy("hub", "block").agg(F.collect_list(F.struct("n", "comp", "d")).alias(side)).select("hub", side)
    pairs = packed(rows.filter("comp <> top"), "left").join(packed(rows, "right"), "hub")

    def compare(batches):
        for batch in batches:
            found = set()
            for x, y in zip(batch.column("left"), batch.column("right")):
                found |= block_links(*(unpacked(z.values) for z in (x, y)), percent)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
        give_back()

    return written(pairs.mapInArrow(compare, "a long, b long").distinct(), "links")


def unpacked(members: pa.StructArray):
    """(set sizes, components, elements of D, the member that each element belongs to)."""
    d = [x.as_py() for x in members.field("d")]
    size = np.array([len(x) // 8 for x in d], np.int64)
    return (members.field("n").to_numpy(), members.field("comp").to_numpy(), size,
            np.frombuffer(b"".join(d), np.uint64), np.repeat(np.arange(len(d)), size))


def block_links(left, right, percent: int) -> set[tuple[int, int]]:
    """Pairs of components (smaller first) that a member of each block links."""
    (n1, c1, d1, e1, o1), (n2, c2, d2, e2, o2) = left, right
    order = np.argsort(e2, kind="stable")
    e2, o2 = e2[order], o2[order]
    lo, hi = np.searchsorted(e2, e1, "left"), np.searchsorted(e2, e1, "right")
    shared = np.zeros(len(n1) * len(n2), np.int64)
    for i in range(0, len(e1), 20_000):
        count = (hi - lo)[i:i + 20_000]
        at = np.repeat(lo[i:i + 20_000] - np.append(0, np.cumsum(count))[:-1], count) + np.arange(count.sum())
        shared += np.bincount(np.repeat(o1[i:i + 20_000], count) * len(n2) + o2[at], minlength=len(shared))
    differ = d1[:, None] + d2[None, :] - 2 * shared.reshape(len(n1), len(n2))
    both = n1[:, None] + n2[None, :]
    # intersection (both - differ) / 2, union (both + differ) / 2
    x, y = np.nonzero((100 * (both - differ) >= percent * (both + differ)) & (c1[:, None] != c2[None, :]))
    return {(min(a, b), max(a, b)) for a, b in set(zip(c1[x].tolist(), c2[y].tolist()))}


def grouped_rows(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, t1, t2, n_shingles, component_id, kept) for every row of ``docs``."""
    sketch = written(sketches(docs), "sketches")
    comps = components(docs, sketch, percent)
    classes = (sketch.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
               .join(comps, "rep", "left").select("k1", "k2", F.coalesce("comp", "rep").alias("comp")))
    rows = sketch.select("doc_id", "t1", "t2", "n", "k1", "k2").join(classes, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("comp", "doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "t1", "t2", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id")
                       ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    return grouped_rows(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that their group keeps, all columns. Rows that share a doc_id are told
    apart by their text, so a text that only one of them has stays."""
    dropped = grouped_rows(docs, percent).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).distinct()
    t1, t2 = text_keys()
    return docs.join(dropped, (F.col("doc_id").cast("long") == F.col("__id")) & (t1 == F.col("__t1")) & (t2 == F.col("__t2")), "left_anti")
