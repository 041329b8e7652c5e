"""Exact top-k search on a bit-sliced index.

Every component x becomes the integer floor(256 x). Rows are indexed in blocks: a block
holds, for each dimension, the bit slices (bitmaps over its rows) of the quantised component
``(v - min) >> shift``, and the integer vectors themselves. A query adds the slices, weighted
by the signed digits of its own components, with carry-save bitmap adders; the result is the
bit-sliced quantised score of all rows of the block. The top rows are selected from the most
significant slice downward. What the quantisation cut off is bounded, so every row whose
score could still reach the k-th best is a boundary row and is scored exactly.

All query blocks meet all row blocks through an equi-join on a slot: row blocks are dealt to a
fixed number of slots, query blocks go to every slot. The query blocks of a slot follow each
other for a row block, whose slices are built once. Each pair returns k rows per query and the
best k of all blocks are ranked. Nothing depends on how rows lie in blocks.

Vectors whose inner products could leave 64 bits lie in blocks of their own. There, the same
search runs on Python's integers, which have no bound; only a score beyond 64 bits that belongs
to a result raises an error, for the result has no place for it.

Defined results: vectors that are NULL or empty or hold a NULL or non-finite component take no
part. Vectors are compared with those of the same length. Rows that carry the query's own vec_id
are not its candidates; a query id that is repeated gets one ranking per row; a row that is
repeated is a candidate each time. An empty table gives an empty result. Other columns of the
table, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tabkit.llm.common import written

#: Rows of an index block and queries of a query block.
BLOCK_ROWS, BLOCK_QUERIES = 32768, 256
#: Bits kept of each component; the rest is bounded and resolved exactly.
SLICES = 6
#: Groups that row blocks are dealt to, and blocks of queries sent to each.
SLOTS = 1024
#: Scores of two vectors are surely below this where each one's bound is (see ``integer_vectors``).
SAFE = 1 << 62
SMALLEST, LARGEST = -(1 << 63), (1 << 63) - 1


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, dim, wide, vec): usable rows. The integers are floor(256 * component), taken where they
    are used. ``wide``: dim * max(|256 * component| + 1) ** 2 is SAFE or more, so that 64 bits
    might not hold the row's scores."""
    vec = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = F.array_max(F.transform("vec", lambda x: F.abs(x))) * 256 + 1
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).select(
        F.col(id_col).cast("long").alias("id"), F.size(vector).alias("dim"), vec.alias("vec"))
    return rows.filter(F.coalesce(usable, F.lit(False))).select(
        "id", "dim", (most * most * F.col("dim") >= float(SAFE)).alias("wide"), "vec")


def integers(raw: np.ndarray, wide: bool) -> np.ndarray:
    """floor(256 * component): 64-bit integers, or Python's for wide vectors."""
    if not wide:
        return np.floor(raw * 256).astype(np.int64)
    out = np.empty(raw.shape, object)
    for at, x in np.ndenumerate(raw):
        above, below = float(x).as_integer_ratio()
        out[at] = above * 256 // below
    return out


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed into blocks within each partition, (dim, wide, ids, vecs) as long and double bytes."""

    def pack(batches):
        held: dict[tuple, list] = {}

        def out(kind, parts):
            ids, vecs = (np.concatenate(x) for x in zip(*parts))
            for i in range(0, len(ids), size):
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([kind[0]], pa.int32()), "wide": pa.array([kind[1]], pa.bool_()),
                    "ids": pa.array([ids[i:i + size].tobytes()], pa.binary()),
                    "vecs": pa.array([vecs[i:i + size].tobytes()], pa.binary())})

        for b in batches:
            ids, dims = b.column("id").to_numpy(), b.column("dim").to_numpy()
            wide = b.column("wide").to_numpy(zero_copy_only=False).astype(bool)
            flat, ends = b.column("vec").flatten().to_numpy(), np.cumsum(dims)
            for dim, far in {*zip(dims.tolist(), wide.tolist())}:
                own = np.flatnonzero((dims == dim) & (wide == far))
                at = (ends[own] - dim)[:, None] + np.arange(dim)
                kind = (dim, far)
                held.setdefault(kind, []).append((ids[own], flat[at]))
                if sum(len(x[0]) for x in held[kind]) >= size:
                    parts = held.pop(kind)
                    ids_all, vecs_all = (np.concatenate(x) for x in zip(*parts))
                    full = len(ids_all) // size * size
                    yield from out(kind, [(ids_all[:full], vecs_all[:full])])
                    if full < len(ids_all):
                        held[kind] = [(ids_all[full:], vecs_all[full:])]
        for kind, parts in held.items():
            yield from out(kind, parts)

    return rows.mapInArrow(pack, "dim int, wide boolean, ids binary, vecs binary")


def bit_slices(vecs: np.ndarray):
    """(dimension -> slices as packed bitmaps, minimum, bits cut off) of one block."""
    low = vecs.min(axis=0)
    span = vecs - low
    shift = max(0, int(span.max()).bit_length() - SLICES)
    q = (span >> shift).astype(np.int64)
    bits = max(1, int(q.max()).bit_length())
    maps = [np.packbits((q >> j) & 1 == 1, axis=0).T for j in range(bits)]  # each: dim x bytes
    pad = -maps[0].shape[1] % 8
    maps = np.stack([np.pad(m, ((0, 0), (0, pad))) for m in maps], axis=1)  # dim x bits x bytes
    return np.ascontiguousarray(maps).view(np.uint64), low, shift


def signed_digits(x: int):
    """Digits -1 / 1 of x in non-adjacent form: pairs (weight exponent, sign)."""
    i, sign = 0, 1 if x > 0 else -1
    x = abs(x)
    while x:
        if x & 1:
            d = 2 - (x & 3)
            yield i, d * sign
            x -= d
        x >>= 1
        i += 1


def add_slices(by_weight: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of weighted bitmaps as bit slices, least first, with carry-save adders."""
    out, w = [], 0
    while by_weight:
        rows = by_weight.pop(w, None)
        if not rows:
            out.append(None)
            w += 1
            continue
        rows = np.concatenate(rows)
        while len(rows) > 1:
            if len(rows) == 2:
                a, b = rows[:1], rows[1:]
                total, carry, rest = a ^ b, a & b, rows[:0]
            else:
                n = len(rows) // 3
                a, b, c = rows[:n], rows[n:2 * n], rows[2 * n:3 * n]
                half = a ^ b
                total, carry, rest = half ^ c, (a & b) | (half & c), rows[3 * n:]
            by_weight.setdefault(w + 1, []).append(carry)
            rows = np.concatenate([total, rest])
        out.append(rows[0])
        w += 1
    return out


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def select_top(slices: list, live: np.ndarray, k: int):
    """Bitmap of at least the k best rows by the sliced sum: walks from the most
    significant slice downward; rows still tied at the end are all kept."""
    sure, tied = np.zeros_like(live), live
    for s in reversed(slices):
        ones = tied & s if s is not None else np.zeros_like(live)
        have = count(sure) + count(ones)
        if have >= k:
            tied = ones
        else:
            sure, tied = sure | ones, tied & ~ones
    return sure | tied


def rows_at_least(slices: list, live: np.ndarray, floor: int) -> np.ndarray:
    """Bitmap of the rows whose sliced sum is ``floor`` or more."""
    if floor <= 0:
        return live
    if floor >> len(slices):
        return np.zeros_like(live)
    above, equal = np.zeros_like(live), live
    for j in range(len(slices) - 1, -1, -1):
        s = slices[j] if slices[j] is not None else np.zeros_like(live)
        if floor >> j & 1:
            equal = equal & s
        else:
            above, equal = above | (equal & s), equal & ~s
    return above | equal


def members(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=n))


def search_block(ids, vecs, queries, k: int, index=None):
    """Best k rows of one block for each query (id, vector): yields (query, ids, scores).
    ``index``: the block's ``bit_slices``, where they are at hand. Vectors of both sides are
    64-bit integers, or both Python's."""
    maps, low, shift = index or bit_slices(vecs)
    n, words = len(ids), maps.shape[2]
    everyone = np.zeros(words, np.uint64)
    everyone.view(np.uint8)[: (n + 7) // 8] = np.packbits(np.ones(n, bool))
    for at, (qid, q) in enumerate(queries):
        live = everyone
        own = np.flatnonzero(ids == qid)
        if len(own):
            mask = np.ones(words * 64, bool)
            mask[own] = False
            live = everyone & np.packbits(mask).view(np.uint64)
        by_weight: dict[int, list[np.ndarray]] = {}
        minus = 0
        for d, x in enumerate(q.tolist()):
            for e, sign in signed_digits(x):
                minus += ((1 << maps.shape[1]) - 1 << e) * (sign < 0)
                for j in range(maps.shape[1]):
                    # minus a bit is its complement less one: the same constant for all rows
                    row = maps[d, j] if sign > 0 else ~maps[d, j]
                    by_weight.setdefault(e + j, []).append(row[None])
        slices = add_slices(by_weight)
        top = members(select_top(slices, live, k), n)
        if not len(top):
            continue
        exact = vecs[top] @ q
        if len(top) >= k and shift:
            # score = 2**shift * (sliced sum + constant) + what was cut off
            kth = int(np.sort(exact)[-k])
            base = int(low @ q)
            most = int(np.maximum(q, 0).sum()) * ((1 << shift) - 1)
            floor = -((base + most - kth) >> shift) + minus
            top = members(rows_at_least(slices, live, floor), n)
            exact = vecs[top] @ q
        best = np.argsort(ids[top], kind="stable")
        best = best[np.argsort(-exact[best], kind="stable")][:k]
        yield at, ids[top][best], exact[best]


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows with the highest integer
    inner product, ties to the smaller id. Both sides as from ``integer_vectors``."""
    packed = written(blocks(rows, BLOCK_ROWS).withColumn("block", F.monotonically_increasing_id()), "bsi-rows")
    asked = written(blocks(queries, BLOCK_QUERIES).withColumn("part", F.monotonically_increasing_id()), "bsi-queries")
    slots = max(1, min(SLOTS, packed.count()))
    dealt = packed.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)))
    sent = (asked.withColumnsRenamed({"wide": "q_wide", "ids": "q_ids", "vecs": "q_vecs"})
            .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long")))))
    pairs = dealt.join(sent, ["slot", "dim"])

    def run(batches):
        last, index = None, None
        for b in batches:
            for r in range(b.num_rows):
                block, part, dim, wide, q_wide = (b.column(c)[r].as_py() for c in ("block", "part", "dim", "wide", "q_wide"))
                far = wide or q_wide
                if last != (block, far):
                    ids = np.frombuffer(b.column("ids")[r].as_py(), np.int64)
                    vecs = integers(np.frombuffer(b.column("vecs")[r].as_py(), np.float64).reshape(-1, dim), far)
                    last, index = (block, far), bit_slices(vecs)
                q_ids = np.frombuffer(b.column("q_ids")[r].as_py(), np.int64)
                q_vecs = integers(np.frombuffer(b.column("q_vecs")[r].as_py(), np.float64).reshape(-1, dim), far)
                out = list(search_block(ids, vecs, list(zip(q_ids.tolist(), q_vecs)), k, index))
                sizes = [len(x[1]) for x in out]
                scores = [int(s) for x in out for s in x[2]]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * sum(sizes), pa.int64()),
                    "row": pa.array(np.repeat([x[0] for x in out], sizes).astype(np.int32), pa.int32()),
                    "query_id": pa.array(np.repeat([q_ids[x[0]] for x in out], sizes).astype(np.int64), pa.int64()),
                    "vec_id": pa.array(np.concatenate([x[1] for x in out]) if out else [], pa.int64()),
                    "score": pa.array([min(max(s, SMALLEST), LARGEST) for s in scores], pa.int64()),
                    "beyond": pa.array([(s > LARGEST) - (s < SMALLEST) for s in scores], pa.int32())})

    found = pairs.select("block", "part", "dim", "wide", "q_wide", "ids", "vecs", "q_ids", "q_vecs").mapInArrow(
        run, "part long, row int, query_id long, vec_id long, score long, beyond int")
    order = Window.partitionBy("part", "row").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(
        F.raise_error(F.lit("a score of the result is beyond 64 bits")).cast("long"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", score.alias("score")))
