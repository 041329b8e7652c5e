"""Finding runs that recur anywhere in a corpus: the part that phrase automata and suffix
arrays share.

A window is ``width`` consecutive units (words or bytes) of one text. Its anchor is the
leftmost smallest hash among its runs of ``gram`` units, so that equal windows have equal
anchors wherever they occur, and windows that follow each other mostly share one. The
windows of a text with the same anchor occurrence form a segment. A window can recur only
if its anchor does, so:

1. all anchors are counted by one shuffle of small rows; an anchor that recurs within one
   batch is known to and sends a single witness, so that a frequent anchor does not fill a
   partition;
2. the segments of recurring anchors are cut from their texts; within a batch equal segments
   share one row that carries the content;
3. an operator settles the contents of each group of anchors (a shard) by its own method,
   and the answers go back to the segments and the texts.

Every window lies in exactly one segment, so counts of segments are counts of windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tabkit.llm.common import BYTE_VALUE, NULL_ID, Words, give_back, slices, window_hash, written

#: Content rows of one anchor beyond which its windows are settled one by one.
HOT_CONTENTS = 8192


def leftmost_min(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest of every ``w`` consecutive values."""
    at, best, have = np.arange(len(values), dtype=np.int32), values, 1
    while have < w:
        step = min(have, w - have)
        left, right = best[:-step], best[step:]
        take = right < left
        best = np.where(take, right, left)
        at = np.where(take, at[step:], at[:-step])
        have += step
    return at


def unit_hashes(data, bounds, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the units of the texts in one buffer, and each text's first unit."""
    if kind == "byte":
        return BYTE_VALUE[data], bounds
    words = Words(data, bounds, lower=False)
    return words.hash, words.first


def segments(hashes: np.ndarray, first: np.ndarray, width: int, gram: int):
    """(text row, first window, windows, anchor hash) of all segments; windows count from
    the text's first unit."""
    grams = window_hash(hashes, gram)
    span = width - gram + 1
    if len(grams) < span:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = leftmost_min(grams, span)
    n = len(at)
    # windows that stay within a text: the others start in its last width - 1 units
    inside = np.ones(n + width, bool)
    ends = first[1:]
    for back in range(1, width) if width <= len(ends) else ():
        at_end = ends - back
        inside[at_end[at_end >= 0]] = False
    if width > len(ends):
        for a, b in zip(first[:-1].tolist(), ends.tolist()):
            inside[max(a, b - width + 1): b] = False
    inside = inside[:n]
    where = np.flatnonzero(inside)
    if not len(where):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    own = at[where]
    new = np.ones(len(where), bool)
    # the anchor lies in the window: windows of different texts never share one
    new[1:] = own[1:] != own[:-1]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(where)))
    lo = where[begin]
    text = np.searchsorted(first, lo, "right") - 1
    return text, lo - first[text], count, grams[own[begin]]


def keyed(docs: DataFrame) -> DataFrame:
    """(rid, did, text): a 64-bit key of each row's id and text; the id, NULL as NULL_ID."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("rid"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"), text.alias("text"))


def recurring(rows: DataFrame, kind: str, width: int, gram: int) -> DataFrame:
    """(rid, h, lo, n): the segments whose anchor occurs more than once."""

    def run(batches):
        for b in batches:
            found, ids = [], b.column("rid").to_numpy()
            for first, last, data, bounds in slices(b.column("text")):
                text, lo, n, h = segments(*unit_hashes(data, bounds, kind), width, gram)
                found.append((ids[first + text], lo, n, h))
            if not found:
                continue
            rid, lo, n, h = (np.concatenate(x) for x in zip(*found))
            distinct, index, inverse, counts = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            sure = counts[inverse] > 1
            many = np.flatnonzero(counts > 1)
            # weight 0: known to recur; 1: not known; 2: witness of those with 0
            weight = np.concatenate([np.where(sure, 0, 1), np.full(len(many), 2)]).astype(np.int8)
            pad = lambda x: np.concatenate([x, np.zeros(len(many), x.dtype)])
            yield pa.RecordBatch.from_arrays([
                pa.array(pad(rid)), pa.array(np.concatenate([h, distinct[many]]).view(np.int64)),
                pa.array((pad(lo) << 16 | pad(n)).astype(np.int64)), pa.array(weight)], names=["rid", "h", "at", "weight"])
            del found, rid, lo, n, h, distinct, index, inverse, counts, sure, many, weight
            give_back()

    def scan():
        return rows.select("rid", "text").mapInArrow(run, "rid long, h long, at long, weight tinyint")

    group = Window.partitionBy("h")
    counted = (scan().filter("weight > 0").withColumn("total", F.sum("weight").over(group))
               .filter("total > 1 and weight = 1"))
    both = scan().filter("weight = 0").select("rid", "h", "at").unionByName(counted.select("rid", "h", "at"))
    return both


def with_segments(rows: DataFrame, kind: str, width: int, gram: int) -> DataFrame:
    """(rid, lo, h, c, content, lowest, highest, copies), written: a row per recurring
    segment. ``c`` is a 64-bit key of the content; the first row of a content in each batch
    carries it, with the lowest and highest doc id and the number of rows it stands for."""
    # a set: rows that repeat an (id, text) share their rid, and each has all of its hits once
    hits = recurring(rows, kind, width, gram).groupBy("rid").agg(F.collect_set(F.struct("h", "at")).alias("hits"))
    texts = packed_text(rows)

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            seen: dict[tuple, int] = {}  # the row that carries a content
            out = [[] for _ in range(8)]
            lowest, highest, copies = out[5:]
            for rid, did, z, hits in zip(b.column("rid").to_pylist(), b.column("did").to_pylist(), b.column("z"), b.column("hits")):
                text = unpack.decompress(z.as_buffer())
                units = text if kind == "byte" else text.split()
                hs, ats = (hits.values.field(i).to_numpy() for i in (0, 1))
                for a, h in sorted(zip(ats.tolist(), hs.tolist())):
                    lo, n = a >> 16, a & 0xFFFF
                    content = units[lo: lo + n - 1 + width]
                    content = content if kind == "byte" else b" ".join(content)
                    c = content_key(content)
                    first = seen.setdefault((h, c), len(out[0]))
                    if first == len(out[0]):
                        stored = (content, did, did, 1)
                    else:
                        lowest[first] = min(lowest[first], did)
                        highest[first] = max(highest[first], did)
                        copies[first] += 1
                        stored = (None, None, None, None)
                    for column, v in zip(out, (rid, lo, h, c, *stored)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in out[:4]), pa.array(out[4], pa.binary()), *(pa.array(x, pa.int64()) for x in out[5:])],
                names=["rid", "lo", "h", "c", "content", "lowest", "highest", "copies"])
            del seen, out, lowest, highest, copies
            give_back()

    return written(texts.join(hits, "rid").mapInArrow(
        cut, "rid long, lo long, h long, c long, content binary, lowest long, highest long, copies long"), "segments")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def content_key(content: bytes) -> int:
    return signed(xxhash.xxh64_intdigest(content))


def packed_text(rows: DataFrame) -> DataFrame:
    """(rid, did, z): the texts compressed, as they are shuffled."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                z = [pack.compress(t.as_buffer()) for t in part.column("text").cast(pa.large_binary())]
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("did"), pa.array(z, pa.binary())], names=["rid", "did", "z"])

    return rows.mapInArrow(run, "rid long, did long, z binary")


def merged_contents(table: pa.Table):
    """Distinct contents of a shard: (first row of each, lowest, highest, copies)."""
    h, c = table.column("h").to_numpy(), table.column("c").to_numpy()
    order = np.lexsort((c, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])
    begin = np.flatnonzero(new)
    column = lambda name: table.column(name).to_numpy()[order]
    return (order[begin], np.minimum.reduceat(column("lowest"), begin), np.maximum.reduceat(column("highest"), begin),
            np.add.reduceat(column("copies"), begin))


def answers(found: DataFrame, kind: str, width: int, solve, shard_bytes: int, by_key) -> DataFrame:
    """(h, c, runs), written: what an operator says of every distinct content.

    ``solve(contents, lowest, highest, copies, anchor)`` answers a shard: for each content the bytes
    of an int64 array of runs, or None. All contents of an anchor are in one shard. An anchor with more than HOT_CONTENTS content rows
    has no bounded shard: its windows are compared by 128-bit keys in a shuffle, and
    ``by_key(rel, lowest, highest, copies)`` makes the runs of a content from those that recur.
    """
    contents = found.filter("content IS NOT NULL").select("h", "c", "content", "lowest", "highest", "copies")
    size = contents.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    # at most one row of 8 bytes for HOT_CONTENTS contents
    hot = written(contents.groupBy("h").count().filter(F.col("count") > HOT_CONTENTS).select("h"), "hot")

    def shard(table: pa.Table) -> pa.Table:
        rows, lowest, highest, copies = merged_contents(table)
        contents = table.column("content").take(pa.array(rows)).to_pylist()
        runs = solve(contents, lowest, highest, copies, table.column("h").to_numpy()[rows])
        some = np.array([i for i, r in enumerate(runs) if r is not None], np.int64)
        at = pa.array(rows[some])
        out = pa.table({"h": table.column("h").take(at), "c": table.column("c").take(at),
                        "runs": pa.array([runs[i] for i in some], pa.binary())})
        if table.nbytes > 4 * shard_bytes:
            del contents, runs
            give_back()
        return out

    plain = contents.join(F.broadcast(hot), "h", "left_anti")
    out = (plain.withColumn("shard", F.pmod("h", F.lit(shards).cast("long"))).groupBy("shard")
           .applyInArrow(lambda t: shard(t), "h long, c long, runs binary"))
    if hot.isEmpty():
        return written(out, "answers")

    def windows(batches):
        for b in batches:
            for i in range(b.num_rows):
                content = b.column("content")[i].as_py()
                units = content if kind == "byte" else content.split(b" ")
                n = len(units) - width + 1
                parts = [units[r: r + width] if kind == "byte" else b" ".join(units[r: r + width]) for r in range(n)]
                digests = [xxhash.xxh128_intdigest(p) for p in parts]
                same = lambda name: pa.array([b.column(name)[i].as_py()] * n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [same("h"), same("c"), pa.array(range(n), pa.int64()), pa.array([signed(d >> 64) for d in digests], pa.int64()),
                     pa.array([signed(d & ((1 << 64) - 1)) for d in digests], pa.int64()), same("lowest"), same("highest"), same("copies")],
                    names=["h", "c", "rel", "w1", "w2", "lowest", "highest", "copies"])

    once = contents.join(F.broadcast(hot), "h", "left_semi").groupBy("h", "c").agg(
        F.first("content").alias("content"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"), F.sum("copies").alias("copies"))
    each = once.mapInArrow(windows, "h long, c long, rel long, w1 long, w2 long, lowest long, highest long, copies long")
    many = each.groupBy("w1", "w2").agg(F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
                                        F.sum("copies").alias("copies")).filter("copies > 1")

    def gathered(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("rel").to_numpy())
        rel, lowest, highest, copies = (table.column(x).to_numpy()[order] for x in ("rel", "lowest", "highest", "copies"))
        runs = by_key(rel, lowest, highest, copies)
        n = int(runs is not None)
        return pa.table({"h": table.column("h")[:n], "c": table.column("c")[:n], "runs": pa.array([runs][:n], pa.binary())})

    back = each.select("h", "c", "rel", "w1", "w2").join(many, ["w1", "w2"]).groupBy("h", "c").applyInArrow(
        lambda t: gathered(t), "h long, c long, runs binary")
    return written(out.unionByName(back), "answers")


def runs_of(rel: np.ndarray, value: np.ndarray) -> bytes | None:
    """int64 triples (first, length, value) of consecutive positions with equal values."""
    if not len(rel):
        return None
    new = np.ones(len(rel), bool)
    new[1:] = (rel[1:] != rel[:-1] + 1) | (value[1:] != value[:-1])
    begin = np.flatnonzero(new)
    return np.stack([rel[begin], np.diff(np.append(begin, len(rel))), value[begin]], axis=1).astype(np.int64).tobytes()


def merged_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans [first, last) as sorted spans that do not touch."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order]) if len(order) else last
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > last[:-1]
    return first[new], last[np.append(new[1:], True)] if len(first) else last


def per_text(rows: DataFrame, found: DataFrame, told: DataFrame, finish, schema: str) -> DataFrame:
    """``finish(did, text, (lo, runs))`` -> a row, for every row of ``rows``: all runs that were
    told of its segments, and the first window of each run's segment."""
    hits = (found.select("rid", "lo", "h", "c").join(told, ["h", "c"]).groupBy("rid")
            .agg(F.collect_set(F.struct("lo", "runs")).alias("hits")))
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    types = [{"long": pa.int64(), "string": pa.string()}[k] for k in kinds]

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = []
                lists = part.column("hits")
                inner, ends = lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy()))
                size = pc.binary_length(inner.field("runs")).to_numpy(zero_copy_only=False).astype(np.int64) // 24
                runs = np.frombuffer(b"".join(inner.field("runs").to_pylist()), np.int64).reshape(-1, 3)
                lo = np.repeat(inner.field("lo").to_numpy(), size)
                cuts = np.append(0, np.cumsum(size))[ends]
                for i, (did, z) in enumerate(zip(part.column("did").to_pylist(), part.column("z"))):
                    own = slice(cuts[i], cuts[i + 1])
                    out.append(finish(did, unpack.decompress(z.as_buffer()), (lo[own], runs[own])))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=list(names))
            give_back()

    return packed_text(rows).join(hits, "rid", "left").select("did", "z", "hits").mapInArrow(run, schema)
