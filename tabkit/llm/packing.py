"""Shortest-pack-first packing over the length histogram.

Documents are tokenised, closed with one end id and cut into pieces of at most ``limit``
ids. Only the histogram of piece lengths (``limit`` counts) reaches the driver: lengths are
placed longest first, always into the pack with the most room left, and a pack is a pattern
of lengths with a count, so that placing works on counts and not on pieces. Patterns are
joined back by rank: the r-th piece of a length goes to the r-th place that the patterns
have for it. Ranks within a length are given per cell (length, hash of the piece) with
running offsets, so that a frequent length is not one task.

Defined results: a NULL or empty text is the end id alone; a NULL doc_id is kept; each
repeated row is packed; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tabkit.llm import common
from tabkit.llm.common import give_back, written

LIMIT = 2048
END_ID = 1
#: Words whose ids a Python worker remembers (some 200 bytes each).
REMEMBERED = 2_000_000
#: Pieces of one ranking cell, on average.
CELL_PIECES = 1024
#: Marks that a word is cut at before it is looked up: each of them is a token piece of its own.
TAIL = b".,!?#$%&*;:"


class Encoder:
    """Ids of whole texts. The vocabulary's pre-tokeniser drops white space, so a text has
    the ids of its words in order; words are encoded once and remembered. The tokeniser is used as
    it is loaded: a text that quotes a special token gets that token's id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def learn(self, words) -> None:
        cut = {}
        for w in words:
            core = w.rstrip(TAIL)
            # ASCII letters and the marks after them never share a token piece; other letters may
            # become a letter and a combining mark, which does
            if core != w and core.isalpha():
                cut[w] = (core, w[len(core):])
        new = {p for pair in cut.values() for p in pair} | {w for w in words if w not in cut}
        new = [w for w in new if w not in self.known]
        for i in range(0, len(new), 10_000):
            part = new[i:i + 10_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                self.known[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        for w, (core, tail) in cut.items():
            self.known[w] = self.known[core] + self.known[tail]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        words = text.encode().split()
        out = []
        for i in range(0, len(words), 100_000):
            part = words[i:i + 100_000]
            if len(self.known) > REMEMBERED:
                self.known.clear()
            found = list(map(self.known.get, part))
            if None in found:
                self.learn({w for w, f in zip(part, found) if f is None})
                found = map(self.known.__getitem__, part)
            out.append(b"".join(found))
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}
common.REMEMBERED.append(_ENCODERS)


def encoder_for(path: str) -> Encoder:
    """The Python worker's own encoder, which outlives a task, until the memory is given back. (A name of the module: what a
    nested function refers to is copied with it, and would start anew in every task.)"""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget_words() -> None:
    """Give back the Python worker's encoders, if it has any."""
    if _ENCODERS:
        give_back()


def pieces(docs: DataFrame, vocabulary: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids): the pieces of every row."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = encoder_for(vocabulary)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = encoder.ids(text or "") + end
                    n = len(ids) // 4
                    rows += [(doc, s, min(limit, n - s), zlib.crc32(p := ids[4 * s: 4 * (s + limit)]), n, p) for s in range(0, n, limit)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def pack(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (count, lengths) that place every length as often as it occurs."""
    room: dict[int, list] = {}  # room left -> open patterns
    done = []
    most = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            most = max((r for r, p in room.items() if p), default=0) if not room.get(most) else most
            if most < length:
                room.setdefault(limit - length, []).append((left, (length,)))
                most = max(most, limit - length)
                break
            count, lengths = room[most].pop()
            used = min(count, left)
            if count > used:
                room[most].append((count - used, lengths))
            left -= used
            if most > length:
                room.setdefault(most - length, []).append((used, (*lengths, length)))
            else:
                done.append((used, (*lengths, length)))
    return done + [p for open_ in room.values() for p in open_]


def places(patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted runs of ranks: keys (length << 40 | first rank), the first sequence of the run,
    the offset in the sequence."""
    first, taken, rows = 0, {}, []
    for count, lengths in patterns:
        at = 0
        for n in lengths:
            rows.append((n << 40 | taken.get(n, 0), first, at))
            taken[n] = taken.get(n, 0) + count
            at += n
        first += count
    rows.sort()
    keys, firsts, offsets = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
    return keys, firsts, offsets


def packed(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``cut`` (pieces, written) with sequence_id and offset. Pieces that stand in for each
    other in every column but doc_id may trade places."""
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # limit rows at most
    keys, firsts, offsets = places(pack(counts, limit))
    cells = F.element_at(F.array(*[F.lit(max(1, -(-counts.get(n, 0) // CELL_PIECES))) for n in range(1, limit + 1)]), F.col("length").cast("int"))
    columns = cut.columns
    rows = cut.withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), cells.cast("long")))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = (rows.groupBy("length", "cell").agg(F.count("*").alias("here"))
            .withColumn("skip", F.coalesce(F.sum("here").over(before), F.lit(0))).select("length", "cell", "skip"))
    inside = Window.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32")
    ranked = (rows.withColumn("in_cell", F.row_number().over(inside) - 1).join(sums, ["length", "cell"])
              .select(*columns, (F.col("skip") + F.col("in_cell")).alias("rank")))

    def place(batches):
        forget_words()  # the pieces are written
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, n << 40 | rank, "right") - 1
            sequence = firsts[at] + rank - (keys[at] & ((1 << 40) - 1))
            kept = [b.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(offsets[at], pa.int64())],
                                             names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece; the ids
    themselves (little-endian unsigned 32-bit) on request."""
    cut = pieces(docs, vocabulary, limit)
    return packed(written(cut if with_ids else cut.drop("ids"), "pieces"), limit)
