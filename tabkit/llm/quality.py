"""Quality classifier by nearest-neighbour voting on latent-semantic vectors.

Every whole text is counted into hashed byte trigrams; damped counts weighted by inverse
document frequency (over all documents) and projected on the leading singular directions are
its latent-semantic vector. Labelled vectors (at most VOTERS, a documented bound, chosen by a
hash of doc_id without regard to class, so that the classes keep their shares at any size) are
broadcast; each document's cosines with all of them are computed exactly in blocks of
documents, and the labels of the K nearest vote with their similarity.

Defined results: a NULL or empty text, and a text without a similar labelled vector, scores
the training share of label 1. Without any training label every score is 0.5. Labels that
are NULL, or ambiguous for a doc_id, train nothing. Repeated rows score alike. Of several
texts with one doc_id the smallest trains; each row counts in the document frequencies.
Neighbours as near as the K-th one share the votes that are left for them. Very long texts are
counted whole, a text at a time. Of an empty table nothing is scored. Other columns, whatever
their names, are not read, and kept by ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabkit.llm.common import slices

#: Labelled rows that may be fitted on and broadcast.
VOTERS = 4000
BUCKETS, RANK, K, BLOCK = 2048, 48, 25, 512
#: Sharpness of the similarity weights.
POWER = 8


def trigram_counts(column: pa.Array) -> np.ndarray:
    """Damped counts of hashed byte trigrams, a row per text."""
    out = np.zeros((len(column), BUCKETS), np.float32)
    for first, last, data, bounds in slices(column):
        a = data.astype(np.uint32)
        if len(a) < 3:
            continue
        code = a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA77) ^ a[2:] * np.uint32(0xC2B2AE3D)
        code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(21)
        for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
            if hi - lo >= 3:
                out[first + i] = np.bincount(code[lo:hi - 2], minlength=BUCKETS)
    return np.log1p(out, out=out)


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def training_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, y): the labels that may train, one per doc_id."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
            .filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
            .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("y2")).filter("y = y2").drop("y2"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", voters: int = VOTERS) -> DataFrame:
    """(doc_id, y, text): the bounded labelled sample, one row per doc_id."""
    chosen = training_labels(labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(voters)
    texts = docs.select(F.col("doc_id"), F.col("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id")  # at most voters ids
    return joined.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of ``docs``, and how many of them hold each bucket."""

    def count(batches):
        n, seen = 0, np.zeros(BUCKETS, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.column("text").slice(lo, BLOCK)
                n += len(part)
                seen += (trigram_counts(part) > 0).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, BUCKETS), pa.int32()), pa.array([n, *seen], pa.int64())], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = {r["bucket"]: r["n"] for r in rows}  # BUCKETS + 1 rows at most
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(BUCKETS)], np.int64)


class Model:
    """Projection and labelled vectors; a few MB whatever the size of the tables."""

    def __init__(self, counts: np.ndarray, y: np.ndarray, share: float, n: int, seen: np.ndarray):
        self.share = share
        self.idf = np.log((1 + n) / (1 + seen)).astype(np.float32) + 1
        x = counts * self.idf  # one copy of the sample, changed in place: it is the driver's largest piece
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(BUCKETS, np.float32)
        if len(x):
            x -= self.mean
            gram = (x.T @ x).astype(np.float64)
            del x
            _, vectors = np.linalg.eigh(gram)
            self.down = np.ascontiguousarray(vectors[:, ::-1][:, :RANK]).astype(np.float32)
        else:
            self.down = np.zeros((BUCKETS, RANK), np.float32)
        self.y = y.astype(np.float32)
        self.known = np.concatenate([self.project(counts[i:i + BLOCK]) for i in range(0, len(counts), BLOCK)] or [self.project(counts)])

    def project(self, counts: np.ndarray) -> np.ndarray:
        x = unit_rows(counts * self.idf) - self.mean
        x[counts.sum(axis=1) == 0] = 0
        return unit_rows(x @ self.down)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.y):
            return np.full(len(counts), 0.5)
        out = np.empty(len(counts))
        for i in range(0, len(counts), BLOCK):
            cosine = self.project(counts[i:i + BLOCK]) @ self.known.T
            k = min(K, cosine.shape[1])
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            close = np.take_along_axis(cosine, near, 1)
            weight = np.maximum(close, 0).astype(np.float64) ** POWER
            total = weight.sum(axis=1)
            vote = (weight * self.y[near]).sum(axis=1)
            last = close.min(axis=1)
            for r in np.flatnonzero((cosine >= last[:, None]).sum(axis=1) > k):  # equals of the k-th share its votes
                above = close[r] > last[r]
                mean = self.y[cosine[r] == last[r]].mean()
                vote[r] = (weight[r] * np.where(above, self.y[near[r]], mean)).sum()
            out[i:i + BLOCK] = np.where(total > 1e-12, vote / np.maximum(total, 1e-12), self.share)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, voters: int = VOTERS) -> Model:
    def vectors(batches):
        for b in batches:
            counts = trigram_counts(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), b.column("y").cast(pa.int32()), pa.array([c.tobytes() for c in counts], pa.binary())],
                names=["doc_id", "y", "counts"])

    train = training_rows(docs, labels, voters=voters).mapInArrow(vectors, "doc_id long, y int, counts binary")
    rows = sorted(((r["doc_id"], r["counts"], r["y"]) for r in train.toLocalIterator()))  # voters rows at most
    share = training_labels(labels).agg(F.avg(F.col("y").cast("double"))).first()[0]
    y = np.array([r[2] for r in rows])
    counts = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(-1, BUCKETS)
    del rows
    return Model(counts, y, 0.5 if share is None else share, *document_frequencies(docs))


def scorer(spark, model: Model):
    """Column function: score of a text column."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = []
        for i in range(0, len(texts), BLOCK):
            column = pa.array(texts.iloc[i:i + BLOCK], pa.large_string(), from_pandas=True)
            found.append(shipped.value.score(trigram_counts(column)))
        return pd.Series(np.concatenate(found) if found else np.zeros(0))

    return score


def scores(docs: DataFrame, labels: DataFrame, voters: int = VOTERS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    score = scorer(docs.sparkSession, fit(docs, labels, voters))
    return docs.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"),
        score(F.col("text")).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, voters: int = VOTERS) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, all columns."""
    score = scorer(docs.sparkSession, fit(docs, labels, voters))
    return docs.filter(score(F.col("text")) >= least)
