"""Splits and folds (D1–D3, U1), split sizes (A1) and prediction alignment.

Row membership comes from a portable hash of the key, so splits do not depend
on partitioning, repeat exactly across runs and engines, and need no global
sort or single-task window.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.scalar import HASH_RANGE, portable_hash
from tabkit.session import ensure_checkpoint_dir

TOP_BITS = 16  # first-level histogram of the exact split: 65,536 buckets


def hash_split(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Rows whose hash falls below ``test_frac`` of the hash range are 'test'."""
    cut = int(test_frac * HASH_RANGE)
    return df.withColumn(out, F.when(portable_hash(key, seed) < F.lit(cut), "test").otherwise("train"))


def assign_folds(df: DataFrame, key: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """D3: fold number 0..k-1 from the hash; each row in exactly one fold (a NULL key in
    the fold of the hash of ``seed|``)."""
    h = F.coalesce(portable_hash(key, seed), portable_hash(F.lit(""), seed))
    return df.withColumn(out, F.pmod(h, F.lit(k)).cast("int"))


def exact_split(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Shuffled split of exact size: the ceil(test_frac * n) rows with the
    smallest (hash, key) are 'test' (scikit-learn's test size).

    The cut is found without sorting the table: a histogram of the hash's top
    16 bits locates the bucket holding the cut, a second histogram of that
    bucket's low bits the exact hash value, and the keys of that one hash value are counted
    in order (NULL first). Where the cut falls between rows of one key, those rows are
    numbered as they lie: counts per partition and their offsets, without moving a row.
    """
    h = F.coalesce(portable_hash(key, seed), portable_hash(F.lit(""), seed))  # a NULL key is a key
    # the three locating passes read only (key, hash): keep that narrow projection
    keys = df.select(F.col(key), h.alias("_h")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shift = 32 - TOP_BITS
        top = keys.groupBy(F.shiftright("_h", shift).alias("b")).agg(F.count(F.lit(1)).alias("c"))
        cut = _locate(top, lambda n: math.ceil(test_frac * n))
        if cut is None:  # empty table or no test rows wanted
            return df.withColumn(out, F.lit("train"))
        b1, need1, n = cut
        low = (
            keys.where(F.shiftright("_h", shift) == F.lit(b1))
            .groupBy((F.col("_h") % F.lit(1 << shift)).alias("b")).agg(F.count(F.lit(1)).alias("c"))
        )
        b2, need2, _ = _locate(low, lambda _n: need1)
        hv = (b1 << shift) + b2
        # keys sharing one 32-bit hash value: about n / 2^32 of them
        same = keys.where(F.col("_h") == F.lit(hv)).groupBy(key).agg(F.count(F.lit(1)).alias("c")).orderBy(F.col(key).asc_nulls_first()).collect()
    finally:
        keys.unpersist()
    for r in same:
        last_key, of_key = r[key], r["c"]
        if need2 <= of_key:
            break
        need2 -= of_key
    here = h == F.lit(hv)
    lower = here & (F.col(key).isNull() if last_key is None else F.coalesce(F.col(key) <= F.lit(last_key), F.lit(True)))
    if need2 == of_key:
        return df.withColumn(out, F.when((h < F.lit(hv)) | lower, "test").otherwise("train"))
    at_cut = here & F.col(key).eqNullSafe(F.lit(last_key))
    rest = df.where(~at_cut).withColumn(out, F.when((h < F.lit(hv)) | lower, "test").otherwise("train"))
    # written, so that a row keeps its partition and its place there
    ensure_checkpoint_dir(df.sparkSession)
    place = F.monotonically_increasing_id()  # partition number, then the row's number in it
    tied = df.where(at_cut).checkpoint(eager=True)
    sizes = tied.select(place.alias("_at")).groupBy(F.shiftright("_at", 33).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    part, within, _ = _locate(sizes, lambda _n: need2)
    marked = tied.withColumn(out, F.when(place < F.lit((part << 33) + within), "test").otherwise("train"))
    return rest.unionByName(marked)


def _locate(hist: DataFrame, want):
    """In a histogram (b, c) of 65,536 buckets or one a partition, which is read whole, find the bucket
    where the running count reaches ``want(total)``. Returns (bucket, rows needed from it, total)."""
    rows = sorted((r["b"], r["c"]) for r in hist.collect())
    n = sum(c for _, c in rows)
    k = min(want(n), n)
    if k <= 0:
        return None
    before = 0
    for b, c in rows:
        if before + c >= k:
            return b, k - before, n
        before += c


def training_folds(df: DataFrame, k: int, fold_col: str = "fold") -> DataFrame:
    """U1 (preferred form): all folds but ``k`` — a filter, no plan growth."""
    return df.where(F.col(fold_col) != F.lit(k))


def union_folds(folds: list[DataFrame]) -> DataFrame:
    """U1 for separate fold tables: bag union by column name."""
    return reduce(DataFrame.unionByName, folds)


def split_sizes(df: DataFrame, col: str) -> DataFrame:
    """A1: rows per split / fold."""
    return df.groupBy(F.col(col).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def align_predictions(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Pair each label with its prediction by key (rows have no position on Spark)."""
    return labels.join(predictions, key, "inner")
