"""URL filter on a sorted digest array.

The rule strings (``host/path-prefix``) are kept as a sorted array of 64-bit xxhash keys
and, in the same order, the full strings. Spark ships both files to every executor
(``SparkContext.addFile`` from the shared folder); a task maps them into memory, probes all
candidate strings of a batch of urls with one vectorised binary search, and compares the
stored string of every digest hit, so that a hash collision decides nothing.

Defined results: a NULL url, or one without ``://``, has empty host and path, fits no rule
and gets the default verdict. Repeated rows are judged one by one. An empty rule list
fits nothing.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabkit.session import scratch_path

#: Rules one list may hold: its arrays are shipped whole to every executor.
MAX_RULES = 50_000_000


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, rest = rule.partition("/")
    return host, slash + rest


class DigestList:
    """The shipped files of one rule list. ``kinds`` are 'allow' / 'block' per rule."""

    def __init__(self, spark: SparkSession, rules: list[tuple[str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; one list holds {MAX_RULES} at most")
        unique = {rule: verdict for verdict, rule in rules}
        if len(unique) < len({(r, v) for v, r in rules}):
            raise ValueError("a rule is listed with two verdicts")
        keyed = sorted((xxhash.xxh64_intdigest(r), r, v) for r, v in unique.items())
        strings = [r.encode() for _, r, _ in keyed]
        self.n = len(keyed)
        self.path_lengths = sorted({len(split_rule(r)[1]) for _, r, _ in keyed})
        self.name = f"digests-{uuid.uuid4().hex}"
        ends = np.cumsum([0] + [len(s) for s in strings]).astype(np.uint64)
        parts = {
            "keys": np.array([k for k, _, _ in keyed], np.uint64).tobytes(),
            "ends": ends.tobytes(),
            "block": bytes(v == "block" for _, _, v in keyed),
            "text": b"".join(strings),
        }
        folder = scratch_path(spark, self.name)
        jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
        for part, data in parts.items():
            target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{self.name}.{part}")
            out = target.getFileSystem(hadoop).create(target)
            out.write(bytearray(data or bytes(8)))  # an empty file cannot be mapped
            out.close()
            spark.sparkContext.addFile(target.toString())

    def open(self):
        """In a task: the mapped arrays (keys, ends, block, text)."""
        def mapped(part, kind, n):
            return np.memmap(SparkFiles.get(f"{self.name}.{part}"), dtype=kind, mode="r")[:n]

        return (mapped("keys", np.uint64, self.n), mapped("ends", np.uint64, self.n + 1),
                mapped("block", np.uint8, self.n), mapped("text", np.uint8, None))


def candidates(host: str, path: str, path_lengths: list[int]):
    """Rule strings that would fit: every suffix of the host's labels with every listed
    length of path prefix."""
    if not host:
        return
    suffix = host
    while True:
        for n in path_lengths:
            if n <= len(path):
                yield suffix + path[:n]
        dot = suffix.find(".")
        if dot < 0:
            return
        suffix = suffix[dot + 1:]


def judge(df: DataFrame, rules: list[tuple[str, str]], default: str = "allow", url: str = "url",
          keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` columns plus host, path, rule (the longest that fits, else NULL), verdict."""
    listed = DigestList(df.sparkSession, rules)
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    schema = "rule string, verdict string"

    @F.pandas_udf(schema)
    def probe(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        keys, ends, block, text = listed.open()
        row, tried = [], []
        for i, (h, p) in enumerate(zip(hosts, paths)):
            found = list(candidates(h, p, listed.path_lengths))
            row += [i] * len(found)
            tried += found
        digest = np.array([xxhash.xxh64_intdigest(t) for t in tried], np.uint64)
        rule, verdict = [None] * len(hosts), [default] * len(hosts)
        at, stop = np.searchsorted(keys, digest, "left"), np.searchsorted(keys, digest, "right")
        for j in np.flatnonzero(at < stop):
            i, own = row[j], tried[j]
            for k in range(at[j], stop[j]):  # rules that share a digest lie side by side
                if text[int(ends[k]): int(ends[k + 1])].tobytes() == own.encode():
                    if rule[i] is None or len(own) > len(rule[i]):
                        rule[i], verdict[i] = own, "block" if block[k] else "allow"
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": verdict})

    parts = df.select(*keep, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    out = parts.withColumn("_judged", probe("host", "path"))
    return out.select(*keep, "host", "path", "_judged.rule", "_judged.verdict")
