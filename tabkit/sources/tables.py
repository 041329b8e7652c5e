"""Small result tables and file inventories."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def results_frame(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """Turn a few result rows (run metrics, grid scores) into a DataFrame.

    Only for results and parameters; data tables are always scanned directly.
    """
    return spark.createDataFrame(rows, schema)


def file_inventory(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Input files with their row counts; ``file_name`` is the path below ``path`` (the
    file's own name where ``path`` is one file), so equal names in different folders stay
    apart. Files without rows are listed with 0: names come from the file listing, counts
    from the scan's file metadata."""
    suffix = {"parquet": "*.parquet"}.get(fmt, "*")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", suffix).option("recursiveFileLookup", True).load(path)
    counts = spark.read.format(fmt).option("recursiveFileLookup", True).load(path).groupBy(
        F.col("_metadata.file_path").alias("uri")).agg(F.count("*").alias("rows"))
    # the two sides write scheme and slashes differently, and one is percent-encoded
    bare = lambda c: F.regexp_replace(c, r"^\w+:/*", "")
    decoded = F.url_decode(F.regexp_replace(F.col("uri"), r"\+", "%2B"))
    names = listed.select(bare(F.col("path")).alias("file"))
    root = re.sub(r"^(\w+:)?/*", "", path.rstrip("/")) + "/"
    below = F.when(F.contains("file", F.lit(root)), F.substring_index("file", root, -1)).otherwise(F.substring_index("file", "/", -1))
    return names.join(counts.select(bare(decoded).alias("file"), "rows"), "file", "left").select(
        below.alias("file_name"), F.coalesce("rows", F.lit(0)).alias("rows"))
