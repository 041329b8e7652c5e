"""Profiles kept up to date file by file (P1, P2, P4, P8, P10 and quantiles over a growing folder).

A profile state has one row per (file, column): counts, moments, extremes and two mergeable
sketches. ``update_profile`` scans only files that the state does not know yet (by path, size and
modification time), in one aggregate over all their columns; ``profile_from_state`` merges the rows
of all files without reading any data. Counts, extremes and moments are those of a profile from
scratch; distinct counts come from HyperLogLog sketches and quantiles from KLL sketches.

The state is a table of the caller's: write it, and pass what was written to the next call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.distributed import present
from tabkit.operators.profile import missing

#: Log2 of the buckets of a distinct sketch (relative error about 1.6 %) and size of a quantile
#: sketch (rank error below 1 %).
DISTINCT_LOG, QUANTILE_SIZE = 12, 400
FILE = ["file", "size", "modified"]
STATE = ("file string, size long, modified timestamp, column string, position int, dtype string, rows long, missing long, "
         "present long, mean double, m2 double, m3 double, least double, greatest double, distinct binary, ranks binary")


def listed_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(file, size, modified, path) of every input file below ``path``; no file is opened."""
    suffix = {"parquet": "*.parquet"}.get(fmt, "*")
    files = spark.read.format("binaryFile").option("pathGlobFilter", suffix).option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"), "path")


def _sums(df: DataFrame, i: int, c: str) -> list:
    """Aggregates of one column. Sums of powers are kept around the file's own mean."""
    col = F.col(f"`{c}`")
    out = [F.count_if(missing(df, c)).alias(f"missing{i}"),
           F.hll_sketch_agg(F.when(~missing(df, c), col.cast("string")), DISTINCT_LOG).alias(f"distinct{i}")]
    if isinstance(df.schema[c].dataType, T.NumericType):
        v = present(col.cast("double"))
        out += [F.count(v).alias(f"present{i}"), F.avg(v).alias(f"mean{i}"), F.var_pop(v).alias(f"var{i}"),
                F.skewness(v).alias(f"skew{i}"), F.min(v).alias(f"least{i}"), F.max(v).alias(f"greatest{i}"),
                F.kll_sketch_agg_double(v, QUANTILE_SIZE).alias(f"ranks{i}")]
    return out


def _entry(df: DataFrame, i: int, c: str):
    field = df.schema[c]
    numeric = isinstance(field.dataType, T.NumericType)
    number = lambda name: (F.col(f"{name}{i}") if numeric else F.lit(None)).cast("double")
    rows, gone = (F.coalesce(F.col(x), F.lit(0)).cast("long") for x in ("rows", f"missing{i}"))
    here = F.coalesce(F.col(f"present{i}"), F.lit(0)).cast("long") if numeric else rows - gone
    spread = F.pow(number("var"), F.lit(1.5))
    return F.struct(
        F.lit(c).alias("column"), F.lit(i).alias("position"), F.lit(field.dataType.simpleString()).alias("dtype"),
        rows.alias("rows"), gone.alias("missing"), here.alias("present"), number("mean").alias("mean"),
        (number("var") * here).alias("m2"),
        F.when(number("var") > 0, number("skew") * spread * here).when(number("var") == 0, 0.0).alias("m3"),
        number("least").alias("least"), number("greatest").alias("greatest"), F.col(f"distinct{i}").alias("distinct"),
        (F.col(f"ranks{i}") if numeric else F.lit(None)).cast("binary").alias("ranks"))


def scan_files(spark: SparkSession, path: str, files: DataFrame, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """State rows of ``files`` (as listed below ``path``), from one scan of them; a file without rows has
    rows of zeros."""
    read = spark.read.format(fmt).options(**(options or {}))
    schema = read.option("recursiveFileLookup", True).load(path).schema
    paths = [r.path for r in files.select("path").collect()]  # names only, which Spark lists on the driver anyway
    if not paths:
        return spark.createDataFrame([], STATE)
    data = spark.read.format(fmt).options(**(options or {})).schema(schema).load(paths)
    aggs = [a for i, c in enumerate(data.columns) for a in _sums(data, i, c)]
    # the group's name is kept apart from the columns of the data
    sums = data.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    whole = files.select(*FILE).join(sums, "file", "left")
    return whole.select(*FILE, F.inline(F.array(*[_entry(data, i, c) for i, c in enumerate(data.columns)])))


def update_profile(spark: SparkSession, path: str, state: DataFrame | None = None, fmt: str = "parquet",
                   options: dict | None = None) -> DataFrame:
    """The state of the folder as it is now. Rows of files that are still there unchanged are taken from
    ``state``; new and changed files are scanned; rows of files that are gone are left out."""
    files = listed_files(spark, path, fmt)
    if state is None:
        return scan_files(spark, path, files, fmt, options)
    kept = state.join(files.select(*FILE), FILE, "left_semi")
    known = state.select(*FILE).distinct()
    return kept.unionByName(scan_files(spark, path, files.join(known, FILE, "left_anti"), fmt, options))


def profile_from_state(state: DataFrame, quantiles: tuple = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column over all files of the state: (column, position, dtype, files, rows, missing, present,
    mean, stddev, skewness, least, greatest, n_distinct, quantiles). Deviation and skewness are the sample
    ones; ``n_distinct`` and ``quantiles`` are estimates. A column of no values has NULLs."""
    key = ["column"]
    centre = state.groupBy(*key).agg((F.sum(F.col("mean") * F.col("present")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("present")))).alias("centre"))
    off, n = F.col("mean") - F.col("centre"), F.col("present")
    merged = state.join(centre, key).groupBy(*key).agg(
        F.min("position").alias("position"), F.max("dtype").alias("dtype"), F.count(F.lit(1)).alias("files"),
        *[F.sum(c).alias(c) for c in ("rows", "missing", "present")], F.first("centre").alias("mean"),
        F.sum(F.col("m2") + n * off * off).alias("m2"), F.sum(F.col("m3") + 3 * off * F.col("m2") + n * off * off * off).alias("m3"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"))
    m2, m3 = F.col("m2"), F.col("m3")
    population = F.when(m2 > 0, (m3 / n) / F.pow(m2 / n, F.lit(1.5))).when(m2 == 0, 0.0)
    cuts = F.array(*[F.kll_sketch_get_quantile_double("ranks", F.lit(float(q))) for q in quantiles])
    return merged.select(
        "column", "position", "dtype", "files", "rows", "missing", "present", "mean",
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("stddev"),
        F.when(n > 2, population * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"), "least", "greatest",
        F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"),
        F.when(F.col("mean").isNotNull(), cuts).alias("quantiles"))
