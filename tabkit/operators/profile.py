"""Profiling (P1–P11) and two-way counts (A4).

Per-column statistics are computed for all columns in one aggregate, or by
unpivoting to (column, value) and one ``groupBy`` — never one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.distributed import present, top_k_per_group


def missing(df: DataFrame, c: str):
    """Whether a value is missing: NULL, or NaN in a floating-point column."""
    col = F.col(f"`{c}`")
    floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return col.isNull() | F.isnan(col) if floating else col.isNull()


def _long(df: DataFrame, cols: list[str], value: str = "value", cast: str = "string") -> DataFrame:
    """Unpivot ``cols`` to rows (column, value), each value cast to one type."""
    cast_df = df.select(*[F.col(f"`{c}`").cast(cast).alias(c) for c in cols])
    return cast_df.unpivot([], cols, "column", value)


def table_shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("int").alias("columns")
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Column, position, Spark type, non-null count (one aggregate; NaN counts as missing)."""
    counts = df.agg(*[F.count_if(~missing(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("position"),
                 F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f"c{i}").alias("non_null"))
        for i, f in enumerate(df.schema.fields)
    ])
    return counts.select(F.inline(rows))


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row over ``cols`` (NULLs compare equal).

    Grouping combines map-side, so only one row per distinct key is shuffled.
    """
    cols = cols or df.columns
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in cols]).count()
    return grouped.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL (and NaN) count of each column, one aggregate."""
    cols = cols or df.columns
    counts = df.agg(*[F.count_if(missing(df, c)).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(cols)])
    return counts.select(F.inline(rows))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """P5: count per value, NULLs left out, most frequent first (ties by value)."""
    c = F.col(f"`{col}`")
    return (
        df.where(c.isNotNull()).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def top_values(df: DataFrame, cols: list[str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of each column (ties by value), with their rank.

    Counts combine map-side; the ranking keeps k per partition first, so a
    column with millions of distinct values is not ordered in one task.
    """
    counts = (
        _long(df, cols).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    )
    return top_k_per_group(counts, ["column"], [F.desc("count"), F.asc("value")], n)


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of each column, NULL included (as a row with value NULL)."""
    return _long(df, cols).distinct()


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct non-NULL values per column.

    Exact counting goes through one unpivot + distinct (a shuffle of distinct
    pairs only); ``approx=True`` uses HyperLogLog++ sketches instead.
    """
    if approx:
        counts = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(f"c{i}") for i, c in enumerate(cols)])
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_distinct")) for i, c in enumerate(cols)])
        return counts.select(F.inline(rows))
    pairs = _long(df, cols).where(F.col("value").isNotNull()).distinct()
    return pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def top_k(df: DataFrame, by: str, n: int = 10, tie: str | None = None) -> DataFrame:
    """O1: the ``n`` rows with the highest ``by`` (ties by ``tie`` ascending).

    ``orderBy(...).limit(n)`` plans as a distributed top-k: each task keeps
    ``n`` rows, the driver merges at most ``n`` per task.
    """
    order = [F.desc_nulls_last(by)] + ([F.asc(tie)] if tie else [])
    return df.orderBy(*order).limit(n)


def head_rows(df: DataFrame, n: int, by: list[str]) -> DataFrame:
    """First ``n`` rows in the stated order (a top-k sort, not a full sort)."""
    return df.orderBy(*by).limit(n)


def skewness(df: DataFrame, cols: list[str]) -> DataFrame:
    """P10: sample-adjusted skewness (pandas ``skew``), NULL and NaN skipped, one aggregate.

    ``F.skewness`` is the population value g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    """
    aggs = []
    for i, c in enumerate(cols):
        col = present(F.col(f"`{c}`"))
        aggs += [F.skewness(col).alias(f"g{i}"), F.count(col).cast("double").alias(f"n{i}")]
    stats = df.agg(*aggs)

    def adjusted(i):
        n = F.col(f"n{i}")
        return F.when(n > 2, F.col(f"g{i}") * F.sqrt(n * (n - 1)) / (n - 2))

    rows = F.array(*[F.struct(F.lit(c).alias("column"), adjusted(i).alias("skewness")) for i, c in enumerate(cols)])
    return stats.select(F.inline(rows))


def columns_by_type(df: DataFrame, target: str | None = None) -> DataFrame:
    """Strings are categorical, every other column but the target numeric."""
    spark = df.sparkSession
    rows = [
        (f.name, "categorical" if isinstance(f.dataType, T.StringType) else "numeric")
        for f in df.schema.fields if f.name != target
    ]
    return spark.createDataFrame(rows, "column string, kind string")


def cross_tab(df: DataFrame, a: str, b: str, values: list) -> DataFrame:
    """A4: counts of ``a`` against the stated ``values`` of ``b`` as a wide table, NULL
    categories left out. Where the values are not known beforehand, the long form
    (``charts.stacked_counts``) has every cell."""
    ca, cb = F.col(f"`{a}`"), F.col(f"`{b}`")
    kept = df.where(ca.isNotNull() & cb.isNotNull())
    return kept.groupBy(ca.alias(a)).agg(
        *[F.count_if(cb == F.lit(v)).alias(str(v)) for v in values]
    )
