"""Chart data (C1–C6): the numbers behind histograms, count plots, violins,
stacked bars, class pies and metric-against-partitions plots. Drawing is left
to the caller; every table here is a small aggregate of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.distributed import MAX_DOUBLE, column_quantiles, maybe_broadcast
from tabkit.functions.scalar import percent_label


def _numeric_long(df: DataFrame, cols: list[str], keep: list[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (column, x), keeping finite values only: NULL,
    NaN and infinities have no place on a histogram axis or in a density.
    ``left_out`` counts what that leaves out."""
    cast_df = df.select(*[F.col(f"`{k}`") for k in keep], *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    long = cast_df.unpivot(list(keep), cols, "column", "x")
    return long.where(F.col("x").between(-MAX_DOUBLE, MAX_DOUBLE))


def left_out(df: DataFrame, cols: list[str]) -> DataFrame:
    """Values per column that chart data leaves out: missing (NULL, NaN) and infinite."""
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    counts = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count_if(x[c].isNull() | F.isnan(x[c])).alias(f"m{i}"), F.count_if(F.abs(x[c]) == float("inf")).alias(f"f{i}"))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"), F.col(f"f{i}").alias("infinite")) for i, c in enumerate(cols)])))


def histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max of each column, last bin closed.

    Two passes over the data, all columns at once: min/max, then counts per
    (column, bin). Every bin is returned, empty ones with count 0. A value belongs to the
    bin whose edges ``lo + i * step`` enclose it: the quotient only proposes a bin, and is
    corrected by the edges, as numpy does. A constant column uses the range value ± 0.5.
    """
    long = _numeric_long(df, cols)
    rng = long.groupBy("column").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    rng = rng.select(
        "column",
        F.when(F.col("mx") > F.col("mn"), F.col("mn")).otherwise(F.col("mn") - 0.5).alias("lo"),
        F.when(F.col("mx") > F.col("mn"), F.col("mx")).otherwise(F.col("mx") + 0.5).alias("hi"),
    ).withColumn("step", (F.col("hi") - F.col("lo")) / bins)

    def edge(i):
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * F.col("step"))

    # one row per column: a bounded side table
    joined = long.join(maybe_broadcast(rng, len(cols)), "column")
    near = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("step")), F.lit(bins - 1)).cast("int")
    joined = joined.withColumn("near", near)
    b = (F.when(F.col("x") < edge(F.col("near")), F.col("near") - 1)
         .when((F.col("x") >= edge(F.col("near") + 1)) & (F.col("near") < bins - 1), F.col("near") + 1)
         .otherwise(F.col("near")))
    counts = joined.groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts, ["column", "bin"], "left").select(
        "column", "bin", F.round(edge(F.col("bin")), 6).alias("left"), F.round(edge(F.col("bin") + 1), 6).alias("right"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count per category of each column (count plots), NULLs left out."""
    cast_df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = cast_df.unpivot([], cols, "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def stacked_counts(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """C4: per column, category × target counts (stacked bars) in long form, one pass; a
    pair that does not occur has count 0, as in a cross table."""
    cast_df = df.select(F.col(f"`{target}`").alias("target"), *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = cast_df.unpivot(["target"], cols, "column", "value")
    long = long.where(F.col("value").isNotNull() & F.col("target").isNotNull())
    counts = long.groupBy("column", "value", "target").agg(F.count(F.lit(1)).alias("count"))
    # the cells of a category: its own classes and, with 0, the other classes of the data
    classes = counts.groupBy("column").agg(F.collect_set("target").alias("all"))  # one row per column
    cells = counts.groupBy("column", "value").agg(F.map_from_entries(F.collect_list(F.struct("target", "count"))).alias("own"))
    return cells.join(classes, "column").select("column", "value", "own", F.explode("all").alias("target")).select(
        "column", "value", "target", F.coalesce(F.col("own")[F.col("target")], F.lit(0)).cast("bigint").alias("count"))


def class_shares(df: DataFrame, target: str, names: dict | None = None) -> DataFrame:
    """Count and share of each class in class order, with a ``51.3%`` label."""
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = F.sum("count").over(Window.partitionBy())  # one row per class
    out = counts.withColumn("share", F.col("count") / total)
    out = out.withColumn("label", percent_label(F.col("share") * 100))
    if names:
        mapping = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        out = out.withColumn("name", mapping[F.col("class")])
    return out.withColumn("share", F.round("share", 6)).orderBy("class")


def violin_quartiles(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Per class and column, the exact quartiles (inner box of a violin)."""
    finite = [F.when(F.col(f"`{c}`").cast("double").between(-MAX_DOUBLE, MAX_DOUBLE), F.col(f"`{c}`").cast("double")).alias(c) for c in cols]
    q = column_quantiles(df.select(F.col(f"`{target}`").alias("class"), *finite), cols, [0.25, 0.5, 0.75], ["class"])
    wide = q.where(F.col("value").isNotNull()).groupBy("class", "column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    return wide.select("class", "column", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")])


def violin_density(
    df: DataFrame, target: str, cols: list[str], grid: int = 100, cut: float = 2.0
) -> DataFrame:
    """Gaussian kernel density per class and column on ``grid`` points.

    Scott's rule: bandwidth = sample std * n^(-1/5); the grid spans
    [min - cut*bw, max + cut*bw]. One aggregate finds the parameters, a second sums the
    kernel at every grid point in ``grid`` sums per (class, column), combined map-side: no
    row is made per value and grid point.
    """
    long = _numeric_long(df, cols, keep=[target]).withColumnRenamed(target, "class")
    long = long.where(F.col("class").isNotNull())
    params = long.groupBy("class", "column").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("mn"), F.max("x").alias("mx"),
    )
    params = params.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    params = params.where(F.col("bw") > 0).select(
        "class", "column", "n", "bw",
        (F.col("mn") - cut * F.col("bw")).alias("g0"),
        ((F.col("mx") - F.col("mn") + 2 * cut * F.col("bw")) / (grid - 1)).alias("step"),
    )
    joined = long.join(params, ["class", "column"])  # one row per (class, column)

    def kernel(i):
        z = (F.col("g0") + F.col("step") * i - F.col("x")) / F.col("bw")
        return F.exp(-0.5 * z * z)

    sums = joined.groupBy("class", "column", "n", "bw", "g0", "step").agg(
        *[F.sum(kernel(i)).alias(f"k{i}") for i in range(grid)])
    points = sums.select("class", "column", "n", "bw", "g0", "step",
                         F.posexplode(F.array(*[F.col(f"k{i}") for i in range(grid)])).alias("i", "ksum"))
    norm = F.col("n") * F.col("bw") * F.sqrt(F.lit(2 * 3.141592653589793))
    return points.select(
        "class", "column", F.col("i").cast("int").alias("point"),
        F.round(F.col("g0") + F.col("step") * F.col("i"), 6).alias("x"),
        F.round(F.col("ksum") / norm, 6).alias("density"),
    )


def metric_series(results: DataFrame, metrics: list[str], lower_better: tuple = ("training_time",),
                  group: str = "model", x: str = "partitions") -> DataFrame:
    """Results in long form (model, partitions, metric, value) with best/worst flags.

    Best = highest value (lowest for ``lower_better`` metrics), the first
    partition count among equals; worst likewise the other way.
    """
    long = results.select(group, x, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [group, x], metrics, "metric", "value"
    )
    low = F.col("metric").isin(list(lower_better))
    key = F.when(low, F.col("value")).otherwise(-F.col("value"))
    w_best = Window.partitionBy(group, "metric").orderBy(key.asc(), F.col(x).asc())
    w_worst = Window.partitionBy(group, "metric").orderBy(key.desc(), F.col(x).asc())
    return long.select(
        group, x, "metric", F.round("value", 6).alias("value"),
        (F.row_number().over(w_best) == 1).alias("is_best"),
        (F.row_number().over(w_worst) == 1).alias("is_worst"),
    )
