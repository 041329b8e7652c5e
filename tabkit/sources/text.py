"""Text-line scans and the line → labeled point parse (F1–F3), as column expressions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.scalar import UNREADABLE, number_or


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3: one row per text line, column ``value``."""
    return spark.read.text(path)


def parse_labeled_points(lines: DataFrame, col: str = "value", as_vector: bool = True) -> DataFrame:
    """split at commas (F1), read each field with the number grammar (F2, unreadable
    -> -1), first value = label, the rest = features.

    An empty line is one empty field: label -1 and no features.
    """
    values = F.transform(F.split(F.col(col), ",", -1), lambda x: number_or(x, UNREADABLE))
    parsed = lines.select(
        F.element_at(values, 1).alias("label"),
        F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))).alias("features"),
    )
    if as_vector:
        parsed = parsed.withColumn("features", array_to_vector("features"))
    return parsed


def binary_points(points: DataFrame) -> DataFrame:
    """Points whose label is 0 or 1: unreadable lines and headers have another."""
    return points.where(F.col("label").isin(0.0, 1.0))
