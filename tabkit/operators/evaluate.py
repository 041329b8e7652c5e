"""Evaluation (E1–E5), mismatch filter (J4) and fold means (A2).

All metrics are aggregates on the executors: the scored rows never leave
Spark, only a handful of metric rows do. Counts per (label, prediction) or per
distinct score come first, so the later steps run over tiny tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.distributed import running_totals
from tabkit.session import ensure_checkpoint_dir


def mismatches(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows whose prediction differs from the label."""
    return df.where(F.col(label) != F.col(prediction))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows, mismatches and accuracy = 1 - mismatches / rows."""
    wrong = F.count_if(F.col(label) != F.col(prediction))
    return df.agg(F.count(F.lit(1)).alias("n"), wrong.alias("mismatches")).select(
        "n", "mismatches", (1 - F.col("mismatches") / F.nullif(F.col("n"), F.lit(0))).alias("accuracy")
    )


def class_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: support (true count), predicted count and true positives.

    One pass builds the confusion counts; each confusion cell then speaks for
    its true class and its predicted class, and one grouping gives the per-class
    table (no join).
    """
    conf = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    ty, tp_ = df.schema[label].dataType, df.schema[prediction].dataType
    ctype = ty if ty == tp_ else T.DoubleType()  # one class type for both sides
    hit = F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("y").cast(ctype).alias("class"), F.col("c").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("tp")),
        F.struct(F.col("p").cast(ctype).alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("c").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    )
    cells = conf.select(F.inline(sides))
    return cells.groupBy("class").agg(
        F.sum("support").cast("bigint").alias("support"), F.sum("predicted").cast("bigint").alias("predicted"),
        F.sum("tp").cast("bigint").alias("tp"),
    )


def _per_class(counts: DataFrame) -> DataFrame:
    prec = F.coalesce(F.col("tp") / F.nullif(F.col("predicted"), F.lit(0)), F.lit(0.0))
    rec = F.coalesce(F.col("tp") / F.nullif(F.col("support"), F.lit(0)), F.lit(0.0))
    out = counts.select("class", "support", "predicted", "tp", prec.alias("precision"), rec.alias("recall"))
    f1 = F.coalesce(
        2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)),
        F.lit(0.0),
    )
    return out.withColumn("f1", f1)


def weighted_precision_recall(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Support-weighted precision and recall; undefined precision counts as 0."""
    pc = _per_class(class_counts(df, label, prediction))
    n = F.sum("support")
    return pc.agg(
        (F.sum(F.col("precision") * F.col("support")) / n).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("weighted_recall"),
    )


def summary(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E1 and E2 from one pass: accuracy, support-weighted precision and recall."""
    pc = _per_class(class_counts(df, label, prediction))
    n = F.nullif(F.sum("support"), F.lit(0))
    return pc.agg((F.sum("tp") / n).alias("accuracy"),
                  (F.sum(F.col("precision") * F.col("support")) / n).alias("weighted_precision"),
                  (F.sum(F.col("recall") * F.col("support")) / n).alias("weighted_recall"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E5: precision, recall, F1 and support per class, then the accuracy row and
    the macro and weighted means (scikit-learn's report as rows)."""
    ensure_checkpoint_dir(df.sparkSession)
    # a row per class, read by the four parts below
    pc = _per_class(class_counts(df, label, prediction)).where(F.col("support") > 0).checkpoint(eager=True)
    per = pc.select(
        F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support"
    )
    total = F.sum("support")
    acc = pc.agg(
        F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), (F.sum("tp") / total).alias("f1"),
        total.cast("bigint").alias("support"),
    )
    macro = pc.agg(
        F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.cast("bigint").alias("support"),
    )
    weighted = pc.agg(
        F.lit("weighted avg").alias("class"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"),
        total.cast("bigint").alias("support"),
    )
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def auc(df: DataFrame, score: str = "prediction", label: str = "label", group: list[str] | tuple = ()) -> DataFrame:
    """Areas under the ROC and precision-recall curves, per ``group`` where given.

    Rows are grouped by distinct score; running class totals in falling score
    order come from ``running_totals`` (range-partitioned). The previous curve point is the
    running total minus the row's own counts, so no ordered ``lag`` window is needed; the
    areas are plain sums (trapezoids), as in Spark's ``BinaryClassificationMetrics``.
    """
    y = F.col(label).cast("double")
    g = df.groupBy(*group, F.col(score).cast("double").alias("sc")).agg(
        F.sum(y).alias("p"), F.sum(1 - y).alias("n")
    )
    c = running_totals(g, "sc", ["p", "n"], descending=True, group_cols=group)
    tp, fp = F.col("cum_p"), F.col("cum_n")
    ptp, pfp = tp - F.col("p"), fp - F.col("n")
    # a class absent from the data leaves its curve undefined (NULL), not an error
    tot_p, tot_n = F.nullif(F.col("tot_p"), F.lit(0.0)), F.nullif(F.col("tot_n"), F.lit(0.0))
    tpr, fpr = tp / tot_p, fp / tot_n
    ptpr, pfpr = ptp / tot_p, pfp / tot_n
    pr = tp / F.nullif(tp + fp, F.lit(0.0))
    ppr = F.coalesce(ptp / F.nullif(ptp + pfp, F.lit(0.0)), pr)
    return c.groupBy(*group).agg(
        F.sum((fpr - pfpr) * (tpr + ptpr) / 2).alias("auroc"),
        F.sum((tpr - ptpr) * (pr + ppr) / 2).alias("aupr"),
    )


def fold_mean(df: DataFrame, group: list[str], value: str, out: str = "mean") -> DataFrame:
    """A2: mean of a measure over folds, per setting."""
    return df.groupBy(*group).agg(F.avg(value).alias(out))
