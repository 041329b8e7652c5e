"""The study's raw table has column names with spaces, '/' and '?'. Every
operator quotes names, so the whole preparation and profiling path works on it."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.operators import charts, features, models, profile

# fixed values: column names of the survey table
NUMERIC = ["Age", "CGPA", "Work/Study Hours", "Academic Pressure"]
ONE_HOT = ["Gender", "Have you ever had suicidal thoughts ?"]
ORDINAL = ["City", "Sleep Duration"]


def _table(spark):
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("Name", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in NUMERIC]
        + [T.StructField(c, T.StringType()) for c in ONE_HOT + ORDINAL]
        + [T.StructField("Depression", T.IntegerType())]
    )
    rows = []
    for i in range(60):
        rows.append((
            i, f"n{i}", float(18 + i % 40) if i % 7 else None, 5.0 + (i % 5) / 2, float(i % 12), float(i % 5 + 1),
            ["Male", "Female"][i % 2] if i % 9 else None, ["Yes", "No"][i % 3 == 0],
            ["Pune", "Delhi", "Agra"][i % 3], ["5-6 hours", "7-8 hours", None][i % 3], int(i % 4 == 0 or i % 5 == 0),
        ))
    return spark.createDataFrame(rows, schema)


def test_prepare_and_train_with_awkward_names(spark):
    df = _table(spark)
    out, model = features.prepare(df, "Depression", NUMERIC, ONE_HOT, ORDINAL, ["id", "Name"])
    assert out.columns[0] == "Depression"
    assert "Have you ever had suicidal thoughts ?_Yes" in out.columns and "Gender_missing" in out.columns
    assert out.where(F.col("`Work/Study Hours`").isNull()).count() == 0
    names = [c for c in out.columns if c != "Depression"]
    data = features.assemble(out.withColumn("label", F.col("Depression").cast("double")), names)
    lr = models.train_lr(data, max_iter=10, reg=0.01)
    assert lr.transform(data).count() == 60


def test_profiles_with_awkward_names(spark):
    df = _table(spark)
    nulls = {r.column: r.nulls for r in profile.null_counts(df).collect()}
    assert nulls["Age"] == 9 and nulls["Sleep Duration"] == 20
    assert profile.skewness(df, NUMERIC).count() == 4
    assert charts.histogram(df, ["Work/Study Hours"], 20).count() > 0
    assert charts.stacked_counts(df, ONE_HOT, "Depression").count() > 0
    assert profile.cross_tab(df, "Have you ever had suicidal thoughts ?", "Depression", [0, 1]).count() == 2
