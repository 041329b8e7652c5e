from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.session import scratch_path

from tabkit.operators import features, models
from tabkit.plans import fixtures as fx
from tabkit.streaming.score import score_stream


def test_stream_scores_like_batch(spark, sf_dir):
    s = fx.survey(spark, sf_dir).drop("name")
    prep = features.PrepModel.fit(s, "label", fx.SURVEY_NUMERIC, fx.SURVEY_ONE_HOT, fx.SURVEY_ORDINAL)
    batch = prep.transform(s).withColumn("label", F.col("label").cast("double"))
    names = [c for c in batch.columns if c not in ("id", "label")]
    model = models.train_lr(features.assemble(batch, names), max_iter=10, reg=0.01)
    want = {r.id: int(r.prediction) for r in model.transform(features.assemble(batch, names)).collect()}

    base = scratch_path(spark, "stream")
    s.repartition(3).write.option("header", True).csv(f"{base}/in")
    q = score_stream(spark, f"{base}/in", s.schema, prep, model, f"{base}/out", f"{base}/ckpt")
    q.awaitTermination(300)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType())])
    got = {r.id: r.label for r in spark.read.schema(schema).option("header", True).csv(f"{base}/out").collect()}
    assert got == want
