"""Scoring files as they arrive: the prediction-file sink (S6) as a Structured
Streaming query.

The fitted preparation is a set of column expressions (and stream-static
dictionary joins), so the same ``PrepModel`` and MLlib model that score a
batch table score each micro-batch. Progress and output commits live in the
checkpoint location, so a restarted query resumes without duplicating output.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.operators.features import PrepModel, assemble
from tabkit.session import scratch_path


def score_stream(
    spark: SparkSession, source_dir: str, schema: T.StructType, prep: PrepModel, model,
    sink_dir: str, checkpoint: str | None = None, id_col: str = "id", target: str = "label",
    source_format: str = "csv", available_now: bool = True, max_files_per_trigger: int | None = None,
):
    """Start a query that reads new files under ``source_dir``, prepares and
    scores them, and appends ``(id, target)`` CSV files with header to ``sink_dir``.

    Returns the ``StreamingQuery``; ``available_now`` processes what is there and stops.
    """
    reader = spark.readStream.schema(schema).format(source_format)
    if source_format == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source_dir)
    prepared = prep.transform(rows)
    names = [c for c in prepared.columns if c not in (id_col, prep.target)]
    scored = model.transform(assemble(prepared, names))
    out = scored.select(F.col(id_col), F.col("prediction").cast("int").alias(target))
    writer = (
        out.writeStream.format("csv").option("header", True).option("path", sink_dir)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "score-stream-ckpt"))
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
