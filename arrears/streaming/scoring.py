"""Streaming form of the training step's predict-and-write (IO5).

The featurised training set is written as Parquet files partitioned by
invoice year; new files landing there are scored by a fitted
``PipelineModel`` (assembler + trees are row-wise, so they run inside the
streaming plan) and appended to a Parquet sink. The checkpoint under the
cluster's ``spark.checkpoint.dir`` makes the job restartable after executor
or driver loss with exactly-once file output.
"""

from __future__ import annotations

import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ml import spread_scoring
from ..operators.split import training_projection
from ..schema import TRAINING_SET_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sources.committed import current_folder

STREAM_SCHEMA = T.StructType(TRAINING_SET_SCHEMA.fields + [T.StructField("invoice_year", T.IntegerType())])


def scored_stream(spark: SparkSession, source_dir: str, model: PipelineModel, from_year: int | None = None,
                  max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of (features..., predicted_bucket) for files under ``source_dir``."""
    rows = (spark.readStream.schema(STREAM_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(current_folder(spark, source_dir)))
    if from_year is not None:
        rows = rows.filter(F.col("invoice_year") >= from_year)
    prepared = training_projection(rows.drop("invoice_year"))
    out = model.transform(spread_scoring(model, prepared)).withColumn("predicted_bucket", F.col("prediction").cast("int"))
    return out.drop("features", "scaled", "rawPrediction", "probability", "prediction")


def run_stream_predictions(spark: SparkSession, source_dir: str, model: PipelineModel, sink_dir: str,
                           checkpoint_dir: str | None = None, from_year: int | None = None) -> str:
    """Score every file available now, append to ``sink_dir``, then stop; returns the sink."""
    checkpoint_dir = checkpoint_dir or os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    query = (
        scored_stream(spark, source_dir, model, from_year).writeStream.format("parquet")
        .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sink_dir
