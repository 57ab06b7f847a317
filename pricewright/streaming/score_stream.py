"""Scoring new item files as they arrive (row 102 on a file stream).

The reference scores a new CSV with the stored model.  The same operator over
a folder that keeps receiving CSV files is a Structured Streaming query: file
source with a declared schema → stored ``PipelineModel`` → price floor → CSV
sink, with its progress in a checkpoint folder on shared storage so a restarted
query resumes without rescoring or losing files.  The reference has no other
streaming behaviour (no windows, watermarks or state), so none is built.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import price_floor
from ..session import scratch_path


def start_scoring(spark: SparkSession, model_path: str, in_dir: str, out_dir: str, schema: T.StructType | str,
                  checkpoint: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops
    (batch-like runs), otherwise it keeps polling for new files."""
    model = PipelineModel.load(model_path)
    reader = (spark.readStream.schema(schema).option("header", "true").option("multiLine", "true")
              .option("quote", '"').option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    items = reader.csv(in_dir)
    scored = model.transform(items).select(F.col("sample_id").cast("string").alias("sample_id"),
                                           price_floor("prediction").alias("price"))
    writer = (scored.writeStream.format("csv").option("header", "true").option("path", out_dir)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "score-stream-ckpt"))
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
