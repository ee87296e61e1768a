"""Detections as a stream: files that appear in a folder, brought to page coordinates as they come.

The step is stateless, so it needs no watermark; grouping needs a whole image and runs on what has
been written, image by image, with the batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import tiling
from ..sources.readers import stem_of


def detection_stream(spark: SparkSession, path: str, files_each: int = 100) -> DataFrame:
    """Valid detections of new JSON files on their page; bounded work in each micro-batch."""
    reader = spark.readStream.schema(schemas.DETECTIONS).option("multiLine", True).option("maxFilesPerTrigger", files_each)
    rows = reader.json(path)
    ok, _ = tiling.valid_detections(rows.withColumn("image", stem_of(F.col("source_image"))))
    return tiling.to_page(ok)


def write_stream(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there now to a table by image, and ends."""
    return rows.writeStream.partitionBy("image").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet")
