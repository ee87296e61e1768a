"""Recognised text: the two recognisers' results, the cascade between them, annotations.

Models plug in as makers (see models), made once for each worker. Both run in one pass, so neither sees a
crop twice: the second one sees only the crops that the first leaves unsure, upright ones (orientation 90)
turned clockwise.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Recognition
from ..models import Plugin, loaded, plugin, with_array
from .crops import turned

log = logging.getLogger(__name__)

RESULT = "struct<text: string, confidence: double, n: int>"


def mean_confidence(steps: Column) -> Column:
    """The mean over a result's steps; 0 without any."""
    return F.when(F.size(steps) > 0, F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / F.size(steps)).otherwise(F.lit(0.0))


def joined(pieces: Column) -> Column:
    """One result from text pieces (text, confidence): joined by blanks and trimmed, with the mean confidence."""
    text = F.trim(F.array_join(F.transform(pieces, lambda p: p["text"]), " "))
    return F.struct(text.alias("text"), mean_confidence(F.transform(pieces, lambda p: p["confidence"])).alias("confidence"), F.greatest(F.size(pieces), F.lit(0)).alias("n"))


def settled(first: Column, r: Recognition) -> Column:
    return F.coalesce(first["confidence"] >= r.confidence_threshold, F.lit(False))


def cascade(first: Column, second: Column, r: Recognition) -> Column:
    """The first result if it is sure, else the second if it has text, else the first however weak."""
    a = F.struct(first["text"].alias("text"), first["confidence"].alias("confidence"), F.lit(None).cast("int").alias("n"), F.lit("TrOCR").alias("method"))
    b = F.struct(second["text"].alias("text"), second["confidence"].alias("confidence"), second["n"].cast("int").alias("n"), F.lit("EasyOCR").alias("method"))
    return F.when(settled(first, r), a).when(F.coalesce(second["text"] != "", F.lit(False)), b).when(first.isNotNull(), a)


def recognise(crops: DataFrame, first: Plugin | Callable, second: Plugin | Callable, r: Recognition) -> DataFrame:
    """Adds result to crops. first and second: plug-ins or makers of functions list of rows -> list of (text,
    confidence, n) or None; rows have pixels where crops do. A crop that a model fails on has no result from it."""
    plugins = plugin(first), plugin(second)
    keys = [p.key for p in plugins]
    pixels = {"pixels", "height_px", "width_px", "channels"} <= set(crops.columns)

    def results(model: Callable, rows: list[dict]) -> list[dict | None]:
        try:
            found = list(model(rows))
        except Exception:  # whatever a model raises: then each alone
            found = []
            for row in rows:
                try:
                    found += model([row])
                except Exception as e:
                    log.warning("%s: %s", row.get("crop_filename"), e)
                    found.append(None)
        return [None if x is None else dict(zip(("text", "confidence", "n"), x, strict=True)) for x in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("text", pa.string()), ("confidence", pa.float64()), ("n", pa.int32())])
        models = [loaded(k, p) for k, p in zip(keys, plugins, strict=True)]
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                rows = [with_array(x) if pixels else x for x in b.to_pylist()]
                one = results(models[0], rows)
                unsure = [k for k, x in enumerate(one) if x is None or x["confidence"] is None or x["confidence"] < r.confidence_threshold]
                asked = [rows[k] | {"pixels": turned(rows[k]["pixels"])} if pixels and rows[k].get("orientation") == 90 else rows[k] for k in unsure]
                two: list[dict | None] = [None] * len(rows)
                for k, x in zip(unsure, results(models[1], asked) if asked else (), strict=True):
                    two[k] = x
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(one, kind), pa.array(two, kind)], [*b.schema.names, "first", "second"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in crops.schema.fields)
    both = crops.mapInArrow(run, f"{schema}, first {RESULT}, second {RESULT}")
    return both.withColumn("result", cascade(F.col("first"), F.col("second"), r)).drop("first", "second")


def with_crop(manifest: DataFrame, crops: DataFrame) -> DataFrame:
    """Rows of the manifest whose crop is there."""
    return manifest.join(crops.select("image", "crop_filename").distinct(), ["image", "crop_filename"], "left_semi")


def annotations(recognised: DataFrame) -> DataFrame:
    """Rows with text, in the form they are stored; orientation is carried on."""
    out = recognised.where(F.coalesce(F.col("result.text") != "", F.lit(False)))
    return out.select("image", F.col("result.text").alias("text"), F.col("result.confidence").alias("confidence"), "original_bbox", "crop_filename", "orientation", F.col("result.method").alias("ocr_method"), F.col("result.n").alias("easyocr_detections"), "original_image_size")


def image_totals(images: DataFrame, rows: DataFrame) -> DataFrame:
    """Of all images, with or without texts: images, images with text, texts by recogniser."""
    by = rows.groupBy("image").agg(F.count(F.lit(1)).alias("texts"), F.count_if(F.col("ocr_method") == "TrOCR").alias("first"), F.count_if(F.col("ocr_method") == "EasyOCR").alias("second"))
    both = images.select("image").distinct().join(by, "image", "left").na.fill(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return both.agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col("texts") > 0).alias("with_text"), total("texts").alias("texts"), total("first").alias("by_first"), total("second").alias("by_second"))


def method_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ocr_method").agg(F.count(F.lit(1)).alias("texts"), F.count_distinct("image").alias("images"))
