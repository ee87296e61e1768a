"""Crops: padded windows, names, the manifest, and pixels."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Cropping
from ..functions import geometry as G


def crop_windows(regions: DataFrame, c: Cropping) -> DataFrame:
    """Adds left, top, right, bottom and crop_filename; windows without area go, after numbering.
    regions: crop_idx, the box, and the page's width and height."""
    out = regions.withColumns({
        "left": F.greatest(F.lit(0), F.col("x0") - c.padding), "top": F.greatest(F.lit(0), F.col("y0") - c.padding),
        "right": F.least(F.col("width"), F.col("x1") + c.padding), "bottom": F.least(F.col("height"), F.col("y1") + c.padding),
        "crop_filename": F.format_string("crop_%04d.png", "crop_idx"),
    })
    return out.where("right > left and bottom > top")


def manifest(windows: DataFrame) -> DataFrame:
    """The manifest's fields; what regions don't carry gets its default."""
    have = set(windows.columns)
    take = lambda name, kind, default: F.coalesce(F.col(name), default).cast(kind) if name in have else default.cast(kind)
    null = F.lit(None)
    return windows.select("image", "crop_filename", G.corners(G.Box.of()).alias("original_bbox"), take("text", "string", F.lit("unknown")).alias("original_text"), take("confidence", "double", null).alias("original_confidence"), take("rotation_angle", "int", F.lit(0)).alias("orientation"), F.array("width", "height").alias("original_image_size"))


def stem(name: Column) -> Column:
    """A grouped file's image stem: the longer suffix goes first, wherever it stands."""
    return F.replace(F.replace(name, F.lit("_grouped_text"), F.lit("")), F.lit("_grouped"), F.lit(""))


def first_file(names: DataFrame, files: DataFrame, extensions: list[str]) -> DataFrame:
    """The file of each name by the order of extensions, then by path; names without a file go."""
    rank = F.array_position(F.array(*map(F.lit, extensions)), F.lower("extension"))
    listed = files.withColumn("_rank", rank).where("_rank > 0")
    return names.join(listed, "stem").groupBy("stem").agg(F.min_by("path", F.struct("_rank", "path")).alias("path"))


def crop_pixels(windows: DataFrame) -> DataFrame:
    """Adds pixels, height_px and width_px: the window's bytes from the image data source's struct
    (rows from the top, nChannels bytes a pixel). One row in, one row out."""
    kept = [f for f in windows.schema.fields if f.name != "image_data"]
    one = F.array(F.struct(*(f.name for f in kept)))
    return _cut(windows.select(one.alias("windows"), "image_data"), kept)


def cut_crops(windows: DataFrame, images: DataFrame) -> DataFrame:
    """The same for the windows of images (image, image_data): an image's pixels are read once, for all its windows."""
    kept = windows.schema.fields
    by = windows.groupBy("image").agg(F.collect_list(F.struct(*windows.columns)).alias("windows"))
    return _cut(images.select("image", "image_data").join(by, "image").select("windows", "image_data"), kept)


def _cut(listed: DataFrame, kept: list) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            kinds = pa.schema([*b.schema.field(0).type.value_type, ("pixels", pa.binary()), ("height_px", pa.int32()), ("width_px", pa.int32()), ("channels", pa.int32())])
            for k in range(b.num_rows):
                im = b.column(1)[k]
                page = np.frombuffer(im["data"].as_buffer(), np.uint8).reshape(*(im[c].as_py() for c in ("height", "width", "nChannels")))
                rows = b.column(0)[k].as_py()
                for at in range(0, len(rows), 64):
                    some = rows[at : at + 64]
                    for r in some:
                        part = page[r["top"] : r["bottom"], r["left"] : r["right"]]
                        r |= {"pixels": part.tobytes(), "height_px": part.shape[0], "width_px": part.shape[1], "channels": part.shape[2]}
                    yield pa.RecordBatch.from_pylist(some, schema=kinds)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", pixels binary, height_px int, width_px int, channels int"
    return listed.mapInArrow(run, schema)


def turned(pixels):
    """An array of pixels turned clockwise by 90 degrees."""
    import numpy as np

    return None if pixels is None else np.rot90(pixels, k=-1)


def rotate_clockwise(crops: DataFrame) -> DataFrame:
    """Crops turned by 90 degrees, height and width changed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                page = turned(np.frombuffer(r["pixels"], np.uint8).reshape(r["height_px"], r["width_px"], r["channels"]))
                r |= {"pixels": page.tobytes(), "height_px": page.shape[0], "width_px": page.shape[1]}
            yield pa.RecordBatch.from_pylist(rows, schema=b.schema)

    return crops.mapInArrow(run, crops.schema)
