"""Overlapping tiles of images, and detections' way from a tile to the page."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Tiling
from ..functions import geometry as G


def large_enough(width: Column, height: Column, t: Tiling) -> Column:
    return (width > 0) & (height > 0) & (width >= t.tile_size) & (height >= t.tile_size)


def split_by_size(images: DataFrame, t: Tiling) -> tuple[DataFrame, DataFrame]:
    """Images that can be tiled, and rejects with a reason."""
    ok = F.coalesce(large_enough(F.col("width"), F.col("height"), t), F.lit(False))
    reason = F.when(F.col("width").isNull() | F.col("height").isNull() | (F.col("width") <= 0) | (F.col("height") <= 0), "empty").otherwise("smaller than a tile")
    return images.where(ok), images.where(~ok).withColumn("error", reason)


def starts(length: Column, t: Tiling) -> Column:
    """Tile starts along an axis: every step, the last one shifted back so that it ends at the border."""
    last = length - t.tile_size
    return F.transform(F.sequence(F.lit(0).cast("long"), F.ceil(F.greatest(last, F.lit(0)) / t.step)), lambda k: F.least(k * t.step, F.greatest(last, F.lit(0))))


def tile_grid(images: DataFrame, t: Tiling) -> DataFrame:
    """image, tile_idx, tile_id, x1, y1, x2, y2, grid_row, grid_col; rows of tiles from top to bottom.
    A shifted last tile can share its grid position with its neighbour; tile_id is the key."""
    cut = images.select("image", "width", "height", F.posexplode(starts(F.col("height"), t)).alias("row_no", "y1"))
    cut = cut.select("*", F.posexplode(starts(F.col("width"), t)).alias("col_no", "x1"))
    per_row = F.ceil(F.greatest(F.col("width") - t.tile_size, F.lit(0)) / t.step) + 1
    cut = cut.withColumn("tile_idx", F.col("row_no") * per_row + F.col("col_no"))
    return cut.select(
        "image", "tile_idx", tile_id(F.col("image"), F.col("tile_idx")).alias("tile_id"), "x1", "y1",
        F.least(F.col("x1") + t.tile_size, "width").alias("x2"), F.least(F.col("y1") + t.tile_size, "height").alias("y2"),
        F.floor(F.col("y1") / t.step).alias("grid_row"), F.floor(F.col("x1") / t.step).alias("grid_col"),
    )


TILE_PIXELS = "image string, source_image string, tile_idx long, tile_id string, x1 long, y1 long, x2 long, y2 long, grid_row long, grid_col long, pixels binary, height_px int, width_px int, channels int"
_TILE_PIXELS = pa.schema([("image", pa.string()), ("source_image", pa.string()), *((c, pa.int64()) for c in ("tile_idx",)), ("tile_id", pa.string()), *((c, pa.int64()) for c in ("x1", "y1", "x2", "y2", "grid_row", "grid_col")), ("pixels", pa.binary()), *((c, pa.int32()) for c in ("height_px", "width_px", "channels"))])


def cut_tiles(images: DataFrame, t: Tiling) -> DataFrame:
    """The tiles of tile_grid with their pixels, from images with image_data. An image's pixels never move:
    its tiles are cut one by one where it was read."""
    given = images.select(F.col("image").cast("string"), "source_image", starts(F.col("height"), t).alias("tops"), starts(F.col("width"), t).alias("lefts"), F.col("width").cast("long"), F.col("height").cast("long"), F.col("image_data.data").alias("data"), F.col("image_data.nChannels").alias("channels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            for k in range(b.num_rows):
                r = {c: b.column(j)[k] for j, c in enumerate(b.schema.names)}
                name, source, tops, lefts, width, height, channels = (r[c].as_py() for c in ("image", "source_image", "tops", "lefts", "width", "height", "channels"))
                page = np.frombuffer(r["data"].as_buffer(), np.uint8).reshape(height, width, channels)
                for row, y1 in enumerate(tops):
                    for col, x1 in enumerate(lefts):
                        part = page[y1 : min(y1 + t.tile_size, height), x1 : min(x1 + t.tile_size, width)]
                        idx = row * len(lefts) + col
                        yield pa.RecordBatch.from_pylist([{"image": name, "source_image": source, "tile_idx": idx, "tile_id": f"{name}_T{idx:04d}", "x1": x1, "y1": y1, "x2": x1 + part.shape[1], "y2": y1 + part.shape[0], "grid_row": y1 // t.step, "grid_col": x1 // t.step, "pixels": part.tobytes(), "height_px": part.shape[0], "width_px": part.shape[1], "channels": channels}], _TILE_PIXELS)

    return given.mapInArrow(run, TILE_PIXELS)


def tile_id(stem: Column, idx: Column) -> Column:
    return F.format_string("%s_T%04d", stem, idx)


def tile_number(tile: Column) -> Column:
    """The number after the last _T; 0 without one."""
    last = F.element_at(F.split(tile, "_T"), -1)
    return F.when(tile.contains("_T"), F.coalesce(last.try_cast("int"), F.lit(0))).otherwise(0)


def with_tiles(detections: DataFrame, tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detections with their tile's columns, and those of which no tile is known. A tile that is
    listed more than once counts once, by its lowest index."""
    order = Window.partitionBy("image", "tile_id").orderBy("tile_idx")
    once = tiles.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return detections.join(once, ["image", "tile_id"]), detections.join(once, ["image", "tile_id"], "left_anti")


def valid_detections(detections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detections with a box and tile coordinates, and the others."""
    ok = F.col("bbox").isNotNull() & F.col("tile_coordinates").isNotNull()
    return detections.where(ok), detections.where(~ok)


def to_page(detections: DataFrame) -> DataFrame:
    """Adds x0, y0, x1, y1 on the page to detections with a quad in their tile."""
    quad = G.moved(F.col("bbox"), F.col("tile_coordinates"))
    x0, y0, x1, y1 = G.envelope(F.col("_quad"))
    return detections.withColumn("_quad", quad).withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y1, "tile_id": F.coalesce("tile_id", F.lit("UNKNOWN")), "tile_number": tile_number(F.coalesce("tile_id", F.lit("")))}).withColumn("bbox", F.col("_quad")).drop("_quad")


def grouped_output(regions: DataFrame, *more: str) -> DataFrame:
    """Regions as they are stored, with more columns on demand; page sizes that aren't a pair drop the row."""
    quad = G.corners(G.Box.of())
    pair = regions.where(F.size("original_image_size") == 2)
    normal = G.normalised(quad, F.col("original_image_size")[0], F.col("original_image_size")[1])
    return pair.select("image", quad.alias("bbox"), normal.alias("bbox_normalized"), "rotation_angle", "source_image", "detection_type", "original_image_size", F.col("tile_ids").alias("grouped_from_tiles"), (F.size("tile_ids") > 1).alias("is_grouped"), *more)
