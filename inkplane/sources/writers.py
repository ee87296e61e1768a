"""Writing what stages exchange: Parquet tables by image, and JSON or image files where others read them.

Files are written by the executors, one folder or file for each image, to any path Spark can write.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G


def write_table(df: DataFrame, path: str) -> None:
    """Rows by image; only the partitions that df has are replaced, so a rerun leaves no stale rows of them."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("image").parquet(path)


def tile_files(tiles: DataFrame, images: DataFrame, tile_size: int, overlap: float) -> DataFrame:
    """One object for each image: the header, then its tiles in order."""
    i = lambda *cs: F.array(*(F.col(c).cast("int") for c in cs))
    tile = F.struct("tile_idx", "tile_id", i("x1", "y1", "x2", "y2").alias("coordinates"), i("grid_row", "grid_col").alias("grid_position"), F.array((F.col("x2") - F.col("x1")).cast("int"), (F.col("y2") - F.col("y1")).cast("int")).alias("tile_size"))
    nested = tiles.groupBy("image").agg(F.array_sort(F.collect_list(tile)).alias("t"))
    nested = nested.join(images.select("image", "source_image", "width", "height"), "image")
    return nested.select("image", "source_image", i("width", "height").alias("original_size"), F.lit(tile_size).alias("tile_size"), F.lit(overlap).alias("overlap_ratio"), F.size("t").alias("num_tiles"), F.transform("t", lambda x: F.struct(*(x[c].alias(c) for c in ("tile_id", "coordinates", "grid_position", "tile_size")))).alias("tiles"))


def image_tiles(tiles: DataFrame, images: DataFrame, overlap: float) -> DataFrame:
    """The second tile artifact, one object for each image: every tile with its image's name and size."""
    i = lambda *cs: F.array(*(F.col(c).cast("int") for c in cs))
    both = tiles.join(images.select("image", F.col("source_image").alias("_source"), F.col("width").alias("_width"), F.col("height").alias("_height")), "image")
    tile = F.struct("tile_idx", "tile_id", F.col("_source").alias("source_image"), i("x1", "y1", "x2", "y2").alias("coordinates"), F.array((F.col("x2") - F.col("x1")).cast("int"), (F.col("y2") - F.col("y1")).cast("int")).alias("tile_size"), i("grid_row", "grid_col").alias("grid_position"), F.lit(overlap).alias("overlap"), i("_width", "_height").alias("original_image_size"))
    nested = both.groupBy("image", F.col("_source").alias("source_image")).agg(F.array_sort(F.collect_list(tile)).alias("t"))
    return nested.select("image", "source_image", F.transform("t", lambda x: x.dropFields("tile_idx")).alias("tiles"))


def objects(rows: DataFrame) -> DataFrame:
    """image and json, one object for each image, from rows of one each."""
    return rows.select("image", F.to_json(F.struct(*(c for c in rows.columns if c != "image"))).alias("json"))


def image_files(rows: DataFrame, images: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """image and json, an array of its rows' objects, by a column that isn't written itself or by what they say;
    images without rows get an empty array if they are given."""
    columns = [c for c in rows.columns if c not in ("image", order)]
    one = F.to_json(F.struct(*columns))
    if order:
        by = rows.groupBy("image").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), one.alias("j")))), lambda x: x["j"]).alias("objects"))
    else:
        by = rows.groupBy("image").agg(F.array_sort(F.collect_list(one)).alias("objects"))
    if images is not None:
        by = images.select("image").distinct().join(by, "image", "left")
    return by.select("image", F.concat(F.lit("["), F.array_join(F.coalesce("objects", F.array().cast("array<string>")), ","), F.lit("]")).alias("json"))


def write_json(files: DataFrame, path: str, column: str = "json") -> None:
    """The json of each image as a text file in its own folder below path."""
    files.select("image", F.col(column).alias("value")).write.mode("overwrite").partitionBy("image").text(path)


def export(files: DataFrame, folder: str) -> DataFrame:
    """Writes files (path below folder, content binary or string) from the executors, to any file system that
    Arrow opens; gives path and bytes of each. A file is written whole under another name, then moved, so a
    task that runs twice leaves one whole file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for b in batches:
            sizes = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data, at = content.as_py(), f"{root}/{path}"
                data = data.encode() if isinstance(data, str) else data or b""
                system.create_dir(at.rpartition("/")[0], recursive=True)
                with system.open_output_stream(part := f"{at}.{uuid.uuid4().hex}") as out:
                    out.write(data)
                system.move(part, at)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return files.select("path", "content").mapInArrow(run, "path string, bytes long")


def png(pixels: bytes, height: int, width: int, channels: int) -> bytes:
    """A PNG file of rows of grey or blue-green-red samples."""
    import numpy as np

    rows = np.frombuffer(pixels, np.uint8).reshape(height, width, channels)
    if channels >= 3:
        rows = rows[:, :, [2, 1, 0, *range(3, channels)]]
    raw = np.concatenate([np.zeros((height, 1), np.uint8), rows.reshape(height, -1)], axis=1).tobytes()
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    kind = {1: 0, 3: 2, 4: 6}[channels]
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def with_png(crops: DataFrame) -> DataFrame:
    """Adds png, the file of a crop's, tile's or page's pixels."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in crops.schema.fields) + ", png binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            files = [None if r["pixels"] is None else png(r["pixels"], r["height_px"], r["width_px"], r["channels"]) for r in b.select(["pixels", "height_px", "width_px", "channels"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(files, pa.binary())], [*b.schema.names, "png"])

    return crops.mapInArrow(run, schema)


def run_record(images: DataFrame, config, seconds: float, version: str = "1.0") -> DataFrame:
    """One row for each image about the run: its time, the pipeline's version and a digest of the parameters."""
    digest = hashlib.md5(json.dumps(dataclasses.asdict(config), sort_keys=True).encode()).hexdigest()
    return images.select("source_image", F.lit(f"{seconds:.3f}").alias("processing_time"), F.lit(version).alias("pipeline_version"), F.lit(digest).alias("config_hash"))


def in_points(annotations: DataFrame, dpi: int) -> DataFrame:
    """The second perspective of annotations: boxes in PDF points."""
    from ..operators.coordinates import to_points

    return annotations.withColumn("bbox", to_points(F.col("bbox"), dpi))


def region_quads(regions: DataFrame) -> DataFrame:
    return regions.withColumn("bbox", G.corners(G.Box.of()))
