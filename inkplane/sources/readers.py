"""Reading what stages exchange: JSON artifacts, images, PDFs' names and sizes, folders."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

#: Rasterising presets (dots per inch, format, threads).
PRESETS = {
    "draft": (200, "JPEG", 4),
    "standard": (300, "PNG", 2),
    "high_quality": (600, "PNG", 1),
    "ultra_high": (1200, "PNG", 1),
    "print_ready": (600, "TIFF", 1),
}
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "tiff", "tif"]


def read_json(spark: SparkSession, path: str | list[str], schema: str, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON files (an array or one object each) with file_path, and the files that can't be read."""
    reader = spark.read.schema(f"{schema}, {schemas.CORRUPT} string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", schemas.CORRUPT)
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    rows = reader.json(path).withColumn("file_path", F.col("_metadata.file_path"))
    # Spark refuses to read the corrupt column alone, so the condition looks at the others too
    whole = F.to_json(F.struct(*(c for c in rows.columns if c not in (schemas.CORRUPT, "file_path"))))
    broken = F.col(schemas.CORRUPT).isNotNull() & whole.isNotNull()
    return rows.where(~broken).drop(schemas.CORRUPT), rows.where(broken).select("file_path", F.lit("invalid JSON").alias("error"))


def explode_tiles(files: DataFrame) -> DataFrame:
    """Tiles of tile files, with their header."""
    t = files.withColumn("image", stem_of(F.col("source_image"))).select("image", "source_image", "original_size", "overlap_ratio", F.posexplode("tiles").alias("tile_idx", "t"))
    return t.select("image", "source_image", "original_size", "overlap_ratio", "tile_idx", "t.tile_id", "t.coordinates", "t.grid_position", F.col("t.tile_size").alias("tile_pixels"))


def detections_by_tile(detections: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row for each image: a map from tile to its detections."""
    per_tile = detections.groupBy("image", "tile_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("detections"))
    return per_tile.groupBy("image").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tile_id", "detections")))).alias("by_tile"))


def stem_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*?)(\.[^./\\]*)?$", 1)


def read_images(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """image (the stem), source_image, width, height and the pixels as image_data; unreadable files go. pattern:
    a part that the file's name must have."""
    return images_or_fail(spark, path, pattern).where("error is null").drop("error")


def images_or_fail(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The same with error, and a row without pixels for each file that isn't readable."""
    raw = spark.read.format("image").option("pathGlobFilter", "*.{png,jpg,jpeg,tiff,tif,PNG,JPG,JPEG,TIFF,TIF}").load(path)
    origin = F.col("image.origin")
    rows = raw.select(stem_of(origin).alias("image"), origin.alias("source_image"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image").alias("image_data"), F.when(F.col("image.nChannels") <= 0, "unreadable").alias("error"))
    return rows.where(F.col("image").contains(pattern)) if pattern else rows


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, stem, extension, length of all files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    files = files.withColumns({"stem": stem_of(F.col("path")), "extension": F.lower(F.regexp_extract("path", r"\.([^./\\]*)$", 1))})
    return files.where(F.col("path").rlike(pattern)) if pattern else files


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path).where("extension = 'pdf'")


_BOX = re.compile(rb"/MediaBox\s*\[\s*([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s*\]")
_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)
_PACKED = re.compile(rb"<<((?:[^<>]|<<[^<>]*>>)*/Type\s*/ObjStm(?:[^<>]|<<[^<>]*>>)*)>>\s*stream\r?\n(.*?)endstream", re.S)


def _objects(content: bytes) -> dict[int, bytes]:
    """A PDF file's objects by number, those in compressed object streams too."""
    out = {int(m[1]): m[3] for m in _OBJECT.finditer(content)}
    for m in _PACKED.finditer(content):
        first, n = (re.search(rb"/" + k + rb"\s+(\d+)", m[1]) for k in (b"First", b"N"))
        try:
            data = zlib.decompressobj().decompress(m[2]) if b"/FlateDecode" in m[1] else m[2]
            heads = list(map(int, data[: int(first[1])].split()[: 2 * int(n[1])]))
        except (zlib.error, ValueError, TypeError):
            continue
        at = [int(first[1]) + x for x in heads[1::2]]
        out |= {k: data[a:b] for k, a, b in zip(heads[::2], at, [*at[1:], len(data)], strict=True)}
    return out


def page_boxes(content: bytes) -> list[list[float]]:
    """The media box of each page, in the order of the page tree; a page without one has its parent's. Files
    without a page tree give the first box they hold, if any."""
    box = lambda body: [float(x) for x in m.groups()] if (m := _BOX.search(body)) else None
    objects = _objects(content)
    kids = {k: [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R", m[1])] for k, body in objects.items() if re.search(rb"/Type\s*/Pages\b", body) and (m := re.search(rb"/Kids\s*\[(.*?)\]", body, re.S))}
    below, out, seen = {x for v in kids.values() for x in v}, [], set()
    todo = [(k, None) for k in sorted(kids, reverse=True) if k not in below]
    while todo:
        k, inherited = todo.pop()
        if k in seen or k not in objects:
            continue
        seen.add(k)
        found = box(objects[k]) or inherited
        if k in kids:
            todo += [(x, found) for x in reversed(kids[k])]
        elif found:
            out.append(found)
    loose = box(content)
    return out or ([loose] if loose else [])


def read_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """stem, pdf_path and content of all PDFs below a folder, whatever the case of their extension."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.lower("path").endswith(".pdf"))
    return files.select(stem_of(F.col("path")).alias("stem"), F.col("path").alias("pdf_path"), "content")


def pdf_sizes(spark: SparkSession, path: str) -> DataFrame:
    """stem, pdf_path, pdf_w, pdf_h (points) of the first page of each PDF; null if they can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            boxes = [(page_boxes(c) or [None])[0] for c in b.column(2).to_pylist()]
            sizes = [[None if x is None else x[k + 2] - x[k] for x in boxes] for k in range(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(s, pa.float64()) for s in sizes)], ["stem", "pdf_path", "pdf_w", "pdf_h"])

    return read_pdfs(spark, path).mapInArrow(run, "stem string, pdf_path string, pdf_w double, pdf_h double")


def page_name(stem: Column, page: Column, pages: Column, extension: Column) -> Column:
    """A page's file name: the PDF's own name if it has one page. Pages count from 1."""
    return F.when(pages == 1, F.concat(stem, F.lit("."), extension)).otherwise(F.concat(F.format_string("%s_page_%02d", stem, page), F.lit("."), extension))


def presets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in PRESETS.items()], "preset string, dpi int, image_format string, threads int")


def clamp_threads(n: int) -> int:
    return max(1, min(12, n))


def valid_dpi(dpi: int) -> int:
    if dpi < 72:
        raise ValueError("dpi must be 72 or more")
    return dpi


def folder_tree(paths: Iterable[str], excluded: Iterable[str] = ()) -> dict:
    """A nested dictionary of relative file paths; files are None. Excluded names hide folders, not files."""
    hidden, tree = set(excluded), {}
    for path in sorted(paths):
        *folders, name = path.strip("/").split("/")
        if hidden.isdisjoint(folders):
            at = tree
            for folder in folders:
                at = at.setdefault(folder, {})
            at[name] = None
    return tree


def tree_text(tree: dict, indent: int = 0) -> list[str]:
    """The tree as lines, a dash before each name, two blanks a level."""
    out = []
    for name, below in tree.items():
        out.append(f"{'  ' * indent}- {name}")
        out += tree_text(below or {}, indent + 1)
    return out
