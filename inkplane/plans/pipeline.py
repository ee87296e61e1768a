"""The stages from PDFs and images to annotations, each persisted, to be started and stopped anywhere.

    python -m inkplane.plans.pipeline IMAGES OUT [--start-at STAGE] [--stop-at STAGE] [--config FILE]

Each stage reads the tables of the stages before it below OUT and writes its own; rows that can't be
processed (files, tiles, images) go to OUT/rejects/STAGE with the reason, and the others go on. Models plug
in with run() (see models); the command line uses stand-ins. With artifacts, stages also write what others
read: page and tile images, crops, JSON by image. The published steps' names stand for stages too.
"""

from __future__ import annotations

import argparse
import logging
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config, models, schemas
from ..functions import geometry as G
from ..operators import coordinates, crops, drawing, grouping, layout, recognition, statistics, tiling
from ..sources import readers, writers

log = logging.getLogger(__name__)


@dataclass
class Run:
    spark: SparkSession
    images: str
    out: str
    config: config.Config
    detector: models.Plugin | Callable = models.stub_detector
    first: models.Plugin | Callable | None = None
    second: models.Plugin | Callable | None = None
    rasteriser: models.Plugin | Callable = models.scanned_pages
    renderer: models.Plugin | Callable | None = None
    pdfs: str | None = None
    artifacts: str | None = None
    pattern: str | None = None

    def read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.parquet(f"{self.out}/{name}")
        except AnalysisException as e:
            raise FileNotFoundError(f"{self.out}/{name} isn't there; an earlier stage writes it") from e

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.out}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.out}/{name}")

    def reject(self, df: DataFrame, stage: str) -> None:
        self.write(df, f"rejects/{stage}")

    def export(self, df: DataFrame, path: Column, content: str) -> None:
        """Files below the artifacts' folder, if there is one."""
        if self.artifacts:
            writers.export(df.select(path.alias("path"), F.col(content).alias("content")), self.artifacts).write.format("noop").mode("overwrite").save()

    def pixels(self) -> DataFrame:
        """The images that can be read and are pages, with their pixels."""
        return readers.read_images(self.spark, self.images, self.pattern)


def _name(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def pdf(r: Run) -> None:
    """Pages of PDF files as images in the images' folder, named after their file."""
    if not r.pdfs:
        log.info("no folder of PDFs")
        return
    c = r.config.pdf
    made = r.write(models.rasterise(readers.read_pdfs(r.spark, r.pdfs), r.rasteriser, c.dpi), "pdf_pages")
    files = writers.with_png(made.where("error is null").select("name", "pixels", F.col("height").alias("height_px"), F.col("width").alias("width_px"), "channels"))
    writers.export(files.select(F.col("name").alias("path"), F.col("png").alias("content")), r.images).write.format("noop").mode("overwrite").save()
    r.reject(made.where("error is not null").select("stem", "error"), "pdf")


def pages(r: Run) -> None:
    found = readers.images_or_fail(r.spark, r.images, r.pattern).drop("image_data")
    r.write(found.where("error is null").drop("error"), "pages")
    r.reject(found.where("error is not null").select("image", "source_image", "error"), "pages")


def tiles(r: Run) -> None:
    t = r.config.tiling
    ok, small = tiling.split_by_size(r.read("pages"), t)
    grid = r.write(tiling.tile_grid(ok, t), "tiles")
    r.reject(small.select("image", "error"), "tiles")
    cut = r.write(tiling.cut_tiles(tiling.split_by_size(r.pixels(), t)[0], t), "tile_pixels")
    if r.artifacts:
        r.export(writers.with_png(cut.select("image", "tile_id", "pixels", "height_px", "width_px", "channels")), _name("tiles/", F.col("image"), "/tile_", F.col("tile_id"), ".png"), "png")
        one = _name("tiles/", F.col("image"), "/tiles_metadata.json")
        r.export(writers.objects(writers.tile_files(grid, ok, t.tile_size, t.overlap_ratio)), one, "json")
        r.export(writers.objects(writers.image_tiles(grid, ok, t.overlap_ratio)), _name("metadata/", F.col("image"), "_tiles.json"), "json")


def detections(r: Run) -> None:
    t, cut = r.read("tiles"), r.read("tile_pixels")
    found = r.write(models.detect_or_fail(cut.drop("tile_idx"), r.detector, r.config.detection.thresholds), "detections_found")
    grid = F.array(F.col("grid_row").cast("int"), F.col("grid_col").cast("int"))
    size = F.array((F.col("x2") - F.col("x1")).cast("int"), (F.col("y2") - F.col("y1")).cast("int"))
    path = _name("tiles/", F.col("image"), "/tile_", F.col("tile_id"), ".png")
    placed, lost = tiling.with_tiles(found.where("error is null").drop("error"), t.select("image", "tile_id", "tile_idx", grid.alias("grid_position"), size.alias("tile_size"), path.alias("tile_path")))
    page = r.read("pages").select("image", "source_image", F.array("width", "height").alias("original_image_size"))
    placed = r.write(placed.drop("tile_idx").join(page, "image", "left"), "detections")
    failed = found.where("error is not null").select("image", "tile_id", "error")
    r.reject(lost.select("image", "tile_id", F.lit("unknown tile").alias("error")).unionByName(failed), "detections")
    if r.artifacts:
        rows = placed.withColumnRenamed("tile_id", "_tile").withColumns({"image": F.struct("image", "_tile"), "tile_id": F.col("_tile")}).drop("_tile")
        r.export(writers.image_files(rows, order="det_index"), _name("detections/", F.col("image.image"), "/", F.col("image._tile"), "_ocr.json"), "json")


def regions(r: Run) -> None:
    ok, bad = tiling.valid_detections(r.read("detections"))
    began = time.perf_counter()
    boxes = r.write(grouping.canonical_index(tiling.to_page(ok)), "boxes")
    merged = grouping.group_boxes(boxes, r.config.grouping)
    page = r.read("pages").select("image", F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height"))
    done = r.write(merged.join(page, "image"), "regions")
    r.reject(bad.select("image", F.lit("no box or tile coordinates").alias("error")), "regions")
    r.write(writers.run_record(r.read("pages"), r.config, time.perf_counter() - began), "runs")
    if r.artifacts:
        r.export(writers.image_files(tiling.grouped_output(done.withColumn("_n", F.col("component")), "_n"), page, "_n"), _name("grouped/", F.col("image"), "_grouped.json"), "json")
        r.export(writers.objects(r.read("runs").withColumn("image", readers.stem_of(F.col("source_image")))), _name("global/", F.col("image"), "_global.json"), "json")


def cropped(r: Run) -> None:
    n = F.row_number().over(Window.partitionBy("image").orderBy("component")) - 1
    windows = crops.crop_windows(r.read("regions").withColumn("crop_idx", n), r.config.cropping)
    windows = r.write(windows, "windows")
    listed = r.write(crops.manifest(windows), "manifest")
    # the first file of an image's name has its pixels, by the order of extensions
    source = r.read("pages").select(F.col("image").alias("stem"), F.col("source_image").alias("path"), F.lower(F.regexp_extract("source_image", r"\.([^./\\]*)$", 1)).alias("extension"))
    chosen = crops.first_file(source.select("stem").distinct(), source, readers.IMAGE_EXTENSIONS)
    pixels = r.pixels().join(chosen.select(F.col("path").alias("source_image")), "source_image", "left_semi")
    made = r.write(crops.cut_crops(windows.select("image", "crop_filename", *(F.col(c).cast("int") for c in ("left", "top", "right", "bottom"))), pixels), "crops")
    r.reject(windows.join(made.select("image").distinct(), "image", "left_anti").select("image", "crop_filename", F.lit("no pixels").alias("error")), "cropped")
    if r.artifacts:
        r.export(writers.with_png(made.select("image", "crop_filename", "pixels", "height_px", "width_px", "channels")), _name("crops/", F.col("image"), "/", F.col("crop_filename")), "png")
        r.export(writers.image_files(listed.withColumn("_n", F.col("crop_filename")), order="_n"), _name("crops/", F.col("image"), "/manifest.json"), "json")


def recognised(r: Run) -> None:
    first = r.first or models.plugin(models.stub_recogniser, name="a", sure=3)
    second = r.second or models.plugin(models.stub_recogniser, name="b", sure=5)
    pixels = r.read("crops").select("image", "crop_filename", "pixels", "height_px", "width_px", "channels")
    rows = r.read("manifest").join(pixels, ["image", "crop_filename"])  # rows of the manifest whose crop is there
    done = recognition.recognise(rows, first, second, r.config.recognition).drop("pixels", "height_px", "width_px", "channels")
    found = r.write(recognition.annotations(done), "annotations")
    r.write(recognition.image_totals(r.read("pages"), found), "recognition_totals")
    if r.artifacts:
        final = found.select("image", F.col("crop_filename").alias("_n"), "text", "confidence", F.col("original_bbox").alias("bbox"), "crop_filename", "ocr_method", "easyocr_detections", "original_image_size")
        r.export(writers.image_files(final, order="_n"), _name("final_annotations/", F.col("image"), "_final.json"), "json")


def points(r: Run) -> None:
    a, c = r.read("annotations"), r.config.coordinates
    done = r.write(a.withColumn("original_bbox", coordinates.to_points(F.col("original_bbox"), c.image_dpi)), "points")
    folder = r.pdfs or c.pdf_base_dir
    if folder and c.validate_dimensions:
        sizes = r.read("pages").select("image", "width", "height")
        checked = r.write(coordinates.validate(sizes, readers.pdf_sizes(r.spark, folder), config.Coordinates(c.image_dpi, True, c.tolerance_percent, folder)), "validation")
        r.write(coordinates.validation_failures(checked), "validation_failures")
    if r.artifacts:
        final = done.select("image", F.col("crop_filename").alias("_n"), "text", "confidence", F.col("original_bbox").alias("bbox"), "crop_filename", "ocr_method", "easyocr_detections", "original_image_size")
        r.export(writers.image_files(final, order="_n"), _name("pdf_perspective/", F.col("image"), "_final.json"), "json")


def labels(r: Run) -> None:
    a = r.read("annotations").join(r.read("pages").select("image", "width", "height"), "image")
    x0, y0, x1, y1 = G.envelope(F.col("original_bbox"))
    rows = a.where(layout.is_quad(F.col("original_bbox"))).withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y1, "text_w": 12 * F.length("text"), "text_h": F.lit(18), "baseline": F.lit(6)})
    placed = r.write(layout.label_places(rows), "labels")
    if r.artifacts:
        shapes = drawing.with_colours(placed.withColumn("bbox", F.col("original_bbox")).drop("orientation"))
        page = F.col("image_data")
        given = r.pixels().select("image", page["data"].alias("pixels"), page["height"].alias("height_px"), page["width"].alias("width_px"), page["nChannels"].alias("channels"))
        drawn = drawing.drawn(given, shapes.select("image", "bbox", "colour", "text", "label_x", "label_y", "back_x0", "back_y0", "back_x1", "back_y1"), renderer=r.renderer)
        r.export(writers.with_png(drawn), _name("visualizations/", F.col("image"), "_annotated.png"), "png")


def imported(r: Run, folder: str) -> list[str]:
    """Writes the tables that stages read from JSON files made elsewhere, wherever they lie below folder: *_ocr.json
    (detections), *_grouped.json (regions), manifest.json and *_final.json (annotations, but for those in PDF points,
    below pdf_perspective). Files that can't be read are rejects. Gives the tables that there were files for; run() may start at the stage after."""
    done = []
    parent = F.element_at(F.split("file_path", "/"), -2)
    place = F.row_number().over(Window.partitionBy("file_path").orderBy(F.monotonically_increasing_id())) - 1
    size = lambda k: F.get("original_image_size", F.lit(k)).cast("long")

    def detections_(rows: DataFrame) -> DataFrame:
        named = rows.where("tile_id is not null or bbox is not null").withColumns({"image": F.coalesce(readers.stem_of(F.col("source_image")), parent), "det_index": place})
        return named.drop("file_path")

    def regions_(rows: DataFrame) -> DataFrame:
        x0, y0, x1, y1 = (c.cast("long") for c in G.envelope(F.col("bbox")))
        named = rows.where("bbox is not null").withColumns({"image": crops.stem(readers.stem_of(F.col("file_path"))), "component": place, "x0": x0, "y0": y0, "x1": x1, "y1": y1, "width": size(0), "height": size(1), "tile_ids": F.col("grouped_from_tiles")})
        return named.drop("file_path", "bbox", "bbox_normalized", "grouped_from_tiles", "is_grouped")

    def annotations_(rows: DataFrame) -> DataFrame:
        named = rows.where("bbox is not null").withColumn("image", coordinates.pdf_stem(readers.stem_of(F.col("file_path"))))
        return named.withColumnRenamed("bbox", "original_bbox").withColumn("orientation", F.lit(0)).drop("file_path")

    for name, schema, glob, make in (
        ("detections", schemas.DETECTIONS, "*_ocr.json", detections_), ("regions", schemas.GROUPED, "*_grouped.json", regions_),
        ("manifest", schemas.MANIFEST, "manifest.json", lambda rows: rows.where("crop_filename is not null").withColumn("image", parent).drop("file_path")),
        ("annotations", schemas.ANNOTATIONS, "*_final.json", annotations_),
    ):
        rows, broken = (x.where(~F.col("file_path").contains("/pdf_perspective/")) for x in readers.read_json(r.spark, folder, schema, glob))
        if not rows.isEmpty() or not broken.isEmpty():
            r.write(make(rows), name)
            r.reject(broken, f"imported_{name}")
            done.append(name)
    return done


STAGES: dict[str, Callable[[Run], None]] = {f.__name__: f for f in (pdf, pages, tiles, detections, regions, cropped, recognised, points, labels)}
#: The published names of steps, with the first and the last stage each stands for.
STEPS = {"pdf": ("pdf", "pdf"), "slice": ("pages", "tiles"), "meta": ("tiles", "tiles"), "detect": ("detections", "detections"), "group": ("regions", "regions"), "crop": ("cropped", "cropped"), "recognize": ("recognised", "recognised"), "coord": ("points", "points"), "viz": ("labels", "labels")}


def run(r: Run, start_at: str | None = None, stop_at: str | None = None) -> list[str]:
    """Runs the stages from start_at to stop_at, both included; a stage that fails ends the run with its error."""
    names = list(STAGES)
    start_at, stop_at = STEPS.get(start_at, (start_at,))[0], STEPS.get(stop_at, (stop_at,))[-1]
    for name in (start_at, stop_at):
        if name is not None and name not in names:
            raise ValueError(f"no stage {name}; there are {', '.join(names)}")
    a, b = names.index(start_at or ("pdf" if r.pdfs else "pages")), names.index(stop_at or names[-1])
    if a > b:
        raise ValueError(f"{start_at} comes after {stop_at}")
    for name in names[a : b + 1]:
        log.info("stage %s", name)
        STAGES[name](r)
    return names[a : b + 1]


def compare(spark: SparkSession, out: str) -> DataFrame:
    """By image, boxes before and regions after grouping, by orientation."""
    return statistics.before_and_after(spark.read.parquet(f"{out}/boxes"), spark.read.parquet(f"{out}/regions"))


def main(args: list[str]) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("images")
    p.add_argument("out")
    names = list(dict.fromkeys([*STAGES, *STEPS]))
    p.add_argument("--start-at", choices=names)
    p.add_argument("--stop-at", choices=names)
    p.add_argument("--config")
    p.add_argument("--pdfs", help="folder of PDF files; without it there is no PDF stage")
    p.add_argument("--no-pdf", action="store_true", help="leave the PDF stage out")
    p.add_argument("--artifacts", help="folder for images and JSON files that others read")
    p.add_argument("--pattern", help="part of the names of the images to take")
    p.add_argument("--import-from", help="folder of JSON files made elsewhere; their tables are written first")
    p.add_argument("--compare", action="store_true", help="print boxes before and after grouping, and end")
    a = p.parse_args(args)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("inkplane").getOrCreate()
    if a.compare:
        compare(spark, a.out).orderBy("image").show(1000, truncate=False)
        return
    c = config.load(a.config)
    devices = ("cuda:0", "cpu") if c.detection.gpu else ("cpu",)
    log.info("models are tried on %s", ", ".join(devices))
    start = a.start_at or ("pages" if a.no_pdf else None)
    r = Run(spark, a.images, a.out, c, pdfs=a.pdfs, artifacts=a.artifacts, pattern=a.pattern)
    if a.import_from:
        log.info("imported %s", ", ".join(imported(r, a.import_from)))
    run(r, start, a.stop_at)


if __name__ == "__main__":
    main(sys.argv[1:])
