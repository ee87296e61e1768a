import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkplane import config, models, schemas
from inkplane.config import Tiling
from inkplane.operators import crops, drawing, recognition, tiling
from inkplane.plans import pipeline
from inkplane.sources import readers, writers
from inkplane.streaming import detections as stream


def test_tile_starts(spark):
    rows = spark.createDataFrame([("a", 1400, 720), ("b", 721, 1368)], "image string, width long, height long")
    got = {(r.image, r.tile_idx, r.x1, r.y1) for r in tiling.tile_grid(rows, Tiling()).collect()}
    assert got == {("a", 0, 0, 0), ("a", 1, 648, 0), ("a", 2, 680, 0), ("b", 0, 0, 0), ("b", 1, 1, 0), ("b", 2, 0, 648), ("b", 3, 1, 648)}


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("tiling: {tile_size: 256, other: 1}\ngrouping: 3\n")
    c = config.load(tmp_path / "c.yaml")
    assert c.tiling.tile_size == 256 and c.grouping == config.Grouping() and c.value("tiling.step") == 230
    assert c.value("a.b", 7) == 7 and config.load(tmp_path / "none.yaml") == config.Config()
    (tmp_path / "bad.yaml").write_text("a: [")
    assert config.load(tmp_path / "bad.yaml") == config.Config()
    for wrong in ({"overlap_ratio": 1.0}, {"tile_size": 10}):
        with pytest.raises(ValueError):
            Tiling(**wrong)


def test_json_files(spark, tmp_path):
    box = {"bbox": [[1, 2], [3, 2], [3, 4], [1, 4]], "tile_id": "a_T0007", "tile_coordinates": [10, 20, 30, 40], "source_image": "/x/a.png"}
    (tmp_path / "a_ocr.json").write_text(json.dumps([box, box]))
    (tmp_path / "b_ocr.json").write_text(json.dumps(box | {"bbox": None}))
    (tmp_path / "c_ocr.json").write_text("[]")
    (tmp_path / "d_ocr.json").write_text("{")
    rows, broken = readers.read_json(spark, str(tmp_path), schemas.DETECTIONS, "*_ocr.json")
    assert rows.count() == 3 and broken.count() == 1
    ok, bad = tiling.valid_detections(rows)
    got = tiling.to_page(ok).select("x0", "y0", "x1", "y1", "tile_number").distinct().collect()
    assert [tuple(r) for r in got] == [(11, 22, 13, 24, 7)] and bad.count() == 1


def test_names(spark):
    row = spark.createDataFrame([("x/a.b_T0012.png", "IMG_T12")], "p string, t string")
    assert row.select(readers.stem_of(F.col("p"))).first()[0] == "a.b_T0012"
    assert row.select(tiling.tile_number(F.col("t"))).first()[0] == 12
    assert readers.clamp_threads(99) == 12 and readers.clamp_threads(0) == 1
    with pytest.raises(ValueError):
        readers.valid_dpi(71)


def test_folder_tree():
    tree = readers.folder_tree(["a/b/c.txt", "a/tests/d", "a/tests2", "tests"], {"tests"})
    assert tree == {"a": {"b": {"c.txt": None}, "tests2": None}, "tests": None}
    assert readers.tree_text(tree) == ["- a", "  - b", "    - c.txt", "  - tests2", "- tests"]


def test_pdf_sizes(spark, tmp_path):
    (tmp_path / "A.PDF").write_bytes(b"%PDF-1.4 /MediaBox [0 0 595.5 842] /MediaBox [0 0 1 1]")
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4")
    got = {r.stem: (r.pdf_w, r.pdf_h) for r in readers.pdf_sizes(spark, str(tmp_path)).collect()}
    assert got == {"A": (595.5, 842.0), "b": (None, None)}


def write_png(path, pixels):
    h, w, c = pixels.shape
    path.write_bytes(writers.png(pixels.tobytes(), h, w, c))


def test_pixels(spark, tmp_path):
    page = np.random.default_rng(1).integers(0, 255, (40, 60, 3), np.uint8)
    write_png(tmp_path / "p.png", page)
    (tmp_path / "broken.png").write_bytes(b"no")
    images = readers.read_images(spark, str(tmp_path))
    windows = images.withColumns({"left": F.lit(5), "top": F.lit(7), "right": F.lit(25), "bottom": F.lit(17)})
    one = crops.crop_pixels(windows)
    got = one.first()
    cut = page[7:17, 5:25]
    assert (got.height_px, got.width_px, got.pixels) == (10, 20, cut.tobytes())
    turned = crops.rotate_clockwise(one).first()
    assert (turned.height_px, turned.width_px) == (20, 10) and turned.pixels == np.rot90(cut, -1).tobytes()
    assert writers.with_png(one).first().png[:4] == b"\x89PNG"


def test_pipeline_starts_and_stops(spark, tmp_path):
    for name, shape in (("big", (900, 1500, 3)), ("small", (100, 100, 3))):
        (tmp_path / "in").mkdir(exist_ok=True)
        write_png(tmp_path / "in" / f"{name}.png", np.zeros(shape, np.uint8))
    r = pipeline.Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), config.Config())
    assert pipeline.run(r, stop_at="tiles") == ["pages", "tiles"]
    assert r.read("tiles").count() == 6 and [x.image for x in r.read("rejects/tiles").collect()] == ["small"]
    pipeline.run(r, start_at="detections")
    assert r.read("regions").count() > 0 and r.read("annotations").count() == r.read("windows").count()
    assert r.read("labels").count() == r.read("annotations").count()
    with pytest.raises(ValueError):
        pipeline.run(r, start_at="labels", stop_at="pages")
    assert writers.run_record(r.read("pages"), r.config, 1.5).first().pipeline_version == "1.0"
    files = writers.tile_files(r.read("tiles"), r.read("pages"), 720, 0.1)
    assert files.first().num_tiles == 6 and readers.explode_tiles(files).count() == 6
    texts = writers.image_files(writers.region_quads(r.read("regions")).select("image", "bbox"), r.read("pages"))
    writers.write_json(texts, str(tmp_path / "json"))
    assert {x.image: len(json.loads(x.json)) for x in texts.collect()}["small"] == 0


def test_stream(spark, tmp_path):
    box = {"bbox": [[1, 2], [3, 2], [3, 4], [1, 4]], "tile_id": "a_T0007", "tile_coordinates": [10, 20, 30, 40], "source_image": "/x/a.png"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([box, {"bbox": None}]))
    q = stream.write_stream(stream.detection_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out")).first()
    assert (got.x0, got.y0, got.image) == (11, 22, "a")


def test_outlines(spark):
    page = np.zeros((20, 30, 3), np.uint8)
    pages = spark.createDataFrame([("a", bytearray(page.tobytes()), 20, 30, 3), ("b", bytearray(page.tobytes()), 20, 30, 3)], "image string, pixels binary, height_px int, width_px int, channels int")
    boxes = drawing.with_colours(spark.createDataFrame([("a", 5, 5, 25, 10, [[5, 5], [25, 5], [25, 10], [5, 10]]), ("a", -4, 12, 3, 99, [[0, 0]])], "image string, x0 int, y0 int, x1 int, y1 int, bbox array<array<int>>"))
    got = {r.image: np.frombuffer(r.pixels, np.uint8).reshape(20, 30, 3) for r in drawing.outlined(pages, boxes).collect()}
    assert not got["b"].any() and (got["a"][5, 5:26] == (0, 255, 0)).all() and not got["a"][7:9, 7:24].any()
    assert (got["a"][19, 0:4] == (128, 128, 128)).all()



def test_rasterise(spark, tmp_path):
    for name, content in (("one.pdf", b"x"), ("two.PDF", b"yz"), ("bad.pdf", b"broken"), ("other.txt", b"q")):
        (tmp_path / name).write_bytes(content)

    def make():
        def pages(content, dpi):
            if content == b"broken":
                raise ValueError("no PDF")
            return [(1, dpi, 1, content)] * len(content)

        return pages

    got = models.rasterise(readers.read_pdfs(spark, str(tmp_path)), make, 300)
    assert {(r.name, r.page, r.pages, r.width) for r in got.collect()} == {("one.png", 1, 1, 300), ("two_page_01.png", 1, 2, 300), ("two_page_02.png", 2, 2, 300), ("bad.png", 1, 1, 0)}


def test_manifest_rows_with_crops(spark):
    m = spark.createDataFrame([("a", "crop_0000.png"), ("a", "crop_0001.png")], "image string, crop_filename string")
    assert recognition.with_crop(m, m.limit(1)).count() == 1
