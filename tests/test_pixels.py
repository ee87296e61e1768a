"""The staged pipeline over real pixels: PDFs and images to annotations, with models that look at them."""

import json
import logging
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkplane import config, models
from inkplane.operators import coordinates, drawing, grouping, recognition, statistics, tiling
from inkplane.plans import pipeline
from inkplane.plans import queries as Q
from inkplane.sources import readers, writers

PUBLISHED = """
pipeline: {input_dir: "in", device: "cpu", surprise: 1}
sahi_slicer: {tile_size: 256, overlap_ratio: 0.2}
data_loader: {cropping_output_dir: "elsewhere"}
ocr: {text_threshold: 0.5, ycenter_ths: 0.25, confidence_threshold: 0.8, model_name: "m", languages: ['en', 'de'], gpu: False}
grouping: {high_overlap_threshold: 0.3, neighborhood_expansion_factor: 2, proximity_factor: "far"}
coordinate_conversion: {image_dpi: 300, pdf_base_dir: 'pdfs'}
pdf_conversion: {dpi: 150, format: TIFF, threads: 99}
cropping: {padding: 3}
nobody: {a: 1}
visualization: 7
"""


def test_published_configuration(tmp_path, caplog):
    (tmp_path / "c.yaml").write_text(PUBLISHED)
    with caplog.at_level(logging.WARNING):
        c = config.load(tmp_path / "c.yaml")
    assert c.tiling.tile_size == 256 and c.detection.thresholds["text_threshold"] == 0.5 and c.detection.thresholds["ycenter_ths"] == 0.25 and len(c.detection.thresholds) == 7
    assert c.recognition.confidence_threshold == 0.8 and not c.recognition.gpu and not c.detection.gpu and c.detection.languages == ("en", "de")
    assert c.grouping.iou_threshold == 0.3 and c.grouping.expansion_factor == 2.0 and c.grouping.proximity_factor == 1.0
    assert c.coordinates.pdf_base_dir == "pdfs" and c.pdf.threads == 12 and c.cropping.padding == 3 and c.folders.cropping_output_dir == "elsewhere"
    assert c.value("ocr.confidence_threshold") == 0.8 and c.value("grouping.high_overlap_threshold") == 0.3 and c.value("sahi_slicer.tile_size") == 256 and c.value("nobody.a", 5) == 5
    assert c.section("ocr")["model_name"] == "m" and c.section("ocr")["low_text"] == 0.2
    said = " ".join(x.getMessage() for x in caplog.records)
    assert all(x in said for x in ("surprise", "nobody", "far", "visualization"))
    for wrong in ({"dpi": 71}, {"format": "BMP2"}):
        with pytest.raises(ValueError):
            config.Pdf(**wrong)


# Models that look at pixels.


def blob_detector(log, bad=()):
    """Boxes round dark stretches of columns; every load is a line in a file."""
    with open(log, "a") as f:
        f.write(f"{os.getpid()}\n")

    def detect(tile, text_threshold, ycenter_ths, **others):
        assert len(others) == 5 and tile["pixels"].ndim == 3
        if tile["tile_id"] in bad:
            raise RuntimeError("cannot")
        ink = (tile["pixels"] < 255 * text_threshold).any(2)
        columns = np.flatnonzero(np.diff(np.concatenate([[0], ink.any(0), [0]]).astype(int)))
        out = [["no", "box"]]
        for a, b in zip(columns[::2], columns[1::2], strict=True):
            rows = np.flatnonzero(ink[:, a:b].any(1))
            out.append([a, b, rows[0], rows[-1] + 1])
        return out

    return detect


def size_reader(log, sure):
    with open(log, "a") as f:
        f.write(f"{os.getpid()}\n")

    def read(rows):
        if any(r["pixels"].shape[1] == 3 * r["pixels"].shape[0] for r in rows):
            raise RuntimeError("a shape I can't read")
        return [("x".join(map(str, r["pixels"].shape[:2])), sure, 2) for r in rows]

    return read


def write_png(path, page):
    path.write_bytes(writers.png(page.tobytes(), *page.shape))


def test_from_pixels_to_annotations(spark, tmp_path):
    page = np.full((300, 400, 3), 255, np.uint8)
    page[20:40, 30:110] = 0  # wide
    page[100:190, 250:270] = 0  # upright
    os.makedirs(tmp_path / "in")
    write_png(tmp_path / "in/a.png", page)
    write_png(tmp_path / "in/empty.png", np.full((300, 400, 3), 255, np.uint8))
    write_png(tmp_path / "in/small.png", np.zeros((10, 10, 3), np.uint8))
    (tmp_path / "in/broken.png").write_bytes(b"no")
    c = config.Config(tiling=config.Tiling(tile_size=200, overlap_ratio=0.1), cropping=config.Cropping(padding=5))
    logs = {k: str(tmp_path / k) for k in ("detector", "first", "second")}
    r = pipeline.Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), c, models.plugin(blob_detector, log=logs["detector"]), models.plugin(size_reader, log=logs["first"], sure=0.3), models.plugin(size_reader, log=logs["second"], sure=0.9), artifacts=str(tmp_path / "art"))
    with pytest.raises(FileNotFoundError):
        pipeline.run(r, "tiles", "tiles")
    assert pipeline.run(r, "slice", "viz") == ["pages", "tiles", "detections", "regions", "cropped", "recognised", "points", "labels"]
    assert {(x.image, x.error) for n in ("pages", "tiles") for x in r.read(f"rejects/{n}").collect()} == {("broken", "unreadable"), ("small", "smaller than a tile")}
    cut, grid = r.read("tile_pixels"), r.read("tiles")
    same = ["image", "tile_idx", "tile_id", "x1", "y1", "x2", "y2", "grid_row", "grid_col"]
    assert sorted(map(tuple, cut.select(same).collect())) == sorted(map(tuple, grid.select(same).collect())) and cut.count() == 12
    for x in cut.where("image = 'a'").collect():
        assert x.pixels == page[x.y1 : x.y2, x.x1 : x.x2].tobytes()
    found = {(x.x0, x.y0, x.x1, x.y1): x for x in r.read("regions").collect()}
    assert set(found) == {(30, 20, 110, 40), (250, 100, 270, 190)}
    upright = found[250, 100, 270, 190]
    assert upright.rotation_angle == 90 and upright.source_tiles_count == len(upright.tile_ids) == len(upright.tile_paths) and upright.tile_numbers and all(len(p) == 2 for p in upright.grid_positions)
    # the wide crop is 30 by 90: the reader fails on it, so it has no text; the upright one is read unsurely, then turned
    got = r.read("annotations").collect()
    assert [(x.text, x.confidence, x.ocr_method, x.orientation) for x in got] == [("30x100", 0.9, "EasyOCR", 90)]
    for k in logs.values():
        pids = Counter(open(k).read().split())
        assert pids and set(pids.values()) == {1}
    assert r.read("recognition_totals").first().images == 3
    art = tmp_path / "art"
    meta = json.loads((art / "tiles/a/tiles_metadata.json").read_text())
    assert meta["num_tiles"] == 6 and len(list((art / "tiles/a").glob("tile_*.png"))) == 6 and meta["tiles"][1]["coordinates"][0] == 180
    assert json.loads((art / "metadata/a_tiles.json").read_text())["tiles"][0]["original_image_size"] == [400, 300]
    assert json.loads((art / "grouped/empty_grouped.json").read_text()) == [] and len(json.loads((art / "grouped/a_grouped.json").read_text())) == 2
    names = [x["crop_filename"] for x in json.loads((art / "crops/a/manifest.json").read_text())]
    assert names == ["crop_0000.png", "crop_0001.png"] and all((art / "crops/a" / n).exists() for n in names)
    assert all(f.suffix in (".json", ".png") for f in art.rglob("*") if f.is_file())
    raw = [json.loads(f.read_text()) for f in (art / "detections/a").glob("*_ocr.json")]
    assert {x["tile_path"] for one in raw for x in one} <= {f"tiles/a/tile_{x.tile_id}.png" for x in grid.collect()} and "det_index" not in raw[0][0]
    image, pdf = (json.loads((art / d / "a_final.json").read_text()) for d in ("final_annotations", "pdf_perspective"))
    assert [x["bbox"][0][0] * 0.12 for x in image] == pytest.approx([x["bbox"][0][0] for x in pdf])
    assert (art / "global/a_global.json").exists() and (art / "visualizations/a_annotated.png").exists()
    again = readers.read_images(spark, str(art / "crops/a")).collect()
    assert {(x.height, x.width) for x in again} == {(30, 90), (100, 30)}
    assert pipeline.compare(spark, r.out).where("image = 'a'").first().after_vertical == 1
    assert statistics.time_summary(r.read("runs")).first().runs == 3


def test_json_made_elsewhere(spark, tmp_path):
    """Stages go on from other runs' JSON files, as the tables they stand for."""
    page = np.full((300, 400, 3), 255, np.uint8)
    page[20:40, 30:110] = 0
    os.makedirs(tmp_path / "in")
    write_png(tmp_path / "in/a.png", page)
    c = config.Config(tiling=config.Tiling(tile_size=200))
    r = pipeline.Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), c, models.plugin(blob_detector, log=str(tmp_path / "log")), artifacts=str(tmp_path / "art"))
    pipeline.run(r)
    (tmp_path / "art/detections/a/broken_ocr.json").write_text("[{")
    other = pipeline.Run(spark, r.images, str(tmp_path / "other"), c)
    assert pipeline.imported(other, r.artifacts) == ["detections", "regions", "manifest", "annotations"]
    assert other.read("rejects/imported_detections").count() == 1 and other.read("rejects/imported_annotations").count() == 0
    boxes = ["image", "x0", "y0", "x1", "y1", "tile_ids"]
    assert other.read("regions").select(boxes).collect() == r.read("regions").select(boxes).collect()
    pipeline.run(pipeline.Run(spark, r.images, r.out, c), "pages", "tiles")
    texts = other.read("annotations").select("image", "text", "crop_filename", "original_bbox").collect()
    assert texts == r.read("annotations").select("image", "text", "crop_filename", "original_bbox").collect()
    pipeline.run(other, "pages", "pages")
    assert pipeline.run(other, "regions", "labels")[0] == "regions"
    assert other.read("regions").select(boxes).collect() == r.read("regions").select(boxes).collect() and other.read("labels").count() == len(texts)


def test_a_failing_tile_is_a_reject(spark, tmp_path):
    page = np.full((300, 400, 3), 255, np.uint8)
    page[20:40, 30:110] = 0
    os.makedirs(tmp_path / "in")
    write_png(tmp_path / "in/a.png", page)
    c = config.Config(tiling=config.Tiling(tile_size=200))
    r = pipeline.Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), c, models.plugin(blob_detector, log=str(tmp_path / "log"), bad=["a_T0005"]))
    pipeline.run(r, "pages", "detections")
    assert [(x.tile_id, x.error) for x in r.read("rejects/detections").collect()] == [("a_T0005", "RuntimeError: cannot")]
    assert r.read("detections").count() >= 1


def test_devices():
    tried = []

    def make(device, fail):
        tried.append(device)
        if device in fail:
            raise RuntimeError(device)
        return device

    assert models.Plugin(make, {"fail": ["gpu"]}, ("gpu", "cpu")).load() == "cpu" and tried == ["gpu", "cpu"]
    with pytest.raises(RuntimeError):
        models.Plugin(make, {"fail": ["gpu", "cpu"]}, ("gpu", "cpu")).load()
    key = models.plugin(make, fail=["x"]).key
    assert key == models.plugin(make, fail=["x"]).key != models.plugin(make, fail=["y"]).key


def test_shared_folder_is_asked_for():
    """Off local masters there is no temporary folder: executors wouldn't see it."""
    from types import SimpleNamespace

    from inkplane.scratch import shared_folder

    def session(master, folder=None):
        made = []
        context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda _: folder), setCheckpointDir=made.append)
        return SimpleNamespace(sparkContext=context)

    for master in ("spark://h:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            shared_folder(session(master))
        assert shared_folder(session(master, "hdfs:///x")) == "hdfs:///x"
    assert shared_folder(session("local[4]")).endswith("inkplane-shared")


# PDFs.


def scan(pages, packed=False):
    """A PDF file whose pages are one deflated grey image each; with its page objects in an object stream on demand."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /MediaBox [0 0 72 36] /Kids [" + b" ".join(b"%d 0 R" % (10 + 2 * k) for k in range(len(pages))) + b"] /Count %d >>" % len(pages)}
    images = {}
    for k, p in enumerate(pages):
        objects[10 + 2 * k] = b"<< /Type /Page /Parent 2 0 R" + (b" /MediaBox [0 0 36 72]" if k else b"") + b" /Resources << /XObject << /I %d 0 R >> >> >>" % (11 + 2 * k)
        data = zlib.compress(p.tobytes())
        images[11 + 2 * k] = b"<< /Type /XObject /Subtype /Image /Width %d /Height %d /BitsPerComponent 8 /ColorSpace /DeviceGray /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (p.shape[1], p.shape[0], len(data), data)
    if packed:
        body, heads = b"", b""
        for k, o in objects.items():
            heads += b"%d %d " % (k, len(body))
            body += o + b" "
        images[99] = b"<< /Type /ObjStm /N %d /First %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(objects), len(heads), zlib.compress(heads + body))
        objects = {}
    return b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in (objects | images).items())


@pytest.mark.parametrize("packed", [False, True])
def test_scanned_pdfs(spark, tmp_path, packed):
    one, two = np.arange(50, dtype=np.uint8).reshape(5, 10), np.full((8, 4), 200, np.uint8)
    for d in ("pdfs", "in"):
        os.makedirs(tmp_path / d)
    (tmp_path / "pdfs/plan.pdf").write_bytes(scan([one, two], packed))
    (tmp_path / "pdfs/single.PDF").write_bytes(scan([one], packed))
    (tmp_path / "pdfs/bad.pdf").write_bytes(b"%PDF-1.4 nothing")
    assert readers.page_boxes(scan([one, two], packed)) == [[0, 0, 72, 36], [0, 0, 36, 72]]
    r = pipeline.Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), config.Config(pdf=config.Pdf(dpi=144)), pdfs=str(tmp_path / "pdfs"))
    pipeline.run(r, "pdf", "pages")
    got = {x.image: (x.width, x.height) for x in r.read("pages").collect()}
    assert got == {"plan_page_01": (144, 72), "plan_page_02": (72, 144), "single": (144, 72)}
    assert [x.stem for x in r.read("rejects/pdf").collect()] == ["bad"]
    sizes = {x.stem: (x.pdf_w, x.pdf_h) for x in readers.pdf_sizes(spark, str(tmp_path / "pdfs")).collect()}
    assert sizes == {"plan": (72, 36), "single": (72, 36), "bad": (None, None)}
    assert pipeline.run(pipeline.Run(spark, r.images, r.out, config.Config()), "pdf", "pdf") == ["pdf"]


# What else the stages use.


def test_validation_summary_sorts_by_stem(spark):
    """A name that begins another one's comes first, though "_" follows the digits; no failures are a null."""
    rows = spark.createDataFrame([("P100000_final", False), ("P10001_final", False), ("P10000_final", False), ("P3_final", True)], "image string, compatible boolean")
    assert coordinates.validation_summary(rows).collect() == [(4, 1, "P10000_final,P100000_final,P10001_final")]
    assert coordinates.validation_summary(rows.where("compatible")).collect() == [(1, 1, None)]


def test_validation_of_annotation_files(spark, tmp_path):
    for name, text in (("a_final.json", '[{"text": "x", "original_image_size": [600, 600]}]'), ("b_final.json", "{"), ("c_final.json", '[{"text": "x"}]'), ("d_final.json", '[{"text": "x", "original_image_size": [600, 600]}]')):
        (tmp_path / name).write_text(text)
    from inkplane import schemas

    rows, broken = readers.read_json(spark, str(tmp_path), schemas.ANNOTATIONS)
    pdfs = spark.createDataFrame([("a", "a.pdf", 72.0, 72.0), ("c", "c.pdf", 72.0, 72.0), ("d", "d.pdf", None, None)], "stem string, pdf_path string, pdf_w double, pdf_h double")
    got = coordinates.validate(coordinates.annotation_sizes(rows, broken), pdfs, config.Coordinates(pdf_base_dir="x"))
    assert {x.image: (x.compatible, x.error) for x in got.collect()} == {"a_final": (True, None), "b_final": (False, "annotations unreadable"), "c_final": (False, "image size missing"), "d_final": (False, "PDF dimensions unreadable")}
    assert {x.image for x in coordinates.validation_failures(got).collect()} == {"b_final", "c_final", "d_final"}
    check = coordinates.dimension_check(F.lit(None).cast("int"), F.lit(1), F.lit(1.0), F.lit(1.0), config.Coordinates())
    assert tuple(spark.range(1).select(check["compatible"], check["error"]).first()) == (False, "Missing image size or PDF dimensions")


def test_polygons_and_labels(spark):
    page = np.zeros((30, 40, 3), np.uint8)
    pages = spark.createDataFrame([("a", bytearray(page.tobytes()), 30, 40, 3)], "image string, pixels binary, height_px int, width_px int, channels int")
    shapes = spark.createDataFrame([("a", [[5, 5], [20, 8], [20, 20], [-5, 20]], "1,2,3", "hi", 25, 28, 24, 20, 60, 30)], "image string, bbox array<array<int>>, colour string, text string, label_x int, label_y int, back_x0 int, back_y0 int, back_x1 int, back_y1 int")
    plain = np.frombuffer(drawing.drawn(pages, shapes, 1).first().pixels, np.uint8).reshape(page.shape)
    assert plain[5, 5].tolist() == [1, 2, 3] and plain[20, 0].tolist() == [1, 2, 3] and plain[14, 20].tolist() == [1, 2, 3] and (plain[20:30, 24:40] == 255).all() and not plain[0].any()
    ink = np.frombuffer(drawing.drawn(pages, shapes, 1, lambda: lambda text: np.full((4, 3 * len(text)), 200)).first().pixels, np.uint8).reshape(page.shape)
    assert ink[25, 26].tolist() == [1, 2, 3] and (ink[21, 39] == 255).all()


def test_merged_positions(spark):
    rows = [(0, 3, 0, "b", ["MERGED"]), (0, 1, 0, "a", ["1,1"]), (0, 2, 0, "a", ["0,0"]), (0, 4, 0, None, ["1,1"])]
    members = spark.createDataFrame([(i, k, c, t, p[0], 0, 0, 1, 1) for i, k, c, t, p in rows], "image long, idx long, component long, tile_id string, grid_position string, x0 int, y0 int, x1 int, y1 int")
    got = grouping.merge_clusters(members).first()
    assert got.grid_positions == ["1,1", "0,0"] and got.tile_ids == ["UNKNOWN", "a", "b"] and got.source_tiles_count == 3


def test_group_boxes_reads_its_input_once(spark, sf_dir):
    plan = Q.group_boxes(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("FileScan parquet") <= 3 and "orders" not in plan  # the survivors twice, and their links


def test_components_of_large_images_by_joins(spark):
    rows = [(0, i, i + 1) for i in range(0, 60, 2)] + [(0, 1, 2), (1, 5, 9), (1, 2, 5)]
    edges = spark.createDataFrame(rows, "image long, i long, j long")
    boxes = spark.createDataFrame([(k, i) for k in (0, 1) for i in range(62)], "image long, idx long")
    one, two = (sorted(map(tuple, grouping.components(boxes, edges, most).collect())) for most in (1000, 10))
    assert one == two and len(one) == 124 and (0, 3, 0) in one and (1, 9, 2) in one and (1, 61, 61) in one


def test_deaths_round_by_round(spark):
    """Both ways of visiting conflicts kill the same boxes at the same pairs, also along chains."""
    rnd = np.random.default_rng(3)
    rows = [(0, i, i + 1, i) for i in range(40)] + [(1, i, i + 1, i + 1) for i in range(40)]
    for image in range(2, 14):
        for i, j in {tuple(sorted(p)) for p in rnd.integers(0, 25, (60, 2)).tolist() if p[0] != p[1]}:
            rows.append((image, i, j, int(rnd.choice([i, j]))))
    conflict = spark.createDataFrame(rows, "image long, i long, j long, victim long")
    one, two = (sorted(map(tuple, grouping.deaths(conflict, most).collect())) for most in (1000, 20))
    want = []
    for image in range(14):
        dead = set()
        for _, i, j, v in sorted(r for r in rows if r[0] == image):
            if i not in dead and j not in dead:
                dead.add(v)
                want.append((image, v, i, j))
    assert one == two == sorted(want)


def test_image_totals(spark):
    rows = spark.createDataFrame([("a", "TrOCR"), ("a", "EasyOCR"), ("b", "TrOCR")], "image string, ocr_method string")
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "image string")
    assert tuple(recognition.image_totals(images, rows).first()) == (3, 2, 3, 2, 1)


def test_tiles_of_odd_sizes(spark, tmp_path):
    page = np.random.default_rng(1).integers(0, 255, (71, 64, 3), np.uint8)
    write_png(tmp_path / "p.png", page)
    t = config.Tiling(tile_size=64, overlap_ratio=0.5)
    cut = tiling.cut_tiles(readers.read_images(spark, str(tmp_path)), t).collect()
    assert [(x.x1, x.y1, x.x2, x.y2, x.grid_row) for x in sorted(cut, key=lambda x: x.tile_idx)] == [(0, 0, 64, 64, 0), (0, 7, 64, 71, 0)]
