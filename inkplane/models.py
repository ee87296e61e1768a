"""Where detectors, recognisers and rasterisers plug in, and deterministic stand-ins for tests.

A Plugin makes its model once for each Python worker, however many tasks and stages use it, on the
first device that works. A detector is called with a tile (a dictionary; pixels is an array of rows, columns,
channels, or None) and the thresholds, and returns horizontal boxes as [x_min, x_max, y_min, y_max]; a recogniser
gets a list of crops (with pixels likewise) and returns (text, confidence, n) or None for each. A tile or crop that a
model fails on becomes a row with an error, or no result; the others go on.
"""

from __future__ import annotations

import hashlib
import logging
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

_LOADED: dict[str, Any] = {}  # by key; one for each worker process


@dataclass(frozen=True)
class Plugin:
    """make(**options) gives the model; with devices, make(device=..., **options), tried in order."""

    make: Callable[..., Any]
    options: dict[str, Any] = field(default_factory=dict)
    devices: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        """Equal plug-ins have one key, also after they were sent to a worker."""
        return hashlib.sha256(cloudpickle.dumps((self.make, sorted(self.options.items()), self.devices))).hexdigest()

    def load(self) -> Any:
        if not self.devices:
            return self.make(**self.options)
        for n, device in enumerate(self.devices, 1):
            try:
                return self.make(device=device, **self.options)
            except Exception as e:
                if n == len(self.devices):
                    raise
                log.warning("no model on %s (%s); trying the next device", device, e)
        raise AssertionError


def plugin(make: Plugin | Callable[..., Any], **options: Any) -> Plugin:
    return make if isinstance(make, Plugin) else Plugin(make, options)


def loaded(key: str, made_by: Plugin) -> Any:
    """This worker's model. key comes from the driver, so that it doesn't hang on how the plug-in travelled."""
    if key not in _LOADED:
        _LOADED[key] = made_by.load()
    return _LOADED[key]


def with_array(row: dict) -> dict:
    """The row with its pixels as an array (rows, columns, channels), None without."""
    import numpy as np

    data = row.get("pixels")
    return row | {"pixels": None if data is None else np.frombuffer(data, np.uint8).reshape(row["height_px"], row["width_px"], row["channels"])}


DETECTED = "image string, tile_id string, det_index int, bbox array<array<int>>, bbox_normalized array<array<double>>, rotation_angle int, tile_coordinates array<int>, detection_type string, error string"
_DETECTED = pa.schema([("image", pa.string()), ("tile_id", pa.string()), ("det_index", pa.int32()), ("bbox", pa.list_(pa.list_(pa.int32()))), ("bbox_normalized", pa.list_(pa.list_(pa.float64()))), ("rotation_angle", pa.int32()), ("tile_coordinates", pa.list_(pa.int32())), ("detection_type", pa.string()), ("error", pa.string())])


def detect_or_fail(tiles: DataFrame, make: Plugin | Callable[[], Callable], thresholds: dict[str, float] | None = None) -> DataFrame:
    """Detections of tiles (image, tile_id, x1, y1, x2, y2 and what the detector reads): 0 to n for each.
    A tile's box that can't be read is skipped, the others stay; a tile that can't be done is a row with error."""
    how, given = plugin(make), thresholds or {}
    key = how.key

    def found(tile: dict, model: Callable) -> list[dict]:
        w, h, out = max(1, tile["x2"] - tile["x1"]), max(1, tile["y2"] - tile["y1"]), []
        for k, box in enumerate(model(with_array(tile), **given)):
            try:
                x0, x1, y0, y1 = map(int, box)
            except (TypeError, ValueError):
                continue
            quad = [[x0, y0], [x1, y0], [x1, y1], [x0, y1]]
            out.append({"image": str(tile["image"]), "tile_id": tile["tile_id"], "det_index": k, "bbox": quad, "bbox_normalized": [[x / w, y / h] for x, y in quad], "rotation_angle": 90 if y1 - y0 > x1 - x0 else 0, "tile_coordinates": [tile[c] for c in ("x1", "y1", "x2", "y2")], "detection_type": "craft_detection"})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(key, how)
        for b in batches:
            for at in range(0, b.num_rows, 16):  # tiles with pixels are large
                out = []
                for tile in b.slice(at, 16).to_pylist():
                    try:
                        out += found(tile, model)
                    except Exception as e:  # whatever a model raises
                        out.append({"image": str(tile["image"]), "tile_id": tile["tile_id"], "error": f"{type(e).__name__}: {e}"})
                yield pa.RecordBatch.from_pylist(out, _DETECTED)

    return tiles.mapInArrow(run, DETECTED)


def detect(tiles: DataFrame, make: Plugin | Callable[[], Callable], thresholds: dict[str, float] | None = None) -> DataFrame:
    """The detections alone."""
    return detect_or_fail(tiles, make, thresholds).where(F.col("error").isNull()).drop("error")


PAGES = "stem string, page int, pages int, name string, height int, width int, channels int, pixels binary, error string"
_PAGES = pa.schema([("stem", pa.string()), ("page", pa.int32()), ("pages", pa.int32()), ("name", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())])


def rasterise(pdfs: DataFrame, make: Plugin | Callable[[], Callable[[bytes, int], list[tuple[int, int, int, bytes]]]], dpi: int, extension: str = "png") -> DataFrame:
    """A row for each page of PDF files (stem, content). The rasteriser gives height, width, channels and
    samples of all pages of a file; one that fails gives a row without pixels and with an error, and the others go on."""
    how = plugin(make)
    key = how.key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(key, how)
        for b in batches:
            for stem, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    found, error = list(model(content, dpi)), None
                except Exception as e:  # whatever a PDF library raises for a broken file
                    found, error = [(0, 0, 0, None)], f"{type(e).__name__}: {e}"
                for k, (h, w, c, data) in enumerate(found, 1):
                    name = f"{stem}.{extension}" if len(found) == 1 else f"{stem}_page_{k:02d}.{extension}"
                    yield pa.RecordBatch.from_pylist([{"stem": stem, "page": k, "pages": len(found), "name": name, "height": h, "width": w, "channels": c, "pixels": data, "error": error}], _PAGES)

    return pdfs.select("stem", "content").mapInArrow(run, PAGES)


_IMAGE = re.compile(rb"<<((?:[^<>]|<<[^<>]*>>|<[^<>]*>)*/Subtype\s*/Image(?:[^<>]|<<[^<>]*>>|<[^<>]*>)*)>>\s*stream\r?\n", re.S)


def scanned_pages() -> Callable[[bytes, int], list[tuple[int, int, int, bytes]]]:
    """A rasteriser for scans: PDF files whose pages are one image each, of 8-bit grey or RGB samples, plain or
    deflated. The image is scaled to its page at the resolution asked for. Other files raise ValueError."""
    import numpy as np

    from .sources.readers import page_boxes

    def number(head: bytes, name: bytes) -> int:
        m = re.search(rb"/" + name + rb"\s+(\d+)", head)
        return int(m[1]) if m else 0

    def pages(content: bytes, dpi: int) -> list[tuple[int, int, int, bytes]]:
        out, boxes = [], page_boxes(content)
        for k, m in enumerate(_IMAGE.finditer(content)):
            head = m[1]
            w, h, channels = number(head, b"Width"), number(head, b"Height"), 3 if b"/DeviceRGB" in head else 1
            if number(head, b"BitsPerComponent") != 8 or b"/DCTDecode" in head or b"/Predictor" in head:
                raise ValueError("an image of another kind than plain 8-bit samples")
            data = content[m.end() :]
            data = zlib.decompressobj().decompress(data) if b"/FlateDecode" in head else data
            image = np.frombuffer(data[: h * w * channels], np.uint8).reshape(h, w, channels)
            if k < len(boxes):
                height, width = (max(1, round((boxes[k][n + 2] - boxes[k][n]) * dpi / 72)) for n in (1, 0))
                image = image[(np.arange(height) * h // height)[:, None], (np.arange(width) * w // width)[None, :]]
            image = image[:, :, ::-1]  # blue first, as Spark's images have it
            out.append((*image.shape, image.tobytes()))
        if not out:
            raise ValueError("no page that is an image")
        return out

    return pages


def stub_detector() -> Callable[..., list[list[float]]]:
    """Two boxes in every tile, by its place."""
    return lambda t, **_: [[8.6, 8 + 40 + (t["x1"] + t["y1"]) % 23, 10.2, 26], [30, 44, 60, 60 + 50 + t["x1"] % 17]]


def stub_recogniser(name: str, sure: int) -> Callable[[list[dict]], list[tuple[str, float, int] | None]]:
    """Text from the crop's name; every sure-th crop isn't recognised with confidence."""
    return lambda rows: [(f"{name}-{r['crop_filename']}", 0.5 if int(r["crop_filename"][5:9]) % sure == 0 else 0.99, 1) for r in rows]
