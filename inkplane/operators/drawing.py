"""Overlays: boxes drawn as outlines on page pixels, by orientation or in one colour.

Quads that aren't boxes are drawn as polygons. Text itself needs a font: a renderer plugs in (a maker of a
function text -> array of rows and columns, 0 to 255); labels' places and backgrounds come from layout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models import Plugin, loaded, plugin
from . import layout


def with_colours(boxes: DataFrame) -> DataFrame:
    """Adds orientation and colour (b,g,r) of quads."""
    named = boxes.withColumn("orientation", layout.overlay_orientation(F.col("bbox")))
    return named.withColumn("colour", layout.overlay_colour(F.col("orientation")))


def outlined(pages: DataFrame, boxes: DataFrame, thickness: int = 2) -> DataFrame:
    """Pages (image, pixels, height_px, width_px, channels) with the outlines of their boxes (image, x0, y0,
    x1, y1, colour), clipped to the page. Pages without boxes stay as they are."""
    lists = boxes.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("x0", "y0", "x1", "y1", "colour"))).alias("boxes"))
    both = pages.select("image", "pixels", "height_px", "width_px", "channels").join(lists, "image", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                page = np.frombuffer(r["pixels"], np.uint8).reshape(r["height_px"], r["width_px"], r["channels"]).copy()
                for x in r.pop("boxes") or ():
                    colour = [int(c) for c in x["colour"].split(",")][: r["channels"]]
                    x0, x1 = (min(max(0, x[c]), r["width_px"] - 1) for c in ("x0", "x1"))
                    y0, y1 = (min(max(0, x[c]), r["height_px"] - 1) for c in ("y0", "y1"))
                    for rows_, cols in ((slice(y0, y0 + thickness), slice(x0, x1 + 1)), (slice(max(y0, y1 - thickness + 1), y1 + 1), slice(x0, x1 + 1)), (slice(y0, y1 + 1), slice(x0, x0 + thickness)), (slice(y0, y1 + 1), slice(max(x0, x1 - thickness + 1), x1 + 1))):
                        page[rows_, cols] = colour
                r["pixels"] = page.tobytes()
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([f for f in b.schema if f.name != "boxes"]))

    return both.mapInArrow(run, "image string, pixels binary, height_px int, width_px int, channels int")


def line_points(x0: int, y0: int, x1: int, y1: int):
    """The pixels from one point to another, both included."""
    import numpy as np

    n = max(abs(x1 - x0), abs(y1 - y0)) + 1
    return np.rint(np.linspace(x0, x1, n)).astype(int), np.rint(np.linspace(y0, y1, n)).astype(int)


def drawn(pages: DataFrame, shapes: DataFrame, thickness: int = 2, renderer: Plugin | Callable | None = None) -> DataFrame:
    """Pages (image, pixels, height_px, width_px, channels) with quads drawn as polygons and labels on a white
    ground, clipped to the page. shapes: image, bbox, colour, and for labels text, label_x, label_y (the left end of
    the base line) and back_x0, back_y0, back_x1, back_y1; rows without text have no label. Without a renderer the
    ground alone is drawn."""
    labelled = "text" in shapes.columns
    fields = ["bbox", "colour", *(["text", "label_x", "label_y", "back_x0", "back_y0", "back_x1", "back_y1"] if labelled else [])]
    lists = shapes.groupBy("image").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("shapes"))
    both = pages.select("image", "pixels", "height_px", "width_px", "channels").join(lists, "image", "left")
    how = plugin(renderer) if renderer else None
    key = how.key if how else ""

    def draw(page, x: dict, font: Callable | None) -> None:
        import numpy as np

        height, width, channels = page.shape
        colour = [int(c) for c in x["colour"].split(",")][:channels]
        quad = [p for p in x["bbox"] or () if len(p) >= 2]
        for a, b in zip(quad, [*quad[1:], *quad[:1]], strict=True):
            xs, ys = line_points(int(a[0]), int(a[1]), int(b[0]), int(b[1]))
            for dx in range(thickness):
                for dy in range(thickness):
                    on = (xs + dx >= 0) & (xs + dx < width) & (ys + dy >= 0) & (ys + dy < height)
                    page[ys[on] + dy, xs[on] + dx] = colour
        if x.get("text"):
            x0, y0, x1, y1 = (int(x[f"back_{c}"]) for c in ("x0", "y0", "x1", "y1"))
            page[max(0, y0) : max(0, y1), max(0, x0) : max(0, x1)] = 255
            if font is not None:
                ink = np.asarray(font(x["text"]))
                top, left = max(0, int(x["label_y"]) - ink.shape[0]), max(0, int(x["label_x"]))
                place = page[top : top + ink.shape[0], left : left + ink.shape[1]]
                place[ink[: place.shape[0], : place.shape[1]] > 127] = colour

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        font = loaded(key, how) if how else None
        for b in batches:
            for k in range(b.num_rows):  # a page is large
                r = b.slice(k, 1).to_pylist()[0]
                page = np.frombuffer(r["pixels"], np.uint8).reshape(r["height_px"], r["width_px"], r["channels"]).copy()
                for x in r.pop("shapes") or ():
                    draw(page, x, font)
                yield pa.RecordBatch.from_pylist([r | {"pixels": page.tobytes()}], schema=pa.schema([f for f in b.schema if f.name != "shapes"]))

    return both.mapInArrow(run, "image string, pixels binary, height_px int, width_px int, channels int")
