"""Where overlays put boxes and labels. Drawing itself is up to a renderer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G

PAD = 5  # Fixed value: pixels around a label; labels stand twice as far from their box


def overlay_orientation(quad: Column) -> Column:
    """unknown with fewer than four points; a square is vertical."""
    x0, y0, x1, y1 = G.envelope(quad)
    return F.when(F.size(quad) < 4, "unknown").when((x1 - x0) > (y1 - y0), "horizontal").otherwise("vertical")


def overlay_colour(orientation: Column) -> Column:
    """Blue, green, red as the image libraries have them."""
    return F.when(orientation == "horizontal", "0,255,0").when(orientation == "vertical", "0,0,255").otherwise("128,128,128")


def on_page(x: Column, offset: Column, size: Column) -> Column:
    """A coordinate moved by its tile's and kept on the page."""
    return F.greatest(F.lit(0), F.least((x + F.coalesce(offset, F.lit(0))).cast("long"), size - 1))


def is_quad(quad: Column) -> Column:
    return F.coalesce((F.size(quad) == 4) & F.forall(quad, lambda p: F.size(p) == 2), F.lit(False))


def label_places(rows: DataFrame) -> DataFrame:
    """Adds label_x and label_y, the left end of a label's base line, and its background's corners.

    Labels of upright texts (orientation 90) stand to the right of the box at its top, or to the left
    where there is no room; others above it, or below. The background surrounds the label as placed;
    then both are kept on the page. rows: the box, orientation, text_w, text_h, baseline, width, height.
    """
    b = G.Box.of()
    w, h, page_w, page_h = F.col("text_w"), F.col("text_h"), F.col("width"), F.col("height")
    upright, pad = F.col("orientation") == 90, F.lit(PAD)
    beside = F.when(b.x1 + w + 3 * PAD <= page_w, b.x1 + 2 * PAD).otherwise(F.greatest(b.x0 - w - 2 * PAD, pad))
    level = F.when(b.y0 - h - 2 * PAD >= 0, b.y0 - 2 * PAD).otherwise(b.y1 + h + 2 * PAD)
    x = F.when(upright, beside).otherwise(b.x0)
    y = F.when(upright, F.greatest(b.y0 + h, h + PAD)).otherwise(level)
    placed = rows.withColumns({"_x": x, "_y": y})
    x, y = F.col("_x"), F.col("_y")
    return placed.withColumns({
        "label_x": F.greatest(F.lit(0), F.least(x, page_w - w)), "label_y": F.greatest(h, F.least(y, page_h)),
        "back_x0": F.greatest(F.lit(0), x - PAD), "back_y0": F.greatest(F.lit(0), y - h - PAD),
        "back_x1": F.least(page_w, x + w + PAD), "back_y1": F.least(page_h, y + F.col("baseline") + PAD),
    }).drop("_x", "_y")
