"""Pixels to PDF points, and whether an image has its PDF's dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Coordinates


def to_points(quad: Column, dpi: float) -> Column:
    """Points of 1/72 inch from the top left, four decimals."""
    return F.transform(quad, lambda p: F.transform(p, lambda v: F.round(v * F.lit(72.0 / dpi), 4)))


def dimension_check(width: Column, height: Column, pdf_w: Column, pdf_h: Column, c: Coordinates) -> dict[str, Column]:
    """Expected size, scale and difference by axis, and whether both differences are within tolerance."""
    scale = F.lit(c.image_dpi / 72.0)
    out: dict[str, Column] = {}
    within = F.lit(True)
    for name, px, pt in (("w", width, pdf_w), ("h", height, pdf_h)):
        wanted = pt * scale
        off = F.when(wanted > 0, F.abs(wanted - px) / wanted * 100).otherwise(F.lit(100.0))
        out[f"expected_{name}"] = F.bround(wanted).cast("long")
        out[f"scale_{name}"] = F.when(pt > 0, px / pt).otherwise(F.lit(0.0))
        out[f"difference_{name}"] = F.bround(off, 2)
        within = within & (off <= c.tolerance_percent)
    missing = width.isNull() | height.isNull() | pdf_w.isNull() | pdf_h.isNull()
    return out | {"compatible": F.coalesce(within, F.lit(False)), "error": F.when(missing, "Missing image size or PDF dimensions")}


def pdf_stem(name: Column) -> Column:
    return F.replace(name, F.lit("_final"), F.lit(""))


def validate(images: DataFrame, pdfs: DataFrame, c: Coordinates) -> DataFrame:
    """image, compatible, error for each image (image, width, height, and error where its annotations couldn't be
    read), by the PDF of its name (stem, pdf_path, pdf_w, pdf_h). error: the first reason for which sizes couldn't
    be compared."""
    named = images.withColumn("stem", pdf_stem(F.col("image"))).join(pdfs, "stem", "left")
    checks = dimension_check(F.col("width"), F.col("height"), F.col("pdf_w"), F.col("pdf_h"), c)
    unread = F.col("error") if "error" in images.columns else F.lit(None).cast("string")
    error = (
        F.when(unread.isNotNull(), unread)
        .when(F.col("width").isNull() | F.col("height").isNull(), "image size missing")
        .when(F.lit(c.pdf_base_dir is None), "PDF folder not configured")
        .when(F.col("pdf_path").isNull(), "PDF not found")
        .when(F.col("pdf_w").isNull() | F.col("pdf_h").isNull(), "PDF dimensions unreadable")
    )
    return named.select("image", F.coalesce(checks["compatible"] & error.isNull(), F.lit(False)).alias("compatible"), F.coalesce(error, checks["error"]).alias("error"))


def annotation_sizes(annotations: DataFrame, broken: DataFrame) -> DataFrame:
    """What validate takes, from annotation files' rows (file_path, original_image_size) and the files that can't
    be read (file_path): a row for each file, with the size its first item has or the error."""
    name = lambda c: F.regexp_extract(c, r"([^/\\\\]*?)(\.[^./\\\\]*)?$", 1)
    size = F.first("original_image_size", ignorenulls=True)
    good = annotations.groupBy(name(F.col("file_path")).alias("image")).agg(size.alias("s"))
    good = good.select("image", F.get("s", F.lit(0)).alias("width"), F.get("s", F.lit(1)).alias("height"), F.lit(None).cast("string").alias("error"))
    bad = broken.select(name(F.col("file_path")).alias("image"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit("annotations unreadable").alias("error"))
    return good.unionByName(bad)


def validation_failures(validated: DataFrame) -> DataFrame:
    """The images that aren't compatible, a row each; validation_summary has their names in one cell, for a report."""
    return validated.where(~F.col("compatible")).select("image", "error")


def validation_summary(validated: DataFrame) -> DataFrame:
    """Counts, and the names that aren't compatible in the order of their stems (null if there are none)."""
    order = F.struct(F.regexp_replace("image", "_final$", "").alias("stem"), "image")
    names = F.transform(F.array_sort(F.collect_list(F.when(~F.col("compatible"), order))), lambda x: x["image"])
    return validated.agg(F.count(F.lit(1)).alias("images"), F.count_if("compatible").alias("compatible"), F.when(F.size(names) > 0, F.array_join(names, ",")).alias("failing"))
