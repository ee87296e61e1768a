"""Counts and ratios of the grouping steps, all from their row tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import LINKING

COUNTED = (*LINKING, "horizontal_text_poor_vertical_alignment", "horizontal_text_too_distant", "vertical_text_poor_horizontal_alignment", "vertical_text_too_distant")


def ratio(part, whole):
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(None).cast("double"))


def suppression_stats(boxes: DataFrame, gone: DataFrame) -> DataFrame:
    before = boxes.groupBy("image").agg(F.count(F.lit(1)).alias("before"))
    lost = gone.groupBy("image").agg(F.count(F.lit(1)).alias("suppressed"))
    both = before.join(lost, "image", "left").withColumn("suppressed", F.coalesce("suppressed", F.lit(0)))
    return both.select("image", "before", (F.col("before") - F.col("suppressed")).alias("after"), "suppressed", ratio(F.col("suppressed"), F.col("before")).alias("rate"))


def connection_stats(boxes: DataFrame, decided: DataFrame) -> DataFrame:
    """Reasons by image over all pairs. Pairs that fail the primary filter aren't enumerated: mismatches
    are horizontal times vertical boxes, and what is left of all pairs is out of reach."""
    n = boxes.groupBy("image").agg(F.count(F.lit(1)).alias("m"), F.count_if((F.col("x1") - F.col("x0")) > (F.col("y1") - F.col("y0"))).alias("flat"))
    by = decided.groupBy("image").agg(F.count(F.lit(1)).alias("near"), *(F.count_if(F.col("reason") == r).alias(r) for r in COUNTED))
    all_pairs = n.join(by, "image", "left").na.fill(0)
    mismatch = F.col("flat") * (F.col("m") - F.col("flat"))
    pairs = F.expr("m * (m - 1) div 2")
    return all_pairs.select("image", pairs.alias("pairs"), mismatch.alias("orientation_mismatch"), (pairs - mismatch - F.col("near")).alias("not_spatial_neighbors"), *COUNTED)


def graph_stats(boxes: DataFrame, edges: DataFrame) -> DataFrame:
    n = boxes.groupBy("image").agg(F.count(F.lit(1)).alias("nodes"))
    e = edges.groupBy("image").agg(F.count(F.lit(1)).alias("edges"))
    c = edges.select("image", F.explode(F.array("i", "j")).alias("idx")).distinct().groupBy("image").agg(F.count(F.lit(1)).alias("connected"))
    return n.join(e, "image", "left").join(c, "image", "left").na.fill(0).select("image", "nodes", "edges", "connected", (F.col("nodes") - F.col("connected")).alias("isolated"))


def component_sizes(placed: DataFrame) -> DataFrame:
    return placed.groupBy("image", "component").agg(F.count(F.lit(1)).alias("size"))


def component_histogram(placed: DataFrame) -> DataFrame:
    return component_sizes(placed).groupBy("size").agg(F.count(F.lit(1)).alias("components"))


def merge_stats(members: DataFrame, kept: DataFrame) -> DataFrame:
    """By image: merges done, members filtered as duplicates, components with merges."""
    before = component_sizes(members)
    after = kept.groupBy("image", "component").agg(F.count(F.lit(1)).alias("kept"))
    both = before.join(after, ["image", "component"], "left").na.fill(0, ["kept"])
    return both.groupBy("image").agg(F.sum(F.greatest(F.col("kept") - 1, F.lit(0))).alias("merges"), F.sum(F.col("size") - F.col("kept")).alias("filtered"), F.count_if(F.col("kept") > 1).alias("components_with_merges"))


def image_summary(boxes: DataFrame, placed: DataFrame, edges: DataFrame) -> DataFrame:
    n = boxes.groupBy("image").agg(F.count(F.lit(1)).alias("before"))
    c = component_sizes(placed).groupBy("image").agg(F.count(F.lit(1)).alias("after"))
    e = edges.groupBy("image").agg(F.count(F.lit(1)).alias("edges"))
    both = n.join(c, "image", "left").join(e, "image", "left").na.fill(0)
    return both.select("image", "before", "after", "edges", ratio(F.col("before") - F.col("after"), F.col("before")).alias("reduction_ratio"))


def global_summary(summary: DataFrame) -> DataFrame:
    total = summary.agg(F.count(F.lit(1)).alias("images"), F.coalesce(F.sum("before"), F.lit(0)).alias("before"), F.coalesce(F.sum("after"), F.lit(0)).alias("after"), F.avg("after").alias("avg_after"), F.min("after").alias("min_after"), F.max("after").alias("max_after"))
    return total.select("*", ratio(F.col("before") - F.col("after"), F.col("before")).alias("reduction_ratio"))


def time_summary(runs: DataFrame) -> DataFrame:
    """Total, average, least and greatest seconds of run records."""
    s = F.col("processing_time").cast("double")
    return runs.agg(F.count(F.lit(1)).alias("runs"), F.sum(s).alias("total_s"), F.avg(s).alias("avg_s"), F.min(s).alias("min_s"), F.max(s).alias("max_s"))


def detection_totals(detections: DataFrame) -> DataFrame:
    """By image, and over all where image is null."""
    return detections.rollup("image").agg(F.count(F.lit(1)).alias("detections"))


def before_and_after(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """By image, boxes before and regions after grouping, by orientation."""
    flat = F.col("x1") - F.col("x0") > F.col("y1") - F.col("y0")
    both = boxes.select("image", flat.alias("flat"), F.lit(False).alias("after")).unionByName(regions.select("image", flat.alias("flat"), F.lit(True).alias("after")))
    count = lambda after, wide: F.count_if((F.col("after") == after) & (F.col("flat") == wide))
    return both.groupBy("image").agg(*(count(a, w).alias(f"{'after' if a else 'before'}_{'horizontal' if w else 'vertical'}") for a in (False, True) for w in (True, False)))


def orientation_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("orientation").agg(F.count_if("drawn").alias("drawn"), F.count_if(~F.col("drawn")).alias("skipped"))
