"""Queries over the derived tables, one for each operator, with the SQL that says the same.

Results are flat: coordinates as numbers, lists as comma-joined strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import models
from ..config import Config, Coordinates, Cropping, Grouping, Recognition, Tiling
from ..functions import geometry as G
from ..operators import coordinates, crops, grouping, layout, recognition, statistics, tiling
from ..sources import readers
from . import fixture as X

CONFIG = Config()
SCANNED = Coordinates(pdf_base_dir="pdfs")
#: Suppression off, so that the larger-box filter has something to do.
NO_SUPPRESSION = Grouping(contained_box_threshold=1.0, high_iou_threshold=0.8)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *ctes: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = (f"WITH RECURSIVE {','.join(ctes)} " if ctes else "") + sql
        return f

    return add


def _flat(quad: str = "bbox") -> list:
    return [F.col(quad)[k][j].alias(f"{'xy'[j]}{k + 1}") for k in range(4) for j in range(2)]


def _live(spark: SparkSession, d: str, g: Grouping = CONFIG.grouping) -> DataFrame:
    return grouping.survivors(X.boxes(spark, d), g)


def _placed(spark: SparkSession, d: str, g: Grouping = CONFIG.grouping) -> tuple[DataFrame, DataFrame]:
    live, edges = grouping.linked(X.boxes(spark, d), g)
    return live.join(grouping.components(live, edges), ["image", "idx"]), edges


def _regions(spark: SparkSession, d: str) -> DataFrame:
    placed, _ = _placed(spark, d)
    n = F.row_number().over(Window.partitionBy("image").orderBy("component")) - 1
    return grouping.merge_clusters(placed).withColumns({"crop_idx": n, "width": F.lit(X.PAGE_W).cast("long"), "height": F.lit(X.PAGE_H).cast("long")})


#: All pairs of an image, and the reason of the decision on each.
ALL_PAIRS = f"pairs AS (SELECT a.image, a.idx AS i, b.idx AS j, {X.PAIR} FROM box a JOIN box b ON a.image = b.image AND a.idx < b.idx)"
ALL_DECIDED = f"{ALL_PAIRS}, reasons AS (SELECT image, i, j, {X.REASON} AS reason FROM pairs)"
OVERLAPS = "FROM pairs WHERE shared > 0"
IOU = "shared::DOUBLE / (area_a + area_b - shared) AS iou"
SHARES = "shared::DOUBLE / area_a AS share_i, shared::DOUBLE / area_b AS share_j"
PASSING = "FROM reasons WHERE NOT starts_with(reason, 'primary')"
I, J = G.Box.of(suffix="_i"), G.Box.of(suffix="_j")
BOX = G.Box.of()


# Geometry of single boxes.


@query("SELECT image, idx, x0 AS x1, y0 AS y1, x1 AS x2, y0 AS y2, x1 AS x3, y1 AS y3, x0 AS x4, y1 AS y4 FROM box", X.BOX_CTE)
def box_corners(spark, d):
    return X.boxes(spark, d).withColumn("bbox", G.corners(BOX)).select("image", "idx", *_flat())


@query("SELECT image, idx, CASE WHEN y1 - y0 > x1 - x0 THEN 90 ELSE 0 END AS detector, x1 - x0 > y1 - y0 AS horizontal FROM box", X.BOX_CTE)
def orientation(spark, d):
    return X.boxes(spark, d).select("image", "idx", G.detector_angle(BOX).alias("detector"), BOX.horizontal.alias("horizontal"))


@query("SELECT image, idx, x0, y0, x1, y1, x1 - x0 AS width, y1 - y0 AS height, (x0 + x1) / 2.0::DOUBLE AS center_x, (y0 + y1) / 2.0::DOUBLE AS center_y FROM box", X.BOX_CTE)
def box_params(spark, d):
    quads = X.boxes(spark, d).select("image", "idx", G.corners(BOX).alias("bbox"))
    e = quads.select("image", "idx", *(c.alias(n) for c, n in zip(G.envelope(F.col("bbox")), grouping.BOX, strict=True)))
    return e.select("*", BOX.w.alias("width"), BOX.h.alias("height"), BOX.cx.alias("center_x"), BOX.cy.alias("center_y"))


def _normal_sql(w: str, h: str, where: str = "") -> str:
    return f"SELECT image, idx, " + ", ".join(f"({x})::DOUBLE / {s} AS {n}" for n, x, s in (("x1", "x0", w), ("y1", "y0", h), ("x2", "x1", w), ("y2", "y0", h), ("x3", "x1", w), ("y3", "y1", h), ("x4", "x0", w), ("y4", "y1", h))) + f" FROM box {where}"


@query(_normal_sql("720", "720"), X.BOX_CTE)
def bbox_norm_tile(spark, d):
    quad = G.normalised(G.corners(BOX), F.lit(720), F.lit(720))
    return X.boxes(spark, d).select("image", "idx", quad.alias("bbox")).select("image", "idx", *_flat())


@query(_normal_sql("CASE WHEN c % 11 = 5 THEN 1 ELSE 1400 END", "CASE WHEN c % 11 = 5 THEN 1 ELSE 1800 END", "WHERE c % 13 <> 3"), X.BOX_CTE)
def bbox_norm_page(spark, d):
    size = F.expr("if(c % 13 = 3, array(), array(if(c % 11 = 5, 0, 1400), 1800))")
    rows = X.boxes(spark, d).withColumn("original_image_size", size).withColumns({"tile_ids": F.array("tile_id"), "rotation_angle": F.lit(0), "source_image": F.lit(""), "detection_type": F.lit("")})
    out = tiling.grouped_output(rows.withColumn("image", F.struct("image", "idx")))
    return out.select("image.image", "image.idx", *_flat("bbox_normalized"))


@query("SELECT image, idx, x0 + CASE WHEN c % 13 = 0 THEN 0 ELSE (n % 10) * 100 END AS x0, y0 + CASE WHEN c % 13 = 0 THEN 0 ELSE (n // 10) * 50 END AS y0, x1 + CASE WHEN c % 13 = 0 THEN 0 ELSE (n % 10) * 100 END AS x1, y1 + CASE WHEN c % 13 = 0 THEN 0 ELSE (n // 10) * 50 END AS y1 FROM box", X.BOX_CTE)
def to_global(spark, d):
    rows = X.boxes(spark, d).select("image", "idx", "tile_id", G.corners(BOX).alias("bbox"), F.expr("if(c % 13 = 0, array((n % 10) * 100), array((n % 10) * 100, (n div 10) * 50, 0, 0))").alias("tile_coordinates"))
    return tiling.to_page(rows).select("image", "idx", *grouping.BOX)


@query("SELECT image, idx, CASE WHEN c % 9 = 0 THEN 0 ELSE n // 10 END::INT AS number FROM box", X.BOX_CTE)
def tile_number(spark, d):
    tile = F.expr("if(c % 9 = 0, if(c % 2 = 0, concat(tile_id, 'x'), 'plain'), concat('a_T1', tile_id))")
    return X.boxes(spark, d).select("image", "idx", tiling.tile_number(tile).alias("number"))


@query("SELECT image, tile_idx, image || '_T' || lpad(tile_idx::VARCHAR, 4, '0') AS tile_id FROM tile", X.TILE_CTE)
def tile_ids(spark, d):
    return tiling.tile_grid(X.images(spark, d).where(tiling.large_enough(F.col("width"), F.col("height"), CONFIG.tiling)), CONFIG.tiling).select("image", "tile_idx", "tile_id")


# Pairs.


@query(f"SELECT image, i, j, {IOU} {OVERLAPS}", X.BOX_CTE, ALL_PAIRS)
def pair_iou(spark, d):
    """Of all pairs of an image; those that aren't listed share no area."""
    return pair_overlaps(spark, d).select("image", "i", "j", "iou")


@query(f"SELECT image, i, j, {SHARES} {OVERLAPS}", X.BOX_CTE, ALL_PAIRS)
def pair_iol(spark, d):
    """Of all pairs of an image; those that aren't listed share no area."""
    return pair_overlaps(spark, d).select("image", "i", "j", "share_i", "share_j")


@query("SELECT image, i, j, victim FROM conflict", X.BOX_CTE, X.GONE_CTE)
def contained_pairs(spark, d):
    return grouping.conflicts(X.boxes(spark, d), CONFIG.grouping)


@query(f"SELECT image, i, j {PASSING}", X.BOX_CTE, ALL_DECIDED)
def primary_filter(spark, d):
    """The pairs of an image that pass; all others fail."""
    return grouping.reach_pairs(X.boxes(spark, d), CONFIG.grouping).select("image", "i", "j")


@query(f"SELECT image, i, j, reason {PASSING}", X.BOX_CTE, ALL_DECIDED)
def connect_reason(spark, d):
    """The decision on all pairs of an image that pass the primary filter; pairs that aren't listed fail it."""
    return grouping.decided_pairs(X.boxes(spark, d), CONFIG.grouping)


@query(f"SELECT image, i, j, {IOU}, {SHARES} {OVERLAPS}", X.BOX_CTE, ALL_PAIRS)
def pair_overlaps(spark, d):
    """IoU and contained shares of all pairs of an image; pairs that aren't listed share no area."""
    return grouping.overlapping(X.boxes(spark, d), CONFIG.grouping)


@query(f"SELECT image, reason, count(*) AS pairs {PASSING} GROUP BY image, reason", X.BOX_CTE, ALL_DECIDED)
def reason_totals(spark, d):
    """How many pairs each rule decides, by image."""
    return connect_reason(spark, d).groupBy("image", "reason").agg(F.count(F.lit(1)).alias("pairs"))


@query(f"SELECT image, i, j, reason {PASSING}", X.BOX_CTE, ALL_DECIDED)
def pair_reasons(spark, d):
    """The same as connect_reason, under the name that says it has all pairs."""
    return connect_reason(spark, d)


@query("SELECT image, i, j, reason FROM edge", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE)
def link_edges(spark, d):
    return grouping.linked(X.boxes(spark, d), CONFIG.grouping)[1]


# Grouping.


@query("SELECT image, idx, x0, y0, x1, y1 FROM live", X.BOX_CTE, X.GONE_CTE)
def suppress_contained(spark, d):
    return _live(spark, d).select("image", "idx", *grouping.BOX)


@query("SELECT image, idx, component FROM comp", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def components(spark, d):
    return _placed(spark, d)[0].select("image", "idx", "component")


KEEP_CTE = f"""
live AS (SELECT * FROM box), {X.EDGE_CTE}, {X.COMPONENT_CTE},
worse AS (SELECT DISTINCT image, idx FROM (SELECT a.image, a.idx, {X.PAIR} FROM placed a JOIN placed b ON a.image = b.image AND a.component = b.component AND a.idx <> b.idx)
  WHERE area_a < area_b AND shared::DOUBLE / (area_a + area_b - shared) > 0.8::DOUBLE),
kept AS (SELECT p.* FROM placed p WHERE NOT EXISTS (SELECT 1 FROM worse w WHERE w.image = p.image AND w.idx = p.idx))"""


@query("SELECT image, idx, component FROM kept", X.BOX_CTE, KEEP_CTE)
def keep_larger(spark, d):
    placed, _ = _placed(spark, d, NO_SUPPRESSION)
    return grouping.keep_larger(placed, NO_SUPPRESSION).select("image", "idx", "component")


@query("SELECT image, component, x0, y0, x1, y1, tile_ids, n_boxes, first_c FROM region", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def merge_clusters(spark, d):
    placed, _ = _placed(spark, d)
    merged = grouping.merge_clusters(placed.withColumn("rotation_angle", F.col("c")))
    return merged.select("image", "component", *grouping.BOX, F.array_join("tile_ids", ",").alias("tile_ids"), "n_boxes", F.col("rotation_angle").alias("first_c"))


OUTPUT = "x0 AS x1, y0 AS y1, x1 AS x2, y0 AS y2, x1 AS x3, y1 AS y3, x0 AS x4, y1 AS y4"


@query(f"SELECT image, {OUTPUT}, x0::DOUBLE / 1400 AS left_share, y1::DOUBLE / 1800 AS bottom_share, tile_ids, n_tiles > 1 AS is_grouped FROM region", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def grouped_output(spark, d):
    rows = _regions(spark, d).withColumns({"original_image_size": F.array("width", "height"), "rotation_angle": F.lit(0), "source_image": F.lit(""), "detection_type": F.lit("craft_detection")})
    out = tiling.grouped_output(rows)
    return out.select("image", *_flat(), F.col("bbox_normalized")[0][0].alias("left_share"), F.col("bbox_normalized")[2][1].alias("bottom_share"), F.array_join("grouped_from_tiles", ",").alias("tile_ids"), "is_grouped")


@query("SELECT image, component, x0, y0, x1, y1, n_boxes FROM region", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def group_boxes(spark, d):
    return grouping.group_boxes(X.boxes(spark, d), CONFIG.grouping).select("image", "component", *grouping.BOX, "n_boxes")


# Statistics.


@query("SELECT b.image, b.n AS before, b.n - coalesce(g.n, 0) AS after, coalesce(g.n, 0) AS suppressed, coalesce(g.n, 0)::DOUBLE / b.n AS rate FROM (SELECT image, count(*) AS n FROM box GROUP BY image) b LEFT JOIN (SELECT image, count(*) AS n FROM gone GROUP BY image) g USING (image)", X.BOX_CTE, X.GONE_CTE)
def suppression_stats(spark, d):
    b = X.boxes(spark, d)
    return statistics.suppression_stats(b, grouping.suppressed(grouping.conflicts(b, CONFIG.grouping)))


@query(
    """SELECT b.image, count(*) AS pairs FROM box a JOIN box b ON a.image = b.image AND a.idx < b.idx
  LEFT JOIN death p ON p.image = a.image AND p.idx = a.idx LEFT JOIN death q ON q.image = b.image AND q.idx = b.idx
  WHERE (p.i IS NULL OR a.idx < p.i OR (a.idx = p.i AND b.idx <= p.j)) AND (q.i IS NULL OR a.idx < q.i OR (a.idx = q.i AND b.idx <= q.j)) GROUP BY b.image""",
    X.BOX_CTE, X.GONE_CTE,
    "death AS (SELECT s.image, s.victim AS idx, s.i, s.j FROM fold f JOIN fold p ON p.image = f.image AND p.r = f.r - 1 AND len(f.dead) > len(p.dead) JOIN seq s ON s.image = f.image AND s.r = f.r)",
)
def pairs_checked(spark, d):
    b = X.boxes(spark, d)
    return grouping.pairs_checked(b, grouping.conflicts(b, CONFIG.grouping))


@query("SELECT image, count(*) AS pairs, count(*) FILTER (reason LIKE '%mismatch') AS orientation_mismatch, count(*) FILTER (reason LIKE '%neighbors') AS not_spatial_neighbors, " + ", ".join(f"count(*) FILTER (reason = '{r}') AS {r}" for r in statistics.COUNTED) + " FROM decided GROUP BY image", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE)
def connection_stats(spark, d):
    live, _ = grouping.linked(X.boxes(spark, d), CONFIG.grouping)
    return statistics.connection_stats(live, grouping.decided_pairs(live, CONFIG.grouping))


@query("SELECT n.image, nodes, coalesce(edges, 0) AS edges, coalesce(connected, 0) AS connected, nodes - coalesce(connected, 0) AS isolated FROM (SELECT image, count(*) AS nodes FROM live GROUP BY image) n LEFT JOIN (SELECT image, count(*) AS edges FROM edge GROUP BY image) e USING (image) LEFT JOIN (SELECT image, count(DISTINCT u) AS connected FROM (SELECT image, i AS u FROM edge UNION ALL SELECT image, j FROM edge) GROUP BY image) c USING (image)", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE)
def graph_stats(spark, d):
    return statistics.graph_stats(*grouping.linked(X.boxes(spark, d), CONFIG.grouping))


@query("SELECT n_boxes AS size, count(*) AS components FROM region GROUP BY n_boxes", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def component_hist(spark, d):
    return statistics.component_histogram(_placed(spark, d)[0])


@query("SELECT image, sum(greatest(k - 1, 0))::BIGINT AS merges, sum(n - k)::BIGINT AS filtered, count(*) FILTER (k > 1) AS components_with_merges FROM (SELECT p.image, p.component, p.n, coalesce(q.n, 0) AS k FROM (SELECT image, component, count(*) AS n FROM placed GROUP BY image, component) p LEFT JOIN (SELECT image, component, count(*) AS n FROM kept GROUP BY image, component) q USING (image, component)) GROUP BY image", X.BOX_CTE, KEEP_CTE)
def merge_stats(spark, d):
    placed, _ = _placed(spark, d, NO_SUPPRESSION)
    return statistics.merge_stats(placed, grouping.keep_larger(placed, NO_SUPPRESSION))


SUMMARY_CTE = "summary AS (SELECT b.image, b.n AS before, r.n AS after, coalesce(e.n, 0) AS edges, (b.n - r.n)::DOUBLE / b.n AS reduction_ratio FROM (SELECT image, count(*) AS n FROM box GROUP BY image) b JOIN (SELECT image, count(*) AS n FROM region GROUP BY image) r USING (image) LEFT JOIN (SELECT image, count(*) AS n FROM edge GROUP BY image) e USING (image))"


@query("SELECT * FROM summary", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE, SUMMARY_CTE)
def image_summary(spark, d):
    placed, edges = _placed(spark, d)
    return statistics.image_summary(X.boxes(spark, d), placed, edges)


@query("SELECT count(*) AS images, sum(before)::BIGINT AS before, sum(after)::BIGINT AS after, avg(after)::DOUBLE AS avg_after, min(after) AS min_after, max(after) AS max_after, (sum(before) - sum(after))::DOUBLE / sum(before) AS reduction_ratio FROM summary", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE, SUMMARY_CTE)
def global_summary(spark, d):
    return statistics.global_summary(image_summary(spark, d))


@query("SELECT image, count(*) FILTER (c % 10 <> 0 AND c % 13 <> 0) AS valid, count(*) FILTER (c % 10 = 0 OR c % 13 = 0) AS rejected FROM box GROUP BY image", X.BOX_CTE)
def detection_rejects(spark, d):
    quad, tile = F.when(F.expr("c % 10 <> 0"), G.corners(BOX)), F.when(F.expr("c % 13 <> 0"), F.array(F.lit(0), F.lit(0)))
    ok, bad = tiling.valid_detections(X.boxes(spark, d).select("image", quad.alias("bbox"), tile.alias("tile_coordinates")))
    both = ok.select("image", F.lit(True).alias("ok")).unionByName(bad.select("image", F.lit(False).alias("ok")))
    return both.groupBy("image").agg(F.count_if("ok").alias("valid"), F.count_if(~F.col("ok")).alias("rejected"))


@query("SELECT image, count(*) AS detections FROM box GROUP BY ROLLUP (image)", X.BOX_CTE)
def detection_totals(spark, d):
    return statistics.detection_totals(X.boxes(spark, d))


# Tiles and lookups.


def _tiles(spark: SparkSession, d: str) -> DataFrame:
    return tiling.tile_grid(tiling.split_by_size(X.images(spark, d), CONFIG.tiling)[0], CONFIG.tiling)


@query("SELECT image, tile_idx, x1, y1, x1 + 720 AS x2, y1 + 720 AS y2 FROM tile", X.TILE_CTE)
def tile_grid(spark, d):
    return _tiles(spark, d).select("image", "tile_idx", "x1", "y1", "x2", "y2")


@query("SELECT image, tile_idx, y1 // 648 AS grid_row, x1 // 648 AS grid_col FROM tile", X.TILE_CTE)
def tile_grid_pos(spark, d):
    return _tiles(spark, d).select("image", "tile_idx", "grid_row", "grid_col")


@query("SELECT image, idx, (n // 10) % 5 * 648 AS tile_x, known FROM (SELECT *, (n // 10) < 25 AS known FROM box) WHERE known UNION ALL SELECT image, idx, NULL, FALSE FROM box WHERE n // 10 >= 25", X.BOX_CTE)
def tile_lookup(spark, d):
    b = X.boxes(spark, d)
    tiles = b.where("n div 10 < 25").selectExpr("image", "tile_id", "n div 10 as tile_idx", "(n div 10) % 5 * 648 as tile_x")
    found, missing = tiling.with_tiles(b.select("image", "idx", "tile_id"), tiles)
    return found.select("image", "idx", "tile_x", F.lit(True).alias("known")).unionByName(missing.select("image", "idx", F.lit(None).cast("long").alias("tile_x"), F.lit(False).alias("known")))


@query("SELECT image, tile_idx::INT AS tile_idx, image || '_T' || lpad(tile_idx::VARCHAR, 4, '0') AS tile_id, x1::INT AS x1, (y1 + 720)::INT AS y2, n_tiles FROM (SELECT *, count(*) OVER (PARTITION BY image) AS n_tiles FROM tile)", X.TILE_CTE)
def tiles_explode(spark, d):
    i = lambda *cs: F.array(*(F.col(c).cast("int") for c in cs))
    t = F.struct("tile_idx", F.col("tile_id"), i("x1", "y1", "x2", "y2").alias("coordinates"), i("grid_row", "grid_col").alias("grid_position"), F.array(F.lit(720), F.lit(720)).alias("tile_size"))
    files = _tiles(spark, d).groupBy("image").agg(F.array_sort(F.collect_list(t)).alias("tiles"))
    files = files.select(F.concat(F.lit("/data/"), "image", F.lit(".png")).alias("source_image"), F.array().cast("array<int>").alias("original_size"), F.lit(0.1).alias("overlap_ratio"), F.transform("tiles", lambda x: F.struct(*(x[c].alias(c) for c in ("tile_id", "coordinates", "grid_position", "tile_size")))).alias("tiles"), F.size("tiles").cast("long").alias("n_tiles"))
    rows = readers.explode_tiles(files)
    counted = rows.withColumn("n_tiles", F.count(F.lit(1)).over(Window.partitionBy("image")))
    return counted.select("image", "tile_idx", "tile_id", F.col("coordinates")[0].alias("x1"), F.col("coordinates")[3].alias("y2"), "n_tiles")


@query("SELECT image, tile_id, count(*) AS n, min(idx) AS first_idx FROM box GROUP BY image, tile_id", X.BOX_CTE)
def ocr_by_tile(spark, d):
    by = readers.detections_by_tile(X.boxes(spark, d), ["idx", "x0"])
    return by.select("image", F.explode("by_tile").alias("tile_id", "found")).select("image", "tile_id", F.size("found").cast("long").alias("n"), F.col("found")[0]["idx"].alias("first_idx"))


@query("SELECT image, width >= 720 AND height >= 720 AS ok FROM img", X.IMAGE_CTE)
def image_size_filter(spark, d):
    ok, bad = tiling.split_by_size(X.images(spark, d), CONFIG.tiling)
    return ok.select("image", F.lit(True).alias("ok")).unionByName(bad.select("image", F.lit(False).alias("ok")))


@query("SELECT image AS stem, CASE WHEN key % 3 = 0 THEN image || '.png' WHEN key % 2 = 0 THEN image || '.jpg' ELSE image || '.TIFF' END AS path FROM img WHERE key % 2 = 0 OR key % 3 = 0 OR key % 5 = 0", X.IMAGE_CTE)
def first_ext_match(spark, d):
    i = X.images(spark, d)
    ext = F.expr("explode(filter(array(if(key % 2 = 0, 'jpg', null), if(key % 3 = 0, 'png', null), if(key % 5 = 0, 'TIFF', null), 'txt'), e -> e is not null))")
    files = i.select(F.col("image").alias("stem"), ext.alias("extension")).withColumn("path", F.concat_ws(".", "stem", "extension"))
    return crops.first_file(i.select(F.col("image").alias("stem")), files, readers.IMAGE_EXTENSIONS)


@query("SELECT image, arg_min(c, idx) AS first_size FROM box GROUP BY image", X.BOX_CTE)
def first_size(spark, d):
    return X.boxes(spark, d).groupBy("image").agg(F.min_by("c", "idx").alias("first_size"))


@query("SELECT image, page, CASE WHEN pages = 1 THEN image || '.png' ELSE image || '_page_' || lpad(page::VARCHAR, 2, '0') || '.png' END AS name FROM (SELECT *, unnest(range(1, pages + 1)) AS page FROM (SELECT *, key % 12 + 1 AS pages FROM img))", X.IMAGE_CTE)
def page_naming(spark, d):
    p = X.images(spark, d).selectExpr("image", "key % 12 + 1 as pages").selectExpr("image", "pages", "explode(sequence(1L, pages)) as page")
    return p.select("image", "page", readers.page_name(F.col("image"), F.col("page"), F.col("pages"), F.lit("png")).alias("name"))


@query("SELECT image, preset, dpi, image_format FROM img JOIN (VALUES (0, 'draft', 200, 'JPEG'), (1, 'standard', 300, 'PNG'), (2, 'high_quality', 600, 'PNG'), (3, 'ultra_high', 1200, 'PNG'), (4, 'print_ready', 600, 'TIFF')) v(k, preset, dpi, image_format) ON key % 6 = k", X.IMAGE_CTE)
def dpi_presets(spark, d):
    wanted = X.images(spark, d).select("image", F.expr("element_at(array('draft', 'standard', 'high_quality', 'ultra_high', 'print_ready', 'other'), cast(key % 6 + 1 as int))").alias("preset"))
    return wanted.join(F.broadcast(readers.presets(spark)), "preset").select("image", "preset", "dpi", "image_format")  # five rows


@query("SELECT image, key, CASE WHEN key % 4 = 3 THEN image || '_x' ELSE image END AS stem FROM img", X.IMAGE_CTE)
def stem_norm(spark, d):
    name = F.concat("image", F.expr("element_at(array('_grouped_text', '_grouped', '', '_grouped_x_grouped'), cast(key % 4 + 1 as int))"))
    return X.images(spark, d).select("image", "key", crops.stem(name).alias("stem"))


# Crops.

CROP_SQL = """(SELECT *, printf('crop_%04d.png', crop_idx) AS crop_filename, greatest(0, x0 - 10) AS "left", greatest(0, y0 - 10) AS top, least(1400, x1 + 10) AS "right", least(1800, y1 + 10) AS bottom
  FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY component) - 1 AS crop_idx FROM region))"""


@query(f'SELECT image, crop_filename, "left", top, "right", bottom FROM {CROP_SQL} WHERE "right" > "left" AND bottom > top', X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def crop_window(spark, d):
    return crops.crop_windows(_regions(spark, d), CONFIG.cropping).select("image", "crop_filename", "left", "top", "right", "bottom")


@query(f"SELECT image, crop_filename, {OUTPUT}, 'unknown' AS original_text, NULL::DOUBLE AS original_confidence, 0 AS orientation, 1400 AS width FROM {CROP_SQL} WHERE \"right\" > \"left\" AND bottom > top", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def manifest(spark, d):
    m = crops.manifest(crops.crop_windows(_regions(spark, d), CONFIG.cropping))
    return m.select("image", "crop_filename", *_flat("original_bbox"), "original_text", "original_confidence", "orientation", F.col("original_image_size")[0].alias("width"))


@query(f'SELECT count(*) AS crops, count(DISTINCT image) AS images FROM {CROP_SQL} WHERE "right" > "left" AND bottom > top', X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def crop_totals(spark, d):
    return crops.crop_windows(_regions(spark, d), CONFIG.cropping).agg(F.count(F.lit(1)).alias("crops"), F.count_distinct("image").alias("images"))


# Recognition.


def _recognised(spark: SparkSession, d: str) -> DataFrame:
    rows = X.crops(spark, d)
    return rows.withColumn("second", recognition.joined(F.col("pieces"))).withColumn("result", recognition.cascade(F.col("first"), F.col("second"), CONFIG.recognition))


@query("SELECT key, text, round(confidence, 9) AS confidence, method, n::INT AS n FROM res", X.CROP_CTE)
def cascade(spark, d):
    return _recognised(spark, d).select("key", "result.text", F.round("result.confidence", 9).alias("confidence"), "result.method", "result.n")


@query("SELECT key, CASE WHEN key % 6 = 0 THEN 0 ELSE round(list_sum(list_transform(range(1, key % 6 + 1), lambda k: ((k * 13 + c) % 100) / 100.0::DOUBLE)) / (key % 6), 9) END AS mean FROM cr0", X.CROP_CTE)
def mean_conf(spark, d):
    steps = F.expr("if(key % 6 = 0, array(), transform(sequence(1, key % 6), k -> ((k * 13 + c) % 100) / 100D))").cast("array<double>")
    return X.crops(spark, d).select("key", F.round(recognition.mean_confidence(steps), 9).alias("mean"))


@query("SELECT key, t2 AS text, round(c2, 9) AS confidence, n2::INT AS n FROM fb", X.CROP_CTE)
def fallback_join(spark, d):
    return X.crops(spark, d).select("key", recognition.joined(F.col("pieces")).alias("r")).select("key", "r.text", F.round("r.confidence", 9).alias("confidence"), "r.n")


def _annotated(spark: SparkSession, d: str) -> DataFrame:
    more = {"original_bbox": F.array(), "crop_filename": F.format_string("crop_%d.png", "key"), "orientation": F.lit(0), "original_image_size": F.array()}
    return recognition.annotations(_recognised(spark, d).withColumns(more))


@query("SELECT image, text, round(confidence, 9) AS confidence, 'crop_' || key || '.png' AS crop_filename, method AS ocr_method, n::INT AS easyocr_detections FROM res WHERE text <> ''", X.CROP_CTE)
def annotations(spark, d):
    return _annotated(spark, d).select("image", "text", F.round("confidence", 9).alias("confidence"), "crop_filename", "ocr_method", "easyocr_detections")


@query("SELECT method AS ocr_method, count(*) AS texts, count(DISTINCT image) AS images FROM res WHERE text <> '' GROUP BY method", X.CROP_CTE)
def method_totals(spark, d):
    return recognition.method_totals(_annotated(spark, d))


# Coordinates.


@query("SELECT image, idx, " + ", ".join(f"round({x} * 0.12::DOUBLE, 4) AS {n}" for x, n in (("x0", "x1"), ("y0", "y1"), ("x1", "x2"), ("y0", "y2"), ("x1", "x3"), ("y1", "y3"), ("x0", "x4"), ("y1", "y4"))) + " FROM box", X.BOX_CTE)
def px_to_pt(spark, d):
    return X.boxes(spark, d).select("image", "idx", coordinates.to_points(G.corners(BOX), 600).alias("bbox")).select("image", "idx", *_flat())


PDF_CTE = f"""{X.IMAGE_CTE},
pdf AS (SELECT image, key, CASE WHEN key % 31 = 0 THEN NULL ELSE width END AS width, height, key % 7 = 0 AS missing, CASE WHEN key % 29 = 0 THEN NULL ELSE width * 0.12::DOUBLE * (1 + (key % 13) / 100.0::DOUBLE) END AS pdf_w, height * 0.12::DOUBLE AS pdf_h FROM img),
chk AS (SELECT *, abs(pdf_w * (600 / 72.0::DOUBLE) - width) / (pdf_w * (600 / 72.0::DOUBLE)) * 100 AS dw, abs(pdf_h * (600 / 72.0::DOUBLE) - height) / (pdf_h * (600 / 72.0::DOUBLE)) * 100 AS dh FROM pdf),
val AS (SELECT image, CASE WHEN width IS NULL THEN 'image size missing' WHEN missing THEN 'PDF not found' WHEN pdf_w IS NULL THEN 'PDF dimensions unreadable' END AS error, coalesce(dw <= 5 AND dh <= 5, FALSE) AS fits FROM chk)"""


def _pdfs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    i = X.images(spark, d).selectExpr("image", "key", "if(key % 31 = 0, null, width) as width", "height", "if(key % 29 = 0, null, width * 0.12D * (1 + (key % 13) / 100D)) as pdf_w", "height * 0.12D as pdf_h")
    pdfs = i.join(X.images(spark, d).selectExpr("image", "width as w"), "image").where("key % 7 <> 0")
    pdfs = pdfs.selectExpr("image as stem", "concat('pdfs/', image, '.pdf') as pdf_path", "if(key % 29 = 0, null, w * 0.12D * (1 + (key % 13) / 100D)) as pdf_w", "pdf_h")
    return i.select(F.concat("image", F.lit("_final")).alias("image"), "width", "height"), pdfs


@query("SELECT image, round_even(pdf_w * (600 / 72.0::DOUBLE), 0)::BIGINT AS expected_w, round_even(pdf_h * (600 / 72.0::DOUBLE), 0)::BIGINT AS expected_h, round(width / pdf_w, 9) AS scale_w, round(dw, 2) AS difference_w, round(dh, 2) AS difference_h, dw <= 5 AND dh <= 5 AS compatible FROM chk WHERE key % 31 <> 0 AND key % 29 <> 0", PDF_CTE)
def dim_check(spark, d):
    i = X.images(spark, d).where("key % 31 <> 0 and key % 29 <> 0").selectExpr("image", "width", "height", "width * 0.12D * (1 + (key % 13) / 100D) as pdf_w", "height * 0.12D as pdf_h")
    c = coordinates.dimension_check(F.col("width"), F.col("height"), F.col("pdf_w"), F.col("pdf_h"), CONFIG.coordinates)
    return i.select("image", c["expected_w"].alias("expected_w"), c["expected_h"].alias("expected_h"), F.round(c["scale_w"], 9).alias("scale_w"), c["difference_w"].alias("difference_w"), c["difference_h"].alias("difference_h"), c["compatible"].alias("compatible"))


@query("SELECT image || '_final' AS image, fits AND error IS NULL AS compatible, error FROM val", PDF_CTE)
def dim_validate(spark, d):
    return coordinates.validate(*_pdfs(spark, d), SCANNED)


@query("SELECT count(*) AS images, count(*) FILTER (fits AND error IS NULL) AS compatible, string_agg(image || '_final', ',' ORDER BY image) FILTER (NOT (fits AND error IS NULL)) AS failing FROM val", PDF_CTE)
def validation_summary(spark, d):
    return coordinates.validation_summary(dim_validate(spark, d))


@query("SELECT image || '_final' AS image, error FROM val WHERE NOT (fits AND error IS NULL)", PDF_CTE)
def validation_failures(spark, d):
    """A row for each image that isn't compatible, where validation_summary has their names in one cell."""
    return coordinates.validation_failures(dim_validate(spark, d))


# Layout.


@query("SELECT image, idx, CASE WHEN c % 19 = 0 THEN 'unknown' WHEN x1 - x0 > y1 - y0 THEN 'horizontal' ELSE 'vertical' END AS orientation, CASE WHEN c % 19 = 0 THEN '128,128,128' WHEN x1 - x0 > y1 - y0 THEN '0,255,0' ELSE '0,0,255' END AS colour FROM box", X.BOX_CTE)
def viz_orientation(spark, d):
    quad = F.when(F.expr("c % 19 = 0"), F.slice(G.corners(BOX), 1, 3)).otherwise(G.corners(BOX))
    o = X.boxes(spark, d).select("image", "idx", layout.overlay_orientation(quad).alias("orientation"))
    return o.withColumn("colour", layout.overlay_colour(F.col("orientation")))


@query("SELECT image, idx, greatest(0, least(x0 - 60 + CASE WHEN c % 3 = 0 THEN 0 ELSE 100 END, 999)) AS x, greatest(0, least(y1 + CASE WHEN c % 3 = 0 THEN 0 ELSE 200 END, 1199)) AS y FROM box", X.BOX_CTE)
def viz_clamp(spark, d):
    dx, dy = F.expr("if(c % 3 = 0, null, 100)"), F.expr("if(c % 3 = 0, null, 200)")
    return X.boxes(spark, d).select("image", "idx", layout.on_page(BOX.x0 - 60, dx, F.lit(1000)).alias("x"), layout.on_page(BOX.y1, dy, F.lit(1200)).alias("y"))


LABEL_CTE = """lab0 AS (SELECT image, idx, x0, y0, x1, y1, 12 * (1 + c % 30) AS w, CASE WHEN y1 - y0 > x1 - x0 THEN 90 ELSE 0 END AS o FROM box),
lab AS (SELECT *, CASE WHEN o = 90 THEN CASE WHEN x1 + w + 15 <= 1400 THEN x1 + 10 ELSE greatest(x0 - w - 10, 5) END ELSE x0 END AS lx,
  CASE WHEN o = 90 THEN greatest(y0 + 18, 23) WHEN y0 - 18 - 10 >= 0 THEN y0 - 10 ELSE y1 + 18 + 10 END AS ly FROM lab0)"""


@query("SELECT image, idx, greatest(0, least(lx, 1400 - w)) AS label_x, greatest(18, least(ly, 1800)) AS label_y, greatest(0, lx - 5) AS back_x0, greatest(0, ly - 18 - 5) AS back_y0, least(1400, lx + w + 5) AS back_x1, least(1800, ly + 6 + 5) AS back_y1 FROM lab", X.BOX_CTE, LABEL_CTE)
def label_layout(spark, d):
    n = lambda x: F.lit(x).cast("long")
    rows = X.boxes(spark, d).withColumns({"orientation": G.detector_angle(BOX), "text_w": F.expr("12 * (1 + c % 30)"), "text_h": n(18), "baseline": n(6), "width": n(X.PAGE_W), "height": n(X.PAGE_H)})
    return layout.label_places(rows.where(layout.is_quad(G.corners(BOX)))).select("image", "idx", "label_x", "label_y", "back_x0", "back_y0", "back_x1", "back_y1")


@query("SELECT CASE WHEN x1 - x0 > y1 - y0 THEN 'horizontal' ELSE 'vertical' END AS orientation, count(*) FILTER (c % 19 <> 0) AS drawn, count(*) FILTER (c % 19 = 0) AS skipped FROM box GROUP BY ALL", X.BOX_CTE)
def viz_counts(spark, d):
    labelled = X.boxes(spark, d).select(layout.overlay_orientation(G.corners(BOX)).alias("orientation"), F.expr("c % 19 <> 0").alias("drawn"))
    return statistics.orientation_counts(labelled)


@query("SELECT image, sum(pre_h)::BIGINT AS before_horizontal, sum(pre_v)::BIGINT AS before_vertical, sum(post_h)::BIGINT AS after_horizontal, sum(post_v)::BIGINT AS after_vertical FROM (SELECT image, (x1 - x0 > y1 - y0)::INT AS pre_h, (x1 - x0 <= y1 - y0)::INT AS pre_v, 0 AS post_h, 0 AS post_v FROM box UNION ALL SELECT image, 0, 0, (x1 - x0 > y1 - y0)::INT, (x1 - x0 <= y1 - y0)::INT FROM region) GROUP BY image", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def viz_comparison(spark, d):
    return statistics.before_and_after(X.boxes(spark, d), group_boxes(spark, d))


@query(
    """SELECT image, image || '_T' || lpad(tile_idx::VARCHAR, 4, '0') AS tile_id, k::INT AS det_index, x1 + bx0 AS x0, y1 + by0 AS y0, x1 + bx1 AS x1, y1 + by1 AS y1, (90 * k)::INT AS rotation_angle
  FROM (SELECT *, 0 AS k, 8 AS bx0, 10 AS by0, 48 + (x1 + y1) % 23 AS bx1, 26 AS by1 FROM tile UNION ALL SELECT *, 1, 30, 60, 44, 110 + x1 % 17 FROM tile)""",
    X.TILE_CTE,
)
def detector_stub(spark, d):
    """Detections of the stand-in detector, on the page."""
    found = models.detect(_tiles(spark, d).select("image", "tile_id", "x1", "y1", "x2", "y2"), models.stub_detector)
    return tiling.to_page(found).select("image", "tile_id", "det_index", *grouping.BOX, "rotation_angle")


@query(f"SELECT CASE WHEN crop_idx % 3 = 0 THEN 'EasyOCR' ELSE 'TrOCR' END AS ocr_method, count(*) AS texts, count(DISTINCT image) AS images FROM {CROP_SQL} WHERE \"right\" > \"left\" AND bottom > top GROUP BY ALL", X.BOX_CTE, X.GONE_CTE, X.EDGE_CTE, X.COMPONENT_CTE)
def recogniser_stub(spark, d):
    """The cascade over stand-in recognisers, the second only for rows that the first leaves."""
    rows = crops.manifest(crops.crop_windows(_regions(spark, d), CONFIG.cropping))
    done = recognition.recognise(rows, models.plugin(models.stub_recogniser, name="a", sure=3), models.plugin(models.stub_recogniser, name="b", sure=5), CONFIG.recognition)
    return recognition.method_totals(recognition.annotations(done))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
