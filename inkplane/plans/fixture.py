"""Boxes, images and recognition results derived from the test tables, in Spark and in SQL.

All values come from integer arithmetic on non-negative keys, so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_W, PAGE_H = 1400, 1800


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """300 boxes an image, one in seven upright, one in four with a second, slightly different detection."""
    o = read(spark, sf_dir, "orders").selectExpr("o_orderkey div 300 as image", "o_orderkey % 300 as n", "o_custkey as c")
    o = o.selectExpr("image", "n", "c", "(n % 10) * 130 + c % 41 as a0", "(n div 10) * 60 + c % 3 as b0", "40 + c % 83 as len", "14 + c % 5 as thick", "c % 7 = 0 as upright")
    first = "struct(n as idx, a0 as s0, a0 + len as s1, b0 as t0, b0 + thick as t1)"
    second = "struct(1000 + n as idx, a0 + 3 as s0, a0 + len + 2 * (c % 11) as s1, b0 + 1 as t0, b0 + thick - 1 as t1)"
    shared = o.selectExpr("image", "n", "c", "upright", f"explode(if(c % 4 = 0, array({first}, {second}), array({first}))) as e")
    return shared.selectExpr(
        "image", "e.idx as idx",
        "if(upright, e.t0, e.s0) as x0", "if(upright, e.s0, e.t0) as y0", "if(upright, e.t1, e.s1) as x1", "if(upright, e.s1, e.t1) as y1",
        "format_string('IMG%04d_T%04d', image, n div 10) as tile_id", "c", "n",
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, width, height; some smaller than a tile."""
    return read(spark, sf_dir, "part").selectExpr("format_string('P%05d', p_partkey) as image", "p_partkey as key", "cast(400 + p_size * 97 as bigint) as width", "500 + p_partkey % 3000 as height")


def crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, key and the two recognisers' raw results for each crop."""
    o = read(spark, sf_dir, "orders").selectExpr("o_orderkey div 300 as image", "o_orderkey as key", "o_custkey as c")
    pieces = "transform(if(key % 5 = 0 or key % 4 = 0, array(), sequence(1, key % 4)), k -> struct(concat('w', k, '_', key) as text, ((k * 7 + c) % 100) / 100D as confidence))"
    return o.selectExpr("image", "key", "c", "if(c % 23 = 0, null, struct(if(c % 17 = 0, '', concat('P', key)) as text, (c % 100) / 100D as confidence)) as first", f"cast({pieces} as array<struct<text: string, confidence: double>>) as pieces")


BOX_CTE = """
o AS (SELECT o_orderkey // 300 AS image, o_orderkey % 300 AS n, o_custkey AS c FROM orders),
g AS (SELECT *, (n % 10) * 130 + c % 41 AS a0, (n // 10) * 60 + c % 3 AS b0, 40 + c % 83 AS len, 14 + c % 5 AS thick, c % 7 = 0 AS upright FROM o),
e AS (SELECT image, n, c, upright, n AS idx, a0 AS s0, a0 + len AS s1, b0 AS t0, b0 + thick AS t1 FROM g
      UNION ALL SELECT image, n, c, upright, 1000 + n, a0 + 3, a0 + len + 2 * (c % 11), b0 + 1, b0 + thick - 1 FROM g WHERE c % 4 = 0),
box AS (SELECT image, idx, c, n, if(upright, t0, s0) AS x0, if(upright, s0, t0) AS y0, if(upright, t1, s1) AS x1, if(upright, s1, t1) AS y1,
        printf('IMG%04d_T%04d', image, n // 10) AS tile_id FROM e)"""

#: Shares, reasons and so on of pairs a, b (a.idx < b.idx) of boxes.
PAIR = """
  greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS shared,
  (a.x1 - a.x0) * (a.y1 - a.y0) AS area_a, (b.x1 - b.x0) * (b.y1 - b.y0) AS area_b,
  a.x1 - a.x0 AS wa, a.y1 - a.y0 AS ha, b.x1 - b.x0 AS wb, b.y1 - b.y0 AS hb,
  (a.x0 + a.x1) / 2.0::DOUBLE AS cxa, (a.y0 + a.y1) / 2.0::DOUBLE AS cya, (b.x0 + b.x1) / 2.0::DOUBLE AS cxb, (b.y0 + b.y1) / 2.0::DOUBLE AS cyb,
  a.x0 AS ax0, a.y0 AS ay0, a.x1 AS ax1, a.y1 AS ay1, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1"""

REASON = """CASE WHEN (wa > ha) <> (wb > hb) THEN 'primary_filter_failed_orientation_mismatch'
  WHEN NOT CASE WHEN area_a >= area_b THEN cxb BETWEEN ax0 - wa * 0.5::DOUBLE AND ax1 + wa * 0.5::DOUBLE AND cyb BETWEEN ay0 - ha * 0.5::DOUBLE AND ay1 + ha * 0.5::DOUBLE
    ELSE cxa BETWEEN bx0 - wb * 0.5::DOUBLE AND bx1 + wb * 0.5::DOUBLE AND cya BETWEEN by0 - hb * 0.5::DOUBLE AND by1 + hb * 0.5::DOUBLE END THEN 'primary_filter_failed_not_spatial_neighbors'
  WHEN shared::DOUBLE / (area_a + area_b - shared) > 0.1::DOUBLE THEN 'high_overlap'
  WHEN wa > ha AND abs(cya - cyb) >= least(ha, hb) * 0.2::DOUBLE THEN 'horizontal_text_poor_vertical_alignment'
  WHEN wa > ha AND least(abs(ax0 - bx1), abs(bx0 - ax1)) < greatest(ha, hb) THEN 'horizontal_text_proximity'
  WHEN wa > ha THEN 'horizontal_text_too_distant'
  WHEN abs(cxa - cxb) >= least(wa, wb) * 0.2::DOUBLE THEN 'vertical_text_poor_horizontal_alignment'
  WHEN least(abs(ay0 - by1), abs(by0 - ay1)) < greatest(wa, wb) THEN 'vertical_text_proximity'
  ELSE 'vertical_text_too_distant' END"""

LINKS = "('high_overlap', 'very_high_iou', 'horizontal_text_proximity', 'vertical_text_proximity')"

GONE_CTE = f"""
pair AS (SELECT a.image, a.idx AS i, b.idx AS j, {PAIR} FROM box a JOIN box b ON a.image = b.image AND a.idx < b.idx),
conflict AS (SELECT image, i, j, CASE WHEN shared::DOUBLE / area_a > 0.9::DOUBLE THEN i ELSE j END AS victim FROM pair
  WHERE area_a > 0 AND area_b > 0 AND (shared::DOUBLE / area_a > 0.9::DOUBLE OR shared::DOUBLE / area_b > 0.9::DOUBLE)),
seq AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY i, j) AS r FROM conflict),
fold(image, r, dead) AS (SELECT DISTINCT image, 0::BIGINT, []::BIGINT[] FROM seq UNION ALL
  SELECT f.image, f.r + 1, CASE WHEN list_contains(f.dead, s.i) OR list_contains(f.dead, s.j) THEN f.dead ELSE list_append(f.dead, s.victim) END
  FROM fold f JOIN seq s ON s.image = f.image AND s.r = f.r + 1),
gone AS (SELECT f.image, unnest(f.dead) AS idx FROM fold f JOIN (SELECT image, max(r) AS r FROM seq GROUP BY image) m ON f.image = m.image AND f.r = m.r),
live AS (SELECT * FROM box b WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.image = b.image AND g.idx = b.idx))"""

EDGE_CTE = f"""
lpair AS (SELECT a.image, a.idx AS i, b.idx AS j, {PAIR} FROM live a JOIN live b ON a.image = b.image AND a.idx < b.idx),
decided AS (SELECT image, i, j, {REASON} AS reason FROM lpair),
edge AS (SELECT * FROM decided WHERE reason IN {LINKS})"""

COMPONENT_CTE = """
sym AS (SELECT image, i AS u, j AS v FROM edge UNION ALL SELECT image, j, i FROM edge),
reach(image, idx, other) AS (SELECT image, idx, idx FROM live UNION SELECT r.image, r.idx, s.v FROM reach r JOIN sym s ON s.image = r.image AND s.u = r.other),
comp AS (SELECT image, idx, min(other) AS component FROM reach GROUP BY image, idx),
placed AS (SELECT l.*, c.component FROM live l JOIN comp c USING (image, idx)),
region AS (SELECT image, component, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, array_to_string(list_sort(list_distinct(list(tile_id))), ',') AS tile_ids,
  count(DISTINCT tile_id) AS n_tiles, count(*) AS n_boxes, arg_min(c, idx) AS first_c FROM placed GROUP BY image, component)"""

IMAGE_CTE = "img AS (SELECT printf('P%05d', p_partkey) AS image, p_partkey AS key, (400 + p_size * 97)::BIGINT AS width, 500 + p_partkey % 3000 AS height FROM part)"

TILE_CTE = f"""{IMAGE_CTE},
big AS (SELECT * FROM img WHERE width >= 720 AND height >= 720),
tile0 AS (SELECT *, unnest(range(0, ceil((height - 720) / 648.0)::BIGINT + 1)) AS ry FROM big),
tile1 AS (SELECT *, unnest(range(0, ceil((width - 720) / 648.0)::BIGINT + 1)) AS rx FROM tile0),
tile AS (SELECT image, key, width, height, ry * (ceil((width - 720) / 648.0)::BIGINT + 1) + rx AS tile_idx, least(rx * 648, width - 720) AS x1, least(ry * 648, height - 720) AS y1 FROM tile1)"""

CROP_CTE = """
cr0 AS (SELECT o_orderkey // 300 AS image, o_orderkey AS key, o_custkey AS c FROM orders),
cr AS (SELECT *, c % 23 <> 0 AS has_first, CASE WHEN c % 23 = 0 THEN NULL WHEN c % 17 = 0 THEN '' ELSE 'P' || key END AS t1, CASE WHEN c % 23 = 0 THEN NULL ELSE (c % 100) / 100.0::DOUBLE END AS c1,
  CASE WHEN key % 5 = 0 OR key % 4 = 0 THEN [] ELSE range(1, key % 4 + 1) END AS ks FROM cr0),
fb AS (SELECT *, trim(array_to_string(list_transform(ks, lambda k: 'w' || k || '_' || key), ' ')) AS t2,
  CASE WHEN len(ks) = 0 THEN 0.0::DOUBLE ELSE list_sum(list_transform(ks, lambda k: ((k * 7 + c) % 100) / 100.0::DOUBLE)) / len(ks) END AS c2, len(ks) AS n2 FROM cr),
cas AS (SELECT *, CASE WHEN c1 >= 0.95::DOUBLE THEN 1 WHEN t2 <> '' THEN 2 WHEN has_first THEN 3 END AS way FROM fb),
res AS (SELECT image, key, c, CASE WHEN way = 2 THEN t2 WHEN way IS NOT NULL THEN t1 END AS text, CASE WHEN way = 2 THEN c2 WHEN way IS NOT NULL THEN c1 END AS confidence,
  CASE WHEN way = 2 THEN 'EasyOCR' WHEN way IS NOT NULL THEN 'TrOCR' END AS method, CASE WHEN way = 2 THEN n2 END AS n FROM cas)"""
