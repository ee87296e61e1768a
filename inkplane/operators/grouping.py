"""From detected boxes to text regions: suppression, links, components, merging.

Boxes have image, idx (their canonical order within an image), x0, y0, x1, y1 and tile_id. Both
spatial self-joins are equi-joins on (image, grid cell): a pair that can qualify meets in the one cell
that holds a centre, so candidates grow with what lies near, not with the square of an image's boxes,
and an image is spread over many tasks. Survivors and links are written once (linked), since all later steps
read them several times. Order-dependent steps fold an image's few conflict or link rows, never its boxes
or pixels, where it has at most FOLDED of them; images with more go round by round, by joins over all
of them at once. Both ways give the same result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Grouping
from ..functions import geometry as G
from ..scratch import Scratch

#: Conflicts or links of an image that are folded in one row; the fold looks at all of them for each.
FOLDED = 400

BOX = ["x0", "y0", "x1", "y1"]


def canonical_index(detections: DataFrame) -> DataFrame:
    """idx by tile number, tile and place in the tile: reading order doesn't change results."""
    order = Window.partitionBy("image").orderBy("tile_number", "tile_id", "det_index")
    return detections.withColumn("idx", F.row_number().over(order) - 1)


def _side(boxes: DataFrame, name: str, *more: Column) -> DataFrame:
    return boxes.select("image", *(F.col(c).alias(f"{c}_{name}") for c in ["idx", *BOX]), *more)


def _box(name: str) -> G.Box:
    return G.Box.of(suffix=f"_{name}")


def contained(boxes: DataFrame, g: Grouping) -> DataFrame:
    """(image, idx_in, idx_by): boxes of which more than the threshold's share lies in another box.

    From a share of one half on the centre lies in the other box too, so each box is looked up by its
    centre's cell; below, boxes would meet in all cells they touch.
    """
    if g.contained_box_threshold < 0.5:
        touch = lambda name: _side(boxes, name, F.explode(G.cells(F.col("x0"), F.col("x1"), g.cell)).alias("gx"), "y0", "y1").select("*", F.explode(G.cells(F.col("y0"), F.col("y1"), g.cell)).alias("gy")).drop("y0", "y1")
        small, large = touch("in"), touch("by")
    else:
        b = G.Box.of()
        small = _side(boxes, "in", G.cell_of(b.cx, g.cell).alias("gx"), G.cell_of(b.cy, g.cell).alias("gy"))
        large = _side(boxes, "by", F.explode(G.cells(b.x0, b.x1, g.cell)).alias("gx"), b.y0.alias("_low"), b.y1.alias("_high"))
        large = large.select("*", F.explode(G.cells(F.col("_low"), F.col("_high"), g.cell)).alias("gy")).drop("_low", "_high")
    met = small.join(large, ["image", "gx", "gy"]).where("idx_in <> idx_by")
    met = met.where(G.contained_share(_box("in"), _box("by")) > g.contained_box_threshold).select("image", "idx_in", "idx_by")
    return met.distinct() if g.contained_box_threshold < 0.5 else met


def overlapping(boxes: DataFrame, g: Grouping) -> DataFrame:
    """(image, i, j, iou, share_i, share_j) of all pairs i < j that share area; all others share none. A
    pair meets in each cell that both touch and counts in the one that holds its shared area's low corner."""

    def touch(name: str) -> DataFrame:
        b = G.Box.of()
        rows = _side(boxes, name, F.explode(G.cells(b.x0, b.x1, g.cell)).alias("gx"), b.y0.alias("_low"), b.y1.alias("_high"))
        return rows.select("*", F.explode(G.cells(F.col("_low"), F.col("_high"), g.cell)).alias("gy")).drop("_low", "_high")

    i, j = _box("i"), _box("j")
    met = touch("i").join(touch("j"), ["image", "gx", "gy"]).where("idx_i < idx_j")
    met = met.where((F.col("gx") == G.cell_of(F.greatest(i.x0, j.x0), g.cell)) & (F.col("gy") == G.cell_of(F.greatest(i.y0, j.y0), g.cell)))
    met = met.where(G.intersection(i, j) > 0)
    return met.select("image", F.col("idx_i").alias("i"), F.col("idx_j").alias("j"), G.iou(i, j).alias("iou"), G.contained_share(i, j).alias("share_i"), G.contained_share(j, i).alias("share_j"))


def conflicts(boxes: DataFrame, g: Grouping) -> DataFrame:
    """(image, i, j, victim), i < j: of a pair the lower index goes if it is contained, else the other."""
    found = contained(boxes, g)
    i, j = F.least("idx_in", "idx_by"), F.greatest("idx_in", "idx_by")
    return found.groupBy("image", i.alias("i"), j.alias("j")).agg(F.min("idx_in").alias("victim"))


def _few_and_many(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of images with at most so many, and the others, None if there are none."""
    many = rows.groupBy("image").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("image")
    if many.isEmpty():
        return rows, None
    return rows.join(many, "image", "left_anti"), rows.join(many, "image", "left_semi")


def deaths(conflict: DataFrame, most: int = FOLDED) -> DataFrame:
    """(image, idx, i, j) of boxes that go, and the pair at which they do. Pairs are visited in order, and one
    with a dead box does nothing; so the outcome isn't a plain anti-join."""
    few, many = _few_and_many(conflict.select("image", "i", "j", "victim"), most)

    def visit(acc: Column, e: Column) -> Column:
        dead = F.transform(acc, lambda d: d["victim"])
        over = F.array_contains(dead, e["i"]) | F.array_contains(dead, e["j"])
        return F.when(over, acc).otherwise(F.array_append(acc, e))

    kind = {f.name: f.dataType.simpleString() for f in conflict.schema.fields}
    pairs = few.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("i", "j", "victim"))).alias("pairs"))
    empty = F.array().cast(f"array<struct<i:{kind['i']},j:{kind['j']},victim:{kind['victim']}>>")
    out = pairs.select("image", F.explode(F.aggregate("pairs", empty, visit)).alias("e")).select("image", F.col("e.victim").alias("idx"), "e.i", "e.j")
    return out if many is None else out.unionByName(deaths_by_rounds(many))


def deaths_by_rounds(conflict: DataFrame) -> DataFrame:
    """The same for images of any size. A pair is decided once no earlier pair that is still open can kill one of
    its boxes: then both live, and its victim dies. Pairs after a box's death go, and the rest is looked at again."""
    scratch = Scratch(conflict.sparkSession, "deaths")
    left, found, k = scratch.save(conflict.select("image", "i", "j", "victim"), "left-0"), [], 0
    at = F.struct("i", "j")
    while not left.isEmpty():
        first = left.groupBy("image", "victim").agg(F.min(at).alias("first"))
        both = left
        for side in "ij":
            both = both.join(first.select("image", F.col("victim").alias(side), F.col("first").alias(f"first_{side}")), ["image", side], "left")
        ready = F.coalesce(F.col("first_i") >= at, F.lit(True)) & F.coalesce(F.col("first_j") >= at, F.lit(True))
        dead = scratch.save(both.where(ready).select("image", F.col("victim").alias("idx"), "i", "j"), f"dead-{k}")
        found.append(dead)
        both = left
        for side in "ij":
            both = both.join(dead.select("image", F.col("idx").alias(side), at.alias(f"died_{side}")), ["image", side], "left")
        open_ = F.coalesce(at < F.col("died_i"), F.lit(True)) & F.coalesce(at < F.col("died_j"), F.lit(True))
        k += 1
        left = scratch.save(both.where(open_).select("image", "i", "j", "victim"), f"left-{k}")
        scratch.drop(f"left-{k - 1}")
    out = found[0] if found else conflict.select("image", F.col("victim").alias("idx"), "i", "j").where("false")
    for dead in found[1:]:
        out = out.unionByName(dead)
    return out


def suppressed(conflict: DataFrame) -> DataFrame:
    """(image, idx) of boxes that go."""
    return deaths(conflict).select("image", "idx")


def survivors(boxes: DataFrame, g: Grouping) -> DataFrame:
    found = Scratch(boxes.sparkSession, "conflicts").save(conflicts(boxes, g), "conflicts")
    return boxes.join(suppressed(found), ["image", "idx"], "left_anti")


def reach_pairs(boxes: DataFrame, g: Grouping) -> DataFrame:
    """Pairs of one orientation of which the smaller one's centre is in reach of the larger, once each:
    (image, i, j, i_larger) and both boxes with suffixes _i and _j, i < j."""
    b, f = G.Box.of(), g.expansion_factor / 2
    large = _side(boxes, "l", b.horizontal.alias("flat"), F.explode(G.cells(b.x0 - b.w * f, b.x1 + b.w * f, g.cell)).alias("gx"), (b.y0 - b.h * f).alias("_low"), (b.y1 + b.h * f).alias("_high"))
    large = large.select("*", F.explode(G.cells(F.col("_low"), F.col("_high"), g.cell)).alias("gy")).drop("_low", "_high")
    small = _side(boxes, "s", b.horizontal.alias("flat"), G.cell_of(b.cx, g.cell).alias("gx"), G.cell_of(b.cy, g.cell).alias("gy"))
    met = large.join(small, ["image", "flat", "gx", "gy"]).where("idx_l <> idx_s")
    l, s = _box("l"), _box("s")
    met = met.where(G.is_larger(l, s, F.col("idx_l") < F.col("idx_s")) & G.in_reach(l, s, g.expansion_factor))
    first = F.col("idx_l") < F.col("idx_s")
    sides = [F.when(first, F.col(f"{c}_{p}")).otherwise(F.col(f"{c}_{q}")).alias(f"{c}_{n}") for n, p, q in (("i", "l", "s"), ("j", "s", "l")) for c in BOX]
    return met.select("image", F.least("idx_l", "idx_s").alias("i"), F.greatest("idx_l", "idx_s").alias("j"), first.alias("i_larger"), *sides)


def decided_pairs(boxes: DataFrame, g: Grouping) -> DataFrame:
    """(image, i, j, reason) of the pairs in reach; all other pairs fail the primary filter."""
    reason = G.link_reason(_box("i"), _box("j"), F.col("i_larger"), g)
    return reach_pairs(boxes, g).select("image", "i", "j", reason.alias("reason"))


def link_edges(boxes: DataFrame, g: Grouping) -> DataFrame:
    return decided_pairs(boxes, g).where(F.col("reason").isin(*G.LINKING))


def linked(boxes: DataFrame, g: Grouping) -> tuple[DataFrame, DataFrame]:
    """Survivors and their links, each written once."""
    scratch = Scratch(boxes.sparkSession, "grouping")
    live = scratch.save(survivors(boxes, g), "live")
    return live, scratch.save(link_edges(live, g), "links")


def components(boxes: DataFrame, edges: DataFrame, most: int = FOLDED) -> DataFrame:
    """(image, idx, component): the lowest index a box is linked to, directly or not; boxes without links are
    their own. An image's links are folded into a map from box to label if there are at most so many."""
    few, many = _few_and_many(edges.select("image", "i", "j"), most)

    def join(labels: Column, e: Column) -> Column:
        a, b = F.coalesce(labels[e["i"]], e["i"]), F.coalesce(labels[e["j"]], e["j"])
        low, high = F.least(a, b), F.greatest(a, b)
        moved = F.transform_values(labels, lambda _, v: F.when(v == high, low).otherwise(v))
        new = F.map_from_arrays(F.array(e["i"], e["j"]), F.array(low, low))
        kept = F.map_filter(moved, lambda k, _: (k != e["i"]) & (k != e["j"]))
        return F.when(low == high, labels).otherwise(F.map_concat(kept, new))

    kind = edges.schema["i"].dataType.simpleString()
    by_image = few.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("i", "j"))).alias("edges"))
    empty = F.map_from_arrays(F.array().cast(f"array<{kind}>"), F.array().cast(f"array<{kind}>"))
    labels = by_image.select("image", F.explode(F.aggregate("edges", empty, join)).alias("idx", "component"))
    if many is not None:
        linked_ = many.select("image", F.explode(F.array("i", "j")).alias("idx")).distinct()
        labels = labels.unionByName(components_iterative(linked_, many).select("image", "idx", "component"))
    return boxes.select("image", "idx").join(labels, ["image", "idx"], "left").withColumn("component", F.coalesce("component", "idx"))


def components_iterative(boxes: DataFrame, edges: DataFrame) -> DataFrame:
    """The same by passing least labels along edges and jumping to the label's label, for graphs of any
    size. Each round is written to the shared folder."""
    scratch = Scratch(boxes.sparkSession, "components")
    both = scratch.save(edges.select("image", "i", "j").unionByName(edges.select("image", F.col("j").alias("i"), F.col("i").alias("j"))), "edges")
    labels, before, k = scratch.save(boxes.select("image", "idx", F.col("idx").alias("component")), "labels-0"), None, 0
    while True:
        now = labels.agg(F.sum("component")).first()[0]
        if now == before:
            return labels.select("image", "idx", "component")
        before = now
        near = both.join(labels.withColumnRenamed("idx", "j"), ["image", "j"]).groupBy("image", F.col("i").alias("idx")).agg(F.min("component").alias("seen"))
        least = labels.join(near, ["image", "idx"], "left").select("image", "idx", F.least("component", F.coalesce("seen", "component")).alias("component"))
        jump = least.select("image", F.col("idx").alias("component"), F.col("component").alias("further"))
        k += 1
        labels = scratch.save(least.join(jump, ["image", "component"]).select("image", "idx", F.col("further").alias("component")), f"labels-{k}")
        scratch.drop(f"labels-{k - 1}")


def keep_larger(members: DataFrame, g: Grouping) -> DataFrame:
    """Within a component, boxes without a strictly larger one whose IoU with them exceeds the threshold."""
    a, b = members.alias("a"), members.alias("b")
    p, q = G.Box.of("a"), G.Box.of("b")
    worse = (F.col("a.image") == F.col("b.image")) & (F.col("a.component") == F.col("b.component")) & (G.iou(p, q) > g.high_iou_threshold) & (p.area < q.area)
    return a.join(b, worse, "left_anti")


def merge_clusters(members: DataFrame) -> DataFrame:
    """One envelope for each component; rotation, type, source and sizes are those of its lowest index. Tiles,
    their numbers, paths and grid positions are listed once each where members have them; positions by
    first member, without those that say MERGED."""
    first = lambda c: F.min_by(c, "idx").alias(c)
    have = set(members.columns)
    carried = [c for c in ("rotation_angle", "source_image", "detection_type", "original_image_size", "tile_size") if c in have]
    more = []
    if "tile_number" in have:
        more.append(F.array_sort(F.collect_set("tile_number")).alias("tile_numbers"))
    if "tile_path" in have:
        more.append(F.array_sort(F.collect_set("tile_path")).alias("tile_paths"))
    if "grid_position" in have:
        in_order = F.transform(F.array_sort(F.collect_list(F.struct("idx", F.col("grid_position").alias("p")))), lambda x: x["p"])
        text = members.schema["grid_position"].dataType.simpleString() == "string"
        more.append(F.array_distinct(F.filter(in_order, lambda p: p.isNotNull() & (p != "MERGED") if text else p.isNotNull())).alias("grid_positions"))
    out = members.groupBy("image", "component").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.array_sort(F.collect_set(F.coalesce("tile_id", F.lit("UNKNOWN")))).alias("tile_ids"),
        F.count(F.lit(1)).alias("n_boxes"), *more, *map(first, carried),
    )
    return out.withColumn("source_tiles_count", F.size("tile_ids"))


def group_boxes(boxes: DataFrame, g: Grouping) -> DataFrame:
    """Final text regions: suppression, links, components, merge."""
    live, links = linked(boxes, g)
    placed = live.join(components(live, links), ["image", "idx"])
    return merge_clusters(keep_larger(placed, g) if g.contained_box_threshold > g.high_iou_threshold else placed)


def pairs_checked(boxes: DataFrame, conflict: DataFrame) -> DataFrame:
    """(image, pairs): pairs the ordered visit looks at while both boxes live, told from the deaths alone.

    A box that dies as the second of a pair is no partner from the next row on, and has no row of its own; one
    that dies as the first ends its row there. So of all pairs of the boxes' ranks those go that such deaths take.
    """
    died = deaths(Scratch(boxes.sparkSession, "conflicts").save(conflict, "conflicts"))
    kind = boxes.schema["image"].dataType.simpleString()

    def count(all_boxes: pa.Table, dead: pa.Table) -> pa.Table:
        idx = sorted(all_boxes.column("idx").to_pylist())
        rank = {x: k for k, x in enumerate(idx)}
        n = len(idx)
        second, first = [], []  # (own rank, row in which it dies), (own rank, rank of its last partner)
        for x, i, j in zip(*(dead.column(c).to_pylist() for c in ("idx", "i", "j")), strict=True):
            (second if x == j else first).append((rank[x], rank[i if x == j else j]))
        pairs = n * (n - 1) // 2 - sum(n - 1 - a for a, _ in second) - sum(n - 1 - last for _, last in first)
        ranks, ended = sorted(b for b, _ in second), sorted((last, a) for a, last in first)
        tree, k = [0] * (n + 1), 0  # counts of rows that have ended, by their rank
        for b, row in sorted(second):
            while k < len(ended) and ended[k][0] < b:
                at, k = ended[k][1] + 1, k + 1
                while at <= n:
                    tree[at] += 1
                    at += at & -at
            after, at = k, row + 1
            while at:
                after -= tree[at]
                at -= at & -at
            between = b - row - 1 - (bisect_left(ranks, b) - bisect_right(ranks, row))
            pairs -= between - after
        if pairs <= 0:
            return pa.table([all_boxes.column("image").slice(0, 0), pa.array([], pa.int64())], names=["image", "pairs"])
        return pa.table([all_boxes.column("image").slice(0, 1), pa.array([pairs], pa.int64())], names=["image", "pairs"])

    return boxes.select("image", "idx").groupBy("image").cogroup(died.groupBy("image")).applyInArrow(lambda a, b: count(a, b), f"image {kind}, pairs long")
