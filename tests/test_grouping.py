import random

import pytest
from pyspark.sql import functions as F

from inkplane.config import Grouping
from inkplane.functions import geometry as G
from inkplane.operators import grouping
from inkplane.plans import queries as Q

from . import model

CFG = Grouping()


def frame(spark, images):
    rows = [(k, i, *b, f"I_T{i % 3:04d}") for k, boxes in images.items() for i, b in enumerate(boxes)]
    return spark.createDataFrame(rows, "image long, idx long, x0 long, y0 long, x1 long, y1 long, tile_id string")


PAIRS = [
    ((0, 0, 100, 20), (105, 0, 180, 20), "horizontal_text_proximity"),
    ((0, 0, 100, 20), (120, 0, 150, 20), "horizontal_text_too_distant"),
    ((0, 0, 100, 20), (120, 0, 220, 20), "primary_filter_failed_not_spatial_neighbors"),
    ((0, 0, 100, 20), (0, 0, 20, 100), "primary_filter_failed_orientation_mismatch"),
    ((0, 0, 100, 20), (60, 0, 160, 20), "high_overlap"),
    ((0, 0, 100, 20), (50, 4, 90, 24), "high_overlap"),
    ((0, 0, 20, 100), (0, 105, 20, 180), "vertical_text_proximity"),
    ((0, 0, 100, 20), (80, 19, 160, 39), "horizontal_text_poor_vertical_alignment"),
]


@pytest.mark.parametrize(("a", "b", "reason"), PAIRS)
def test_reason(spark, a, b, reason):
    row = spark.createDataFrame([(*a, *b)], ", ".join(f"{c}_{s} long" for s in "ij" for c in grouping.BOX))
    i, j = G.Box.of(suffix="_i"), G.Box.of(suffix="_j")
    got = row.select(G.link_reason(i, j, G.is_larger(i, j, F.lit(True)), CFG).alias("r")).first().r
    assert got == reason


def test_suppression_is_greedy(spark):
    b = frame(spark, {0: [(0, 0, 100, 20), (0, 0, 92, 20), (90, 0, 100, 20)], 1: [(0, 0, 100, 20), (0, 0, 100, 20)], 2: [(10, 10, 10, 30), (0, 0, 50, 50)]})
    left = {(r.image, r.idx) for r in grouping.survivors(b, CFG).collect()}
    assert left == {(0, 1), (0, 2), (1, 1), (2, 0), (2, 1)}


def random_images(seed, n=40):
    rnd = random.Random(seed)
    out = {}
    for k in range(n):
        boxes = []
        for _ in range(rnd.randint(0, 25)):
            x, y, w, h = rnd.randint(0, 300), rnd.randint(0, 300), rnd.randint(0, 90), rnd.randint(0, 60)
            boxes.append((x, y, x + w, y + h))
        out[k] = boxes
    return out


@pytest.mark.parametrize("cell", [32, 128])
def test_regions_match_the_model(spark, cell):
    images = random_images(cell)
    got = {}
    for r in grouping.group_boxes(frame(spark, images), Grouping(cell=cell)).collect():
        got.setdefault(r.image, {})[r.component] = (r.x0, r.y0, r.x1, r.y1, r.n_boxes)
    assert got == {k: model.regions(b, CFG) for k, b in images.items() if b}


def test_low_threshold_meets_all_cells(spark):
    images, g = random_images(5, 15), Grouping(contained_box_threshold=0.3)
    left = {(r.image, r.idx) for r in grouping.survivors(frame(spark, images), g).collect()}
    assert left == {(k, i) for k, b in images.items() for i in model.survivors(b, 0.3)}


def test_iterative_components_agree(spark):
    b = frame(spark, random_images(9, 10))
    e = grouping.link_edges(b, CFG)
    one = grouping.components(b, e).orderBy("image", "idx").collect()
    assert one == grouping.components_iterative(b, e).select("image", "idx", "component").orderBy("image", "idx").collect()


def test_no_nested_loops_and_no_python(spark, sf_dir):
    plan = Q.group_boxes(spark, sf_dir)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and "Arrow" not in plan


def test_known_counts(spark, sf_dir):
    sizes = {r["size"]: r.components for r in Q.component_hist(spark, sf_dir).collect()}
    assert sizes == {1: 1168, 2: 221, 3: 17, 4: 4}
    assert Q.contained_pairs(spark, sf_dir).count() == 208 and Q.link_edges(spark, sf_dir).count() == 278


def test_empty(spark):
    assert grouping.group_boxes(frame(spark, {0: []}), CFG).count() == 0


def test_translation_moves_regions(spark):
    images = random_images(21, 10)
    moved = {k: [(x0 + 977, y0 + 311, x1 + 977, y1 + 311) for x0, y0, x1, y1 in b] for k, b in images.items()}
    one = {tuple(r) for r in grouping.group_boxes(frame(spark, images), CFG).select("image", "component", *grouping.BOX).collect()}
    two = {(r.image, r.component, r.x0 - 977, r.y0 - 311, r.x1 - 977, r.y1 - 311) for r in grouping.group_boxes(frame(spark, moved), CFG).collect()}
    assert one == two


def test_transposition_swaps_directions(spark):
    images = {k: [b for b in boxes if b[2] - b[0] != b[3] - b[1]] for k, boxes in random_images(22, 10).items()}
    turned = {k: [(y0, x0, y1, x1) for x0, y0, x1, y1 in b] for k, b in images.items()}
    swap = {"horizontal_text_proximity": "vertical_text_proximity", "vertical_text_proximity": "horizontal_text_proximity"}
    one = {(r.image, r.i, r.j, swap.get(r.reason, r.reason)) for r in grouping.link_edges(frame(spark, images), CFG).collect()}
    assert one == {(r.image, r.i, r.j, r.reason) for r in grouping.link_edges(frame(spark, turned), CFG).collect()}


def test_survivors_and_regions(spark):
    images = random_images(23, 12)
    b = frame(spark, images)
    left = grouping.survivors(b, CFG)
    assert grouping.conflicts(left, CFG).count() == 0
    placed = left.join(grouping.components(left, grouping.link_edges(left, CFG)), ["image", "idx"])
    assert placed.count() == left.count()
    inside = placed.join(grouping.merge_clusters(placed).withColumnsRenamed({c: f"r_{c}" for c in grouping.BOX}), ["image", "component"])
    assert inside.where("x0 < r_x0 or y0 < r_y0 or x1 > r_x1 or y1 > r_y1").count() == 0


def test_pairs_checked(spark):
    images = random_images(24, 6)
    b = frame(spark, images)
    got = {r.image: r.pairs for r in grouping.pairs_checked(b, grouping.conflicts(b, CFG)).collect()}
    want = {}
    for k, boxes in images.items():
        dead, n = set(), 0
        for i in range(len(boxes)):
            for j in range(i + 1, len(boxes)):
                if i in dead or j in dead:
                    continue
                n += 1
                if model.contained(boxes[i], boxes[j]) > CFG.contained_box_threshold:
                    dead.add(i)
                elif model.contained(boxes[j], boxes[i]) > CFG.contained_box_threshold:
                    dead.add(j)
        if n:
            want[k] = n
    assert got == want


def all_pairs(images):
    return {(k, i, j): (boxes[i], boxes[j]) for k, boxes in images.items() for j in range(len(boxes)) for i in range(j)}


def shared_area(a, b):
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def area(b):
    return (b[2] - b[0]) * (b[3] - b[1])


def reaches(a, b):
    """Whether two boxes i < j have one orientation and the smaller one's centre is in reach of the larger."""
    size = lambda x: (x[2] - x[0], x[3] - x[1])
    large, small = (a, b) if area(a) >= area(b) else (b, a)
    flat = size(a)[0] > size(a)[1], size(b)[0] > size(b)[1]
    return flat[0] == flat[1] and all(large[n] - size(large)[n] / 2 <= (small[n] + small[n + 2]) / 2 <= large[n + 2] + size(large)[n] / 2 for n in (0, 1))


def fixture_images(spark, sf_dir):
    out = {}
    for r in Q.X.boxes(spark, sf_dir).where("image < 3").collect():
        out.setdefault(r.image, []).append((r.idx, (r.x0, r.y0, r.x1, r.y1)))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("cell", [32, 128])
def test_all_overlapping_pairs(spark, cell):
    images = random_images(8)
    got = grouping.overlapping(frame(spark, images), Grouping(cell=cell)).collect()
    want = {k: (s / (area(a) + area(b) - s), s / area(a), s / area(b)) for k, (a, b) in all_pairs(images).items() if (s := shared_area(a, b))}
    assert {(r.image, r.i, r.j): (r.iou, r.share_i, r.share_j) for r in got} == want and len(got) == len(want) > 100


def test_pair_queries_have_all_pairs(spark, sf_dir):
    """Every pair of an image is decided, whatever the distance of its indices."""
    named = fixture_images(spark, sf_dir)
    pairs = {(k, v[i][0], v[j][0]): (v[i][1], v[j][1]) for k, v in named.items() for j in range(len(v)) for i in range(j)}
    overlap = {(r.image, r.i, r.j): (r.iou, r.share_i, r.share_j) for r in Q.queries()["pair_overlaps"](spark, sf_dir).where("image < 3").collect()}
    assert overlap == {k: (s / (area(a) + area(b) - s), s / area(a), s / area(b)) for k, (a, b) in pairs.items() if (s := shared_area(a, b))}
    decided = Q.queries()["pair_reasons"](spark, sf_dir).where("image < 3").collect()
    passing = {k for k, (a, b) in pairs.items() if reaches(a, b)}
    assert {(r.image, r.i, r.j) for r in decided} == passing and len(decided) == len(passing)
    assert not any(r.reason.startswith("primary") for r in decided)
    assert {j - i for _, i, j in passing} - {1, 2, 10, 1000}
    sample = {(r.image, r.i, r.j): r.reason for r in Q.connect_reason(spark, sf_dir).where("image < 3").collect()}
    assert {k: r for k, r in sample.items() if not r.startswith("primary")} == {k: r.reason for r in decided if (k := (r.image, r.i, r.j)) in sample}
