"""The grouping rules once more, box by box in plain Python; for comparison only."""

from itertools import combinations


def share(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    return w * h if w > 0 and h > 0 else 0


def area(a):
    return (a[2] - a[0]) * (a[3] - a[1])


def contained(a, b):
    return share(a, b) / area(a) if area(a) and area(b) else 0.0


def survivors(boxes, t):
    dead = set()
    for i, j in combinations(range(len(boxes)), 2):
        if i not in dead and j not in dead:
            if contained(boxes[i], boxes[j]) > t:
                dead.add(i)
            elif contained(boxes[j], boxes[i]) > t:
                dead.add(j)
    return [i for i in range(len(boxes)) if i not in dead]


def centre(a):
    return (a[0] + a[2]) / 2, (a[1] + a[3]) / 2


def linked(a, b, g):
    wide = [x[2] - x[0] > x[3] - x[1] for x in (a, b)]
    if wide[0] != wide[1]:
        return False
    big, small = (a, b) if area(a) >= area(b) else (b, a)
    dx, dy = (big[2] - big[0]) * g.expansion_factor / 2, (big[3] - big[1]) * g.expansion_factor / 2
    cx, cy = centre(small)
    if not (big[0] - dx <= cx <= big[2] + dx and big[1] - dy <= cy <= big[3] + dy):
        return False
    union = area(a) + area(b) - share(a, b)
    if union and share(a, b) / union > g.iou_threshold:
        return True
    along, across = (0, 1) if wide[0] else (1, 0)
    extent = [x[across + 2] - x[across] for x in (a, b)]
    factor = g.vertical_alignment_factor if wide[0] else g.horizontal_alignment_factor
    if abs(centre(a)[across] - centre(b)[across]) >= min(extent) * factor:
        return False
    return min(abs(a[along] - b[along + 2]), abs(b[along] - a[along + 2])) < max(extent) * g.proximity_factor


def regions(boxes, g):
    live = survivors(boxes, g.contained_box_threshold)
    label = {i: i for i in live}
    for i, j in combinations(live, 2):
        if linked(boxes[i], boxes[j], g):
            low, high = sorted((label[i], label[j]))
            label = {k: low if v == high else v for k, v in label.items()}
    out = {}
    for i, c in label.items():
        out.setdefault(c, []).append(boxes[i])
    return {c: (min(b[0] for b in m), min(b[1] for b in m), max(b[2] for b in m), max(b[3] for b in m), len(m)) for c, m in out.items()}
