"""Geometry of axis-aligned boxes as Columns, so that Catalyst sees all of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Grouping


@dataclass(frozen=True)
class Box:
    """The columns x0, y0, x1, y1 of one box, by alias and suffix; x1 and y1 lie on its far edges."""

    alias: str | None = None
    suffix: str = ""

    @classmethod
    def of(cls, alias: str | None = None, suffix: str = "") -> Box:
        return cls(alias, suffix)

    def _column(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}{self.suffix}" if self.alias else f"{name}{self.suffix}")

    @property
    def x0(self) -> Column:
        return self._column("x0")

    @property
    def y0(self) -> Column:
        return self._column("y0")

    @property
    def x1(self) -> Column:
        return self._column("x1")

    @property
    def y1(self) -> Column:
        return self._column("y1")

    @property
    def w(self) -> Column:
        return self.x1 - self.x0

    @property
    def h(self) -> Column:
        return self.y1 - self.y0

    @property
    def area(self) -> Column:
        return self.w * self.h

    @property
    def cx(self) -> Column:
        return (self.x0 + self.x1) / 2

    @property
    def cy(self) -> Column:
        return (self.y0 + self.y1) / 2

    @property
    def horizontal(self) -> Column:
        """For grouping: wider than high, so a square is vertical."""
        return self.w > self.h


def detector_angle(b: Box) -> Column:
    """For detection: 90 if higher than wide, so a square is horizontal."""
    return F.when(b.h > b.w, 90).otherwise(0)


def corners(b: Box) -> Column:
    """Top left, top right, bottom right, bottom left."""
    return F.array(F.array(b.x0, b.y0), F.array(b.x1, b.y0), F.array(b.x1, b.y1), F.array(b.x0, b.y1))


def envelope(quad: Column) -> tuple[Column, Column, Column, Column]:
    """x0, y0, x1, y1 around the points of a quad."""
    xs, ys = F.transform(quad, lambda p: p[0]), F.transform(quad, lambda p: p[1])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def normalised(quad: Column, width: Column, height: Column) -> Column:
    """Points over width and height; where either is zero both count as one."""
    flat = (width == 0) | (height == 0)
    w, h = F.when(flat, 1).otherwise(width), F.when(flat, 1).otherwise(height)
    return F.transform(quad, lambda p: F.array(p[0] / w, p[1] / h))


def moved(quad: Column, origin: Column) -> Column:
    """Points moved by a tile's first two coordinates; unchanged where it has fewer."""
    return F.when(F.size(origin) >= 2, F.transform(quad, lambda p: F.when(F.size(p) >= 2, F.array(p[0] + F.get(origin, F.lit(0)), p[1] + F.get(origin, F.lit(1)))).otherwise(p))).otherwise(quad)


def intersection(a: Box, b: Box) -> Column:
    """Shared area; boxes that only touch share none."""
    w = F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)
    h = F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)
    return F.when((w > 0) & (h > 0), w * h).otherwise(0)


def iou(a: Box, b: Box) -> Column:
    both = intersection(a, b)
    union = a.area + b.area - both
    return F.when(union > 0, both.cast("double") / union).otherwise(F.lit(0.0))


def contained_share(a: Box, b: Box) -> Column:
    """The share of a that b covers; 0 where either has no area."""
    return F.when((a.area > 0) & (b.area > 0), intersection(a, b).cast("double") / a.area).otherwise(F.lit(0.0))


def is_larger(a: Box, b: Box, a_first: Column) -> Column:
    """Whether a is the larger box; at equal areas the one of lower index."""
    return (a.area > b.area) | ((a.area == b.area) & a_first)


def in_reach(large: Box, small: Box, factor: float) -> Column:
    """Whether small's centre lies in large, expanded by half its size times factor on each side."""
    dx, dy = large.w * (factor / 2), large.h * (factor / 2)
    return small.cx.between(large.x0 - dx, large.x1 + dx) & small.cy.between(large.y0 - dy, large.y1 + dy)


#: The reasons of a decision on two boxes, in the order of the rules.
REASONS = (
    "primary_filter_failed_orientation_mismatch",
    "primary_filter_failed_not_spatial_neighbors",
    "high_overlap",
    "very_high_iou",
    "horizontal_text_poor_vertical_alignment",
    "horizontal_text_proximity",
    "horizontal_text_too_distant",
    "vertical_text_poor_horizontal_alignment",
    "vertical_text_proximity",
    "vertical_text_too_distant",
)
#: Those that link two boxes.
LINKING = ("high_overlap", "very_high_iou", "horizontal_text_proximity", "vertical_text_proximity")


def link_reason(a: Box, b: Box, a_larger: Column, g: Grouping) -> Column:
    """The rule that decides whether two boxes belong together; see LINKING."""
    reach = F.when(a_larger, in_reach(a, b, g.expansion_factor)).otherwise(in_reach(b, a, g.expansion_factor))
    share = iou(a, b)
    off_v = F.abs(a.cy - b.cy) >= F.least(a.h, b.h) * g.vertical_alignment_factor
    off_h = F.abs(a.cx - b.cx) >= F.least(a.w, b.w) * g.horizontal_alignment_factor
    near_h = F.least(F.abs(a.x0 - b.x1), F.abs(b.x0 - a.x1)) < F.greatest(a.h, b.h) * g.proximity_factor
    near_v = F.least(F.abs(a.y0 - b.y1), F.abs(b.y0 - a.y1)) < F.greatest(a.w, b.w) * g.proximity_factor
    rules = (
        a.horizontal != b.horizontal, ~reach, share > g.iou_threshold, share > g.high_iou_threshold,
        a.horizontal & off_v, a.horizontal & near_h, a.horizontal, off_h, near_v,
    )
    return F.coalesce(*(F.when(rule, reason) for rule, reason in zip(rules, REASONS, strict=False)), F.lit(REASONS[-1]))


def cells(low: Column, high: Column, cell: int) -> Column:
    """Numbers of the grid cells that an interval touches."""
    return F.sequence(F.floor(low / cell), F.floor(high / cell))


def cell_of(x: Column, cell: int) -> Column:
    return F.floor(x / cell)
