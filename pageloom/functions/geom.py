"""Box predicates as Column expressions (no UDFs).

Every function takes :class:`Box` values, i.e. four Columns, so the same expression serves as a
projection, a filter, or the residual condition of a page join.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x0: Column
    y0: Column
    x1: Column
    y1: Column


class NamedBox:
    """Box over columns of a DataFrame alias; columns are built on use, so it may live at module level."""

    def __init__(self, alias: str = ""):
        self.prefix = f"{alias}." if alias else ""

    x0 = property(lambda self: F.col(f"{self.prefix}x0"))
    y0 = property(lambda self: F.col(f"{self.prefix}y0"))
    x1 = property(lambda self: F.col(f"{self.prefix}x1"))
    y1 = property(lambda self: F.col(f"{self.prefix}y1"))


def box(alias: str = "") -> NamedBox:
    return NamedBox(alias)


def width(a: Box) -> Column:
    return a.x1 - a.x0


def height(a: Box) -> Column:
    return a.y1 - a.y0


def area(a: Box) -> Column:
    return width(a) * height(a)


def _ratio(num: Column, den: Column) -> Column:
    """num / den, and 0 where den is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def round_exact(value: Column, digits: int) -> Column:
    """Round the binary value itself, ties to even, as IEEE-based languages print it.

    SQL rounding works on the shortest decimal form, so 0.5075 (just below the tie in binary) would
    go up. The product with 10^digits is split into its rounded part and the exact remainder, which
    decides apparent ties.
    """
    scale = float(10 ** digits)
    product = value * F.lit(scale)
    split = value * F.lit(134217729.0)
    high = split - (split - value)
    rest = (high * F.lit(scale) - product) + (value - high) * F.lit(scale)
    whole = F.floor(product)
    past = product - whole - F.lit(0.5)
    up = (past > 0) | ((past == 0) & ((rest > 0) | ((rest == 0) & (whole % 2 == 1))))
    return (whole + up.cast("int")) / F.lit(scale)


def intersection(a: Box, b: Box) -> Column:
    """Common area; 0 for boxes that are apart or only touch."""
    w = F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)
    h = F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)
    return F.when((w < 0) | (h < 0), w * 0).otherwise(w * h)


def contains(inner: Box, outer: Box) -> Column:
    """G1: inner lies in outer, borders included."""
    return (
        (inner.x0 >= outer.x0) & (inner.y0 >= outer.y0)
        & (inner.x1 <= outer.x1) & (inner.y1 <= outer.y1)
    )


class Side(NamedTuple):
    left: Column
    right: Column
    bottom: Column
    top: Column


def relative_position(a: Box, b: Box) -> Side:
    """Where b lies seen from a (strict): b left of a, right of a, above a (bottom), below a (top)."""
    return Side(b.x1 < a.x0, a.x1 < b.x0, b.y1 < a.y0, a.y1 < b.y0)


def sides_apart(a: Box, b: Box) -> Column:
    """How many of the four relative positions hold; 2 means the boxes are diagonal."""
    return sum((s.cast("int") for s in relative_position(a, b)), F.lit(0))


def _gaps(a: Box, b: Box) -> tuple[Column, Column]:
    zero = F.lit(0)
    dx = F.greatest(a.x0 - b.x1, b.x0 - a.x1, zero).cast("double")
    dy = F.greatest(a.y0 - b.y1, b.y0 - a.y1, zero).cast("double")
    return dx, dy


def edge_distance(a: Box, b: Box) -> Column:
    """Gap between boxes, Euclidean between corners when diagonal, 0 when touching.

    With one axis gap at 0 the root equals the other gap, so one formula covers all cases.
    """
    dx, dy = _gaps(a, b)
    return F.sqrt(dx * dx + dy * dy)


def center_distance(a: Box, b: Box) -> Column:
    """Distance of the two centres."""
    dx = (a.x0 + a.x1) / 2.0 - (b.x0 + b.x1) / 2.0
    dy = (a.y0 + a.y1) / 2.0 - (b.y0 + b.y1) / 2.0
    return F.sqrt(dx * dx + dy * dy)


def overlap_of_smaller(a: Box, b: Box) -> Column:
    """Common area over the smaller area; zero area gives 0."""
    return _ratio(intersection(a, b), F.least(area(a), area(b)))


def first_is_smaller(a: Box, b: Box) -> Column:
    """Which box a ratio test would pick; equal areas pick the first."""
    return area(a) <= area(b)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; zero area on either side gives 0."""
    inter = intersection(a, b)
    value = _ratio(inter, area(a) + area(b) - inter)
    return F.when((area(a) == 0) | (area(b) == 0), F.lit(0.0)).otherwise(value)


def overlap_of_first(a: Box, b: Box) -> Column:
    """Common area over the area of a."""
    return _ratio(intersection(a, b), area(a))


def x_projection_overlap(a: Box, b: Box) -> Column:
    """Common x range over the width of a."""
    return _ratio(F.greatest(F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0), F.lit(0)), width(a))


def _axis_overlap(a0: Column, a1: Column, b0: Column, b1: Column, threshold: float) -> Column:
    shorter = F.least(a1 - a0, b1 - b0)
    common = F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0))
    return (shorter > 0) & (_ratio(common, shorter) > threshold)


def y_overlaps(a: Box, b: Box, threshold: float = 0.8) -> Column:
    """Common y range exceeds the share of the shorter box."""
    return _axis_overlap(a.y0, a.y1, b.y0, b.y1, threshold)


def x_overlaps(a: Box, b: Box, threshold: float = 0.8) -> Column:
    """G9 on x."""
    return _axis_overlap(a.x0, a.x1, b.x0, b.x1, threshold)


def _contained(apart: Column | None, size_a: Column, size_b: Column, common: Column, threshold: float) -> Column:
    """1 if less than ``threshold`` of a lies outside, else 2 if so for b, else null. Size <= 0 counts as inside."""
    out_a = F.when(size_a > 0, _ratio(size_a - common, size_a)).otherwise(F.lit(0.0))
    out_b = F.when(size_b > 0, _ratio(size_b - common, size_b)).otherwise(F.lit(0.0))
    verdict = F.when(out_a < threshold, F.lit(1)).when(out_b < threshold, F.lit(2))
    return verdict if apart is None else F.when(~apart, verdict)


def _apart(a: Box, b: Box) -> Column:
    return (a.x1 < b.x0) | (a.x0 > b.x1) | (a.y1 < b.y0) | (a.y0 > b.y1)


def box_contained(a: Box, b: Box, threshold: float = 0.2) -> Column:
    """1 if a is (nearly) inside b, 2 if b is inside a, else null."""
    return _contained(_apart(a, b), area(a), area(b), intersection(a, b), threshold)


def axis_contained(a: Box, b: Box, axis: str = "x", threshold: float = 0.2) -> Column:
    """The same on one axis; the common length may be negative."""
    if axis == "x":
        common = F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)
        return _contained(None, width(a), width(b), common, threshold)
    common = F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)
    return _contained(None, height(a), height(b), common, threshold)


def table_iou(a: Box, b: Box) -> Column:
    """IoU where two degenerate boxes that meet score 1."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return (
        F.when(_apart(a, b), F.lit(0.0))
        .when(union == 0, F.lit(1.0))
        .otherwise(_ratio(inter, union))
    )


def overlaps(a: Box, b: Box) -> Column:
    """The boxes share area; touching edges do not count."""
    return (F.least(a.x1, b.x1) > F.greatest(a.x0, b.x0)) & (F.least(a.y1, b.y1) > F.greatest(a.y0, b.y0))


def mostly_inside(small: Box, big: Box, share: float = 0.8) -> Column:
    """At least ``share`` of small lies in big."""
    return overlaps(small, big) & (intersection(small, big).cast("double") >= area(small) * F.lit(share))


def area_iou(a: Box, b: Box) -> Column:
    """IoU that is 0 for touching boxes and for an empty union."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.when(overlaps(a, b) & (union > 0), _ratio(inter, union)).otherwise(F.lit(0.0))


def structure_distance(a: Box, b: Box) -> Column:
    """L1 over both corners plus the nearer corner once more."""
    first = F.abs(b.x0 - a.x0) + F.abs(b.y0 - a.y0)
    second = F.abs(b.x1 - a.x1) + F.abs(b.y1 - a.y1)
    return first + second + F.least(first, second)


def structure_iou(a: Box, b: Box) -> Column:
    """IoU that is 0 when the boxes share no area."""
    inter = intersection(a, b)
    return F.when(overlaps(a, b), _ratio(inter, area(a) + area(b) - inter)).otherwise(F.lit(0.0))


# Marks that may close or open a line slightly outside its box.
CLOSING_MARKS = [
    ".", "!", "?", "。", "！", "？", ")", "）", '"', "”", ":", "：", ";", "；", "]", "】",
    "}", ">", "》", "、", ",", "，", "-", "—", "–",
]
OPENING_MARKS = ["(", "（", '"', "“", "【", "{", "《", "<", "「", "『", "["]
AXIS_SHARE = 0.33


def char_in_span(char: Box, span: Box, text: Column) -> Column:
    """A character belongs to a span by its centre; marks may also hang over a border.

    The centre line must lie within a third of the span height. A closing mark may start within one
    height before the right border, an opening mark may end within one height after the left one.
    """
    cx, cy = (char.x0 + char.x1) / 2.0, (char.y0 + char.y1) / 2.0
    span_height = height(span)
    level = (
        (cy > span.y0) & (cy < span.y1)
        & (F.abs(cy - (span.y0 + span.y1) / 2.0) < span_height * F.lit(AXIS_SHARE))
    )
    inside = (cx > span.x0) & (cx < span.x1)
    closing = (
        text.isin(CLOSING_MARKS) & (char.x0 > span.x1 - span_height) & (char.x0 < span.x1) & (cx > span.x0)
    )
    opening = (
        text.isin([m for m in OPENING_MARKS if m not in CLOSING_MARKS])
        & (char.x1 > span.x0) & (char.x1 < span.x0 + span_height) & (cx < span.x1)
    )
    return level & (inside | closing | opening)
