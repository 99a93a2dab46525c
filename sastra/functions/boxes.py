"""Expressions on boxes [x1, y1, x2, y2] and on page leaves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 999


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scale(box: str | Column, sx: Column, sy: Column) -> Column:
    return F.transform(_c(box), lambda v, i: v * F.when(i % 2 == 0, sx).otherwise(sy))


def scale_all(boxes: str | Column, sx: Column, sy: Column) -> Column:
    """Each box of a list, for the lines of a leaf."""
    return F.transform(_c(boxes), lambda b: scale(b, sx, sy))


def rotate_all(boxes: str | Column, degrees: Column, width: Column, height: Column) -> Column:
    return F.transform(_c(boxes), lambda b: rotate(b, degrees, width, height))


def to_grid(box: str | Column, width: Column, height: Column) -> Column:
    """Coordinates as whole steps of 0 to 999, halves to even, cut off at the ends."""
    return F.transform(_c(box), lambda v, i: F.greatest(F.lit(0), F.least(F.lit(GRID), F.bround(v / F.when(i % 2 == 0, width).otherwise(height) * GRID))).cast("int"))


def clip(box: str | Column, width: Column, height: Column) -> Column:
    return F.transform(_c(box), lambda v, i: F.greatest(F.lit(0.0), F.least(F.when(i % 2 == 0, width).otherwise(height).cast("double"), v)))


def rotate(box: str | Column, degrees: Column, width: Column, height: Column) -> Column:
    """The upright box around the box turned about the page's centre (counter-clockwise, y downwards), clipped."""
    b = _c(box)
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    cx, cy = width / 2, height / 2
    corners = [(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3])]
    xs = [c * (x - cx) + s * (y - cy) + cx for x, y in corners]
    ys = [-s * (x - cx) + c * (y - cy) + cy for x, y in corners]
    return clip(F.array(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)), width, height)


# What stands around a leaf's text in Markdown, by block type.
MARKDOWN = {"title": ("# ", ""), "section_header": ("## ", ""), "list_item": ("- ", ""), "caption": ("*", "*"), "form_label": ("**", "**")}


def markdown_text(block_type: str | Column, text: str | Column) -> Column:
    out = None
    for kind, (before, after) in MARKDOWN.items():
        value = F.concat(F.lit(before), _c(text), F.lit(after))
        out = F.when(_c(block_type) == kind, value) if out is None else out.when(_c(block_type) == kind, value)
    return out.otherwise(_c(text))


def grounded_text(block_type: str | Column, text: str | Column, grid_box: str | Column) -> Column:
    """One leaf of a grounded target: its Markdown text in reference tags and its box in detection tags."""
    numbers = F.array_join(F.transform(_c(grid_box), lambda v: v.cast("string")), ", ")
    return F.concat(F.lit("<|ref|>"), markdown_text(block_type, text), F.lit("<|/ref|><|det|>[["), numbers, F.lit("]]<|/det|>"))


def out_of_bounds(box: str | Column, width: Column, height: Column) -> Column:
    """A coordinate is negative or more than a pixel beyond the page."""
    b = _c(box)
    inside = (F.least(b[0], b[2]) >= 0) & (F.greatest(b[0], b[2]) <= width + 1) & (F.least(b[1], b[3]) >= 0) & (F.greatest(b[1], b[3]) <= height + 1)
    return ~inside


def no_area(box: str | Column) -> Column:
    b = _c(box)
    return (b[2] <= b[0]) | (b[3] <= b[1])


def off_grid(grid_box: str | Column) -> Column:
    """A grid coordinate is out of 0 to 999; a missing grid box is no fault."""
    return F.coalesce(F.exists(_c(grid_box), lambda v: (v < 0) | (v > GRID)), F.lit(False))
