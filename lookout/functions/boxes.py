"""Boxes and label texts.

A box is a struct(class_id, cx, cy, w, h, conf), its sides as shares of the image, or four columns x1, y1, x2, y2.  Numbers are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def corners(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return F.struct((cx - w / 2).alias("x1"), (cy - h / 2).alias("y1"), (cx + w / 2).alias("x2"), (cy + h / 2).alias("y2"))


def centred(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(((x1 + x2) / 2).alias("cx"), ((y1 + y2) / 2).alias("cy"), (x2 - x1).alias("w"), (y2 - y1).alias("h"))


def iou(a: Column, b: Column, eps: float = 0.0) -> Column:
    """Intersection over union of structs of corners; 0 without an intersection.  eps is added to the union."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
    area = lambda x: F.greatest(F.lit(0.0), x["x2"] - x["x1"]) * F.greatest(F.lit(0.0), x["y2"] - x["y1"])
    inter = side("x1", "x2") * side("y1", "y2")
    union = area(a) + area(b) - inter + F.lit(eps)
    return F.when((inter > 0) & (union > 0), inter / union).otherwise(F.lit(0.0))


def clip(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def pixels(share: Column, size: Column) -> Column:
    """A side in whole pixels, cut off."""
    return (share * size).cast("int")


def expanded(x1: Column, y1: Column, x2: Column, y2: Column, least_width: Column, least_height: Column, width: Column, height: Column) -> Column:
    """A box of whole pixels, grown around its middle to least_width by least_height where either of its sides is shorter; a box that is large enough stays as it is.

    Where the image ends first, the box is put at that border and keeps the least side as far as the image has it.
    """
    small = ((x2 - x1) < least_width) | ((y2 - y1) < least_height)

    def span(lo: Column, hi: Column, least: Column, most: Column) -> tuple[Column, Column]:
        start = F.greatest(F.lit(0), lo - F.floor((least - (hi - lo)) / 2))
        end = F.least(most, start + least)
        short = (end - start) < least
        at_start = F.when(short & (start != 0), F.greatest(F.lit(0), most - least)).otherwise(start)
        at_end = F.when(short, F.when(start == 0, F.least(most, least)).otherwise(most)).otherwise(end)
        return F.when(small, at_start).otherwise(lo).cast("int"), F.when(small, at_end).otherwise(hi).cast("int")

    (a, c), (b, d) = span(x1, x2, least_width, width), span(y1, y2, least_height, height)
    return F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))


def square_crop(x1: Column, y1: Column, x2: Column, y2: Column, factor: float = 1.4) -> Column:
    """The square around a box whose side is its longer side times factor; it may stick out (and is padded)."""
    half = F.greatest(x2 - x1, y2 - y1) * factor / 2
    cx, cy = (x1 + x2) / 2, (y1 + y2) / 2
    return F.struct((cx - half).alias("x1"), (cy - half).alias("y1"), (cx + half).alias("x2"), (cy + half).alias("y2"))


def _tokens(text: Column) -> Column:
    """The non-blank lines of a label, each as its tokens.  Splits by one character only, as a pattern is compiled again for each value."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\r\n"), F.lit("\n"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    return F.transform(lines, lambda x: F.array_remove(F.split(F.translate(x, "\t\x0b\f\r", "    "), " "), ""))


def boxes(text: Column, most_tokens: int | None = None) -> Column:
    """The boxes in a label text.

    A line needs five tokens (class, centre, sides) that are numbers and positive sides; others are left out.  A sixth is the confidence, 1 where it is missing or no
    number.  An empty or null text has none.  NaN is no number here.
    """
    number = lambda t, i: F.get(t, F.lit(i)).try_cast("double")
    box = lambda t: F.struct(number(t, 0).cast("int").alias("class_id"), *[number(t, i).alias(n) for i, n in enumerate(("cx", "cy", "w", "h"), 1)], F.coalesce(F.nanvl(number(t, 5), F.lit(None).cast("double")), F.lit(1.0)).alias("conf"))
    ok = lambda b: b["cx"].isNotNull() & b["cy"].isNotNull() & ~F.isnan(b["cx"]) & ~F.isnan(b["cy"]) & ~F.isnan(b["w"]) & ~F.isnan(b["h"]) & (b["w"] > 0) & (b["h"] > 0)
    lines = F.split(F.translate(F.coalesce(text, F.lit("")), "\t\x0b\f\r", "    "), "\n")  # a line without five tokens, as a blank one, lacks a side and isn't ok
    tokens = F.transform(lines, lambda x: F.array_remove(F.split(x, " "), ""))  # a step of its own, as box() names its argument for each number
    return F.filter(F.transform(tokens, box), ok)


def normalised(text: Column) -> Column:
    """A label text with the first five tokens of each line, without blank lines or a newline at the end."""
    return F.array_join(F.transform(_tokens(text), lambda t: F.array_join(F.slice(t, 1, 5), " ")), "\n")


def max_score(text: Column) -> Column:
    """The highest confidence of lines with six tokens or more; 0 without one."""
    scores = F.transform(F.filter(_tokens(text), lambda t: F.size(t) >= 6), lambda t: F.get(t, F.lit(5)).try_cast("double"))
    return F.coalesce(F.array_max(scores), F.lit(0.0))


def label_text(found: Column, confidence: bool = False) -> Column:
    """Boxes back to a label text."""
    names = ["class_id", "cx", "cy", "w", "h", *["conf"] * confidence]
    return F.array_join(F.transform(found, lambda b: F.concat_ws(" ", *[b[n].cast("string") for n in names])), "\n")


def label_of_class(is_background: Column, text: Column) -> Column:
    """What is written for a frame: nothing for background, else its annotation in five columns."""
    return F.when(is_background, F.lit("")).otherwise(label_text(boxes(text)))


def platform_boxes(text: Column) -> Column:
    """`[[x1, y1, x2, y2, conf], ...]` as the platform gives it -> boxes; read as JSON, never run."""
    rows = F.from_json(F.translate(text, "()", "[]"), "array<array<double>>")
    return F.transform(rows, lambda x: F.struct(F.lit(0).alias("class_id"), ((x[0] + x[2]) / 2).alias("cx"), ((x[1] + x[3]) / 2).alias("cy"), (x[2] - x[0]).alias("w"), (x[3] - x[1]).alias("h"), x[4].alias("conf")))


def task_box(cx: Column, cy: Column, w: Column, h: Column, label: Column) -> Column:
    """A label tool's box: top left and sides in percent of the image."""
    return F.struct((100 * (cx - w / 2)).alias("x"), (100 * (cy - h / 2)).alias("y"), (100 * w).alias("width"), (100 * h).alias("height"), F.coalesce(label, F.lit("unknown")).alias("rectanglelabel"))


def homography_features(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1, a_width, a_height, b_width, b_height, det) -> Column:
    """struct(dcx, h_scale, s_area, d_area): how two views' matched regions lie to each other, each as shares of its own image; a scale only where the determinant is positive."""
    centre = lambda lo, hi, width: (lo + hi) / 2 / width
    area = lambda x0, y0, x1, y1, width, height: (x1 - x0) / width * ((y1 - y0) / height)
    dcx = centre(bx0, bx1, b_width) - centre(ax0, ax1, a_width)
    return F.struct(F.round(dcx, 4).alias("dcx"), F.round(F.when(det > 0, F.sqrt(det)), 4).alias("h_scale"), F.round(area(ax0, ay0, ax1, ay1, a_width, a_height), 4).alias("s_area"), F.round(area(bx0, by0, bx1, by1, b_width, b_height), 4).alias("d_area"))
