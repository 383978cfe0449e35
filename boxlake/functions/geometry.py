"""Box geometry and validity as columns. Boxes are pixels with a top-left origin.

A missing or non-finite coordinate makes a box null: greatest and least skip nulls, and NaN is above every number, so both are
tested first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Border of the third source's pictures, and the size inside it.
BORDER, INNER_WIDTH, INNER_HEIGHT = 100, 640, 512
SMALL, MEDIUM = 32 * 32, 96 * 96
EDGE_TOLERANCE, AREA_TOLERANCE = 0.001, 0.01

C = Column | str


def col(x: C) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_finite(x: C) -> Column:
    """False for NaN and the infinities, and for null."""
    x = col(x).cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False))


def all_finite(*xs: C) -> Column:
    out = is_finite(xs[0])
    for x in xs[1:]:
        out = out & is_finite(x)
    return out


def clip_box(x: C, y: C, w: C, h: C, width: C, height: C) -> Column:
    """struct(x, y, w, h) of the part inside the picture, rounded to 3 digits; null where nothing is left."""
    x, y, w, h, width, height = map(col, (x, y, w, h, width, height))
    x1, y1 = F.greatest(F.lit(0.0), x), F.greatest(F.lit(0.0), y)
    x2, y2 = F.least(width.cast("double"), x + w), F.least(height.cast("double"), y + h)
    box = F.struct(*(F.round(v, 3).alias(k) for k, v in (("x", x1), ("y", y1), ("w", x2 - x1), ("h", y2 - y1))))
    return F.when(all_finite(x, y, w, h, width, height) & (x2 > x1) & (y2 > y1), box)


def keep_min_side(box: C, side: float = 2.0) -> Column:
    """Whether a box is there and its rounded sides are long enough."""
    box = col(box)
    return F.coalesce((box["w"] >= side) & (box["h"] >= side), F.lit(False))


def yolo_to_pixels(cx: C, cy: C, w: C, h: C, width: C, height: C) -> Column:
    """struct(x, y, w, h) in pixels of a box given by its centre and size relative to the picture."""
    cx, cy, w, h, width, height = map(col, (cx, cy, w, h, width, height))
    return F.struct(((cx - w / 2) * width).alias("x"), ((cy - h / 2) * height).alias("y"), (w * width).alias("w"), (h * height).alias("h"))


def corners_to_box(xs: list[C], ys: list[C], border: int = BORDER, width: int = INNER_WIDTH, height: int = INNER_HEIGHT) -> Column:
    """The clipped box around corners of a bordered picture; null where a coordinate is missing or nothing is left."""
    xs, ys = [col(v) - border for v in xs], [col(v) - border for v in ys]
    x, y = F.least(*xs), F.least(*ys)
    return F.when(all_finite(*xs, *ys), clip_box(x, y, F.greatest(*xs) - x, F.greatest(*ys) - y, F.lit(width), F.lit(height)))


def box_area(w: C, h: C) -> Column:
    return F.round(col(w) * col(h), 3)


def coco_size_bucket(area: C) -> Column:
    return F.when(col(area) < SMALL, "small").when(col(area) < MEDIUM, "medium").when(col(area).isNotNull(), "large")


def tiny_side_flags(w: C, h: C) -> dict[str, Column]:
    """Cumulative flags: a box with a side below 4 is below 8 and 16 too."""
    side = F.when(col(w).isNotNull() & col(h).isNotNull(), F.least(col(w), col(h)))
    return {f"side_below_{k}": side < k for k in (4, 8, 16)}


def touches_boundary(x: C, y: C, w: C, h: C, width: C, height: C) -> Column:
    return (col(x) <= 0) | (col(y) <= 0) | (col(x) + col(w) >= col(width)) | (col(y) + col(h) >= col(height))


def relative_area(w: C, h: C, width: C, height: C) -> Column:
    return col(w) * col(h) / (col(width) * col(height))


def box_issues(x: C, y: C, w: C, h: C, area: C, category: C, width: C, height: C, category_id: int = 1) -> dict[str, Column]:
    """Flags of an annotation, in order: later ones hold only for boxes that are whole and finite."""
    x, y, w, h, area = map(col, (x, y, w, h, area))
    malformed = x.isNull() | y.isNull() | w.isNull() | h.isNull()
    finite = all_finite(x, y, w, h)
    outside = (x < 0) | (y < 0) | (x + w > col(width) + EDGE_TOLERANCE) | (y + h > col(height) + EDGE_TOLERANCE)
    return {
        "wrong_category": ~col(category).eqNullSafe(F.lit(category_id)),
        "malformed_boxes": malformed,
        "nonfinite_boxes": ~malformed & ~finite,
        "nonpositive_boxes": finite & ((w <= 0) | (h <= 0)),
        "out_of_bounds_boxes": finite & F.coalesce(outside, F.lit(False)),
        "incorrect_areas": finite & (F.abs(F.coalesce(area, F.lit(-1.0)) - w * h) > AREA_TOLERANCE),
    }


def box_center(x1: C, y1: C, x2: C, y2: C) -> Column:
    return F.struct(((col(x1) + col(x2)) / 2).alias("cx"), ((col(y1) + col(y2)) / 2).alias("cy"))


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two corner boxes (x1, y1, x2, y2); 0 where both are empty."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    size = lambda r: (r["x2"] - r["x1"]) * (r["y2"] - r["y1"])
    union = size(a) + size(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def speed_to_kmh(px_s: C, meters_per_pixel: C | float) -> Column:
    scale = F.lit(meters_per_pixel) if isinstance(meters_per_pixel, (int, float)) else col(meters_per_pixel)
    return col(px_s) * scale * 3.6


def format_speed_label(track: C, px_s: C, meters_per_pixel: C | None = None) -> Column:
    """"#<id> | <speed>"; rounded half to even, since Java's own formatting rounds half up. A null scale gives px/s."""
    speed = F.when(col(px_s).isNull(), "-- px/s").otherwise(F.format_string("%.0f px/s", F.bround(col(px_s), 0)))
    if meters_per_pixel is not None:
        scaled = F.when(col(px_s).isNull(), "-- km/h").otherwise(F.format_string("%.1f km/h", F.bround(speed_to_kmh(px_s, meters_per_pixel), 1)))
        speed = F.when(col(meters_per_pixel).isNull(), speed).otherwise(scaled)
    return F.concat(F.lit("#"), col(track).cast("string"), F.lit(" | "), speed)


def unit_name(meters_per_pixel: C) -> Column:
    """The unit of speeds as a frame's status shows it, with the scale where there is one."""
    scale = col(meters_per_pixel)
    return F.when(scale.isNull(), "PX/S").otherwise(F.format_string("KM/H @ %.4f M/PX", F.bround(scale, 4)))
