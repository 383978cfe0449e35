"""Detections per frame: tiles, overlaps, suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions.geometry import iou

FRAME = ["video_id", "frame_number"]
BOX = ["x1", "y1", "x2", "y2"]
CONFIDENCE, TRACK_THRESHOLD, NMS_IOU = 0.15, 0.50, 0.50
SLICE_SIZE, SLICE_OVERLAP = 960, 160
MODES = ("full", "slice", "both")


def confidence_filter(rows: DataFrame, confidence: float = CONFIDENCE, track_threshold: float = TRACK_THRESHOLD) -> DataFrame:
    """Rows of at least that confidence, which must not exceed the tracker's threshold."""
    for name, x in (("confidence", confidence), ("track_threshold", track_threshold)):
        if not 0 < x < 1:
            raise ValueError(f"{name} must be between 0 and 1")
    if confidence > track_threshold:
        raise ValueError("confidence must not exceed track_threshold")
    return rows.filter(F.col("confidence") >= confidence)


def _starts(length: Column, size: int, step: int) -> Column:
    """Tile starts along one side; the last tile ends at the edge."""
    last = F.greatest(length - size, F.lit(0))
    regular = F.filter(F.sequence(F.lit(0), last, F.lit(step)), lambda v: v < last)
    return F.array_append(regular, last)


def slice_grid(frames: DataFrame, size: int = SLICE_SIZE, overlap: int = SLICE_OVERLAP) -> DataFrame:
    """frames (width, height) with one row per tile: tile_x, tile_y, tile_width, tile_height."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    w, h, step = F.col("width").cast("int"), F.col("height").cast("int"), size - overlap
    rows = frames.withColumn("tile_y", F.explode(_starts(h, size, step))).withColumn("tile_x", F.explode(_starts(w, size, step)))
    return rows.withColumns({"tile_width": F.least(F.lit(size), w), "tile_height": F.least(F.lit(size), h)})


def slice_to_frame(rows: DataFrame) -> DataFrame:
    """Boxes local to a tile (tile_x, tile_y) in frame coordinates."""
    shift = {k: F.col(k) + F.col("tile_x" if k[0] == "x" else "tile_y") for k in BOX}
    return rows.withColumns(shift).drop("tile_x", "tile_y")


#: A frame's cells have twice the mean side of its boxes, and a sixteenth of its largest side at least, so a box touches 17 x 17 cells at most.
MEANS, MOST_CELLS = 2.0, 16


def _in_cells(boxes: DataFrame, keys: list[str], cell: Column) -> DataFrame:
    """boxes (x1, y1, x2, y2) once for each cell of their frame that they touch."""
    along = lambda a, b: F.sequence(F.floor(F.col(a) / cell), F.floor(F.greatest(F.col(a), F.col(b)) / cell))
    return boxes.withColumn("_cx", F.explode(along("x1", "x2"))).withColumn("_cy", F.explode(along("y1", "y2")))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], least: float) -> DataFrame:
    """Pairs of boxes of the same keys with an overlap of at least `least`: a and b (structs of the other columns) and iou.

    Boxes meet in cells of a grid, whose side follows the frame's boxes, and a pair is taken in the cell of its intersection's first corner only; so a frame with many boxes takes
    time in proportion to the pairs that touch, and is shared by as many tasks as it has cells. least must be above 0.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    sides = left.select(*keys, side.alias("s")).unionByName(right.select(*keys, side.alias("s"))).filter("s >= 0")
    cells = sides.groupBy(*keys).agg(F.greatest(F.avg("s") * MEANS, F.max("s") / MOST_CELLS, F.lit(1e-6)).alias("_cell"))

    def dealt(rows: DataFrame, name: str) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        placed = _in_cells(rows.filter("x1 <= x2 and y1 <= y2").join(cells, keys), keys, F.col("_cell"))
        return placed.select(*keys, "_cx", "_cy", "_cell", F.struct(*rest).alias(name))

    both = dealt(left, "a").join(dealt(right, "b").drop("_cell"), [*keys, "_cx", "_cy"])
    corner = lambda k, c: F.floor(F.greatest(F.col(f"a.{k}"), F.col(f"b.{k}")) / F.col("_cell")) == F.col(c)
    box = lambda s: {k: F.col(f"{s}.{k}") for k in BOX}
    return both.filter(corner("x1", "_cx") & corner("y1", "_cy")).withColumn("iou", iou(box("a"), box("b"))).filter(F.col("iou") >= least).select(*keys, "a", "b", "iou")


def iou_pairs(rows: DataFrame, least: float = 0.5) -> DataFrame:
    """Pairs of detections of one frame whose overlap exceeds `least`."""
    boxes = rows.select(*FRAME, "det_no", *BOX)
    pairs = overlapping(boxes, boxes, FRAME, max(least, 1e-9)).filter((F.col("a.det_no") < F.col("b.det_no")) & (F.col("iou") > least))
    return pairs.select(*FRAME, F.col("a.det_no").alias("a_det_no"), F.col("b.det_no").alias("b_det_no"), "iou")


def nms(rows: DataFrame, threshold: float = NMS_IOU) -> DataFrame:
    """Class-agnostic greedy suppression per frame: by falling confidence, then det_no; a box goes if it overlaps a kept one by more than threshold.

    A frame's boxes are folded into the list of kept ones, inside the JVM.
    """
    others = [c for c in rows.columns if c not in FRAME]
    item = F.struct((-F.col("confidence")).alias("_c"), F.col("det_no").alias("_d"), F.struct(*others).alias("r"))
    lists = rows.groupBy(*FRAME).agg(F.sort_array(F.collect_list(item)).alias("a"))
    lists = lists.select(*FRAME, F.col("a.r").alias("a"))
    box = lambda s: {k: s[k] for k in BOX}
    none = F.slice("a", 1, 0)
    kept = F.aggregate("a", none, lambda k, d: F.when(F.exists(k, lambda q: iou(box(q), box(d)) > threshold), k).otherwise(F.array_append(k, d)))
    return lists.select(*FRAME, F.inline(kept)).select(*rows.columns)


def merge_full_and_slices(rows: DataFrame, mode: str = "both", threshold: float = NMS_IOU) -> DataFrame:
    """Detections by origin (full, slice): one origin, or both; slices are suppressed first, then all together."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    full, tiles = rows.filter("origin = 'full'"), rows.filter("origin = 'slice'")
    if mode == "full":
        return nms(full, threshold)
    tiles = nms(tiles, threshold)
    return tiles if mode == "slice" else nms(full.unionByName(tiles), threshold)
