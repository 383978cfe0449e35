"""Labels to boxes: joins with pictures, class filters, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions.geometry import BORDER, INNER_HEIGHT, INNER_WIDTH, box_area, clip_box, corners_to_box, keep_min_side, yolo_to_pixels
from boxlake.functions.naming import DRONEVEHICLE_NAMES, VISDRONE_VEHICLES, strip

KEY = ["raw_split", "stem"]


def boxes_with_image_size(boxes: DataFrame, images: DataFrame, key: str | list[str] = "image_id") -> DataFrame:
    """boxes with the width and height of their picture; boxes without one go."""
    keys = [key] if isinstance(key, str) else key
    return boxes.join(images.select(*keys, "width", "height"), keys)


def clipped(boxes: DataFrame, min_side: float = 2.0) -> DataFrame:
    """boxes (x, y, w, h, width, height) cut to their picture, with area; too small ones go."""
    box = clip_box("x", "y", "w", "h", "width", "height")
    cut = boxes.withColumn("box", box).filter(keep_min_side("box", min_side))
    return cut.withColumns({k: F.col(f"box.{k}") for k in "xywh"}).withColumn("area", box_area("w", "h")).drop("box")


def attach_labels(images: DataFrame, label_files: DataFrame, keys: list[str] = KEY) -> tuple[DataFrame, DataFrame]:
    """Pictures that have a label file, be it empty, and those that have none. label_files: a listing, since empty files have no rows."""
    there = label_files.select(*keys).distinct()
    return images.join(there, keys, "left_semi"), images.join(there, keys, "left_anti")


def filter_visdrone(rows: DataFrame, ids: list[int] = VISDRONE_VEHICLES) -> DataFrame:
    """Rows that aren't bad, have a score and a vehicle's class."""
    return rows.filter(~F.col("bad_row") & (F.col("score") != 0) & F.col("class_id").isin(ids))


def filter_dronevehicle_class(name: str | Column, names: list[str] = DRONEVEHICLE_NAMES) -> Column:
    return F.coalesce(F.lower(strip(name)).isin(names), F.lit(False))


def visdrone_kept() -> Column:
    """Whether a parsed row isn't bad and has a score and a vehicle's class."""
    return ~F.col("bad_row") & (F.col("score") != 0) & F.col("class_id").isin(VISDRONE_VEHICLES)


def visdrone_marked(rows: DataFrame) -> DataFrame:
    """Parsed rows with their picture's size, with box: the clipped box of those that are kept, else null. One pass."""
    box = clip_box(*(F.col(k).cast("double") for k in "xywh"), "width", "height")
    rows = rows.withColumn("box", F.when(visdrone_kept(), box))
    return rows.withColumn("box", F.when(keep_min_side("box"), F.col("box")))


def visdrone_boxes(rows: DataFrame) -> DataFrame:
    """Parsed rows with their picture's size to clipped boxes."""
    kept = filter_visdrone(rows)
    return clipped(kept.withColumns({k: F.col(k).cast("double") for k in "xywh"}))


def yolo_boxes(rows: DataFrame) -> DataFrame:
    """Parsed rows with their picture's size to clipped boxes; the class isn't filtered."""
    good = rows.filter(~F.col("bad_row")).withColumn("p", yolo_to_pixels("cx", "cy", "w", "h", "width", "height"))
    return clipped(good.withColumns({k: F.col(f"p.{k}") for k in "xywh"}).drop("p", "cx", "cy"))


def _value(path: str) -> Column:
    text = F.trim(path)
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def voc_boxes(objects: DataFrame) -> DataFrame:
    """voc_marked() of the rows that have an object."""
    return voc_marked(objects.filter(F.col("object").isNotNull()))


def voc_marked(objects: DataFrame) -> DataFrame:
    """Objects with status and box (struct, null unless status is ok or invalid_box leaves none).

    status: skipped_class, bad_polygon (no fallback to the other element), bad_bndbox, point_only, invalid_box or ok;
    converted: whether a box element could be read, even if the box is invalid later.
    """
    names = [f"{a}{i}" for i in range(1, 5) for a in "xy"]
    polygon = {k: _value(f"object.polygon.{k}") for k in names}
    bndbox = {k: _value(f"object.bndbox.{k}") for k in ("xmin", "ymin", "xmax", "ymax")}
    rows = objects.withColumns({f"_{k}": v for k, v in (polygon | bndbox).items()})

    def whole(keys) -> Column:
        out = F.lit(True)
        for k in keys:
            out = out & F.col(f"_{k}").isNotNull()
        return out

    is_vehicle = filter_dronevehicle_class("object.name")
    has_polygon, has_bndbox = F.col("object.polygon").isNotNull(), F.col("object.bndbox").isNotNull()
    from_polygon = corners_to_box([f"_x{i}" for i in range(1, 5)], [f"_y{i}" for i in range(1, 5)])
    # corners in the wrong order leave nothing, unlike a polygon's
    from_bndbox = clip_box(F.col("_xmin") - BORDER, F.col("_ymin") - BORDER, F.col("_xmax") - F.col("_xmin"), F.col("_ymax") - F.col("_ymin"), F.lit(INNER_WIDTH), F.lit(INNER_HEIGHT))
    box = F.when(has_polygon, from_polygon).when(has_bndbox, from_bndbox)
    rows = rows.withColumn("box", F.when(is_vehicle, box))
    status = (
        F.when(~is_vehicle, "skipped_class")
        .when(has_polygon & ~whole(names), "bad_polygon")
        .when(~has_polygon & has_bndbox & ~whole(bndbox), "bad_bndbox")
        .when(~has_polygon & ~has_bndbox, "point_only")
        .when(~keep_min_side("box"), "invalid_box")
        .otherwise("ok")
    )
    converted = is_vehicle & ~has_polygon & has_bndbox & whole(bndbox)
    return rows.withColumns({"status": status, "converted": converted}).drop(*(f"_{k}" for k in [*names, *bndbox]))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All readers' rows; columns that one lacks are null."""
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def source_stats(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """metric, value: rows for which each flag holds, in one pass. Counts, not accumulators, as tasks can run twice."""
    one = rows.agg(*(F.count_if(c).alias(k) for k, c in flags.items()))
    pairs = ", ".join(f"'{k}', `{k}`" for k in flags)
    return one.selectExpr(f"stack({len(flags)}, {pairs}) as (metric, value)")


def _kept(x: str, y: str, w: str, h: str) -> Column:
    return keep_min_side(clip_box(x, y, w, h, "width", "height"))


def visdrone_metric() -> Column:
    """The counter of a parsed row with its picture's size: bad_rows, class_<id>_boxes or invalid_boxes; null for rows that are left out silently."""
    kept = F.concat(F.lit("visdrone_class_"), F.col("class_id").cast("string"), F.lit("_boxes"))
    out = (F.col("score") == 0) | ~F.col("class_id").isin(VISDRONE_VEHICLES)
    return F.when(F.col("bad_row"), "visdrone_bad_rows").when(out, F.lit(None)).when(_kept("x", "y", "w", "h"), kept).otherwise("visdrone_invalid_boxes")


def yolo_metric() -> Column:
    """The counter of a parsed row with its picture's size: bad_rows, source_class_<id>_boxes or invalid_boxes."""
    kept = F.concat(F.lit("uavdt_source_class_"), F.col("class_id").cast("string"), F.lit("_boxes"))
    p = yolo_to_pixels("cx", "cy", "w", "h", "width", "height")
    fits = keep_min_side(clip_box(p["x"], p["y"], p["w"], p["h"], "width", "height"))
    return F.when(F.col("bad_row"), "uavdt_bad_rows").when(fits, kept).otherwise("uavdt_invalid_boxes")


def voc_metrics() -> Column:
    """The counters, as an array, of an object of voc_boxes()."""
    name = F.coalesce(F.lower(strip("object.name")), F.lit(""))
    named = {"skipped_class": F.concat(F.lit("dronevehicle_skipped_class:"), name), "point_only": F.lit("dronevehicle_point_only_skipped"), "invalid_box": F.lit("dronevehicle_invalid_boxes")}
    status = F.lit(None).cast("string")
    for k, v in named.items():
        status = F.when(F.col("status") == k, v).otherwise(status)
    status = F.when(F.col("status").isin("bad_polygon", "bad_bndbox"), F.concat(F.lit("dronevehicle_"), F.col("status"))).otherwise(status)
    return F.array_compact(F.array(status, F.when(F.col("converted"), "dronevehicle_bndbox_converted")))


def xml_metrics() -> Column:
    """The counters, as an array, of a row of voc_marked(): an object's, or that of a document that can't be read (one row)."""
    return F.when(F.col("bad_xml"), F.array(F.lit("dronevehicle_bad_xml"))).when(F.col("object").isNotNull(), voc_metrics())


def counted(rows: DataFrame, metric: Column) -> DataFrame:
    """metric, value of the rows' counters (a text or an array of texts); null counts nothing."""
    named = rows.select(metric.alias("metric"))
    several = F.col("metric") if dict(named.dtypes)["metric"].startswith("array") else F.array("metric")
    # an outer generator: from another one Spark infers a filter on the array, for which it would work out the whole counter again for each column that the counter is made of
    named = named.select(F.explode_outer(several).alias("metric"))
    return named.filter("metric is not null").groupBy("metric").agg(F.count("*").alias("value"))


def box_counts(images: DataFrame, boxes: DataFrame, key: str = "image_id") -> DataFrame:
    """images with n_boxes; zero for those without any."""
    n = boxes.groupBy(key).agg(F.count("*").alias("n_boxes"))
    return images.join(n, key, "left").withColumn("n_boxes", F.coalesce("n_boxes", F.lit(0)).cast("bigint"))


def reusable_crops(images: DataFrame, crops: DataFrame) -> DataFrame:
    """images with materialized_path where a crop is listed (file_name, path), else crop_border is true."""
    found = crops.select(F.col("file_name").alias("output_name"), F.col("path").alias("materialized_path"))
    return images.join(found, "output_name", "left").withColumn("crop_border", F.col("materialized_path").isNull())


def picture_counters(decoded: DataFrame, label_files: DataFrame, kept: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """metric, value: pictures that can't be decoded, decoded ones without labels (both per source), and pictures before and after exact deduplication.

    decoded: source_dataset, keys, decode_ok; kept: one row per picture that stays.
    """
    good = decoded.filter("decode_ok")
    with_labels, without = attach_labels(good, label_files, keys)
    name = lambda kind: F.concat("source_dataset", F.lit(kind))
    parts = [(decoded.filter(~F.col("decode_ok")), name("_corrupt_images")), (without, name("_missing_labels")), (with_labels, F.lit("images_before_exact_dedup")), (kept, F.lit("images_after_exact_dedup"))]
    return union_sources(*(counted(rows, metric) for rows, metric in parts))


def negative_images(images: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    return images.join(boxes.select(*keys).distinct(), keys, "left_anti")


def orphan_annotations(annotations: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    return annotations.join(images.select(*keys).distinct(), keys, "left_anti")
