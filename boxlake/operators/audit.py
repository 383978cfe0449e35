"""Dataset audit: issue counters, quantiles, histograms, leaks between splits, samples."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.functions.geometry import box_issues, coco_size_bucket, is_finite, relative_area, tiny_side_flags, touches_boundary
from boxlake.functions.naming import resolution_key, source_name
from boxlake.operators.dedup import manifest_diff
from boxlake.scratch import stored

QUANTILES = {"min": 0.0, "p01": 0.01, "p05": 0.05, "p10": 0.10, "p50": 0.50, "p90": 0.90, "p95": 0.95, "p99": 0.99, "max": 1.0}
#: Accuracy of the sketches of exact quantiles, and half the width of a bracket in steps of 1 / SKETCH.
SKETCH, SPREAD = 10_000, 3


def flagged(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """annotations (split, image_id, x, y, w, h, area, category_id) with their picture's columns and all issue flags.

    Of several pictures with one id the last counts: the one with the greatest `position` in its document if images has that column, else the greatest file_name, width and height.
    """
    place = [c for c in ("position", "file_name", "width", "height") if c in images.columns]
    last = F.max(F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(place)), F.struct("width", "height", "file_name").alias("side"))).alias("last")
    sides = images.groupBy("split", "image_id").agg(last).select("split", "image_id", "last.side.*", F.lit(True).alias("known"))
    rows = annotations.join(sides, ["split", "image_id"], "left")
    orphan = F.col("known").isNull()
    flags = box_issues("x", "y", "w", "h", "area", "category_id", "width", "height")
    return rows.withColumns({"orphan_annotations": orphan} | {k: F.coalesce(~orphan & v, F.lit(False)) for k, v in flags.items()}).drop("known")


def measured(rows: DataFrame) -> DataFrame:
    """flagged() rows that count in statistics: known picture, whole and finite (boxes that aren't positive stay)."""
    return rows.filter(~F.col("orphan_annotations") & ~F.col("malformed_boxes") & ~F.col("nonfinite_boxes"))


def unpivoted(row: DataFrame, by: list[str], names: list[str], key: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', cast(`{n}` as bigint)" for n in names)
    return row.selectExpr(*by, f"stack({len(names)}, {pairs}) as ({key}, value)")


ISSUES = ["orphan_annotations", "wrong_category", "malformed_boxes", "nonfinite_boxes", "nonpositive_boxes", "out_of_bounds_boxes", "incorrect_areas"]


def id_duplicates(rows: DataFrame, id_: str, name: str) -> DataFrame:
    """split, issue, value: ids that repeat, per split."""
    n = rows.filter(F.col(id_).isNotNull()).groupBy("split", id_).agg(F.count("*").alias("n")).groupBy("split").agg(F.sum(F.col("n") - 1).alias("value"))
    return n.select("split", F.lit(name).alias("issue"), "value")


def audit_issues(annotations: DataFrame, images: DataFrame, categories: DataFrame | None = None, present: DataFrame | None = None, decoded: DataFrame | None = None) -> DataFrame:
    """split, issue, value of all issues that occur.

    present: split and file_name on disk. decoded: split, file_name, width, height, decode_ok of the files themselves.
    """
    found = stored(flagged(annotations, images).select("split", "annotation_id", *ISSUES))  # read for its flags and its ids
    counts = unpivoted(found.groupBy("split").agg(*(F.count_if(k).alias(k) for k in ISSUES)), ["split"], ISSUES, "issue")
    out = counts.unionByName(id_duplicates(images, "image_id", "duplicate_image_ids")).unionByName(id_duplicates(found, "annotation_id", "duplicate_annotation_ids"))
    if categories is not None:
        out = out.unionByName(unexpected_categories(categories))
    if present is not None:
        diff = manifest_diff(images, present, ["split", "file_name"])
        out = out.unionByName(diff.groupBy("split", F.concat("side", F.lit("_files")).alias("issue")).agg(F.count("*").alias("value")))
    if decoded is not None:
        out = out.unionByName(decode_issues(images, decoded).groupBy("split", "issue").agg(F.count("*").alias("value")))
    return out.filter("value > 0")


def categories_match(categories: str | Column) -> Column:
    """Whether the list is exactly the one vehicle category."""
    one = F.array(F.struct(F.lit(1).alias("id"), F.lit("vehicle").alias("name"), F.lit("vehicle").alias("supercategory")))
    return F.coalesce(F.col(categories) == one, F.lit(False)) if isinstance(categories, str) else F.coalesce(categories == one, F.lit(False))


def unexpected_categories(categories: DataFrame) -> DataFrame:
    return categories.select("split", F.lit("unexpected_categories").alias("issue"), (~categories_match("categories")).cast("bigint").alias("value"))


def decode_issues(images: DataFrame, decoded: DataFrame) -> DataFrame:
    """split, issue, file_name, actual, declared of files that don't decode or have another size than declared."""
    d = decoded.select("split", "file_name", F.col("width").alias("dw"), F.col("height").alias("dh"), "decode_ok")
    both = images.select("split", "file_name", "width", "height").join(d, ["split", "file_name"])
    wrong = (F.col("dw") != F.col("width")) | (F.col("dh") != F.col("height"))
    issue = F.when(~F.col("decode_ok"), "decode_errors").when(wrong, "dimension_mismatches")
    return both.withColumn("issue", issue).filter("issue is not null").select("split", "issue", "file_name", resolution_key("dw", "dh").alias("actual"), resolution_key("width", "height").alias("declared"))


def first_rows(rows: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def issue_examples(annotations: DataFrame, images: DataFrame, n: int = 10) -> DataFrame:
    """split, issue, file_name, annotation_id: the first n examples of each issue."""
    found = flagged(annotations, images)
    each = F.explode(F.array_compact(F.array(*(F.when(F.col(k), F.lit(k)) for k in ISSUES))))
    rows = found.select("split", each.alias("issue"), F.coalesce("file_name", F.lit("")).alias("file_name"), "annotation_id")
    return first_rows(rows, ["split", "issue"], ["file_name", "annotation_id"], n)


def boxes_per_image(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """split, image_id, n_boxes: malformed boxes count, pictures without boxes have zero."""
    n = annotations.groupBy("split", "image_id").agg(F.count("annotation_id").alias("n_boxes"))
    return images.select("split", "image_id").join(n, ["split", "image_id"], "left").select("split", "image_id", F.coalesce("n_boxes", F.lit(0)).alias("n_boxes"))


def quantiles(rows: DataFrame, by: list[str], values: list[str], approximate: bool = False) -> DataFrame:
    """by, metric, quantile, value: linear interpolation, rounded to 6. approximate: percentile sketches alone.

    The exact form takes sketches of all values in one pass, with partial results, and from them a bracket around each wanted pair of neighbouring ranks. A second pass counts what lies
    below each bracket and keeps, as values with counts, only what lies inside: about SPREAD of 2 * SKETCH values each. Ranks are then found inside their brackets. A sketch's error is
    bounded; should a bracket still miss its rank, that one is taken as wide as the values.
    """
    names = F.array(*(F.struct(F.lit(k).alias("quantile"), F.lit(f).alias("f")) for k, f in QUANTILES.items()))
    if approximate:
        at = F.array(*(F.lit(f) for f in QUANTILES.values()))
        row = rows.groupBy(*by).agg(*(F.percentile_approx(v, at, F.lit(100_000)).alias(v) for v in values))
        long = row.selectExpr(*by, _stacked(values, "q")).filter("q is not null")
        long = long.select(*by, "metric", F.explode(F.arrays_zip(names.alias("n"), F.col("q").alias("value"))).alias("z"))
        return long.select(*by, "metric", F.col("z.n.quantile").alias("quantile"), F.round("z.value", 6).alias("value"))
    keys = [*by, "metric"]
    rows = stored(rows.select(*by, *(F.col(v).cast("double").alias(v) for v in values)))
    within = lambda f: min(max(f, 0.0), 1.0)
    ends = F.array(*(F.lit(within(f + d * SPREAD / SKETCH)) for f in QUANTILES.values() for d in (-1, 1)))

    def sketch(v: str) -> Column:
        return F.struct(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.percentile_approx(v, ends, F.lit(SKETCH)).alias("e"))

    sketches = stored(rows.groupBy(*by).agg(*(sketch(v).alias(v) for v in values)).selectExpr(*by, _stacked(values, "s")).filter("s.n > 0").select(*keys, "s.*"))
    many = range(len(QUANTILES))
    told = sketches.select(*keys, "n", "least", "most", *(F.col("e")[2 * k].alias(f"lo{k}") for k in many), *(F.col("e")[2 * k + 1].alias(f"hi{k}") for k in many))
    each = rows.selectExpr(*by, _stacked(values, "v")).filter("v is not null")
    holds_value = lambda k: (F.col(f"lo{k}") <= F.col("v")) & (F.col(f"hi{k}") >= F.col("v"))

    def counted(told: DataFrame) -> DataFrame:
        """keys, tag, v, c: how many values lie below `tag` brackets; those inside one or more are counted each for itself, others together."""
        bounds = told.drop("n", "least", "most")
        tag = sum(((F.col(f"lo{k}") > F.col("v")).cast("int") for k in many), F.lit(0))
        inside = reduce(or_, (holds_value(k) for k in many))
        tags = each.join(F.broadcast(bounds), keys).select(*keys, tag.alias("tag"), F.when(inside, F.col("v")).alias("v"))  # a row a group and metric
        return stored(tags.groupBy(*keys, "tag", "v").agg(F.count("*").alias("c")))

    def placed(told: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """keys, k, r, n with below and inside: how many values lie below the bracket and in it. Brackets ascend, so a value below one is below all later ones. And the values by bracket."""
        marks = counts.filter("v is not null").join(F.broadcast(told.drop("n", "least", "most")), keys)
        kept = marks.select(*keys, "v", "c", F.explode(F.array_compact(F.array(*(F.when(holds_value(k), F.lit(k)) for k in many)))).alias("k"))
        sums = kept.groupBy(*keys, "k").agg(F.sum("c").alias("inside"))
        low = counts.groupBy(*keys).agg(F.array(*(F.sum(F.when(F.col("tag") >= len(QUANTILES) - k, F.col("c")).otherwise(0)) for k in many)).alias("low"))
        ranks = F.array(*(F.struct(F.lit(k).alias("k"), F.floor(F.lit(f) * (F.col("n") - 1)).alias("r")) for k, f in enumerate(QUANTILES.values())))
        one = told.join(low, keys).select(*keys, "n", "low", F.explode(ranks).alias("x")).select(*keys, "n", "x.k", "x.r", F.get("low", F.col("x.k")).alias("below"))
        return one.join(sums, [*keys, "k"], "left").select(*keys, "k", "r", "n", "below", F.coalesce("inside", F.lit(0)).alias("inside")), kept

    counts = counted(told)
    places, kept = placed(told, counts)
    last = F.least(F.col("r") + 1, F.col("n") - 1)
    missed = (F.col("below") > F.col("r")) | (F.col("below") + F.col("inside") <= last)
    places = stored(places)
    if places.filter(missed).limit(1).count():
        again = told.join(places.filter(missed).select(*keys).distinct().withColumn("wide", F.lit(True)), keys, "left")
        wide = F.coalesce("wide", F.lit(False))
        ends = {f"lo{k}": F.when(wide, F.col("least")).otherwise(F.col(f"lo{k}")) for k in many} | {f"hi{k}": F.when(wide, F.col("most")).otherwise(F.col(f"hi{k}")) for k in many}
        told = stored(again.withColumns(ends).drop("wide"))
        counts = counted(told)
        places, kept = placed(told, counts)
    at = F.element_at(F.array(*(F.lit(f) for f in QUANTILES.values())), F.col("k") + 1) * (F.col("n") - 1)
    running = F.sum("c").over(W.partitionBy(*keys, "k").orderBy("v"))
    numbered = kept.withColumn("end", running)
    found = numbered.join(F.broadcast(places), [*keys, "k"]).withColumns({"at": at, "last": last, "end": F.col("end") + F.col("below")})  # a row a group, metric and quantile
    # of two neighbouring ranks each counts by its nearness
    part = F.col("at") - F.col("r")
    holds = lambda r: (F.col(r) < F.col("end")) & (F.col(r) >= F.col("end") - F.col("c"))
    share = F.when(holds("r"), 1 - part).otherwise(0.0) + F.when(holds("last"), part).otherwise(0.0)
    name = F.element_at(F.array(*(F.lit(k) for k in QUANTILES)), F.col("k") + 1)
    return found.filter(holds("r") | holds("last")).groupBy(*keys, name.alias("quantile")).agg(F.round(F.sum(F.when(share > 0, F.col("v") * share).otherwise(0.0)), 6).alias("value"))


def _stacked(values: list[str], name: str) -> str:
    pairs = ", ".join(f"'{v}', `{v}`" for v in values)
    return f"stack({len(values)}, {pairs}) as (metric, {name})"


def box_quantiles(annotations: DataFrame, images: DataFrame, approximate: bool = False) -> DataFrame:
    """split, metric, quantile, value for widths, heights, relative areas and boxes per picture."""
    boxes = measured(flagged(annotations, images)).select("split", F.col("w").alias("box_width"), F.col("h").alias("box_height"), relative_area("w", "h", "width", "height").alias("relative_area"))
    one = quantiles(boxes, ["split"], ["box_width", "box_height", "relative_area"], approximate)
    return one.unionByName(quantiles(boxes_per_image(images, annotations).withColumnRenamed("n_boxes", "boxes_per_image"), ["split"], ["boxes_per_image"], approximate))


def top_resolutions(images: DataFrame, n: int = 12) -> DataFrame:
    """split, resolution, images of the n most frequent resolutions; ties by name."""
    counts = images.groupBy("split", resolution_key("width", "height").alias("resolution")).agg(F.count("*").alias("images"))
    return first_rows(counts, ["split"], [F.desc("images"), "resolution"], n)


def size_histogram(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """split and numbers of boxes by size, small side and boundary contact."""
    rows = measured(flagged(annotations, images)).withColumn("bucket", coco_size_bucket(F.col("w") * F.col("h")))
    flags = {k: F.col("bucket") == k for k in ("small", "medium", "large")} | tiny_side_flags("w", "h") | {"boundary": touches_boundary("x", "y", "w", "h", "width", "height")}
    return rows.groupBy("split").agg(*(F.count_if(v).alias(k) for k, v in flags.items()))


def source_counts(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """split, source, images, annotations, negatives; source is the file name up to its first underscore."""
    n = measured(flagged(annotations, images)).groupBy("split", source_name("file_name").alias("source")).agg(F.count("*").alias("annotations"))
    per = boxes_per_image(images, annotations)
    i = images.select("split", "image_id", "file_name").join(per, ["split", "image_id"]).groupBy("split", source_name("file_name").alias("source")).agg(F.count("*").alias("images"), F.count_if(F.col("n_boxes") == 0).alias("negatives"))
    return i.join(n, ["split", "source"], "left").select("split", "source", "images", F.coalesce("annotations", F.lit(0)).alias("annotations"), "negatives")


def split_stats(images: DataFrame) -> DataFrame:
    """Pictures, boxes and negatives by split, and by split and source (source_dataset null: all). images: with n_boxes."""
    rows = images.rollup("split", "source_dataset").agg(
        F.count("*").alias("images"), F.sum("n_boxes").alias("boxes"), F.count_if(F.col("n_boxes") == 0).alias("negatives"), F.grouping_id().alias("g")
    )
    return rows.filter("g < 3").drop("g")


def crossing_groups(rows: DataFrame, digest: str) -> DataFrame:
    """digest, images and splits of digests that occur in more than one split."""
    n = rows.groupBy(digest).agg(F.count("*").alias("images"), F.array_sort(F.collect_set("split")).alias("splits"))
    return n.filter("size(splits) > 1").select(digest, "images", F.array_join("splits", ",").alias("splits"))


def leak_examples(groups: DataFrame, digest: str, n: int = 20) -> DataFrame:
    return groups.orderBy(digest).limit(n)


def review_sample(images: DataFrame, n: int = 12, seed: int = 42) -> DataFrame:
    """Up to n pictures with and n without boxes of each source, in the order of md5(seed|name)."""
    rows = images.withColumn("is_negative", F.col("n_boxes") == 0)
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), "file_name").cast("binary"))
    return first_rows(rows, ["source_dataset", "is_negative"], [order, "file_name"], n)


def finite_rows(rows: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        rows = rows.filter(is_finite(c))
    return rows
