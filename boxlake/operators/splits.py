"""Grouped splitting: totals, greedy assignment, reports, dense ids."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FRACTIONS = {"train": 0.8, "valid": 0.1, "test": 0.1}


def shuffle_order(seed: int, name: str) -> Column:
    """A seeded order that doesn't depend on partitions: md5(seed|name)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(name)).cast("binary"))


def group_totals(images: DataFrame) -> DataFrame:
    """source_dataset, sequence_group, force_train, images, boxes; forced pictures apart from the others."""
    return images.groupBy("source_dataset", "sequence_group", "force_train").agg(F.count("*").alias("images"), F.sum("n_boxes").alias("boxes"))


def assign_groups(totals: DataFrame, seed: int = 42, fractions: dict[str, float] = FRACTIONS) -> DataFrame:
    """source_dataset, sequence_group, split for the groups of group_totals() that aren't forced.

    Per source, groups in falling order of pictures, boxes, then md5(seed|group) go to the split with the least
    filling (pictures plus boxes against their targets; ties by name). One step depends on the last, so a source's group totals, never
    its pictures, meet in one task.
    """
    if abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError("fractions must add up to 1")

    def greedy(rows: pd.DataFrame) -> pd.DataFrame:
        target = {s: (rows.images.sum() * f, rows.boxes.sum() * f) for s, f in fractions.items()}
        filled = {s: [0, 0] for s in fractions}
        forced = rows[rows.force_train]
        filled["train"] = [int(forced.images.sum()), int(forced.boxes.sum())]
        free = rows[~rows.force_train].sort_values(["images", "boxes", "o"], ascending=[False, False, True])
        out = []
        for g, n, b in zip(free.sequence_group, free.images, free.boxes, strict=True):
            cost = {s: (filled[s][0] + n) / max(t[0], 1) + (filled[s][1] + b) / max(t[1], 1) for s, t in target.items()}
            best = min(cost, key=lambda s: (cost[s], s))
            filled[best][0] += int(n)
            filled[best][1] += int(b)
            out.append((rows.source_dataset.iloc[0], g, best))
        return pd.DataFrame(out, columns=["source_dataset", "sequence_group", "split"])

    rows = totals.withColumn("force_train", F.coalesce("force_train", F.lit(False))).withColumn("o", shuffle_order(seed, "sequence_group"))
    return rows.groupBy("source_dataset").applyInPandas(greedy, "source_dataset string, sequence_group string, split string")


def apply_assignments(images: DataFrame, assignments: DataFrame) -> DataFrame:
    """images with split: train where forced, else their group's."""
    rows = images.join(assignments, ["source_dataset", "sequence_group"], "left")
    return rows.withColumn("split", F.when(F.coalesce("force_train", F.lit(False)), "train").otherwise(F.col("split")))


def split_report(images: DataFrame, splits: tuple = ("train", "valid", "test")) -> DataFrame:
    """One row per source: totals, assignable groups, forced pictures; pictures, boxes and groups by split. images: assigned."""
    forced = F.coalesce("force_train", F.lit(False))
    by = [
        c
        for s in splits
        for c in (
            F.count_if(F.col("split") == s).alias(f"images_{s}"),
            F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n_boxes"))), F.lit(0)).alias(f"boxes_{s}"),
            F.countDistinct(F.when((F.col("split") == s) & ~forced, F.col("sequence_group"))).alias(f"groups_{s}"),
        )
    ]
    return images.groupBy("source_dataset").agg(
        F.count("*").alias("total_images"),
        F.sum("n_boxes").alias("total_boxes"),
        F.countDistinct(F.when(~forced, F.col("sequence_group"))).alias("assignable_groups"),
        F.count_if(forced).alias("forced_images"),
        *by,
    )


def dense_numbers(rows: DataFrame, by: str, bucket: Column, order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """rows with 1..n within each value of `by`, in the order of unique columns; with weight, the sum of weights before the row.

    bucket: cuts the order into ranges (falling or rising with it). Only a table of ranges is summed across a whole group; rows
    are sorted within their range, so no group meets in one task.
    """
    rows = rows.withColumn("_b", bucket)
    w = F.lit(1) if weight is None else F.col(weight)
    inside = F.sum(w).over(W.partitionBy(by, "_b").orderBy(*order)) - (F.lit(0) if weight is None else w)
    before = W.partitionBy(by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy(by, "_b").agg(F.sum(w).alias("_s")).withColumn("_before", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    return rows.withColumn("_i", inside).join(sums, [by, "_b"]).withColumn(name, (F.col("_i") + F.col("_before")).cast("bigint")).drop("_b", "_i", "_before")


def dense_image_ids(images: DataFrame, seed: int = 42) -> DataFrame:
    """images with image_id 1..n per split in a seeded order. images: split, file_name."""
    rows = images.withColumn("_o", shuffle_order(seed, "file_name"))
    return dense_numbers(rows, "split", F.substring("_o", 1, 3), ["_o", "file_name"], "image_id").drop("_o")


def dense_annotation_ids(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """boxes with annotation_id 1..m per split, in the order of picture ids and box numbers.

    images: split, image_id, file_name, n_boxes; boxes: file_name, box_no (from 1, no gaps).
    """
    starts = dense_numbers(images.select("split", "image_id", "file_name", "n_boxes"), "split", F.floor(F.col("image_id") / 4096), ["image_id"], "_first", "n_boxes")
    return boxes.join(starts.drop("n_boxes"), "file_name").withColumn("annotation_id", F.col("_first") + F.col("box_no")).drop("_first")
