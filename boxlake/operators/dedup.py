"""Exact copies, cross-split copies, manifests and layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAYOUT = {"train": "train", "val": "valid", "test": "test"}


def content_sha256(content: str) -> Column:
    return F.sha2(F.col(content).cast("binary"), 256)


def content_md5(content: str) -> Column:
    return F.md5(F.col(content).cast("binary"))


def dedup_key(digest: str, crop_border: str, source: str, name: str) -> Column:
    """The digest; pictures whose border isn't cut yet have a key of their own and are never copies."""
    return F.when(F.coalesce(crop_border, F.lit(False)), F.concat_ws(":", F.lit("uncropped"), F.col(source), F.col(name))).otherwise(F.col(digest))


def keep_best_duplicate(rows: DataFrame, key: str = "key") -> DataFrame:
    """One row per key: most boxes, then the least name.

    An aggregate with partial results, so a digest that many rows share doesn't meet in one task.
    """
    order = F.struct((-F.col("n_boxes")).alias("n"), F.col("output_name"))
    return rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("r")).select(key, "r.*")


def duplicate_groups(rows: DataFrame, key: str = "key") -> DataFrame:
    """key, kept, kept_boxes, file, boxes: one row per file that is removed, beside the file of its key that stays."""
    first = F.min(F.struct((-F.col("n_boxes")).alias("n"), "output_name"))
    best = rows.groupBy(key).agg(first.alias("b"), F.count("*").alias("m")).filter("m > 1").select(key, F.col("b.output_name").alias("kept"), (-F.col("b.n")).alias("kept_boxes"))
    files = rows.select(key, F.col("output_name").alias("file"), F.col("n_boxes").alias("boxes"))
    return files.join(best, key).filter("file <> kept").select(key, "kept", "kept_boxes", "file", "boxes")


def drop_train_copies(rows: DataFrame, digest: str = "md5", train: str = "train", others: tuple = ("valid", "test")) -> tuple[DataFrame, DataFrame]:
    """Survivors, and the training rows whose digest occurs in another split."""
    seen = rows.filter(F.col("split").isin(*others)).select(digest).distinct()
    in_train = rows.filter(F.col("split") == train)
    removed = in_train.join(seen, digest, "left_semi")
    kept = in_train.join(seen, digest, "left_anti").unionByName(rows.filter(F.col("split").isNull() | (F.col("split") != train)))
    return kept, removed


def cascade_annotations(annotations: DataFrame, removed: DataFrame, key: str = "image_id") -> DataFrame:
    return annotations.join(removed.select(key).distinct(), key, "left_anti")


def manifest_diff(declared: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Names on one side only, with side missing (not present) or extra (not declared)."""
    a = declared.select(*keys).distinct().withColumn("_a", F.lit(1))
    b = present.select(*keys).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, keys, "full_outer")
    side = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra")
    return both.withColumn("side", side).filter("side is not null").select(*keys, "side")


def missing_and_extra_names(declared: DataFrame, present: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    a, b = declared.select(*keys), present.select(*keys)
    return a.subtract(b), b.subtract(a)


def rename_splits(rows: DataFrame, declared: DataFrame, present: DataFrame, keys: list[str], names: dict[str, str] = LAYOUT) -> DataFrame:
    """rows with the new layout's split names; any difference between the two lists is an error that gives both counts."""
    n = {r.side: r["count"] for r in manifest_diff(declared, present, keys).groupBy("side").count().collect()}
    if n:
        raise ValueError(f"manifest differs: {n.get('missing', 0)} missing, {n.get('extra', 0)} extra")
    return renamed(rows, names)


def renamed(rows: DataFrame, names: dict[str, str] = LAYOUT) -> DataFrame:
    out = F.col("split")
    for old, new in names.items():
        out = F.when(F.col("split") == old, F.lit(new)).otherwise(out)
    return rows.withColumn("split", out)
