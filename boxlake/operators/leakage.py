"""Near-duplicate pictures, leaks between splits, and groups merged over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions.images import MAX_DIFFERENCE, MIN_CORRELATION, MIN_STD, pixel_similarity, population_std
from boxlake.scratch import stored


KEYS = ["source_dataset", "dhash", "digest"]
PARTS = 8


def _measured(signatures: DataFrame) -> DataFrame:
    """Signatures with a digest of their pixels, their mean and deviation, and sums of PARTS parts; written once, so that pixels aren't made again for each use."""
    n = F.size("pixels")
    mean = F.aggregate("pixels", F.lit(0.0), lambda a, x: a + x) / n
    return stored(signatures.withColumns({"digest": F.md5(F.to_json("pixels").cast("binary")), "mean": mean, "std": population_std("pixels"), "sums": _part_sums("pixels")}))


def _part_sums(pixels: str) -> Column:
    """Sums of PARTS consecutive parts: mean absolute error is at least the difference of two pictures' parts, added up, by pixel."""
    n = F.size(pixels)

    def one(i: Column) -> Column:
        a, b = (F.floor(n * k / PARTS).cast("int") for k in (i, i + 1))
        return F.aggregate(F.slice(pixels, a + 1, b - a), F.lit(0.0), lambda s, x: s + x)

    return F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), one)


def picture_classes(signatures: DataFrame) -> DataFrame:
    """output_name, representative: pictures of one source with equal hashes and pixels are one class, named by its least output_name."""
    rows = stored(signatures.select("output_name", "source_dataset", "dhash", F.md5(F.to_json("pixels").cast("binary")).alias("digest")))
    least = stored(rows.groupBy(*KEYS).agg(F.min("output_name").alias("representative")))
    return rows.join(least, KEYS).select("output_name", "representative")


def _links(signatures: DataFrame, differ: str, slack: float = 0.0) -> DataFrame:
    """Pairs between representatives whose column `differ` is not the same, with their measures.

    A class of equal pictures gives one pair for each further value of `differ`, from its least picture to the least one with that value.
    Two classes give one pair, of pictures with different values where they have such. So copies are never paired with each
    other, and no link between different pictures is lost. Within a hash, classes meet by bands of their mean: mean absolute error is at least the
    difference of means, so only neighbouring bands can be similar. Pairs meet as names and sums of parts; pixels are fetched only for those that
    the sums leave possible.
    """
    seen = _measured(signatures).filter(F.col("std") >= MIN_STD - slack)
    each = stored(seen.groupBy(*KEYS, differ).agg(F.min("output_name").alias("name"), *(F.any_value(c).alias(c) for c in ("pixels", "mean", "std", "sums"))))
    first = stored(each.groupBy(*KEYS).agg(F.min_by(F.struct("name", differ, "pixels", "mean", "std", "sums"), "name").alias("f"), F.count("*").alias("n")).select(*KEYS, "f.*", "n"))
    heads = first.filter("n > 1").select(*KEYS, F.col("name").alias("left_output_name"), F.col(differ).alias(f"left_{differ}"))
    within = each.drop("pixels", "sums").join(heads, KEYS).filter(F.col(differ) != F.col(f"left_{differ}"))
    within = stored(within.select(*KEYS, "left_output_name", F.col("name").alias("right_output_name"), f"left_{differ}", F.col(differ).alias(f"right_{differ}"), F.struct(F.lit(1.0).alias("correlation"), F.lit(0.0).alias("mean_absolute_error"), F.col("std").alias("left_std"), F.col("std").alias("right_std")).alias("m")))

    second = within.groupBy(*KEYS).agg(F.min(F.struct(F.col("right_output_name").alias("name"), F.col(f"right_{differ}").alias(differ))).alias("s"))
    many = first.groupBy(*KEYS[:2]).agg(F.count("*").alias("k")).filter("k > 1").select(*KEYS[:2])
    sides = first.withColumn("n", F.size("pixels")).drop("pixels").join(many, KEYS[:2], "left_semi").join(second, KEYS, "left")
    band = F.floor(F.col("mean") / MAX_DIFFERENCE)
    left, right = (sides.select(*KEYS[:2], b.alias("band"), *(F.col(c).alias(f"{x}_{c}") for c in ("name", differ, "sums", "n", "s"))) for x, b in (("a", band), ("b", F.explode(F.array(band - 1, band, band + 1)))))
    near = left.join(right, [*KEYS[:2], "band"]).filter(f"a_name < b_name and (a_{differ} <> b_{differ} or a_s is not null or b_s is not null)")
    gap = F.aggregate(F.zip_with("a_sums", "b_sums", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
    near = near.filter(gap <= (MAX_DIFFERENCE + 1e-6) * F.greatest("a_n", "b_n")).drop("a_sums", "b_sums", "a_n", "b_n")
    for x in "ab":
        near = near.join(first.select(*KEYS[:2], F.col("name").alias(f"{x}_name"), F.col("pixels").alias(f"{x}_pixels")), [*KEYS[:2], f"{x}_name"])
    apart = F.col(f"a_{differ}") != F.col(f"b_{differ}")
    b_second = ~apart & F.col("b_s").isNotNull()
    a_second = ~apart & ~b_second
    pick = lambda x, second: F.when(second, F.col(f"{x}_s")).otherwise(F.struct(F.col(f"{x}_name").alias("name"), F.col(f"{x}_{differ}").alias(differ)))
    near = near.withColumns({"l": pick("a", a_second), "r": pick("b", b_second), "m": pixel_similarity("a_pixels", "b_pixels")})
    between = near.select(*KEYS[:2], F.col("l.name").alias("left_output_name"), F.col("r.name").alias("right_output_name"), F.col(f"l.{differ}").alias(f"left_{differ}"), F.col(f"r.{differ}").alias(f"right_{differ}"), "m")
    return between.unionByName(within.drop("digest"))


def near_duplicate_pairs(signatures: DataFrame) -> DataFrame:
    """Pairs (see _links) of one source with equal hashes, different groups and similar pixels; thresholds on unrounded measures.

    signatures: output_name, source_dataset, sequence_group, dhash, pixels. picture_classes() gives the members of each class.
    """
    rows = _links(signatures, "sequence_group")
    low = F.least("m.left_std", "m.right_std")
    rows = rows.filter((low >= MIN_STD) & (F.col("m.correlation") >= MIN_CORRELATION) & (F.col("m.mean_absolute_error") <= MAX_DIFFERENCE))
    measures = [F.round("m.correlation", 6).alias("correlation"), F.round("m.mean_absolute_error", 6).alias("mean_absolute_error"), F.round(low, 6).alias("minimum_contrast_stddev")]
    return rows.select("source_dataset", "dhash", "left_output_name", "right_output_name", "left_sequence_group", "right_sequence_group", *measures)


def cross_split_leak_pairs(signatures: DataFrame) -> DataFrame:
    """Pairs (see _links) of one source with equal hashes in different splits; thresholds on measures rounded to 6 digits."""
    # rounding can lift a deviation just below the limit, so the filter before the join is a little wider
    rows = _links(signatures, "split", 1e-6)
    measures = {"correlation": F.round("m.correlation", 6), "mean_absolute_error": F.round("m.mean_absolute_error", 6), "minimum_contrast_stddev": F.round(F.least("m.left_std", "m.right_std"), 6)}
    rows = rows.withColumns(measures).filter((F.col("minimum_contrast_stddev") >= MIN_STD) & (F.col("correlation") >= MIN_CORRELATION) & (F.col("mean_absolute_error") <= MAX_DIFFERENCE))
    return rows.select("source_dataset", "dhash", "left_output_name", "right_output_name", "left_split", "right_split", *measures)


def merge_groups(pairs: DataFrame) -> DataFrame:
    """sequence_group, merged_group: each group that a pair links, with the least name of its component.

    Least-label spreading over the distinct edges between groups, with labels followed to their own label in each round.
    """
    edges = pairs.select(F.col("left_sequence_group").alias("a"), F.col("right_sequence_group").alias("b")).filter("a <> b")
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        around = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("a").alias("label"), F.col("label").alias("far"))
        new = labels.join(around, "a").join(jump, "label", "left").select("a", "label", F.least("label", "near", "far").alias("new"))
        new = stored(new)
        changed = not new.filter("new < label").isEmpty()
        labels = new.select("a", F.col("new").alias("label"))
        if not changed:
            return labels.select(F.col("a").alias("sequence_group"), F.col("label").alias("merged_group"))


def propagate_force_train(images: DataFrame, merged: DataFrame) -> DataFrame:
    """images with their merged group; a forced picture forces its whole component."""
    rows = images.join(merged, "sequence_group", "left").withColumn("sequence_group", F.coalesce("merged_group", "sequence_group")).drop("merged_group")
    forced = rows.groupBy("sequence_group").agg(F.max("force_train").alias("forced"))
    return rows.join(forced, "sequence_group").withColumn("force_train", F.coalesce("forced", F.lit(False))).drop("forced")


def merge_stats(pairs: DataFrame, merged: DataFrame) -> DataFrame:
    """metric, value: pairs, groups that are linked, groups that got another name, components."""
    one = pairs.agg(F.count("*").alias("pairs")).crossJoin(merged.agg(F.count("*").alias("linked_groups"), F.count_if(F.col("sequence_group") != F.col("merged_group")).alias("changed_groups"), F.countDistinct("merged_group").alias("components")))
    return one.selectExpr("stack(4, 'pairs', pairs, 'linked_groups', linked_groups, 'changed_groups', changed_groups, 'components', components) as (metric, value)")
