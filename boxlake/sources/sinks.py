"""Writers: split tables, COCO documents, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.scratch import discard, scratch_dir, shuffles_freed, stored

CATEGORIES = [(1, "vehicle", "vehicle")]


def write_dataset(images: DataFrame, annotations: DataFrame, path: str) -> None:
    """Both tables by split; an output that exists is an error."""
    images.write.mode("errorifexists").partitionBy("split").parquet(f"{path}/images")
    annotations.write.mode("errorifexists").partitionBy("split").parquet(f"{path}/annotations")


def to_coco_struct(images: DataFrame, annotations: DataFrame, seed: int = 42, description: str = "Vehicle boxes", policy: str = "sequence groups") -> DataFrame:
    """split, part, id, value: the lines of one JSON document per split, in the order of part and id.

    A head, a line for each image and each annotation in the order of their ids, and a tail; each is a row of its own, so a document of any size is never held
    whole.
    """
    image = F.struct(F.col("image_id").alias("id"), "file_name", "width", "height", "source_dataset", "sequence_group", "raw_split")
    note = F.struct(F.col("annotation_id").alias("id"), "image_id", "category_id", F.array("x", "y", "w", "h").alias("bbox"), "area", "iscrowd")
    info = F.struct(F.lit(description).alias("description"), F.lit(seed).cast("bigint").alias("seed"), F.lit(policy).alias("split_policy"))
    kinds = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), F.lit(s).alias("supercategory")) for i, n, s in CATEGORIES))
    head = F.struct(info.alias("info"), F.expr("cast(array() as array<string>)").alias("licenses"), kinds.alias("categories"))

    def lines(rows: DataFrame, id_: str, part: int, item: Column) -> DataFrame:
        first = rows.groupBy("split").agg(F.min(id_).alias("_first"))
        comma = F.when(F.col(id_) == F.col("_first"), "").otherwise(",")
        return rows.join(F.broadcast(first), "split").select("split", F.lit(part).alias("part"), F.col(id_).cast("bigint").alias("id"), F.concat(comma, F.to_json(item)).alias("value"))  # as many rows as splits

    splits = images.select("split").distinct()
    between = [(0, F.concat(F.regexp_replace(F.to_json(head), r"\}$", ""), F.lit(',"images":['))), (2, F.lit('],"annotations":[')), (4, F.lit("]}"))]
    out = lines(images, "image_id", 1, image).unionByName(lines(annotations, "annotation_id", 3, note))
    for part, text in between:
        out = out.unionByName(splits.select("split", F.lit(part).alias("part"), F.lit(0).cast("bigint").alias("id"), text.alias("value")))
    return out


def write_coco_json(images: DataFrame, annotations: DataFrame, path: str, **info) -> None:
    """One document per split below split=<name>, as parts that make it in the order of their names.

    Lines are dealt out by ranges of (split, part, id) and sorted in each, so a task holds a range of a document at most. `coco.read_coco` reads such a folder as the document it is.
    Both tables are stored first, as finding the ranges reads them too: shuffles of theirs are gone before those of the lines are made.
    """
    order, spark = ["split", "part", "id"], images.sparkSession
    tables = [scratch_dir(spark), scratch_dir(spark)]
    images, annotations = (stored(t, path, compression="zstd") for t, path in zip((images, annotations), tables, strict=True))
    lines = to_coco_struct(images, annotations, **info).repartitionByRange(*order).sortWithinPartitions(*order)
    with shuffles_freed(spark):
        lines.select("split", "value").write.mode("errorifexists").partitionBy("split").text(path)
    discard(spark, tables)


def join_parts(spark: SparkSession, folder: str, path: str) -> None:
    """Copy a document's parts to one file, in the order of their names, piece by piece: for readers that want a single file."""
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    place = jvm.org.apache.hadoop.fs.Path
    source = place(folder)
    fs, target = source.getFileSystem(hadoop), place(path)
    parts = sorted((f.getPath().toString() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")))
    out = target.getFileSystem(hadoop).create(target, False)
    try:
        for part in parts:
            data = fs.open(place(part))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 16, False)
            data.close()
    finally:
        out.close()


def sorted_reports(report: DataFrame, *keys: str) -> DataFrame:
    return report.orderBy(*keys)


def write_reports(reports: dict[str, tuple[DataFrame, list[str]]], path: str) -> None:
    """Each report, sorted by its keys, as JSON lines below its name."""
    for name, (report, keys) in reports.items():
        sorted_reports(report, *keys).write.mode("errorifexists").json(f"{path}/{name}")


def write_removed_names(names: DataFrame, path: str, column: str = "file_name") -> None:
    names.select(F.col(column).alias("value")).orderBy("value").write.mode("errorifexists").text(path)


def write_audit(tables: dict[str, DataFrame], path: str) -> None:
    """Each table of an audit, and one JSON row that counts the issues."""
    for name, t in tables.items():
        t.write.mode("errorifexists").parquet(f"{path}/{name}")
    if "issues" in tables:
        view = tables["issues"].agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.concat_ws("/", "split", "issue"), "value")))).alias("issues"))
        view.select(F.to_json(F.struct("issues")).alias("value")).write.mode("errorifexists").text(f"{path}/summary")
