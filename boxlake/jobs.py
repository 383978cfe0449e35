"""The jobs from end to end: label folders to a split dataset with reports, an audit of one, and speeds from detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.functions.geometry import BORDER, INNER_HEIGHT, INNER_WIDTH, format_speed_label
from boxlake.functions.images import image_signature
from boxlake.functions.naming import dronevehicle_group, output_name, uavdt_group, visdrone_group
from boxlake.operators import annotations as an
from boxlake.operators import audit as au
from boxlake.operators import dedup, leakage, splits, tracks
from boxlake.operators import detections as det
from boxlake.scratch import stored
from boxlake.sources import labels, sinks

#: Source to raw split to the folders of its pictures and labels.
Folders = dict[str, dict[str, tuple[str, str]]]
GLOBS = {"visdrone": "*", "uavdt": "*.jpg", "dronevehicle": "*.jpg"}
PICTURE = ["source_dataset", "raw_split", "stem"]


def _union(frames) -> DataFrame:
    return an.union_sources(*frames)


def pictures(spark: SparkSession, folders: Folders, globs: dict[str, str] = GLOBS) -> DataFrame:
    """Every listed picture with its decoded size, decode_ok and the digests of its bytes."""
    out = []
    for source, by_split in folders.items():
        for split, (place, _) in by_split.items():
            listed = labels.list_images(spark, place, globs[source], split).withColumn("source_dataset", F.lit(source))
            read = spark.read.format("binaryFile").option("pathGlobFilter", globs[source]).option("recursiveFileLookup", "true").load(place)
            digests = read.select(labels.normal_path("path").alias("path"), dedup.content_sha256("content").alias("sha256"), dedup.content_md5("content").alias("md5"))
            out.append(listed.join(labels.decode_status(spark, place), "path", "left").join(digests, "path", "left"))
    rows = _union(out).withColumn("decode_ok", F.coalesce("decode_ok", F.lit(False)))
    return rows.withColumn("output_name", output_name("source_dataset", "raw_split", "file_name"))


def label_files(spark: SparkSession, folders: Folders) -> DataFrame:
    """source_dataset, raw_split and stem of every label file, empty ones too."""
    parts = [labels.list_images(spark, place, "*.xml" if s == "dronevehicle" else "*.txt", split).withColumn("source_dataset", F.lit(s)) for s, x in folders.items() for split, (_, place) in x.items()]
    return _union(parts).select(*PICTURE)


def label_text(spark: SparkSession, folders: Folders, source: str) -> DataFrame:
    """source_dataset, raw_split, stem and the text of each label file of a source."""
    parts = [labels.read_xml_files(spark, place).select(F.lit(source).alias("source_dataset"), F.lit(split).alias("raw_split"), "stem", F.col("xml").alias("text")) for split, (_, place) in folders.get(source, {}).items()]
    return _union(parts) if parts else spark.createDataFrame([], "source_dataset string, raw_split string, stem string, text string")


def _numbered_lines(files: DataFrame) -> DataFrame:
    """One row per line, numbered; a line break at the end of a file begins no further line."""
    return files.select(*PICTURE, F.posexplode(F.split(F.regexp_replace("text", r"\r?\n\z", ""), r"\r?\n")).alias("line_no", "line"))


def _lines_to_boxes(spark: SparkSession, folders: Folders, sized: DataFrame, source: str, read, metric: Column, boxes) -> tuple[DataFrame, DataFrame]:
    rows = stored(read(_numbered_lines(label_text(spark, folders, source)).join(sized, PICTURE)))
    return boxes(rows).select(*PICTURE, "line_no", "x", "y", "w", "h"), an.counted(rows, metric)


def labelled_boxes(spark: SparkSession, folders: Folders, images: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """images with sequence_group and force_train (those with faulty XML go), their boxes by place in the file, and the readers' counters."""
    sized = images.select(*PICTURE, "width", "height")
    one = _lines_to_boxes(spark, folders, sized, "visdrone", labels.read_visdrone_labels, an.visdrone_metric(), an.visdrone_boxes)
    two = _lines_to_boxes(spark, folders, sized, "uavdt", labels.read_yolo_labels, an.yolo_metric(), an.yolo_boxes)
    files = label_text(spark, folders, "dronevehicle").join(images.select(*PICTURE), PICTURE, "left_semi")
    xml = stored(labels.read_voc_xml_labels(files, "text", PICTURE))
    objects = stored(an.voc_boxes(xml.filter(~F.col("bad_xml"))))
    three = objects.filter("status = 'ok'").select(*PICTURE, F.col("object_no").alias("line_no"), "box.*")
    bad = xml.filter("bad_xml").select(*PICTURE).distinct()
    counters = _union([one[1], two[1], an.counted(objects, an.voc_metrics()), an.counted(bad, F.lit("dronevehicle_bad_xml"))])
    named = xml.filter(~F.col("bad_xml")).groupBy(*PICTURE).agg(*(F.any_value(c).alias(f"_{c}") for c in ("folder", "filename", "path")))
    told = dronevehicle_group("_folder", "_filename", "_path", "raw_split")
    rows = images.join(bad, PICTURE, "left_anti").join(named, PICTURE, "left").withColumn("_told", told)
    source = F.col("source_dataset")
    group = F.when(source == "visdrone", visdrone_group("stem")).when(source == "uavdt", uavdt_group("stem")).otherwise(F.col("_told.sequence_group"))
    rows = rows.withColumns({"sequence_group": group, "force_train": (source == "dronevehicle") & F.col("_told.force_train")}).drop("_folder", "_filename", "_path", "_told")
    return rows, _union([one[0], two[0], three]), counters


def signatures(spark: SparkSession, folders: Folders, images: DataFrame) -> DataFrame:
    """images with dhash and pixels of their decoded content, without the border where that is still to be cut."""
    out = []
    for place in sorted({p for x in folders.values() for p, _ in x.values()}):
        read = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(place).select("image.*")
        read = read.withColumn("path", labels.normal_path("origin")).join(images.select("path", "crop_border"), "path")
        out.append(read.select("path", image_signature("data", "width", "height", "nChannels", "crop_border").alias("s")))
    return images.join(stored(_union(out)).select("path", "s.dhash", "s.pixels"), "path")


def build_dataset(spark: SparkSession, folders: Folders, out: str, crops: DataFrame | None = None, seed: int = 42, globs: dict[str, str] = GLOBS) -> dict[str, DataFrame]:
    """Write the dataset (tables by split, a document per split) and its reports below `out`, and return the tables.

    Pictures that don't decode or have no label file go, then exact copies; near-duplicate sequences become one group, and groups are
    dealt to splits whole. crops: a listing (file_name, path) of pictures without border that are there already.
    """
    found = stored(pictures(spark, folders, globs))
    files = stored(label_files(spark, folders))
    inner = F.col("source_dataset") == "dronevehicle"
    good = an.attach_labels(found.filter("decode_ok"), files, PICTURE)[0]
    good = good.withColumns({"decoded_width": F.col("width"), "decoded_height": F.col("height")})
    good = good.withColumns({"width": F.when(inner, INNER_WIDTH).otherwise(F.col("width")), "height": F.when(inner, INNER_HEIGHT).otherwise(F.col("height"))})
    none = spark.createDataFrame([], "file_name string, path string")
    good = an.reusable_crops(stored(good), none if crops is None else crops).withColumn("crop_border", F.col("crop_border") & (F.col("source_dataset") == "dronevehicle"))
    images, boxes, counters = labelled_boxes(spark, folders, good)
    images, boxes = stored(images), stored(boxes)
    images = stored(an.box_counts(images.withColumn("key", dedup.dedup_key("sha256", "crop_border", "source_dataset", "output_name")), boxes.join(images.select(*PICTURE, "output_name"), PICTURE), "output_name"))
    kept = stored(dedup.keep_best_duplicate(images))
    copies = stored(dedup.duplicate_groups(images))

    pairs = stored(leakage.near_duplicate_pairs(signatures(spark, folders, kept)))
    merged = leakage.merge_groups(pairs)
    kept = stored(leakage.propagate_force_train(kept, merged))
    assigned = stored(splits.assign_groups(splits.group_totals(kept), seed))
    placed = stored(splits.apply_assignments(kept, assigned).withColumn("raw_file", F.col("file_name")).withColumn("file_name", F.col("output_name")))
    numbered = stored(splits.dense_image_ids(placed, seed))
    in_file = boxes.join(numbered.select(*PICTURE, "file_name"), PICTURE)
    in_file = in_file.withColumn("box_no", F.row_number().over(W.partitionBy("file_name").orderBy("line_no"))).select("file_name", "box_no", "x", "y", "w", "h")
    notes = stored(splits.dense_annotation_ids(numbered.select("split", "image_id", "file_name", "n_boxes"), in_file))
    notes = notes.select("split", "annotation_id", "image_id", F.lit(1).alias("category_id"), "x", "y", "w", "h", F.round(F.col("w") * F.col("h"), 3).alias("area"), F.lit(0).alias("iscrowd"))

    sinks.write_dataset(numbered.drop("raw_file"), notes, out)
    document = ["split", "image_id", "file_name", "width", "height", "source_dataset", "sequence_group", "raw_split"]
    sinks.write_coco_json(numbered.select(*document), notes, f"{out}/documents")
    stats = _union([counters, an.picture_counters(found, files, kept, PICTURE), leakage.merge_stats(pairs, merged)])
    reports = {
        "preparation": (stats, ["metric"]),
        "splits": (splits.split_report(numbered), ["source_dataset"]),
        "exact_duplicates_removed": (copies, ["kept", "file"]),
        "group_merges": (pairs, ["left_output_name", "right_output_name"]),
        "assignments": (assigned, ["source_dataset", "sequence_group"]),
    }
    sinks.write_reports(reports, f"{out}/reports")
    return {"images": numbered, "annotations": notes, "pairs": pairs, **{k: t for k, (t, _) in reports.items()}}


def audit(images: DataFrame, annotations: DataFrame, signed: DataFrame | None = None, present: DataFrame | None = None, decoded: DataFrame | None = None, categories: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a dataset's audit; sinks.write_audit() writes them.

    signed: output_name, source_dataset, split, sha256, dhash, pixels of the files, for leaks between splits.
    """
    images, annotations = stored(images), stored(annotations)
    out = {
        "issues": au.audit_issues(annotations, images, categories, present, decoded),
        "examples": au.issue_examples(annotations, images),
        "quantiles": au.box_quantiles(annotations, images),
        "sizes": au.size_histogram(annotations, images),
        "resolutions": au.top_resolutions(images),
        "sources": au.source_counts(annotations, images),
    }
    if decoded is not None:
        rows = au.first_rows(au.decode_issues(images, decoded), ["split", "issue"], ["file_name"], 10)
        out["decode_examples"] = rows
    if signed is not None:
        signed = stored(signed)
        for digest in ("sha256", "dhash"):
            out[f"crossing_{digest}"] = au.leak_examples(au.crossing_groups(signed, digest), digest)
        out["leaks"] = leakage.cross_split_leak_pairs(signed)
    return out


def decoded_sizes(images: DataFrame) -> DataFrame:
    """split, file_name, width, height, decode_ok of build_dataset()'s pictures, less the border where that is still to be cut."""
    inside = lambda c: F.when(F.col("crop_border"), F.col(c) - 2 * BORDER).otherwise(F.col(c))
    return images.select("split", "file_name", inside("decoded_width").cast("int").alias("width"), inside("decoded_height").cast("int").alias("height"), "decode_ok")


def speeds(detections: DataFrame, fps: float, mode: str = "both", confidence: float = det.CONFIDENCE, metres_per_pixel: float | None = None, **tracker) -> dict[str, DataFrame]:
    """Detections (video_id, frame_number, det_no, box, confidence, origin) to speeds with labels, frame status and a summary."""
    rows = det.merge_full_and_slices(det.confidence_filter(detections, confidence), mode).drop("origin")
    linked = tracks.link_tracks(rows, fps, **tracker).filter("tracker_id >= 0")
    linked = stored(linked.withColumns({"cx": (F.col("x1") + F.col("x2")) / 2, "cy": (F.col("y1") + F.col("y2")) / 2}))
    scale = () if metres_per_pixel is None else (F.lit(metres_per_pixel),)
    found = tracks.speeds(linked, fps).withColumn("label", format_speed_label("tracker_id", "speed_px_s", *scale))
    return {"speeds": found, "status": tracks.frame_status(linked, metres_per_pixel), "summary": tracks.video_summary(linked)}
