"""Label formats as text columns or files, and pictures and listings.

Parsers take a DataFrame with the raw text, so that the same code serves files, tables and streams. try_cast is used
throughout, since ANSI casts fail the job.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions.geometry import all_finite
from boxlake.functions.naming import strip

VOC = "folder string, filename string, path string, bad string"
VOC_OBJECT = "name string, polygon struct<x1:string,y1:string,x2:string,y2:string,x3:string,y3:string,x4:string,y4:string>, bndbox struct<xmin:string,ymin:string,xmax:string,ymax:string>"
COCO_SCHEMA = (
    "info struct<description:string,seed:bigint,split_policy:string>, licenses array<string>,"
    " categories array<struct<id:int,name:string,supercategory:string>>,"
    " images array<struct<id:bigint,file_name:string,width:int,height:int,source_dataset:string,sequence_group:string,raw_split:string>>,"
    " annotations array<struct<id:bigint,image_id:bigint,category_id:int,bbox:array<double>,area:double,iscrowd:int>>"
)
COCO_FILE = "_annotations.coco.json"
#: Text forms that a whole or a decimal number may have; Java's suffixes such as 1.0d aren't among them.
WHOLE, DECIMAL = r"^\s*[+-]?\d+\s*$", r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def file_stem(path: Column | str) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(F.instr(F.substring(name, 2, 1 << 30), ".") > 0, F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def list_images(spark: SparkSession, folder: str, glob: str = "*", split: str | None = None) -> DataFrame:
    """path, file_name, stem and raw_split of the files of a folder, empty ones too, without their content.

    A scan leaves empty files out, so the names come from Spark's own listing, which the driver holds for every scan anyway.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).inputFiles()
    files = spark.createDataFrame([(unquote(f),) for f in listed], "path string").withColumn("path", normal_path("path"))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("file_name"), file_stem("path").alias("stem"), F.lit(split).alias("raw_split"))


def list_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the files of a split's folder, without its annotation document."""
    return list_images(spark, folder).filter(F.col("file_name") != COCO_FILE).select("file_name")


def normal_path(path: Column | str) -> Column:
    """file:///x and file:/x are one path."""
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")


def decode_status(spark: SparkSession, folder: str) -> DataFrame:
    """path, width, height and decode_ok; a file that can't be decoded has no size."""
    found = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(folder).select("image.origin", "image.width", "image.height")
    ok = F.coalesce(F.col("height") > 0, F.lit(False))
    return found.select(normal_path("origin").alias("path"), F.when(ok, F.col("width")).alias("width"), F.when(ok, F.col("height")).alias("height"), ok.alias("decode_ok"))


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """stem and line of each line of the text files of a folder."""
    return spark.read.option("recursiveFileLookup", "true").text(folder).select(file_stem("_metadata.file_path").alias("stem"), F.col("value").alias("line"))


def _number(text: Column, pattern: str, kind: str) -> Column:
    return F.when(text.rlike(pattern), F.trim(text).try_cast(kind))


def read_visdrone_labels(lines: DataFrame, line: str = "line") -> DataFrame:
    """lines with x, y, w, h, score, class_id and bad_row: comma-separated whole numbers, eight or more fields."""
    parts = F.split(strip(line), ",")
    numbers = F.transform(F.slice(parts, 1, 8), lambda p: _number(p, WHOLE, "bigint"))
    rows = lines.withColumn("_n", F.explode(F.array(numbers)))  # behind a generator the numbers are read once, and not for each field
    bad = F.col(line).isNull() | (F.size("_n") < 8) | F.exists("_n", lambda v: v.isNull())
    names = ["x", "y", "w", "h", "score", "class_id"]
    rows = rows.withColumn("bad_row", bad)  # a column of its own, so that it is tested once and not per field
    return rows.withColumns({k: F.when(~F.col("bad_row"), F.get("_n", F.lit(i))) for i, k in enumerate(names)}).drop("_n")


def read_yolo_labels(lines: DataFrame, line: str = "line") -> DataFrame:
    """lines with class_id, cx, cy, w, h and bad_row: exactly five finite numbers between white space."""
    parts = F.split(strip(line), r"\s+")
    rows = lines.withColumn("_n", F.explode(F.array(F.transform(parts, lambda p: _number(p, DECIMAL, "double")))))  # once, as above
    bad = F.col(line).isNull() | (F.size("_n") != 5) | F.exists("_n", lambda v: v.isNull())
    bad = bad | ~all_finite(*(F.get("_n", F.lit(i)) for i in range(5)))
    names = ["class_value", "cx", "cy", "w", "h"]
    rows = rows.withColumn("bad_row", bad)
    fields = {k: F.when(~F.col("bad_row"), F.get("_n", F.lit(i))) for i, k in enumerate(names)}
    whole = F.when(F.col("class_value") < 0, F.ceil("class_value")).otherwise(F.floor("class_value"))
    return rows.withColumns(fields).withColumn("class_id", whole.cast("bigint")).drop("_n", "class_value")


def read_voc_xml_labels(files: DataFrame, text: str = "xml", keep: list[str] | None = None) -> DataFrame:
    """One row per object (none for a file without objects): the kept columns, bad_xml, folder, filename, path, object_no, object.

    Objects are found at any depth below the root (of objects inside one another, the innermost). A document is parsed once for its own fields and
    faults, and each object once by itself: both pass through a generator, behind which no filter can repeat the parsing.
    """
    keep = files.columns if keep is None else keep
    doc = F.from_xml(F.col(text), VOC, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    rows = files.withColumn("_doc", F.explode(F.array(doc)))
    rows = rows.withColumn("bad_xml", F.col("_doc.bad").isNotNull() | F.col("_doc").isNull())
    found = F.regexp_extract_all(F.regexp_replace(text, r"(?s)<!--.*?-->", ""), F.lit(r"(?s)<object(?:\s[^>]*)?>(?:(?!<object[\s>]).)*?</object>"), F.lit(0))
    objects = F.transform(F.when(~F.col("bad_xml"), found), lambda x: F.from_xml(x, VOC_OBJECT))
    return rows.select(*keep, "bad_xml", "_doc.folder", "_doc.filename", "_doc.path", F.posexplode_outer(objects).alias("object_no", "object"))


def read_xml_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(folder).select(file_stem("_metadata.file_path").alias("stem"), F.col("value").alias("xml"))


def coco_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """images, annotations and categories tables of documents (split and the document's fields); absent lists are empty."""
    images = documents.select("split", F.inline("images")).withColumnRenamed("id", "image_id")
    notes = documents.select("split", F.inline("annotations")).withColumnRenamed("id", "annotation_id")
    box = {k: F.when(F.size("bbox") == 4, F.get("bbox", F.lit(i))) for i, k in enumerate("xywh")}
    categories = documents.select("split", F.coalesce("categories", F.expr("array()").cast("array<struct<id:int,name:string,supercategory:string>>")).alias("categories"))
    return {"images": images, "annotations": notes.withColumns(box).drop("bbox"), "categories": categories}


def read_coco_whole(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Tables of one small document per split, each parsed as one row; coco.read_coco() reads documents of any size. paths: split name to file."""
    out = None
    for split, path in paths.items():
        one = spark.read.schema(COCO_SCHEMA).json(path, multiLine=True).withColumn("split", F.lit(split))
        out = one if out is None else out.unionByName(one)
    return coco_tables(out)


def read_detections(rows: DataFrame, start_frame: int = 0, max_frames: int | None = None) -> DataFrame:
    """Detections (batch or stream) of the frames from start_frame on, max_frames of them at most."""
    if start_frame < 0:
        raise ValueError("start_frame cannot be negative")
    if max_frames is not None and max_frames < 1:
        raise ValueError("max_frames must be at least 1")
    rows = rows.filter(F.col("frame_number") >= start_frame)
    return rows if max_frames is None else rows.filter(F.col("frame_number") < start_frame + max_frames)


def check_videos(videos: DataFrame, start_frame: int = 0) -> DataFrame:
    """videos (video_id, fps, width, height, frames), failing where a video's metadata can't be used."""
    bad = ~F.coalesce((F.col("fps") > 0) & (F.col("width") > 0) & (F.col("height") > 0) & (F.col("frames") > start_frame), F.lit(False))
    return videos.withColumn("fps", F.when(bad, F.raise_error(F.concat(F.lit("unusable video "), F.col("video_id").cast("string"))).cast("double")).otherwise(F.col("fps")))
