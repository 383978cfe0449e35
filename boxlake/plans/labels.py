"""Queries of label parsing, names, copies and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxlake.functions.naming import dronevehicle_group, output_name, uavdt_group, visdrone_group
from boxlake.operators import annotations as an
from boxlake.operators import dedup
from boxlake.plans.fixtures import ctes, frame
from boxlake.sources import labels


def clip_boxes(s, d):
    """J2, P1, P2, P9."""
    rows = an.boxes_with_image_size(frame(s, d, "fx_boxes"), frame(s, d, "fx_images"))
    return an.clipped(rows).select("annotation_id", "x", "y", "w", "h", "area")


CLIP = """, {a} AS (SELECT *, round(greatest(0.0e0, x), 3) AS cx, round(greatest(0.0e0, y), 3) AS cy,
  round(least(CAST(width AS DOUBLE), x + w) - greatest(0.0e0, x), 3) AS cw, round(least(CAST(height AS DOUBLE), y + h) - greatest(0.0e0, y), 3) AS ch FROM {b})"""
_CLIP_BOXES = ctes("fx_boxes", "fx_images") + ", j AS (SELECT b.*, width, height FROM fx_boxes b JOIN fx_images USING (image_id))" + CLIP.format(a="c", b="j") + "SELECT annotation_id, cx AS x, cy AS y, cw AS w, ch AS h, round(cw * ch, 3) AS area FROM c WHERE cw >= 2 AND ch >= 2"


def visdrone_lines(s, d):
    """S3, P3."""
    rows = labels.read_visdrone_labels(frame(s, d, "fx_lines").select("annotation_id", "image_id", F.col("visdrone_line").alias("line")))
    rows = an.visdrone_marked(an.boxes_with_image_size(rows, frame(s, d, "fx_images")))
    return rows.select("annotation_id", "bad_row", F.when(F.col("box").isNotNull(), F.col("class_id")).alias("class_id"), "box.*")


_VISDRONE_LINES = ctes("fx_lines", "fx_images") + """, p AS (SELECT annotation_id, width, height, string_split(visdrone_line, ',') AS f FROM fx_lines JOIN fx_images USING (image_id)),
q AS (SELECT *, len(f) < 8 OR len(list_filter(f[1:8], lambda v: try_cast(v AS BIGINT) IS NULL)) > 0 AS bad_row FROM p),
n AS (SELECT *, try_cast(f[1] AS DOUBLE) AS x, try_cast(f[2] AS DOUBLE) AS y, try_cast(f[3] AS DOUBLE) AS w, try_cast(f[4] AS DOUBLE) AS h, try_cast(f[5] AS BIGINT) AS sc, try_cast(f[6] AS BIGINT) AS class_id FROM q)""" + CLIP.format(a="c", b="n") + """
SELECT annotation_id, bad_row, CASE WHEN k THEN class_id END AS class_id, CASE WHEN k THEN cx END AS x, CASE WHEN k THEN cy END AS y, CASE WHEN k THEN cw END AS w, CASE WHEN k THEN ch END AS h
FROM (SELECT *, NOT bad_row AND sc <> 0 AND class_id IN (4, 5, 6, 9, 10) AND cw >= 2 AND ch >= 2 AS k FROM c)"""


def yolo_lines(s, d):
    """S4, P4."""
    rows = labels.read_yolo_labels(frame(s, d, "fx_lines").select("annotation_id", "image_id", F.col("yolo_line").alias("line")))
    rows = an.boxes_with_image_size(rows, frame(s, d, "fx_images"))
    return an.yolo_boxes(rows).select("annotation_id", "class_id", "x", "y", "w", "h")


_YOLO_LINES = ctes("fx_lines", "fx_images") + """, p AS (SELECT annotation_id, width, height, string_split(yolo_line, ' ') AS f FROM fx_lines JOIN fx_images USING (image_id) WHERE part % 47 <> 0 AND part % 53 <> 0),
n AS (SELECT annotation_id, width, height, CAST(f[1] AS BIGINT) AS class_id, (f[2]::DOUBLE - f[4]::DOUBLE / 2) * width AS x, (f[3]::DOUBLE - f[5]::DOUBLE / 2) * height AS y, f[4]::DOUBLE * width AS w, f[5]::DOUBLE * height AS h FROM p)""" + CLIP.format(a="c", b="n") + """
SELECT annotation_id, class_id, cx AS x, cy AS y, cw AS w, ch AS h FROM c WHERE cw >= 2 AND ch >= 2"""


def voc_xml_objects(s, d):
    """S5, P5, P6, P7."""
    rows = labels.read_voc_xml_labels(frame(s, d, "fx_xml").select("annotation_id", "xml"), keep=["annotation_id"])
    rows = an.voc_boxes(rows.filter(~F.col("bad_xml")))
    return rows.select("annotation_id", "status", "converted", "box.*")


_VOC = ctes("fx_xml") + """, v AS (SELECT *, line % 2 = 0 AS poly, part % 31 = 0 AS point, part % 37 = 0 AS broken, name <> 'person' AS vehicle, CAST(px - 100 AS DOUBLE) AS x, CAST(py - 100 AS DOUBLE) AS y, CAST(pw AS DOUBLE) AS w, CAST(ph AS DOUBLE) AS h, 640 AS width, 512 AS height FROM fx_xml WHERE part % 59 <> 0)""" + CLIP.format(a="c", b="v") + """,
t AS (SELECT *, CASE WHEN NOT vehicle THEN 'skipped_class' WHEN point THEN 'point_only' WHEN broken AND poly THEN 'bad_polygon' WHEN broken THEN 'bad_bndbox' WHEN NOT (cw >= 2 AND ch >= 2) THEN 'invalid_box' ELSE 'ok' END AS status FROM c)
SELECT annotation_id, status, vehicle AND NOT poly AND NOT point AND NOT broken AS converted,
  CASE WHEN b THEN cx END AS x, CASE WHEN b THEN cy END AS y, CASE WHEN b THEN cw END AS w, CASE WHEN b THEN ch END AS h
FROM (SELECT *, status IN ('ok', 'invalid_box') AND cw > 0 AND ch > 0 AS b FROM t)"""


def reader_stats(s, d):
    """A1: the counters of all three readers."""
    lines, images = frame(s, d, "fx_lines").select("annotation_id", "image_id", "visdrone_line", "yolo_line"), frame(s, d, "fx_images")
    sized = an.boxes_with_image_size(lines, images)
    one = labels.read_visdrone_labels(sized, "visdrone_line").select("yolo_line", "width", "height", an.visdrone_metric().alias("first"))
    both = labels.read_yolo_labels(one, "yolo_line").select(F.array_compact(F.array("first", an.yolo_metric())).alias("metrics"))
    xml = an.voc_marked(labels.read_voc_xml_labels(frame(s, d, "fx_xml").select("xml"), keep=[]))
    return an.union_sources(an.counted(both, F.col("metrics")), an.counted(xml, an.xml_metrics()))


_READER_STATS = f"""WITH a AS ({_VISDRONE_LINES.replace('SELECT annotation_id, bad_row, CASE WHEN k THEN class_id END AS class_id', 'SELECT sc, class_id AS ci, k, bad_row, CASE WHEN k THEN class_id END AS class_id')}),
b AS ({_YOLO_LINES.replace('SELECT annotation_id, class_id, cx AS x, cy AS y, cw AS w, ch AS h FROM c WHERE cw >= 2 AND ch >= 2', 'SELECT class_id, cw >= 2 AND ch >= 2 AS k FROM c')}),
o AS ({_VOC.replace('SELECT annotation_id, status,', 'SELECT name, status,')}),
lk AS ({ctes('fx_lines', 'fx_images')} SELECT part FROM fx_lines JOIN fx_images USING (image_id)),
xb AS ({ctes('fx_lines')} SELECT part FROM fx_lines WHERE part % 59 = 0),
m AS (SELECT CASE WHEN bad_row THEN 'visdrone_bad_rows' WHEN sc = 0 OR ci NOT IN (4, 5, 6, 9, 10) THEN NULL WHEN k THEN 'visdrone_class_' || ci || '_boxes' ELSE 'visdrone_invalid_boxes' END AS metric FROM a
UNION ALL SELECT CASE WHEN k THEN 'uavdt_source_class_' || class_id || '_boxes' ELSE 'uavdt_invalid_boxes' END FROM b
UNION ALL SELECT 'uavdt_bad_rows' FROM lk WHERE part % 47 = 0 OR part % 53 = 0
UNION ALL SELECT CASE status WHEN 'skipped_class' THEN 'dronevehicle_skipped_class:' || lower(trim(name)) WHEN 'point_only' THEN 'dronevehicle_point_only_skipped' WHEN 'invalid_box' THEN 'dronevehicle_invalid_boxes' WHEN 'ok' THEN NULL ELSE 'dronevehicle_' || status END FROM o
UNION ALL SELECT 'dronevehicle_bndbox_converted' FROM o WHERE converted
UNION ALL SELECT 'dronevehicle_bad_xml' FROM xb)
SELECT metric, count(*) AS value FROM m WHERE metric IS NOT NULL GROUP BY metric"""


def group_names(s, d):
    """F5, F6, F7, F8, P8."""
    x = dronevehicle_group("folder", "filename", "path", "raw_split")
    return frame(s, d, "fx_names").select("id", uavdt_group("stem").alias("uavdt"), visdrone_group("stem").alias("visdrone"), x["sequence_group"].alias("dronevehicle"), x["force_train"].alias("force_train"), output_name(F.lit("uavdt"), "raw_split", "stem").alias("output_name"))


def _norm(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(replace(lower(trim({x}, ' ')), ' ', ''), '\\(1\\)$', ''), '[^a-z0-9()_-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown')"


_GROUP_NAMES = ctes("fx_names") + r""", u AS (SELECT *, CASE event_kind
    WHEN 0 THEN regexp_extract(stem, '(?i)^(DJI_\d+ \([^)]*\))_n\d+$', 1) WHEN 1 THEN regexp_extract(stem, '(?i)^(DJI_\d+\([^)]*\))_n\d+$', 1) WHEN 2 THEN regexp_extract(stem, '(?i)^(DJI_\d+)_n\d+$', 1)
    WHEN 3 THEN regexp_extract(stem, '(?i)^(DJI-\d+-\d+p)\d+$', 1) WHEN 4 THEN 'det_ucystr__' WHEN 5 THEN regexp_extract(stem, '(?i)^(pavilion_\d+_)\d+$', 1) WHEN 6 THEN regexp_extract(stem, '(?i)^(dji_\d+_\d+m)\d+_\d+$', 1)
    WHEN 7 THEN regexp_extract(stem, '(?i)^(dji\d+)\d+_\d+$', 1) WHEN 8 THEN regexp_extract(stem, '(?i)^(djibridge\d*)_?\d+.*$', 1) WHEN 9 THEN regexp_extract(stem, '(?i)^(lim_?\d*)\D*\d+$', 1) WHEN 10 THEN regexp_extract(stem, '(?i)^(lim_?\d*)\D*\d+$', 1)
    WHEN 11 THEN regexp_extract(stem, '(?i)^(dhi_\d{4})\d+_\d+$', 1) WHEN 12 THEN regexp_extract(stem, '(?i)^(traina?)\d+$', 1) ELSE '' END AS g FROM (SELECT *, id % 14 AS event_kind FROM fx_names)),
n AS (SELECT *, """ + _norm("g") + " AS ng, " + _norm("stem") + " AS ns, " + _norm("folder") + " AS nf, " + _norm("regexp_extract(ltrim(filename, '/'), '(?i)^(DJI_20\\d{8})_\\d+', 1)") + " AS flight, " + _norm("split_part(stem, '_', 1)") + """ AS nv FROM u)
SELECT id, CASE WHEN g = '' THEN 'uavdt:singleton:' || ns WHEN ng LIKE 'lim\\_%' ESCAPE '\\' OR ng LIKE 'dji\\_%' ESCAPE '\\' THEN 'uavdt:' || split_part(ng, '_', 1) ELSE 'uavdt:' || ng END AS uavdt,
  'visdrone:' || nv AS visdrone,
  CASE WHEN id % 7 = 0 THEN 'dronevehicle:flight:' || flight WHEN id % 5 = 1 THEN 'dronevehicle:capture:' || nf WHEN id % 6 = 0 THEN 'dronevehicle:capture:cap' || user_id WHEN id % 6 = 1 THEN 'dronevehicle:capture:d' WHEN id % 6 = 4 THEN 'dronevehicle:capture:run7'
    WHEN raw_split = 'train' THEN 'dronevehicle:unresolved-train-metadata' ELSE 'dronevehicle:unresolved-validation-metadata' END AS dronevehicle,
  id % 7 <> 0 AND id % 5 <> 1 AND id % 6 NOT IN (0, 1, 4) AND raw_split = 'train' AS force_train, 'uavdt_' || raw_split || '_' || stem AS output_name FROM n"""


def label_join(s, d):
    """J1, U1, A1."""
    images = frame(s, d, "fx_images").select("image_id", "source_dataset")
    files = frame(s, d, "fx_boxes").select("image_id")
    with_labels, without = an.attach_labels(images, files, ["image_id"])
    rows = an.union_sources(with_labels.withColumn("has_labels", F.lit(True)), without.withColumn("has_labels", F.lit(False)))
    flags = {f"{k}_{n}": (F.col("source_dataset") == k) & c for k in ("visdrone", "uavdt", "dronevehicle") for n, c in (("images", F.col("has_labels")), ("missing_labels", ~F.col("has_labels")))}
    return an.source_stats(rows, flags)


_LABEL_JOIN = ctes("fx_images", "fx_boxes") + """, j AS (SELECT source_dataset, image_id IN (SELECT image_id FROM fx_boxes) AS has FROM fx_images)
SELECT source_dataset || '_images' AS metric, count(*) FILTER (has) AS value FROM j GROUP BY source_dataset
UNION ALL SELECT source_dataset || '_missing_labels', count(*) FILTER (NOT has) FROM j GROUP BY source_dataset"""


def _keyed(s, d):
    rows = frame(s, d, "fx_files").select("output_name", "lang", "n_boxes", "crop_border", "split", dedup.content_sha256("text").alias("sha256"))
    return rows.withColumn("key", dedup.dedup_key("sha256", "crop_border", "lang", "output_name"))


_KEYED = ctes("fx_files") + ", k AS (SELECT output_name, n_boxes, split, sha256(text) AS sha256, CASE WHEN crop_border THEN 'uncropped:' || lang || ':' || output_name ELSE sha256(text) END AS key FROM fx_files)"


def exact_dedup(s, d):
    """F4, W1."""
    return dedup.keep_best_duplicate(_keyed(s, d)).select("key", "output_name", "n_boxes", "split")


_EXACT_DEDUP = _KEYED + "SELECT key, output_name, n_boxes, split FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY n_boxes DESC, output_name) = 1"


def duplicate_log(s, d):
    """A5."""
    return dedup.duplicate_groups(_keyed(s, d))


_DUPLICATE_LOG = _KEYED + """, r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n_boxes DESC, output_name) AS p FROM k)
SELECT a.key, a.output_name AS kept, a.n_boxes AS kept_boxes, b.output_name AS file, b.n_boxes AS boxes FROM r a JOIN r b ON a.key = b.key AND a.p = 1 AND b.p > 1"""


def preparation_counters(s, d):
    """Pictures of every 31st id don't decode, those of every 19th have no labels."""
    rows = frame(s, d, "fx_files").select("output_name", "n_boxes", "doc_id", F.col("lang").alias("source_dataset"), (F.coalesce(F.col("doc_id") % 31, F.lit(1)) != 0).alias("decode_ok"), dedup.content_sha256("text").alias("key"))
    files = rows.filter("doc_id % 19 <> 0").select("doc_id")
    kept = dedup.keep_best_duplicate(an.attach_labels(rows.filter("decode_ok"), files, ["doc_id"])[0])
    return an.picture_counters(rows, files, kept, ["doc_id"])


_PREPARATION = ctes("fx_files") + """, p AS (SELECT lang, text, doc_id % 31 <> 0 AS ok, doc_id % 19 <> 0 AS labelled FROM fx_files), c AS (
SELECT lang || '_corrupt_images' AS metric FROM p WHERE NOT ok UNION ALL SELECT lang || '_missing_labels' FROM p WHERE ok AND NOT labelled
UNION ALL SELECT 'images_before_exact_dedup' FROM p WHERE ok AND labelled)
SELECT metric, count(*) AS value FROM c GROUP BY metric UNION ALL SELECT 'images_after_exact_dedup', count(DISTINCT text) FROM p WHERE ok AND labelled"""


def reusable_crops(s, d):
    """Crops are there for training pictures with an even number of boxes."""
    rows = frame(s, d, "fx_files").select("output_name", "split", "n_boxes")
    crops = rows.filter("split = 'train' and n_boxes % 2 = 0").select(F.col("output_name").alias("file_name"), F.concat(F.lit("crops/"), "output_name").alias("path"))
    return an.reusable_crops(rows, crops)


_REUSABLE = ctes("fx_files") + "SELECT output_name, split, n_boxes, CASE WHEN split = 'train' AND n_boxes % 2 = 0 THEN 'crops/' || output_name END AS materialized_path, NOT (split = 'train' AND n_boxes % 2 = 0) AS crop_border FROM fx_files"


def train_copies_removed(s, d):
    """F4, J8."""
    rows = frame(s, d, "fx_files").select("output_name", "split", dedup.content_md5("text").alias("md5"))
    kept, removed = dedup.drop_train_copies(rows)
    return kept.select("output_name", F.lit("kept").alias("state")).unionByName(removed.select("output_name", F.lit("removed").alias("state")))


_TRAIN_COPIES = ctes("fx_files") + ", s AS (SELECT DISTINCT text FROM fx_files WHERE split <> 'train') SELECT output_name, CASE WHEN split = 'train' AND text IN (SELECT text FROM s) THEN 'removed' ELSE 'kept' END AS state FROM fx_files"


def cascade_annotations(s, d):
    """The pictures of every seventh order go."""
    return dedup.cascade_annotations(frame(s, d, "fx_boxes"), frame(s, d, "fx_images").filter("image_id % 7 = 0")).select("annotation_id", "image_id")


_CASCADE = ctes("fx_boxes", "fx_images") + "SELECT annotation_id, image_id FROM fx_boxes WHERE image_id NOT IN (SELECT image_id FROM fx_images WHERE image_id % 7 = 0)"


def manifest_diff(s, d):
    """S8, J11, U2."""
    images = frame(s, d, "fx_images")
    there = images.filter("image_id % 11 <> 0").select("split", "file_name").unionByName(images.filter("image_id % 13 = 0").select("split", F.concat(F.lit("extra_"), "file_name").alias("file_name")))
    return dedup.manifest_diff(images, there, ["split", "file_name"])


_MANIFEST = ctes("fx_images") + "SELECT split, file_name, 'missing' AS side FROM fx_images WHERE image_id % 11 = 0 UNION ALL SELECT split, 'extra_' || file_name, 'extra' FROM fx_images WHERE image_id % 13 = 0"


def rename_splits(s, d):
    """U5 after J11."""
    images = frame(s, d, "fx_images").select("image_id", "file_name", F.when(F.col("split") == "valid", "val").otherwise(F.col("split")).alias("split"))
    return dedup.rename_splits(images, images, images, ["split", "file_name"])


_RENAME = ctes("fx_images") + "SELECT image_id, file_name, split FROM fx_images"


QUERIES = {
    "clip_boxes": (clip_boxes, _CLIP_BOXES),
    "visdrone_lines": (visdrone_lines, _VISDRONE_LINES),
    "yolo_lines": (yolo_lines, _YOLO_LINES),
    "voc_xml_objects": (voc_xml_objects, _VOC),
    "reader_stats": (reader_stats, _READER_STATS),
    "group_names": (group_names, _GROUP_NAMES),
    "label_join": (label_join, _LABEL_JOIN),
    "exact_dedup": (exact_dedup, _EXACT_DEDUP),
    "duplicate_log": (duplicate_log, _DUPLICATE_LOG),
    "preparation_counters": (preparation_counters, _PREPARATION),
    "reusable_crops": (reusable_crops, _REUSABLE),
    "train_copies_removed": (train_copies_removed, _TRAIN_COPIES),
    "cascade_annotations": (cascade_annotations, _CASCADE),
    "manifest_diff": (manifest_diff, _MANIFEST),
    "rename_splits": (rename_splits, _RENAME),
}
