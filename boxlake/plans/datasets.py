"""Queries of the audit, leakage, splitting and export."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.functions.images import HASH_SIZE, THUMBNAIL, bits_to_hex, image_signature, signature_of
from boxlake.operators import annotations as an
from boxlake.operators import audit, dedup, leakage, splits
from boxlake.plans.fixtures import ctes, frame
from boxlake.scratch import discard, scratch_dir, shuffles_freed, stored
from boxlake.sources import coco, labels, sinks


def _grey_sql(n: int) -> str:
    lo, hi = f"len(sizes) * i // {n}", f"len(sizes) * (i + 1) // {n}"
    return f"list_transform(range(0, {n}), lambda i: CASE WHEN {hi} > {lo} THEN least(255e0, 25e0 * list_sum(sizes[{lo} + 1:{hi}]) / ({hi} - {lo})) ELSE 0e0 END)"


def _signatures_sql(differ: str) -> str:
    """Classes of equal pictures, then links (source_dataset, dhash, l, r, lg, rg, low, corr, mae) of pictures that differ in a column."""
    return f""", sig0 AS (SELECT output_name, lang AS source_dataset, {differ} AS g, {_grey_sql(64)} AS px, {_grey_sql(17)} AS hx FROM (SELECT *, list_transform(string_split(coalesce(text, ''), ' '), lambda w: length(w)) AS sizes FROM fx_files)),
sig AS (SELECT *, (SELECT sum(CASE WHEN hx[i + 1] > hx[i] THEN CAST(pow(2, 16 - i) AS BIGINT) ELSE 0 END) FROM (SELECT unnest(range(1, 17)) AS i)) AS bits, list_sum(px) / 64 AS m FROM sig0),
st AS (SELECT *, printf('%04x', CAST(bits AS BIGINT)) AS dhash, list_transform(px, lambda v: v - m) AS c FROM sig), s2 AS (SELECT *, list_sum(list_transform(c, lambda v: v * v)) AS ss FROM st), s3 AS (SELECT *, sqrt(ss / 64) AS std FROM s2),
cl AS (SELECT source_dataset, dhash, px, any_value(c) AS c, any_value(ss) AS ss, any_value(std) AS std, min(output_name) AS n1, arg_min(g, output_name) AS g1 FROM s3 GROUP BY source_dataset, dhash, px),
sx AS (SELECT cl.source_dataset, cl.dhash, cl.px, n1, g1, cl.std, g, min(output_name) AS name FROM cl JOIN s3 ON s3.source_dataset = cl.source_dataset AND s3.dhash = cl.dhash AND s3.px = cl.px AND s3.g <> g1 GROUP BY ALL),
c2 AS (SELECT cl.*, n2, g2 FROM cl LEFT JOIN (SELECT source_dataset, dhash, px, min(name) AS n2, arg_min(g, name) AS g2 FROM sx GROUP BY ALL) z ON z.source_dataset = cl.source_dataset AND z.dhash = cl.dhash AND z.px = cl.px),
pr AS (SELECT a.source_dataset, a.dhash, CASE WHEN a.g1 = b.g1 AND b.n2 IS NULL THEN a.n2 ELSE a.n1 END AS l, CASE WHEN a.g1 = b.g1 AND b.n2 IS NOT NULL THEN b.n2 ELSE b.n1 END AS r,
  CASE WHEN a.g1 = b.g1 AND b.n2 IS NULL THEN a.g2 ELSE a.g1 END AS lg, CASE WHEN a.g1 = b.g1 AND b.n2 IS NOT NULL THEN b.g2 ELSE b.g1 END AS rg, least(a.std, b.std) AS low,
  CASE WHEN a.ss * b.ss > 0 THEN list_dot_product(a.c, b.c) / sqrt(a.ss * b.ss) ELSE 0 END AS corr, list_sum(list_transform(range(1, 65), lambda i: abs(a.px[i] - b.px[i]))) / 64 AS mae
  FROM c2 a JOIN c2 b ON a.source_dataset = b.source_dataset AND a.dhash = b.dhash AND a.n1 < b.n1 WHERE a.g1 <> b.g1 OR a.n2 IS NOT NULL OR b.n2 IS NOT NULL
  UNION ALL SELECT source_dataset, dhash, n1, name, g1, g, std, 1e0, 0e0 FROM sx)"""


def split_stats(s, d):
    """A2, J5, A11."""
    images = an.box_counts(frame(s, d, "fx_images"), frame(s, d, "fx_boxes"))
    return audit.split_stats(images)


_SPLIT_STATS = ctes("fx_counted") + """SELECT split, source_dataset, count(*) AS images, CAST(sum(n_boxes) AS BIGINT) AS boxes, count(*) FILTER (n_boxes = 0) AS negatives
FROM fx_counted GROUP BY GROUPING SETS ((split), (split, source_dataset))"""


def _notes(s, d):
    return frame(s, d, "fx_notes"), frame(s, d, "fx_images")


_FLAGGED = ctes("fx_notes") + """, f AS (SELECT n.*, i.width, i.height, i.file_name, i.image_id IS NULL AS orphan_annotations, i.image_id IS NOT NULL AS known, w IS NULL AS bad, w IS NOT NULL AND NOT isnan(h) AS fine FROM fx_notes n LEFT JOIN fx_images i ON n.image_id = i.image_id AND n.split = i.split),
g AS (SELECT *, known AND category_id <> 1 AS wrong_category, known AND bad AS malformed_boxes, known AND NOT bad AND NOT fine AS nonfinite_boxes, known AND fine AND (w <= 0 OR h <= 0) AS nonpositive_boxes,
  known AND fine AND (x < 0 OR y < 0 OR x + w > width + 0.001e0 OR y + h > height + 0.001e0) AS out_of_bounds_boxes, known AND fine AND abs(area - w * h) > 0.01e0 AS incorrect_areas, known AND fine AS measured FROM f)"""
_LONG = "UNPIVOT (SELECT split, " + ", ".join(f"count(*) FILTER ({k}) AS {k}" for k in audit.ISSUES) + " FROM g GROUP BY split) ON " + ", ".join(audit.ISSUES) + " INTO NAME issue VALUE value"


def size_histogram(s, d):
    """P10, P11, P12, A12."""
    return audit.size_histogram(*_notes(s, d))


_SIZES = _FLAGGED + """SELECT split, count(*) FILTER (w * h < 1024) AS small, count(*) FILTER (w * h >= 1024 AND w * h < 9216) AS medium, count(*) FILTER (w * h >= 9216) AS large,
count(*) FILTER (least(w, h) < 4) AS side_below_4, count(*) FILTER (least(w, h) < 8) AS side_below_8, count(*) FILTER (least(w, h) < 16) AS side_below_16,
count(*) FILTER (x <= 0 OR y <= 0 OR x + w >= width OR y + h >= height) AS boundary FROM g WHERE measured GROUP BY split"""


def source_counts(s, d):
    """F9, A12 by source."""
    return audit.source_counts(*_notes(s, d))


_SOURCES = _FLAGGED + """, p AS (SELECT i.split, split_part(i.file_name, '_', 1) AS source, i.image_id, count(n.annotation_id) AS k FROM fx_images i LEFT JOIN fx_notes n ON n.image_id = i.image_id AND n.split = i.split GROUP BY ALL)
SELECT split, source, count(*) AS images, (SELECT count(*) FROM g WHERE measured AND g.split = p.split AND split_part(g.file_name, '_', 1) = p.source) AS annotations, count(*) FILTER (k = 0) AS negatives FROM p GROUP BY split, source"""


def box_quantiles(s, d):
    """P13, A6."""
    return audit.box_quantiles(*_notes(s, d))


_QUANTILES = _FLAGGED + """, v AS (SELECT split, 'box_width' AS metric, w AS v FROM g WHERE measured UNION ALL SELECT split, 'box_height', h FROM g WHERE measured UNION ALL SELECT split, 'relative_area', w * h / (CAST(width AS BIGINT) * height) FROM g WHERE measured
UNION ALL SELECT i.split, 'boxes_per_image', CAST(count(n.annotation_id) AS DOUBLE) FROM fx_images i LEFT JOIN fx_notes n ON n.image_id = i.image_id AND n.split = i.split GROUP BY i.split, i.image_id),
q(quantile, f) AS (VALUES ('min', 0.0e0), ('p01', 0.01e0), ('p05', 0.05e0), ('p10', 0.1e0), ('p50', 0.5e0), ('p90', 0.9e0), ('p95', 0.95e0), ('p99', 0.99e0), ('max', 1.0e0)),
a AS (SELECT split, metric, quantile_cont(v, [0, 0.01, 0.05, 0.1, 0.5, 0.9, 0.95, 0.99, 1]) AS qs FROM v GROUP BY ALL)
SELECT split, metric, unnest(['min', 'p01', 'p05', 'p10', 'p50', 'p90', 'p95', 'p99', 'max']) AS quantile, round(unnest(qs), 6) AS value FROM a"""


def top_resolutions(s, d):
    """F10, A7."""
    return audit.top_resolutions(frame(s, d, "fx_images"))


_RESOLUTIONS = ctes("fx_images") + "SELECT split, resolution, images FROM (SELECT split, width || 'x' || height AS resolution, count(*) AS images FROM fx_images GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY split ORDER BY images DESC, resolution) <= 12"


def audit_issues(s, d):
    """P14, F11, J4, J11, A8, A10, U4; repeated ids, missing files and a wrong category list are planted."""
    notes, images = _notes(s, d)
    again = notes.filter("image_id % 101 = 0")
    twice = images.filter("image_id % 103 = 0")
    kinds = images.select("split").distinct().withColumn("categories", F.array(F.struct(F.when(F.col("split") == "test", 2).otherwise(1).alias("id"), F.lit("vehicle").alias("name"), F.lit("vehicle").alias("supercategory"))))
    present = images.filter("image_id % 11 <> 0").select("split", "file_name")
    return audit.audit_issues(notes.unionByName(again), images.unionByName(twice), kinds, present)


_ISSUES = _FLAGGED.replace("FROM fx_notes n LEFT JOIN", "FROM (SELECT * FROM fx_notes UNION ALL SELECT * FROM fx_notes WHERE image_id % 101 = 0) n LEFT JOIN") + f"""SELECT split, issue, value FROM (
SELECT split, issue, value FROM ({_LONG})
UNION ALL SELECT split, 'duplicate_image_ids', count(*) FROM fx_images WHERE image_id % 103 = 0 GROUP BY split
UNION ALL SELECT split, 'duplicate_annotation_ids', count(*) FROM fx_notes WHERE image_id % 101 = 0 GROUP BY split
UNION ALL SELECT 'test', 'unexpected_categories', 1
UNION ALL SELECT split, 'missing_files', count(*) FROM fx_images WHERE image_id % 11 = 0 GROUP BY split) WHERE value > 0"""


def issue_examples(s, d):
    """L1."""
    return audit.issue_examples(*_notes(s, d))


_EXAMPLES = _FLAGGED + "SELECT split, issue, file_name, annotation_id FROM (" + " UNION ALL ".join(f"SELECT split, '{k}' AS issue, coalesce(file_name, '') AS file_name, annotation_id FROM g WHERE {k}" for k in audit.ISSUES) + ") QUALIFY row_number() OVER (PARTITION BY split, issue ORDER BY file_name, annotation_id) <= 10"


def crossing_groups(s, d):
    """A9."""
    return audit.crossing_groups(frame(s, d, "fx_files").select("split", F.sha2("text", 256).alias("sha256")), "sha256")


_CROSSING = ctes("fx_files") + ", c AS (SELECT sha256(text) AS sha256, count(*) AS images, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM fx_files GROUP BY text HAVING count(DISTINCT split) > 1) SELECT * FROM c"


def leak_examples(s, d):
    """L2: the report's first twenty."""
    return audit.leak_examples(crossing_groups(s, d), "sha256")


def review_sample(s, d):
    """L3."""
    rows = audit.review_sample(an.box_counts(frame(s, d, "fx_images"), frame(s, d, "fx_boxes")))
    return rows.select("source_dataset", "is_negative", "file_name")


_REVIEW = ctes("fx_counted") + "SELECT source_dataset, n_boxes = 0 AS is_negative, file_name FROM fx_counted QUALIFY row_number() OVER (PARTITION BY source_dataset, n_boxes = 0 ORDER BY md5('42|' || file_name), file_name) <= 12"


def _grey(n: int):
    """An array of word lengths as n grey levels: 25 times the mean of each of n parts of equal length."""
    words = F.size("sizes").cast("bigint")

    def level(i):
        lo, hi = (F.floor(words * k / n).cast("int") for k in (i, i + 1))
        total = F.aggregate(F.slice("sizes", lo + 1, hi - lo), F.lit(0), lambda a, x: a + x)
        return F.when(hi > lo, F.least(F.lit(255.0), F.lit(25.0) * total / (hi - lo))).otherwise(F.lit(0.0))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), level)


def _signatures(s, d):
    """Whole texts as pictures of 64 grey levels, with the hash of a coarser picture."""
    rows = frame(s, d, "fx_files").withColumn("sizes", F.transform(F.split(F.coalesce("text", F.lit("")), " "), F.length))
    rows = rows.select("output_name", F.col("lang").alias("source_dataset"), "sequence_group", "split", "force_train", "n_boxes", _grey(64).alias("pixels"), _grey(17).alias("coarse"))
    return rows.withColumn("dhash", bits_to_hex("coarse")).drop("coarse")


def picture_classes(s, d):
    """Equal pictures, whose links J6 and J7 give by representatives."""
    return leakage.picture_classes(_signatures(s, d))


_CLASSES = ctes("fx_files") + _signatures_sql("split") + "SELECT output_name, min(output_name) OVER (PARTITION BY source_dataset, dhash, px) AS representative FROM s3"


def near_duplicate_pairs(s, d):
    """F1, J6."""
    return leakage.near_duplicate_pairs(_signatures(s, d))


_NEAR = ctes("fx_files") + _signatures_sql("sequence_group") + """SELECT source_dataset, dhash, l AS left_output_name, r AS right_output_name, lg AS left_sequence_group, rg AS right_sequence_group, round(corr, 6) AS correlation, round(mae, 6) AS mean_absolute_error, round(low, 6) AS minimum_contrast_stddev
FROM pr WHERE low >= 10 AND corr >= 0.95e0 AND mae <= 10"""


def cross_split_leaks(s, d):
    """F1, J7."""
    return leakage.cross_split_leak_pairs(_signatures(s, d))


_LEAKS = ctes("fx_files") + _signatures_sql("split") + """SELECT source_dataset, dhash, l AS left_output_name, r AS right_output_name, lg AS left_split, rg AS right_split, round(corr, 6) AS correlation, round(mae, 6) AS mean_absolute_error, round(low, 6) AS minimum_contrast_stddev
FROM pr WHERE round(low, 6) >= 10 AND round(corr, 6) >= 0.95e0 AND round(mae, 6) <= 10"""


def merged_groups(s, d):
    """G1."""
    return leakage.merge_groups(leakage.near_duplicate_pairs(_signatures(s, d)))


_MERGED_CTES = ctes("fx_files") + _signatures_sql("sequence_group") + """, e0 AS (SELECT lg, rg FROM pr WHERE low >= 10 AND corr >= 0.95e0 AND mae <= 10), e AS (SELECT lg AS a, rg AS b FROM e0 UNION SELECT rg, lg FROM e0),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a), mg AS (SELECT a AS sequence_group, least(a, min(b)) AS merged_group FROM reach GROUP BY a)"""
_MERGED = _MERGED_CTES + "SELECT * FROM mg"


def forced_groups(s, d):
    """G2 over G1."""
    rows = _signatures(s, d).select("output_name", "sequence_group", "force_train", "n_boxes", "source_dataset")
    return leakage.propagate_force_train(rows, merged_groups(s, d)).select("output_name", "sequence_group", "force_train")


_FORCED = _MERGED_CTES + ", x AS (SELECT output_name, coalesce(merged_group, f.sequence_group) AS sequence_group, force_train FROM fx_files f LEFT JOIN mg ON f.sequence_group = mg.sequence_group) SELECT output_name, sequence_group, max(force_train) OVER (PARTITION BY sequence_group) AS force_train FROM x"


def _images(s, d):
    rows = an.box_counts(frame(s, d, "fx_images"), frame(s, d, "fx_boxes"))
    return rows.withColumn("force_train", F.col("sequence_group").endswith("seq13"))


def assign_groups(s, d):
    """A3, G3."""
    return splits.assign_groups(splits.group_totals(_images(s, d)))


_ASSIGN_CTES = ctes("fx_counted") + """, im AS (SELECT *, sequence_group LIKE '%seq13' AS forced FROM fx_counted), gt AS (SELECT source_dataset, sequence_group, forced, count(*) AS n, CAST(sum(n_boxes) AS BIGINT) AS b FROM im GROUP BY ALL),
tt AS (SELECT source_dataset, sum(n) AS tn, sum(b) AS tb, coalesce(sum(n) FILTER (forced), 0) AS fn, coalesce(sum(b) FILTER (forced), 0) AS fb FROM gt GROUP BY ALL),
od AS (SELECT *, row_number() OVER (PARTITION BY source_dataset ORDER BY n DESC, b DESC, md5('42|' || sequence_group)) AS k FROM gt WHERE NOT forced),
gr(source_dataset, k, g, split, ni, nv, ns, bi, bv, bs) AS (
  SELECT source_dataset, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(fn AS DOUBLE), 0e0, 0e0, CAST(fb AS DOUBLE), 0e0, 0e0 FROM tt
  UNION ALL
  SELECT source_dataset, k, g, w, ni + CASE WHEN w = 'train' THEN n ELSE 0 END, nv + CASE WHEN w = 'valid' THEN n ELSE 0 END, ns + CASE WHEN w = 'test' THEN n ELSE 0 END, bi + CASE WHEN w = 'train' THEN b ELSE 0 END, bv + CASE WHEN w = 'valid' THEN b ELSE 0 END, bs + CASE WHEN w = 'test' THEN b ELSE 0 END
  FROM (SELECT *, CASE WHEN cs <= ci AND cs <= cv THEN 'test' WHEN ci <= cv THEN 'train' ELSE 'valid' END AS w FROM (
    SELECT gr.source_dataset, od.k, od.sequence_group AS g, od.n, od.b, ni, nv, ns, bi, bv, bs, (ni + od.n) / greatest(tn * 0.8e0, 1) + (bi + od.b) / greatest(tb * 0.8e0, 1) AS ci, (nv + od.n) / greatest(tn * 0.1e0, 1) + (bv + od.b) / greatest(tb * 0.1e0, 1) AS cv, (ns + od.n) / greatest(tn * 0.1e0, 1) + (bs + od.b) / greatest(tb * 0.1e0, 1) AS cs
    FROM gr JOIN od ON od.source_dataset = gr.source_dataset AND od.k = gr.k + 1 JOIN tt ON tt.source_dataset = gr.source_dataset))),
asg AS (SELECT source_dataset, g AS sequence_group, split FROM gr WHERE k > 0)"""
_ASSIGN = _ASSIGN_CTES + "SELECT * FROM asg"


def split_report(s, d):
    """A4, J10."""
    images = _images(s, d)
    return splits.split_report(splits.apply_assignments(images.drop("split"), splits.assign_groups(splits.group_totals(images))))


_REPORT = _ASSIGN_CTES + ", fi AS (SELECT im.source_dataset, im.sequence_group, n_boxes, forced, CASE WHEN forced THEN 'train' ELSE asg.split END AS s FROM im LEFT JOIN asg ON im.sequence_group = asg.sequence_group) SELECT source_dataset, count(*) AS total_images, CAST(sum(n_boxes) AS BIGINT) AS total_boxes, count(DISTINCT CASE WHEN NOT forced THEN sequence_group END) AS assignable_groups, count(*) FILTER (forced) AS forced_images, " + ", ".join(f"count(*) FILTER (s = '{x}') AS images_{x}, CAST(coalesce(sum(n_boxes) FILTER (s = '{x}'), 0) AS BIGINT) AS boxes_{x}, count(DISTINCT CASE WHEN NOT forced AND s = '{x}' THEN sequence_group END) AS groups_{x}" for x in ("train", "valid", "test")) + " FROM fi GROUP BY source_dataset"


def _numbered(s, d):
    known = frame(s, d, "fx_images").select(F.col("image_id").alias("k"), "file_name", "split", "width", "height", "source_dataset", "sequence_group")
    boxes = frame(s, d, "fx_boxes").filter("image_id < 1000000000").select(F.col("image_id").alias("k"), "annotation_id", "x", "y", "w", "h")
    boxes = boxes.withColumn("box_no", F.row_number().over(W.partitionBy("k").orderBy("annotation_id"))).withColumnRenamed("annotation_id", "old_id")
    images = splits.dense_image_ids(an.box_counts(known, boxes, "k"))
    return images, splits.dense_annotation_ids(images, boxes.join(known.select("k", "file_name"), "k"))


def dense_ids(s, d):
    """W2, W3."""
    return _numbered(s, d)[1].select("old_id", "split", "image_id", "annotation_id")


_DENSE = ctes("fx_images", "fx_boxes") + """, di AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42|' || file_name), file_name) AS new_id FROM fx_images)
SELECT b.annotation_id AS old_id, split, new_id AS image_id, row_number() OVER (PARTITION BY split ORDER BY new_id, b.annotation_id) AS annotation_id FROM fx_boxes b JOIN di ON b.image_id = di.image_id"""


def coco_documents(s, d):
    """Documents per split, written in ranges and read again by ranges."""
    images, boxes = _numbered(s, d)
    images = images.withColumn("raw_split", F.col("split"))
    boxes = boxes.select("split", "annotation_id", "image_id", F.lit(1).alias("category_id"), "x", "y", "w", "h", F.round(F.col("w") * F.col("h"), 3).alias("area"), F.lit(0).alias("iscrowd"))
    path = scratch_dir(s)
    sinks.write_coco_json(images, boxes, path)
    back = coco.read_coco(s, {split: f"{path}/split={split}" for split in splits.FRACTIONS})
    discard(s, [path])
    return back["annotations"].select("split", "annotation_id", "image_id", "category_id", "x", "y", "w", "h", "area")


def foreign_documents(s, d):
    """A document of another layout: lists in another order, objects over several lines, nested fields, texts with braces and quotes."""
    images, path, made = frame(s, d, "fx_images"), scratch_dir(s), scratch_dir(s)
    boxes = stored(frame(s, d, "fx_boxes").select("annotation_id", "image_id", "x", "y", "w", "h"), made, compression="zstd")
    image = F.struct(F.struct(F.lit('say "}, {"').alias("by"), F.array(F.struct(F.lit("[").alias("k"))).alias("tags")).alias("extra"), F.concat(F.lit('a\\"}]'), "file_name").alias("file_name"), F.col("image_id").alias("id"), "height", "width")
    note = F.struct(F.array("x", "y", "w", "h").alias("bbox"), F.struct(F.array(F.lit(1)).alias("counts")).alias("segmentation"), F.col("image_id"), F.col("annotation_id").alias("id"))

    def lines(rows, part, id_, item):
        first = rows.agg(F.min(id_).alias("least"))
        text = F.regexp_replace(F.to_json(item), r',"', ',\n  "')
        return rows.join(F.broadcast(first)).select(F.lit(part).alias("part"), F.col(id_).alias("id"), F.concat(F.when(F.col(id_) > F.col("least"), ",").otherwise(""), text).alias("value"))  # one row

    fixed = s.createDataFrame([(0, 0, '{"annotations" : ['), (2, 0, '], "info": {"about": {"a": {}}}, "images":\n['), (4, 0, "]}")], "part int, id bigint, value string")
    rows = lines(boxes, 1, "annotation_id", note).unionByName(lines(images, 3, "image_id", image)).unionByName(fixed)
    with shuffles_freed(s):
        rows.repartitionByRange("part", "id").sortWithinPartitions("part", "id").select("value").write.text(path)
    discard(s, [made])
    tables = coco.read_coco(s, {"all": path})
    discard(s, [path])
    notes = tables["annotations"].groupBy("image_id").agg(F.count("*").alias("boxes"), F.round(F.sum(F.col("x") + F.col("w")), 3).alias("sum"))
    return tables["images"].join(notes, "image_id", "left").select("split", "image_id", "file_name", "width", "height", "boxes", "sum")


_FOREIGN = ctes("fx_images", "fx_boxes") + """SELECT 'all' AS split, i.image_id, concat('a', chr(92), '"}]', file_name) AS file_name, width, height, boxes, sum FROM fx_images i LEFT JOIN (SELECT image_id, count(*) AS boxes, round(sum(x + w), 3) AS sum FROM fx_boxes GROUP BY image_id) b ON b.image_id = i.image_id"""


_COCO = ctes("fx_images", "fx_boxes") + """, di AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42|' || file_name), file_name) AS new_id FROM fx_images)
SELECT split, row_number() OVER (PARTITION BY split ORDER BY new_id, b.annotation_id) AS annotation_id, new_id AS image_id, 1 AS category_id, x, y, w, h, round(w * h, 3) AS area FROM fx_boxes b JOIN di ON b.image_id = di.image_id"""

def dataset_tables(s, d):
    """K1: both tables written by split and read again."""
    images, boxes = _numbered(s, d)
    path = scratch_dir(s)
    sinks.write_dataset(images.select("split", "image_id", "file_name", "width", "height"), boxes.select("split", "annotation_id", "image_id", "x", "y", "w", "h"), path)
    notes = s.read.parquet(f"{path}/annotations").groupBy("split", "image_id").agg(F.count("*").alias("boxes"), F.min("annotation_id").alias("first_annotation"))
    return s.read.parquet(f"{path}/images").join(notes, ["split", "image_id"], "left")


_TABLES = _DENSE.split("SELECT b.annotation_id AS old_id")[0] + """, dn AS (SELECT b.image_id AS k, row_number() OVER (PARTITION BY split ORDER BY new_id, b.annotation_id) AS annotation_id FROM fx_boxes b JOIN di ON b.image_id = di.image_id),
dc AS (SELECT k, count(*) AS boxes, min(annotation_id) AS first_annotation FROM dn GROUP BY k)
SELECT split, new_id AS image_id, file_name, width, height, boxes, first_annotation FROM di LEFT JOIN dc ON dc.k = di.image_id"""


def _placed_lines(s, path):
    """Lines of text files with their places, in the order of the files' names."""
    lines = s.read.text(path).select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    return lines.select(F.row_number().over(W.partitionBy(F.lit(0)).orderBy("file", "at")).alias("place"), F.col("value").alias("line"))  # a report's lines, which are few


def report_lines(s, d):
    """K3, L4: group totals as sorted JSON lines."""
    path = scratch_dir(s)
    totals = splits.group_totals(_images(s, d)).groupBy("source_dataset", "sequence_group").agg(F.sum("images").alias("images"))
    sinks.write_reports({"groups": (totals, ["sequence_group"])}, path)
    return _placed_lines(s, f"{path}/groups")


_REPORT_LINES = ctes("fx_images") + """, g AS (SELECT source_dataset, sequence_group, count(*) AS n FROM fx_images GROUP BY ALL)
SELECT row_number() OVER (ORDER BY sequence_group) AS place, '{"source_dataset":"' || source_dataset || '","sequence_group":"' || sequence_group || '","images":' || n || '}' AS line FROM g"""


def removed_names(s, d):
    """K4: the names of training pictures that have copies elsewhere, one a line."""
    rows = frame(s, d, "fx_files").select(F.col("output_name").alias("file_name"), "split", dedup.content_md5("text").alias("md5"))
    path = scratch_dir(s)
    sinks.write_removed_names(dedup.drop_train_copies(rows)[1], path)
    return s.read.text(path).select(F.col("value").alias("file_name"))


_REMOVED = ctes("fx_files") + "SELECT output_name AS file_name FROM fx_files WHERE split = 'train' AND text IN (SELECT text FROM fx_files WHERE split <> 'train')"


def audit_files(s, d):
    """K5: the audit's tables and its summary, written and read again."""
    path = scratch_dir(s)
    sinks.write_audit({"issues": audit_issues(s, d), "resolutions": top_resolutions(s, d)}, path)
    counts = s.read.text(f"{path}/summary").select(F.explode(F.from_json("value", "issues map<string,bigint>")["issues"]).alias("name", "value"))
    other = s.read.parquet(f"{path}/resolutions").select(F.concat_ws("/", "split", "resolution").alias("name"), F.col("images").alias("value"))
    return counts.unionByName(other)


_AUDIT_FILES = "SELECT split || '/' || issue AS name, CAST(value AS BIGINT) AS value FROM (" + _ISSUES + ") UNION ALL SELECT split || '/' || resolution, images FROM (" + _RESOLUTIONS + ")"


def listed_files(s, d):
    """A file for each supplier, listed without its content; none of them is a picture."""
    path = scratch_dir(s)
    rows = s.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_name")
    rows.repartition("s_suppkey").write.partitionBy("s_suppkey").text(f"{path}/train")
    key = F.regexp_extract("path", r"s_suppkey=(\d+)/", 1).cast("bigint").alias("s_suppkey")
    listed = labels.list_images(s, f"{path}/train", "*.txt", "train").select(key, "raw_split", "path", (F.concat("stem", F.lit(".txt")) == F.col("file_name")).alias("stem_fits"))
    status = labels.decode_status(s, f"{path}/train").filter(~F.element_at(F.split("path", "/"), -1).startswith("_"))
    names = labels.list_manifest(s, f"{path}/train").filter("file_name like '%.txt'").agg(F.count("*").alias("files_in_all"))
    both = listed.join(status, "path").groupBy("s_suppkey", "raw_split").agg(F.count("*").alias("files"), F.min("stem_fits").alias("stem_fits"), F.count_if("decode_ok").alias("pictures"), F.max("width").alias("width"))
    return both.crossJoin(names)  # one row


_LISTED = "SELECT s_suppkey, 'train' AS raw_split, 1 AS files, true AS stem_fits, 0 AS pictures, CAST(NULL AS INTEGER) AS width, count(*) OVER () AS files_in_all FROM supplier"


def picture_signatures(s, d):
    """hashes of grey pictures of 9 by 8 and pixels of those of 32 by 24, whose levels come from the document's row."""
    rows = s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.coalesce("n_chars", F.lit(0)).cast("bigint").alias("n"))

    def picture(width, height):
        level = lambda i: F.lower(F.lpad(F.hex((F.col("n") * (i * i + 7) + F.col("doc_id") * i * 31) % 256), 2, "0"))
        data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(width * height - 1).cast("bigint")), level), ""))
        return image_signature(data, F.lit(width), F.lit(height), F.lit(1), F.lit(False))

    rows = rows.select("doc_id", picture(*HASH_SIZE).alias("a"), picture(*THUMBNAIL).alias("b"))
    total = F.aggregate(F.zip_with("b.pixels", F.sequence(F.lit(1), F.lit(768)), lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    return rows.select("doc_id", F.col("a.dhash").alias("dhash"), total.alias("weighted_pixels"), F.round("b.pixel_std", 4).alias("pixel_std"))


_SIGNATURES = """WITH d AS (SELECT doc_id, coalesce(n_chars, 0) AS n FROM documents), l AS (SELECT doc_id, [(n * (i * i + 7) + doc_id * i * 31) % 256 FOR i IN range(0, 768)] AS v FROM d)
SELECT doc_id, printf('%016x', CAST(list_sum([CASE WHEN v[(k // 8) * 9 + k % 8 + 2] > v[(k // 8) * 9 + k % 8 + 1] THEN CAST(1 AS UBIGINT) << (63 - k) ELSE CAST(0 AS UBIGINT) END FOR k IN range(0, 64)]) AS UBIGINT)) AS dhash,
  CAST(list_sum([v[i] * i FOR i IN range(1, 769)]) AS DOUBLE) AS weighted_pixels, round(list_stddev_pop(v), 4) AS pixel_std FROM l"""

#: Sides of the coloured pictures, and the region that is cut out of some.
WIDE, HIGH, REGION = 54, 40, (6, 5, 48, 35)


def resized_pictures(s, d):
    """Three-channel pictures from whole texts, larger than the thumbnails, a third of them cut to a region."""
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    part = lambda k: F.conv(F.substring(digest, 1 + 4 * k, 4), 16, 10).cast("bigint")
    rows = s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.explode(F.array(F.struct(*(part(k).alias(f"m{k}") for k in range(3))))).alias("m"), (F.col("doc_id") % 3 == 0).alias("crop"))
    # behind a generator, so that the digest is taken once a text; the byte at 3 * (y * width + x) + channel: blue, green, red
    level = lambda i: F.lower(F.lpad(F.hex((F.col("m.m0") * i * (i % 251) + F.floor(F.col("m.m1") * i / 7) + F.col("m.m2") * (i % 3)) % 256), 2, "0"))
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(3 * WIDE * HIGH - 1).cast("bigint")), level), ""))
    signed = rows.select("doc_id", signature_of(REGION)(data, F.lit(WIDE), F.lit(HIGH), F.lit(3), F.col("crop")).alias("s"))
    total = F.aggregate(F.zip_with("s.pixels", F.sequence(F.lit(1), F.lit(768)), lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    return signed.select("doc_id", F.col("s.dhash").alias("dhash"), total.alias("weighted_pixels"), F.round("s.pixel_std", 4).alias("pixel_std"))


def _resized() -> str:
    """Integer arithmetic by rows: levels, weights of both passes, sums."""
    left, top, right, bottom = REGION

    def weights(name: str, target: int, side: str) -> str:
        """By picture class (cut or not): weights of each source place for each target place."""
        return f"""{name}_w AS (SELECT crop, t, p, greatest(0e0, 1e0 - abs((p - c + 0.5e0) * (1e0 / r))) AS w FROM (SELECT crop, size, t, (t + 0.5e0) * (size / {target}e0) AS c, greatest(size / {target}e0, 1e0) AS r, unnest(range(size)) AS p
  FROM (SELECT crop, {side} AS size, unnest(range({target})) AS t FROM sides)) z WHERE p >= greatest(0, trunc(c - r + 0.5e0)) AND p < least(size, trunc(c + r + 0.5e0))),
{name} AS (SELECT crop, t, p, CAST(floor(w / sum(w) OVER (PARTITION BY crop, t) * 4194304e0 + 0.5e0) AS BIGINT) AS k FROM {name}_w)"""

    def passes(name: str, width: int, height: int) -> str:
        return f"""{weights(name + '_x', width, 'wide')},
{weights(name + '_y', height, 'high')},
{name}_a AS (SELECT doc_id, l.crop, y, t AS x, least(255, greatest(0, (sum(v * k) + 2097152) // 4194304)) AS v FROM l JOIN {name}_x f ON f.crop = l.crop AND f.p = l.x GROUP BY ALL),
{name} AS (SELECT doc_id, t AS y, x, least(255, greatest(0, (sum(v * k) + 2097152) // 4194304)) AS v FROM {name}_a a JOIN {name}_y f ON f.crop = a.crop AND f.p = a.y GROUP BY doc_id, t, x)"""

    byte = lambda c: f"((m0 * ({c}) * (({c}) % 251) + CAST(floor(m1 * ({c}) / 7e0) AS BIGINT) + m2 * (({c}) % 3)) % 256)"
    hash_bits = "CASE WHEN v > lag(v) OVER (PARTITION BY doc_id, y ORDER BY x) THEN CAST(1 AS UBIGINT) << CAST(63 - (y * 8 + x - 1) AS INTEGER) ELSE CAST(0 AS UBIGINT) END"
    return f"""WITH m AS (SELECT doc_id, doc_id % 3 = 0 AS crop, CAST('0x' || substr(h, 1, 4) AS BIGINT) AS m0, CAST('0x' || substr(h, 5, 4) AS BIGINT) AS m1, CAST('0x' || substr(h, 9, 4) AS BIGINT) AS m2 FROM (SELECT doc_id, md5(coalesce(text, '')) AS h FROM documents) z),
sides AS (SELECT true AS crop, {right - left} AS wide, {bottom - top} AS high UNION ALL SELECT false, {WIDE}, {HIGH}),
i AS (SELECT *, 3 * n AS b FROM (SELECT *, unnest(range({WIDE * HIGH})) AS n FROM m) z),
g AS (SELECT doc_id, crop, n % {WIDE} AS x, n // {WIDE} AS y, (19595 * {byte('b + 2')} + 38470 * {byte('b + 1')} + 7471 * {byte('b')} + 32768) // 65536 AS v FROM i),
l AS (SELECT doc_id, crop, CASE WHEN crop THEN x - {left} ELSE x END AS x, CASE WHEN crop THEN y - {top} ELSE y END AS y, v FROM g WHERE NOT crop OR (x >= {left} AND x < {right} AND y >= {top} AND y < {bottom})),
{passes('th', *THUMBNAIL)},
{passes('ha', *HASH_SIZE)},
hb AS (SELECT doc_id, printf('%016x', CAST(sum(bit) AS UBIGINT)) AS dhash FROM (SELECT doc_id, x, {hash_bits} AS bit FROM ha) z WHERE x > 0 GROUP BY doc_id)
SELECT th.doc_id, any_value(dhash) AS dhash, CAST(sum(v * (y * {THUMBNAIL[0]} + x + 1)) AS DOUBLE) AS weighted_pixels, round(stddev_pop(v), 4) AS pixel_std FROM th JOIN hb ON hb.doc_id = th.doc_id GROUP BY th.doc_id"""


QUERIES = {
    "resized_pictures": (resized_pictures, _resized()),
    "dataset_tables": (dataset_tables, _TABLES),
    "report_lines": (report_lines, _REPORT_LINES),
    "removed_names": (removed_names, _REMOVED),
    "audit_files": (audit_files, _AUDIT_FILES),
    "listed_files": (listed_files, _LISTED),
    "picture_signatures": (picture_signatures, _SIGNATURES),
    "split_stats": (split_stats, _SPLIT_STATS),
    "size_histogram": (size_histogram, _SIZES),
    "source_counts": (source_counts, _SOURCES),
    "box_quantiles": (box_quantiles, _QUANTILES),
    "top_resolutions": (top_resolutions, _RESOLUTIONS),
    "audit_issues": (audit_issues, _ISSUES),
    "issue_examples": (issue_examples, _EXAMPLES),
    "crossing_groups": (crossing_groups, _CROSSING),
    "leak_examples": (leak_examples, _CROSSING + " ORDER BY sha256 LIMIT 20"),
    "review_sample": (review_sample, _REVIEW),
    "picture_classes": (picture_classes, _CLASSES),
    "near_duplicate_pairs": (near_duplicate_pairs, _NEAR),
    "cross_split_leaks": (cross_split_leaks, _LEAKS),
    "merged_groups": (merged_groups, _MERGED),
    "forced_groups": (forced_groups, _FORCED),
    "assign_groups": (assign_groups, _ASSIGN),
    "split_report": (split_report, _REPORT),
    "dense_ids": (dense_ids, _DENSE),
    "coco_documents": (coco_documents, _COCO),
    "foreign_documents": (foreign_documents, _FOREIGN),
}
