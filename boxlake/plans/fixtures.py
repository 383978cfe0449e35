"""Input tables of the queries, derived from the star-schema tables by SQL that Spark and DuckDB both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SQL = {
    # ids by order, so that no sort covers the whole table: order key and the line's place in its order
    "fx_boxes": """
SELECT l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS annotation_id,
  l_orderkey + (CASE WHEN l_partkey % 50 = 0 THEN 1000000000 ELSE 0 END) AS image_id,
  CAST((l_partkey * 37) % 1000 - 40 AS DOUBLE) AS x, CAST((l_partkey * 53 + l_linenumber * 17) % 700 - 30 AS DOUBLE) AS y,
  l_quantity * 4 - 6 AS w, (l_partkey % 60) * 2.5e0 - 2 AS h, l_linenumber AS class_id,
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS score, l_partkey AS part, l_suppkey AS supp, l_linenumber AS line, l_returnflag AS flag
FROM {lineitem}""",
    "fx_images": """
SELECT o_orderkey AS image_id, CASE o_custkey % 3 WHEN 0 THEN 'visdrone' WHEN 1 THEN 'uavdt' ELSE 'dronevehicle' END AS source_dataset,
  CAST(640 + 160 * (o_orderkey % 5) AS INT) AS width, CAST(512 + 90 * (o_orderkey % 4) AS INT) AS height,
  CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'valid' ELSE 'test' END AS split,
  (CASE o_custkey % 3 WHEN 0 THEN 'visdrone' WHEN 1 THEN 'uavdt' ELSE 'dronevehicle' END) || ':seq' || CAST(o_custkey % 97 AS STRING) AS sequence_group,
  (CASE o_custkey % 3 WHEN 0 THEN 'visdrone' WHEN 1 THEN 'uavdt' ELSE 'dronevehicle' END) || '_' || CAST(o_orderkey AS STRING) || '.jpg' AS file_name,
  o_orderkey % 41 = 0 AS force_train
FROM {orders}""",
    "fx_counted": """
SELECT i.*, coalesce(b.n, 0) AS n_boxes FROM {fx_images} i LEFT JOIN (SELECT image_id, count(*) AS n FROM {fx_boxes} GROUP BY image_id) b ON i.image_id = b.image_id""",
    # boxes of a split's document with planted defects
    "fx_notes": """
SELECT b.annotation_id, b.image_id, coalesce(i.split, 'train') AS split, CASE WHEN part % 97 = 0 THEN 2 ELSE 1 END AS category_id, CASE WHEN part % 61 = 0 THEN -0.0005e0 ELSE x END AS x, y,
  CASE WHEN part % 73 = 0 THEN NULL ELSE w END AS w, CASE WHEN part % 89 = 0 THEN CAST('NaN' AS DOUBLE) ELSE h END AS h,
  w * h + (CASE WHEN supp % 13 = 0 THEN 1 ELSE 0 END) AS area
FROM {fx_boxes} b LEFT JOIN {fx_images} i ON b.image_id = i.image_id""",
    "fx_lines": """
SELECT annotation_id, image_id, part, line, class_id,
  CASE WHEN part % 41 = 0 THEN concat_ws(',', CAST(CAST(x AS BIGINT) AS STRING), CAST(CAST(y AS BIGINT) AS STRING), CAST(CAST(w AS BIGINT) AS STRING), CAST(CAST(floor(h) AS BIGINT) AS STRING), CAST(score AS STRING), CAST(class_id AS STRING), '0')
    ELSE concat_ws(',', CASE WHEN part % 43 = 0 THEN 'abc' ELSE CAST(CAST(x AS BIGINT) AS STRING) END, CAST(CAST(y AS BIGINT) AS STRING), CAST(CAST(w AS BIGINT) AS STRING), CAST(CAST(floor(h) AS BIGINT) AS STRING), CAST(score AS STRING), CAST(class_id AS STRING), '0', '0') || (CASE WHEN part % 7 = 0 THEN ',' ELSE '' END) END AS visdrone_line,
  concat_ws(' ', CAST(class_id AS STRING), CAST((part * 37 % 1024) / 1024e0 AS STRING), CAST((part * 53 % 1024) / 1024e0 AS STRING), CAST((part * 11 % 200) / 1024e0 AS STRING), CAST((part * 7 % 160) / 1024e0 AS STRING)) || (CASE WHEN part % 47 = 0 THEN ' 1' WHEN part % 53 = 0 THEN ' nan' ELSE '' END) AS yolo_line,
  CASE WHEN line = 1 THEN ' TRUVK ' WHEN line = 2 THEN 'feright car' WHEN line = 3 THEN 'Bus' WHEN line = 4 THEN 'person' ELSE 'car' END AS name,
  CAST((part * 37) % 800 AS BIGINT) AS px, CAST((part * 53) % 650 AS BIGINT) AS py, 1 + part % 90 AS pw, 1 + part % 70 AS ph
FROM {fx_boxes}""",
    "fx_xml": """
SELECT annotation_id, '<annotation><folder>f' || CAST(part % 9 AS STRING) || '</folder><filename>' || CAST(annotation_id AS STRING) || '.jpg</filename><path>x</path>' || (CASE WHEN part % 17 = 0 THEN '<objects><!-- <object> -->' ELSE '' END) || '<object><name>' || name || '</name>' ||
  (CASE WHEN part % 31 = 0 THEN '' WHEN line % 2 = 0 THEN '<polygon><x1>' || CAST(px AS STRING) || '</x1><y1>' || CAST(py AS STRING) || '</y1><x2>' || CAST(px + pw AS STRING) || '</x2><y2>' || CAST(py AS STRING) || '</y2><x3>' || CAST(px + pw AS STRING) || '</x3><y3>' || CAST(py + ph AS STRING) || '</y3><x4>' || CAST(px AS STRING) || '</x4>' || (CASE WHEN part % 37 = 0 THEN '' ELSE '<y4>' || CAST(py + ph AS STRING) || '</y4>' END) || '</polygon>'
   ELSE '<bndbox><xmin>' || CAST(px AS STRING) || '</xmin><ymin>' || (CASE WHEN part % 37 = 0 THEN 'oops' ELSE CAST(py AS STRING) END) || '</ymin><xmax>' || CAST(px + pw AS STRING) || '</xmax><ymax>' || CAST(py + ph AS STRING) || '</ymax></bndbox>' END) ||
  '</object>' || (CASE WHEN part % 17 = 0 THEN '</objects>' ELSE '' END) || (CASE WHEN part % 59 = 0 THEN '' ELSE '</annotation>' END) AS xml, part, line, name, px, py, pw, ph
FROM {fx_lines}""",
    "fx_names": """
SELECT event_id AS id, user_id,
  CASE event_id % 14 WHEN 0 THEN 'DJI_' || CAST(user_id AS STRING) || ' (2)_n' || CAST(event_id AS STRING) WHEN 1 THEN 'DJI_' || CAST(user_id AS STRING) || '(1)_n7' WHEN 2 THEN 'dji_' || CAST(user_id AS STRING) || '_n9'
    WHEN 3 THEN 'DJI-' || CAST(user_id AS STRING) || '-720p' || CAST(event_id AS STRING) WHEN 4 THEN 'det_ucystr__' || CAST(event_id AS STRING) WHEN 5 THEN 'Pavilion_' || CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING)
    WHEN 6 THEN 'dji_' || CAST(user_id AS STRING) || '_30m' || CAST(event_id AS STRING) || '_1' WHEN 7 THEN 'dji' || CAST(event_id AS STRING) || '_4' WHEN 8 THEN 'djibridge' || CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING) || 'x'
    WHEN 9 THEN 'lim_' || CAST(user_id AS STRING) || 'a' || CAST(event_id AS STRING) WHEN 10 THEN 'lim' || CAST(event_id AS STRING) WHEN 11 THEN 'dhi_1234' || CAST(event_id AS STRING) || '_2' WHEN 12 THEN 'TrainA' || CAST(event_id AS STRING)
    ELSE ' Odd  Name%%' || CAST(user_id AS STRING) || ' (1)' END AS stem,
  CASE event_id % 5 WHEN 0 THEN 'image' WHEN 1 THEN ' Cap ' || CAST(user_id AS STRING) WHEN 2 THEN '' WHEN 3 THEN 'ModalA' ELSE 'b' END AS folder,
  CASE WHEN event_id % 7 = 0 THEN '/DJI_20' || CAST(10000000 + user_id AS STRING) || '_5.jpg' ELSE 'DJI_0582.jpg' END AS filename,
  CASE event_id % 6 WHEN 0 THEN 'D:' || chr(92) || 'cap' || CAST(user_id AS STRING) || chr(92) || 'images' || chr(92) || 'a.jpg' WHEN 1 THEN 'D:' || chr(92) || 'a.jpg' WHEN 2 THEN 'x.jpg' WHEN 3 THEN '' WHEN 4 THEN 'E:/Run 7/jpg/B/y.jpg' ELSE 'images' || chr(92) || 'z.jpg' END AS path,
  CASE WHEN event_id % 3 = 0 THEN 'val' ELSE 'train' END AS raw_split
FROM {events}""",
    "fx_files": """
SELECT doc_id, text, lang, source, CASE doc_id % 10 WHEN 0 THEN 'valid' WHEN 1 THEN 'test' ELSE 'train' END AS split, n_chars % 17 AS n_boxes,
  lang || '_' || CAST(doc_id AS STRING) AS output_name, doc_id % 29 = 0 AS crop_border, doc_id % 37 = 0 AS force_train,
  lang || ':' || source || ':' || CAST(doc_id % 25 AS STRING) AS sequence_group
FROM {documents}""",
    "fx_tracks": """
SELECT user_id % 8 AS video_id, user_id AS tracker_id, hour AS frame_number, event_id AS det_no, value AS cx, CAST((event_id * 7) % 1000 AS DOUBLE) AS cy FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, hour ORDER BY event_id) AS k FROM (
    SELECT event_id, user_id, value, 24 * CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) + CAST(extract(hour FROM ts) AS BIGINT) AS hour FROM {events}) e) f
WHERE k = 1""",
    "fx_detections": """
SELECT l_orderkey % 16 AS video_id, CAST(floor(l_orderkey / 16e0) AS BIGINT) AS frame_number,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS det_no,
  CAST((l_partkey * 7) % 60 AS DOUBLE) AS x1, CAST((l_suppkey * 11) % 60 AS DOUBLE) AS y1, (l_partkey * 7) % 60 + 20 + l_quantity AS x2, (l_suppkey * 11) % 60 + 30 + l_quantity AS y2,
  CAST((l_partkey * 31 + l_linenumber * 7) % 1000 AS DOUBLE) / 1000 AS confidence, CASE WHEN l_linenumber % 2 = 0 THEN 'full' ELSE 'slice' END AS origin,
  l_suppkey AS supp, l_returnflag AS flag, l_orderkey AS image_id
FROM {lineitem}""",
    # frame rates and, for some, a known length with its length in pixels
    "fx_videos": """
SELECT DISTINCT video_id, CASE video_id % 3 WHEN 0 THEN 10e0 WHEN 1 THEN 25e0 ELSE 50e0 END AS fps, CASE WHEN video_id % 2 = 0 THEN 0.5e0 * (video_id + 1) END AS known_m,
  CASE WHEN video_id % 2 = 0 THEN 8e0 * (video_id + 2) END AS measured_px FROM {fx_tracks}""",
    "fx_truth": """SELECT image_id, det_no AS truth_no, x1, y1, x2, y2 FROM {fx_detections} WHERE flag <> 'R'""",
    "fx_found": """SELECT image_id, det_no, confidence, x1 + supp % 5 AS x1, y1, x2 + supp % 5 AS x2, y2 FROM {fx_detections}""",
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture or a table as a DataFrame."""
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SQL[name].replace("date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))", "datediff(CAST(ts AS DATE), DATE '2024-01-01')")
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{u: frame(spark, sf_dir, u) for u in used})


def ctes(*names: str) -> str:
    """WITH clause of DuckDB for fixtures and those below them."""
    order: list[str] = []

    def visit(n: str) -> None:
        for u in re.findall(r"\{(\w+)\}", SQL[n]):
            if u in SQL:
                visit(u)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({re.sub(r'[{}]', '', SQL[n].strip())})" for n in order)
