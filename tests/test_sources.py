import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.functions import images
from boxlake.operators import annotations as an
from boxlake.operators import audit
from boxlake.sources import coco, labels, sinks


def png(path, rgb):
    h, w, _ = rgb.shape
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\0" + rgb[y].tobytes() for y in range(h))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_pictures(spark, tmp_path):
    rgb = np.random.default_rng(1).integers(0, 256, (48, 64, 3), dtype=np.uint8)
    png(tmp_path / "a_1.png", rgb)
    png(tmp_path / "b.png", np.zeros((8, 9, 3), np.uint8))
    (tmp_path / "bad.png").write_bytes(b"nothing")
    listed = labels.list_images(spark, str(tmp_path), "*.png", "train").collect()
    assert {(r.file_name, r.stem, r.raw_split) for r in listed} == {("a_1.png", "a_1", "train"), ("b.png", "b", "train"), ("bad.png", "bad", "train")}
    status = {r.path.rsplit("/", 1)[1]: (r.width, r.height, r.decode_ok) for r in labels.decode_status(spark, str(tmp_path)).collect()}
    assert status == {"a_1.png": (64, 48, True), "b.png": (9, 8, True), "bad.png": (None, None, False)}
    x = spark.read.format("image").option("dropInvalid", "true").load(str(tmp_path)).select("image.*")
    got = {r.origin.rsplit("/", 1)[1]: r.s for r in x.select("origin", images.image_signature("data", "width", "height", "nChannels", F.lit(False)).alias("s")).collect()}
    grey = (rgb.astype(int) @ np.array([299, 587, 114]) + 500) // 1000
    assert got["a_1.png"].dhash == images.dhash(grey) and len(got["a_1.png"].pixels) == 768
    assert got["b.png"].dhash == "0" * 16 and got["b.png"].pixel_std == 0


def test_thumbnails():
    ramp = np.tile(np.arange(90), (80, 1))
    assert images.dhash(ramp) == "f" * 16 and images.dhash(ramp[:, ::-1]) == "0" * 16
    assert (images.gray_thumbnail(np.full((100, 100), 77), 32, 24) == 77).all()
    assert images.crop_region(np.zeros((712, 840))).shape == (512, 640)
    assert images.luminance(bytes([0, 0, 255]), 1, 1, 3)[0, 0] == 76 and images.luminance(bytes([9]), 1, 1, 1)[0, 0] == 9


def test_visdrone_rows(spark):
    rows = ["", "1,2,3,4,1,4,0", "1,2,3,4,1,4,0,0,9", " 12 ,2,3,4,1,4,0,0", "3.5,2,3,4,1,4,0,0", "1,2,3,4,0,4,0,0", "1,2,3,4,1,7,0,0", "1,2,3,4,1,4,0,0,", None]
    got = labels.read_visdrone_labels(spark.createDataFrame([(r,) for r in rows], "line string")).collect()
    assert [r.bad_row for r in got] == [True, True, False, False, True, False, False, False, True]
    assert got[3].x == 12 and got[0].x is None
    kept = an.filter_visdrone(labels.read_visdrone_labels(spark.createDataFrame([(r,) for r in rows], "line string")))
    assert kept.count() == 3


def test_yolo_rows(spark):
    rows = ["0 .5 .5 .1 .1", "0 .5 .5 .1", "0 .5 .5 .1 .1 1", "0 nan .5 .1 .1", "0 1.0d .5 .1 .1", "2.7\t.5  .5 .1 .1 ", "-1.5 1e-1 .5 .1 .1"]
    got = labels.read_yolo_labels(spark.createDataFrame([(r,) for r in rows], "line string")).collect()
    assert [r.bad_row for r in got] == [False, True, True, True, True, False, False]
    assert [got[i].class_id for i in (0, 5, 6)] == [0, 2, -1] and got[6].cx == 0.1


def test_xml(spark):
    poly = "<polygon>" + "".join(f"<{k}>{v}</{k}>" for k, v in zip(("x1", "y1", "x2", "y2", "x3", "y3", "x4", "y4"), (110, 110, 150, 110, 150, 140, 110, 140), strict=True)) + "</polygon>"
    box = "<bndbox><xmin>110</xmin><ymin>110</ymin><xmax>150</xmax><ymax>140</ymax></bndbox>"
    doc = lambda o: f"<annotation><folder>f</folder>{o}</annotation>"
    obj = lambda name, x: f"<object><name>{name}</name>{x}</object>"
    files = ["<annotation><object>", doc(""), doc(obj(" TRUVK ", poly) + obj("car", box) + obj("car", "") + obj("person", poly)), doc(obj("car", poly.replace("<y4>140</y4>", "") + box))]
    df = spark.createDataFrame(list(enumerate(files)), "i int, xml string")
    rows = labels.read_voc_xml_labels(df, keep=["i"])
    assert {r.i for r in rows.filter("bad_xml").collect()} == {0}
    got = sorted((r.i, r.object_no, r.status, r.converted, r.box and tuple(r.box)) for r in an.voc_boxes(rows.filter("not bad_xml")).collect())
    b = (10.0, 10.0, 40.0, 30.0)
    assert got == [(2, 0, "ok", False, b), (2, 1, "ok", True, b), (2, 2, "point_only", False, None), (2, 3, "skipped_class", False, None), (3, 0, "bad_polygon", False, None)]


def test_lines_and_empty_label_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1,2,30,40,1,4,0,0\n\n")
    (tmp_path / "b.txt").write_text("")
    rows = labels.read_lines(spark, str(tmp_path))
    assert sorted((r.stem, r.line) for r in rows.collect()) == [("a", ""), ("a", "1,2,30,40,1,4,0,0")]
    pics = spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "c")], "raw_split string, stem string")
    with_, without = an.attach_labels(pics, labels.list_images(spark, str(tmp_path), "*.txt", "t"))
    assert sorted(r.stem for r in with_.collect()) == ["a", "b"] and [r.stem for r in without.collect()] == ["c"]


def test_coco_round_trip(spark, tmp_path):
    pics = spark.createDataFrame([("train", 1, "a.jpg", 10, 20, "s", "g", "r"), ("train", 2, "b.jpg", 10, 20, "s", "g", "r")], "split string, image_id long, file_name string, width int, height int, source_dataset string, sequence_group string, raw_split string")
    notes = spark.createDataFrame([("train", 2, 2, 1, 1.0, 2.0, 3.0, 4.0, 12.0, 0), ("train", 1, 1, 1, 5.0, 6.0, 2.0, 2.0, 4.0, 0)], "split string, annotation_id long, image_id long, category_id int, x double, y double, w double, h double, area double, iscrowd int")
    out = str(tmp_path / "coco")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_coco_json(pics, notes, out)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "coco" / "split=train").glob("part-*.txt"))) > 1  # no task writes a whole document
    file = tmp_path / "train.json"
    sinks.join_parts(spark, str(tmp_path / "coco" / "split=train"), str(file))
    doc = json.loads(file.read_text())
    assert [i["id"] for i in doc["annotations"]] == [1, 2] and doc["annotations"][1]["bbox"] == [1.0, 2.0, 3.0, 4.0] and doc["licenses"] == []
    back = coco.read_coco(spark, {"train": str(file)})
    assert back["annotations"].select("annotation_id", "x", "w").orderBy("annotation_id").collect() == [(1, 5.0, 2.0), (2, 1.0, 3.0)]
    for other in (coco.read_coco(spark, {"train": str(tmp_path / "coco" / "split=train")}), labels.read_coco_whole(spark, {"train": str(file)})):
        for name in ("images", "annotations"):
            cols = sorted(back[name].columns)
            assert sorted(map(str, other[name].select(cols).collect())) == sorted(map(str, back[name].select(cols).collect()))
    assert back["images"].count() == 2 and audit.audit_issues(back["annotations"], back["images"], back["categories"]).count() == 0
    (tmp_path / "empty.json").write_text("{}")
    none = coco.read_coco(spark, {"test": str(tmp_path / "empty.json")})
    assert none["images"].count() == 0 and audit.unexpected_categories(none["categories"]).first().value == 1
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_coco_json(pics, notes, out)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("train", "b.jpg"), ("test", "a.jpg")], "split string, file_name string")
    sinks.write_dataset(rows, rows, str(tmp_path / "d"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_dataset(rows, rows, str(tmp_path / "d"))
    sinks.write_removed_names(rows, str(tmp_path / "names"))
    assert [r.value for r in spark.read.text(str(tmp_path / "names")).collect()] == ["a.jpg", "b.jpg"]
    sinks.write_reports({"r": (rows, ["file_name"])}, str(tmp_path / "reports"))
    assert spark.read.json(str(tmp_path / "reports/r")).count() == 2
    issues = spark.createDataFrame([("train", "x", 2)], "split string, issue string, value long")
    sinks.write_audit({"issues": issues}, str(tmp_path / "audit"))
    assert json.loads(spark.read.text(str(tmp_path / "audit/summary")).first().value) == {"issues": {"train/x": 2}}


def test_parameters(spark):
    rows = spark.createDataFrame([(1, 5)], "video_id long, frame_number long")
    for bad in ({"start_frame": -1}, {"max_frames": 0}):
        with pytest.raises(ValueError):
            labels.read_detections(rows, **bad)
    videos = spark.createDataFrame([(1, 0.0, 10, 10, 100)], "video_id long, fps double, width int, height int, frames long")
    with pytest.raises(Exception, match="unusable video 1"):
        labels.check_videos(videos).collect()


def test_objects_at_any_depth(spark):
    car = lambda x: f"<object><name>{x}</name><bndbox><xmin>110</xmin><ymin>110</ymin><xmax>150</xmax><ymax>140</ymax></bndbox></object>"
    xml = f"<annotation><!-- {car('comment')} --><folder>f</folder><a><b>{car('car')}</b></a>{car('bus')}<objects>{car('van')}{car('tree')}</objects></annotation>"
    df = spark.createDataFrame([(xml,), (xml[:-3],), ("<annotation/>",)], "xml string")
    rows = labels.read_voc_xml_labels(df, keep=[])
    assert [(r.object.name, r.object_no, r.folder) for r in rows.filter("object is not null").collect()] == [("car", 0, "f"), ("bus", 1, "f"), ("van", 2, "f"), ("tree", 3, "f")]
    assert rows.filter("bad_xml").count() == 1 and rows.count() == 6
    plan = an.voc_boxes(rows.filter(~F.col("bad_xml"))).select("status", "converted", "box.*")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") + plan.count("xmltostructs") <= 2  # the document, and its objects


def test_bndbox_corners_in_the_wrong_order(spark):
    xml = "<annotation><object><name>car</name><bndbox><xmin>150</xmin><ymin>110</ymin><xmax>110</xmax><ymax>140</ymax></bndbox></object></annotation>"
    rows = an.voc_boxes(labels.read_voc_xml_labels(spark.createDataFrame([(xml,)], "xml string"), keep=[])).first()
    assert (rows.status, rows.converted, rows.box) == ("invalid_box", True, None)


def test_a_counter_is_worked_out_once_a_row(spark):
    from pyspark.sql import functions as F

    from boxlake.operators import annotations

    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def metrics(i):
        calls.add(1)
        return [None, ["even"], ["even", "fourth"]][2 if i % 4 == 0 else 1 if i % 2 == 0 else 0]

    got = annotations.counted(spark.range(40), metrics("id")).collect()
    assert sorted(map(tuple, got)) == [("even", 20), ("fourth", 10)] and calls.value == 40
