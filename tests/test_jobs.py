import numpy as np
from pyspark.sql import functions as F

from boxlake import jobs
from tests.test_sources import png


def picture(seed, h=96, w=128):
    """Smooth noise, which no thumbnail flattens."""
    coarse = np.random.default_rng(seed).integers(0, 256, (6, 8, 3), dtype=np.uint8)
    return np.kron(coarse, np.ones((h // 6 + 1, w // 8 + 1, 1), np.uint8))[:h, :w].copy()


def xml(name, box, folder="cap1"):
    corners = "".join(f"<{k}>{v}</{k}>" for k, v in zip(("xmin", "ymin", "xmax", "ymax"), box, strict=True))
    return f"<annotation><folder>{folder}</folder><filename>a.jpg</filename><path>D:\\x\\a.jpg</path><objects><object><name>{name}</name><bndbox>{corners}</bndbox></object></objects></annotation>"


def folders(root):
    out = {s: {k: (str(root / s / k / "images"), str(root / s / k / "labels")) for k in ks} for s, ks in {"visdrone": ["train", "val"], "uavdt": ["train"], "dronevehicle": ["train"]}.items()}
    for x in out.values():
        for pair in x.values():
            for p in pair:
                (root / p).mkdir(parents=True)
    return out


def test_from_files_to_an_audit_without_issues(spark, tmp_path):
    where = folders(tmp_path / "in")
    place = lambda s, k, i: tmp_path / "in" / s / k / ("images" if i == 0 else "labels")
    for i in range(24):
        split = "train" if i < 16 else "val"
        png(place("visdrone", split, 0) / f"{i:07d}_1.jpg", picture(i if i != 20 else 3))  # a near copy of 3 in another sequence
        (place("visdrone", split, 1) / f"{i:07d}_1.txt").write_text(f"{i},2,30,40,1,4,0,0\n1,2,3,4,0,4,0,0\nbad\n" if i else "")
    for i in range(8):
        png(place("uavdt", "train", 0) / f"DJI_{i}_n{i}.jpg", picture(100 + i if i != 7 else 100))
        (place("uavdt", "train", 1) / f"DJI_{i}_n{i}.txt").write_text("0 0.5 0.5 0.25 0.25\n" * (i + 1))
    (place("uavdt", "train", 0) / "broken.jpg").write_bytes(b"no picture")
    (place("uavdt", "train", 1) / "broken.txt").write_text("0 0.5 0.5 0.25 0.25\n")
    png(place("uavdt", "train", 0) / "unlabelled.jpg", picture(200))
    for i in range(6):
        png(place("dronevehicle", "train", 0) / f"{i:05d}.jpg", picture(300 + i, 712, 840))
        (place("dronevehicle", "train", 1) / f"{i:05d}.xml").write_text(xml("car", (150, 160, 190, 200), f"cap{i}") if i != 5 else "<annotation><object>")
    out = str(tmp_path / "out")
    globs = dict.fromkeys(jobs.GLOBS, "*.jpg")
    made = jobs.build_dataset(spark, where, out, globs=globs)
    stats = {r.metric: r.value for r in made["preparation"].collect()}
    assert stats["uavdt_corrupt_images"] == 1 and stats["uavdt_missing_labels"] == 1 and stats["dronevehicle_bad_xml"] == 1
    assert stats["visdrone_class_4_boxes"] == 23 and stats["visdrone_bad_rows"] == 23 and stats["dronevehicle_bndbox_converted"] == 5
    assert stats["images_before_exact_dedup"] == 24 + 8 + 6 and stats["images_after_exact_dedup"] == stats["images_before_exact_dedup"] - 1 - 2
    images = made["images"].collect()
    assert {r.file_name for r in images} >= {"uavdt_train_DJI_7_n7.jpg", "dronevehicle_train_00004.jpg"}  # of equal pictures the one with more boxes stays
    assert "uavdt_train_DJI_0_n0.jpg" not in {r.file_name for r in images}
    assert spark.read.parquet(f"{out}/images").count() == len(images) == 35
    names = [r.value for r in spark.read.text(f"{out}/reports/preparation").collect()]
    assert names == sorted(names) and len(names) == len(stats)

    present = made["images"].select("split", "file_name")
    signed = jobs.signatures(spark, where, made["images"]).select("output_name", "source_dataset", "split", "sha256", "dhash", "pixels")
    kinds = present.select("split").distinct().withColumn("categories", F.array(F.struct(F.lit(1).alias("id"), F.lit("vehicle").alias("name"), F.lit("vehicle").alias("supercategory"))))
    found = jobs.audit(made["images"], made["annotations"], signed, present, jobs.decoded_sizes(made["images"]), kinds)
    assert found["issues"].collect() == [] and found["crossing_sha256"].count() == found["leaks"].count() == found["decode_examples"].count() == 0
    assert found["sources"].agg(F.sum("annotations")).first()[0] == made["annotations"].count()
    wrong = found["examples"].count(), jobs.audit(made["images"], made["annotations"].withColumn("w", -F.col("w")))["issues"].filter("issue = 'nonpositive_boxes'").agg(F.sum("value")).first()[0]
    assert wrong == (0, made["annotations"].count())


def test_near_copies_share_a_split(spark, tmp_path):
    where = {"visdrone": {k: (str(tmp_path / k / "images"), str(tmp_path / k / "labels")) for k in ("train", "val")}}
    for k, i in (("train", 0), ("val", 1)):
        (tmp_path / k / "images").mkdir(parents=True)
        (tmp_path / k / "labels").mkdir(parents=True)
        rgb = picture(1)
        rgb[0, 0] = i  # other bytes, the same thumbnail
        png(tmp_path / k / "images" / f"seq{i}_1.jpg", rgb)
        (tmp_path / k / "labels" / f"seq{i}_1.txt").write_text("1,2,30,40,1,4,0,0\n")
    made = jobs.build_dataset(spark, where, str(tmp_path / "out"), globs=dict.fromkeys(jobs.GLOBS, "*.jpg"))
    assert made["pairs"].count() == 1
    rows = made["images"].collect()
    assert len(rows) == 2 and len({r.split for r in rows}) == 1 and {r.sequence_group for r in rows} == {"visdrone:seq0"}


def test_speeds(spark):
    rows = [(1, f, 1, 10.0 + 2 * f, 20.0, 40.0 + 2 * f, 50.0, 0.9, "full") for f in range(40)] + [(1, f, 2, 10.0 + 2 * f, 20.5, 40.0 + 2 * f, 50.0, 0.8, "slice") for f in range(40)]
    df = spark.createDataFrame(rows, "video_id long, frame_number long, det_no long, x1 double, y1 double, x2 double, y2 double, confidence double, origin string")
    got = jobs.speeds(df, 10.0, metres_per_pixel=0.1)
    last = got["speeds"].orderBy(F.desc("frame_number")).first()
    assert abs(last.speed_px_s - 20) < 1e-6 and last.label == "#1 | 7.2 km/h"
    assert got["summary"].first().tracks == 1 and got["status"].count() == 38
