import math

from pyspark.sql import functions as F

from boxlake.functions import geometry as g


def one(spark, row, schema, **columns):
    return spark.createDataFrame([row], schema).select(*(c.alias(k) for k, c in columns.items())).first()


BOX = "x double, y double, w double, h double, iw int, ih int"


def test_clip(spark):
    rows = [
        (-5.0, 0.0, 10.0, 10.0, 100, 100),
        (200.0, 0.0, 10.0, 10.0, 100, 100),
        (0.0, 0.0, 1.9996, 5.0, 100, 100),
        (0.0, 0.0, 1.9994, 5.0, 100, 100),
        (0.0, 0.0, -3.0, 5.0, 100, 100),
        (float("nan"), 0.0, 5.0, 5.0, 100, 100),
        (None, 0.0, 5.0, 5.0, 100, 100),
        (0.0, 0.0, 5.0, 5.0, None, 100),
        (1.0, 1.0, float("inf"), 5.0, 100, 100),
    ]
    got = spark.createDataFrame(rows, BOX).select(g.clip_box("x", "y", "w", "h", "iw", "ih").alias("b")).select("b", g.keep_min_side("b").alias("k")).collect()
    assert tuple(got[0].b) == (0.0, 0.0, 5.0, 10.0) and got[0].k
    assert [r.b is None for r in got] == [False, True, False, False, True, True, True, True, True]
    assert got[2].b.w == 2.0 and got[2].k and not got[3].k and not got[1].k


def test_issues_in_order(spark):
    rows = [
        (1.0, 1.0, 5.0, 5.0, 25.0, 1),
        (1.0, 1.0, None, 5.0, 25.0, 2),
        (1.0, float("nan"), 5.0, 5.0, 25.0, 1),
        (1.0, 1.0, 0.0, 5.0, 0.0, 1),
        (95.0, 1.0, 5.0005, 5.0, 25.0025, 1),
        (95.0, 1.0, 5.002, 5.0, 25.01, 1),
        (1.0, 1.0, 5.0, 5.0, 25.02, 1),
        (1.0, 1.0, 5.0, 5.0, None, None),
    ]
    df = spark.createDataFrame(rows, "x double, y double, w double, h double, area double, c int")
    flags = g.box_issues("x", "y", "w", "h", "area", "c", F.lit(100), F.lit(100))
    got = [{k for k, v in r.asDict().items() if v} for r in df.select(*(v.alias(k) for k, v in flags.items())).collect()]
    assert got == [set(), {"wrong_category", "malformed_boxes"}, {"nonfinite_boxes"}, {"nonpositive_boxes"}, set(), {"out_of_bounds_boxes"}, {"incorrect_areas"}, {"wrong_category", "incorrect_areas"}]


def test_small_columns(spark):
    r = one(
        spark, (3.0, 40.0), "w double, h double",
        **g.tiny_side_flags("w", "h"), bucket=g.coco_size_bucket(F.col("w") * F.col("h")), edge=g.touches_boundary(F.lit(1.0), F.lit(1.0), F.lit(99.0), F.lit(3.0), F.lit(100), F.lit(100)),
        part=g.relative_area("w", "h", F.lit(10), F.lit(12)), kmh=g.speed_to_kmh(F.lit(10.0), 0.5),
    )
    assert (r.side_below_4, r.side_below_8, r.side_below_16, r.bucket, r.edge, r.part, r.kmh) == (True, True, True, "small", True, 1.0, 18.0)


def test_labels_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (2.5,), (None,), (10.0,)], "v double")
    got = df.select(g.format_speed_label(F.lit(7), "v").alias("a"), g.format_speed_label(F.lit(7), "v", F.lit(0.038)).alias("b")).collect()
    assert [r.a for r in got] == ["#7 | 0 px/s", "#7 | 2 px/s", "#7 | -- px/s", "#7 | 10 px/s"]
    assert [r.b for r in got][2:] == ["#7 | -- km/h", "#7 | 1.4 km/h"]


def test_iou(spark):
    box = lambda *v: dict(zip(("x1", "y1", "x2", "y2"), (F.lit(float(x)) for x in v), strict=True))
    r = one(spark, (1,), "i int", a=g.iou(box(0, 0, 10, 10), box(0, 0, 10, 5)), b=g.iou(box(0, 0, 1, 1), box(2, 2, 3, 3)), c=g.iou(box(0, 0, 0, 0), box(0, 0, 0, 0)))
    assert (r.a, r.b, r.c) == (0.5, 0.0, 0.0) and not math.isnan(r.c)
