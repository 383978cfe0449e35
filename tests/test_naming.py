from boxlake.functions import naming


def test_uavdt(spark):
    cases = {
        "DJI_0001 (2)_n5": "uavdt:dji", "lim1234": "uavdt:lim123", "lim_12a3": "uavdt:lim", "det_ucystr__77": "uavdt:det_ucystr", "TrainA12": "uavdt:traina", "dhi_123456_1": "uavdt:dhi_1234",
        "x (1)": "uavdt:singleton:x", "": "uavdt:singleton:unknown", "dji12345_6": "uavdt:dji1234", "Pavilion_3_9": "uavdt:pavilion_3",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", naming.uavdt_group("s").alias("g"))
    assert {r.s: r.g for r in df.collect()} == cases


def test_dronevehicle(spark):
    rows = [
        ("image", "/DJI_2020010203_7.jpg", "", "train", "dronevehicle:flight:dji_2020010203", False),
        (" Cap 1 ", "a.jpg", "", "train", "dronevehicle:capture:cap1", False),
        ("A", "a.jpg", "D:\\cap\\images\\a.jpg", "train", "dronevehicle:capture:cap", False),
        ("", "a.jpg", "D:\\a.jpg", "val", "dronevehicle:capture:d", False),
        (None, None, None, "train", "dronevehicle:unresolved-train-metadata", True),
        ("b", "a.jpg", "images/a.jpg", "val", "dronevehicle:unresolved-validation-metadata", False),
    ]
    df = spark.createDataFrame([r[:4] for r in rows], "folder string, filename string, path string, raw_split string")
    got = [tuple(r.g) for r in df.select(naming.dronevehicle_group("folder", "filename", "path", "raw_split").alias("g")).collect()]
    assert got == [r[4:] for r in rows]


def test_others(spark):
    r = spark.range(1).select(naming.visdrone_group(naming.F.lit("0000A_1_2.jpg")).alias("a"), naming.source_name(naming.F.lit("uavdt_x_y")).alias("b"), naming.output_name(naming.F.lit("s"), naming.F.lit("t"), naming.F.lit("f.jpg")).alias("c")).first()
    assert tuple(r) == ("visdrone:0000a", "uavdt", "s_t_f.jpg")
