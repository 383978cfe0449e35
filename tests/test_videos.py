import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from boxlake.operators import detections as det
from boxlake.operators import evaluate, tracks
from boxlake.operators.linking import Tracker
from boxlake.streaming import frames
from tests.test_linking import model

DET = "video_id long, frame_number long, det_no long, x1 double, y1 double, x2 double, y2 double, confidence double, origin string"
TRACK = "video_id long, tracker_id long, frame_number long, det_no long, cx double, cy double"


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)


def test_nms(spark):
    rows = [
        (1, 1, 1, 0.0, 0.0, 10.0, 10.0, 0.9, "full"), (1, 1, 2, 0.0, 0.0, 10.0, 5.0, 0.8, "full"), (1, 1, 3, 0.0, 0.0, 10.0, 9.0, 0.7, "full"),
        (1, 2, 1, 0.0, 0.0, 10.0, 10.0, 0.5, "slice"), (1, 2, 2, 0.0, 1.0, 10.0, 11.0, 0.5, "full"),
    ]
    df = spark.createDataFrame(rows, DET)
    assert {(r.frame_number, r.det_no) for r in det.nms(df).collect()} == {(1, 1), (1, 2), (2, 1)}
    assert {(r.frame_number, r.det_no) for r in det.merge_full_and_slices(df, "full").collect()} == {(1, 1), (1, 2), (2, 2)}
    assert {(r.frame_number, r.det_no) for r in det.merge_full_and_slices(df, "slice").collect()} == {(2, 1)}
    with pytest.raises(ValueError):
        det.merge_full_and_slices(df, "none")


def test_nms_matches_brute_force(spark):
    r = random.Random(3)
    rows = []
    for f in range(30):
        for k in range(r.randint(0, 12)):
            x, y = r.randint(0, 30), r.randint(0, 30)
            rows.append((0, f, k, float(x), float(y), x + 20.0, y + 15.0, r.choice([0.2, 0.5, 0.8]), "full"))
    want = set()
    for f in range(30):
        kept = []
        for x in sorted((x for x in rows if x[1] == f), key=lambda x: (-x[7], x[2])):
            if all(overlap(x[3:7], y[3:7]) <= 0.5 for y in kept):
                kept.append(x)
        want |= {(f, x[2]) for x in kept}
    assert {(x.frame_number, x.det_no) for x in det.nms(spark.createDataFrame(rows, DET)).collect()} == want


def test_pairs_of_a_dense_frame(spark):
    import time

    r = random.Random(6)
    rows = [(1, 1, k, x := r.uniform(-3000, 3000), y := r.uniform(0, 6000), x + r.uniform(10, 40), y + r.uniform(10, 40), 0.9, "full") for k in range(20_000)]
    rows += [(1, 1, 20_000 + k, -3000.0, 0.0, 3000.0 + k, 6000.0, 0.9, "full") for k in range(3)]  # and three that cover it
    rows += [(1, 2, k, x := float(r.randint(0, 20)), y := float(r.randint(0, 20)), x + r.choice([0.0, 5.0, 9.0]), y + 8.0, 0.5, "full") for k in range(60)]
    df = spark.createDataFrame(rows, DET).repartition(8)
    began = time.time()
    got = {(x.frame_number, x.a_det_no, x.b_det_no): x.iou for x in det.iou_pairs(df, 0.3).collect()}
    assert time.time() - began < 60  # 200 million pairs if all were looked at
    want = {}
    for f in (1, 2):
        boxes = np.array([x[3:7] for x in rows if x[1] == f])
        for i in range(len(boxes)):
            b = boxes[i + 1 :]
            w = np.minimum(boxes[i, 2], b[:, 2]) - np.maximum(boxes[i, 0], b[:, 0])
            h = np.minimum(boxes[i, 3], b[:, 3]) - np.maximum(boxes[i, 1], b[:, 1])
            both = np.maximum(w, 0) * np.maximum(h, 0)
            union = (boxes[i, 2] - boxes[i, 0]) * (boxes[i, 3] - boxes[i, 1]) + (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1]) - both
            share = np.where(union > 0, both / np.where(union > 0, union, 1), 0)
            want |= {(f, i, i + 1 + int(k)): share[k] for k in np.flatnonzero(share > 0.3)}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    with pytest.raises(ValueError):
        det.overlapping(df, df, det.FRAME, 0.0)


def test_tiles(spark):
    df = spark.createDataFrame([(1, 1920, 1080), (2, 500, 960)], "image_id int, width int, height int")
    got = sorted((r.image_id, r.tile_x, r.tile_y, r.tile_width, r.tile_height) for r in det.slice_grid(df).collect())
    assert got == [(1, 0, 0, 960, 960), (1, 0, 120, 960, 960), (1, 800, 0, 960, 960), (1, 800, 120, 960, 960), (1, 960, 0, 960, 960), (1, 960, 120, 960, 960), (2, 0, 0, 500, 960)]
    with pytest.raises(ValueError):
        det.slice_grid(df, 100, 100)


def random_video(seed):
    r = random.Random(seed)
    cars = [[r.uniform(0, 200), r.uniform(0, 200), r.uniform(-4, 4), r.uniform(-4, 4)] for _ in range(6)]
    rows = []
    for f in range(60):
        if r.random() < 0.1:
            continue
        seen = [c for c in cars if r.random() < 0.85]
        for k, (x, y, vx, vy) in enumerate(seen):
            x, y = x + vx * f + r.uniform(-1, 1), y + vy * f + r.uniform(-1, 1)
            rows.append((f, k, x, y, x + 25, y + 18, r.choice([0.3, 0.45, 0.55, 0.7, 0.9])))
    return rows


def test_linking_matches_an_independent_model_in_any_batches(spark, tmp_path):
    videos = {v: random_video(v) for v in range(4)}
    want = {(v, *k): i for v, rows in videos.items() for k, i in model(rows, 12.0).items()}
    assert max(want.values()) > 5 and -1 in want.values()
    rows = [(v, *x) for v, video in videos.items() for x in video]
    schema = "video_id long, frame_number long, det_no long, x1 double, y1 double, x2 double, y2 double, confidence double"
    df = spark.createDataFrame(rows, schema)
    got = {(x.video_id, x.frame_number, x.det_no): x.tracker_id for x in tracks.link_tracks(df, 12.0).collect()}
    assert got == want
    r = random.Random(9)
    cuts = [0, *sorted(r.sample(range(1, 60), 4)), 60]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        df.filter(f"frame_number >= {a} and frame_number < {b}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        frames.append_to(frames.link_tracks_stream(stream, 12.0), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = {(x.video_id, x.frame_number, x.det_no): x.tracker_id for x in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == want


def test_null_videos_are_kept(spark):
    rows = [(v, f, 1, 0.0, 0.0, 9.0, 9.0, 0.9) for v, f in ((None, 1), (1, 1), (1, 2), (1, 3))]
    df = spark.createDataFrame(rows, "video_id long, frame_number long, det_no long, x1 double, y1 double, x2 double, y2 double, confidence double")
    assert sorted(((x.video_id, x.frame_number, x.tracker_id) for x in tracks.link_tracks(df, 12.0).collect()), key=str) == sorted([(None, 1, -1), (1, 1, -1), (1, 2, -1), (1, 3, 1)], key=str)


def test_parameters(spark):
    df = spark.createDataFrame([], DET)
    for bad in ({"confidence": 0.6}, {"confidence": 0.0}, {"track_threshold": 1.0}):
        with pytest.raises(ValueError):
            det.confidence_filter(df, **bad)
    with pytest.raises(ValueError):
        tracks.window_frames(0, 30)
    with pytest.raises(ValueError):
        Tracker(0)
    assert tracks.window_frames(0.5, 5) == 3 and tracks.window_frames(0.5, 25) == 12


def walk(seed, n=60):
    r = random.Random(seed)
    rows, f = [], 0
    for v in range(2):
        for t in range(4):
            f = 0
            for k in range(n):
                f += r.choice([1, 1, 1, 2, 3, 51, 52])
                rows.append((v, t, f, k, r.random() * 100, r.random() * 100))
    return rows


def brute_speeds(rows, fps, window, stationary=5.0):
    out = {}
    for key in {(x[0], x[1]) for x in rows}:
        last, smooth, hist = None, None, []
        for _, _, f, _, x, y in sorted((x for x in rows if (x[0], x[1]) == key), key=lambda x: x[2]):
            if last is not None and f - last >= 5 * round(fps) + 2:
                smooth, hist = None, []
            hist, last = [h for h in hist if f - h[0] <= window] + [(f, x, y)], f
            raw = None
            if len(hist) >= 4:
                a = np.array(hist)
                raw = float(np.hypot(np.polyfit(a[:, 0] / fps, a[:, 1], 1)[0], np.polyfit(a[:, 0] / fps, a[:, 2], 1)[0]))
                raw = 0.0 if raw < stationary else raw
                smooth = raw if smooth is None else 0.25 * raw + 0.75 * smooth
            out[(*key, f)] = None if raw is None else smooth
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (v is None) == (got[k] is None or got[k] != got[k]) and (v is None or abs(v - got[k]) < 1e-6), k


def test_speeds_and_stream(spark, tmp_path):
    rows, fps = walk(1), 10.0
    want = brute_speeds(rows, fps, tracks.window_frames(2.0, fps))
    df = spark.createDataFrame(rows, TRACK)
    for parts in (1, 6):
        got = {(r.video_id, r.tracker_id, r.frame_number): r.speed_px_s for r in tracks.speeds(df.repartition(parts), fps, 2.0).collect()}
        same(got, want)
    cuts = [0, 100, 300, 10_000]
    path = tmp_path / "in"
    for a, b in zip(cuts, cuts[1:], strict=False):  # each run of the stream sees one more range of frames
        df.filter(f"frame_number > {a} and frame_number <= {b}").drop("det_no").coalesce(1).write.mode("append").parquet(str(path))
        stream = spark.readStream.schema(df.drop("det_no").schema).parquet(str(path))
        frames.append_to(frames.speed_stream(stream, fps, 2.0), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
        status = frames.frame_status_stream(stream.select("video_id", "tracker_id", "frame_number"))
        frames.append_to(status, str(tmp_path / "status"), str(tmp_path / "log2")).awaitTermination()
    same({(r.video_id, r.tracker_id, r.frame_number): r.speed_px_s for r in spark.read.parquet(str(tmp_path / "out")).collect()}, want)
    batch = {tuple(r) for r in tracks.frame_status(df).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "status")).select("video_id", "frame_number", "active", "unique_tracks", "unit").collect()} == batch


def test_session_gap(spark):
    rows = [(1, 1, f, f, 1.0, 1.0) for f in (0, 51, 103)] + [(1, 2, f, f, 1.0, 1.0) for f in (0, 52)]
    got = sorted((r.tracker_id, r.frame_number, r.session) for r in tracks.track_sessions(spark.createDataFrame(rows, TRACK), 10.0).collect())
    assert got == [(1, 0, 0), (1, 51, 0), (1, 103, 1), (2, 0, 0), (2, 52, 1)]


def test_linking(spark, tmp_path):
    rows = []
    for f in range(40):
        for k, (x, v) in enumerate(((0, 3), (300, -2))):
            if not (k == 1 and 15 <= f < 20):  # one is hidden for five frames
                weak = 0.3 if k == 0 and f % 7 == 3 else 0.9
                rows.append((1, f, k, x + v * f, 50.0 + 100 * k, x + v * f + 40.0, 90.0 + 100 * k, weak, "full"))
    df = spark.createDataFrame([tuple(map(float, r[3:7])) and (*r[:3], *map(float, r[3:7]), r[7], r[8]) for r in rows], DET).drop("origin")
    out = tracks.link_tracks(df).toPandas()
    ids = out[out.tracker_id > 0].groupby("det_no").tracker_id.nunique()
    assert ids.to_dict() == {0: 1, 1: 1} and out.tracker_id.nunique() == 3
    assert set(out[out.tracker_id < 0].frame_number) == {0, 1}
    for a, b in ((0, 17), (17, 60)):
        df.filter(f"frame_number >= {a} and frame_number < {b}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        frames.append_to(frames.link_tracks_stream(stream), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).toPandas()
    key = ["video_id", "frame_number", "det_no"]
    pd.testing.assert_frame_equal(streamed.sort_values(key).reset_index(drop=True)[[*key, "tracker_id"]], out.sort_values(key).reset_index(drop=True)[[*key, "tracker_id"]])


def test_speeds_of_videos_with_their_own_rates(spark):
    rows = [(v, t, f, k, x, y) for v, t, f, k, x, y in walk(2)]
    videos = spark.createDataFrame([(0, 10.0, 25.0, 500.0), (1, 25.0, None, None)], "video_id long, fps double, known_m double, measured_px double")
    df = tracks.with_videos(spark.createDataFrame(rows, TRACK), videos)
    got = tracks.speeds(df, "fps", 2.0).collect()
    want = brute_speeds([r for r in rows if r[0] == 0], 10.0, tracks.window_frames(2.0, 10.0)) | brute_speeds([r for r in rows if r[0] == 1], 25.0, tracks.window_frames(2.0, 25.0))
    same({(r.video_id, r.tracker_id, r.frame_number): r.speed_px_s for r in got}, want)
    assert {(r.video_id, r.fps, r.metres_per_pixel) for r in got} == {(0, 10.0, 0.05), (1, 25.0, None)}
    units = {(r.video_id, r.unit) for r in tracks.frame_status(df).collect()}
    assert units == {(0, "KM/H @ 0.0500 M/PX"), (1, "PX/S")}
    for bad in ([(0, 10.0, None, None)], [(0, 10.0, 0.0, 5.0), (1, 10.0, None, None)], [(0, 0.0, None, None), (1, 10.0, None, None)], [(0, 10.0, 2.0, None), (1, 10.0, None, None)]):
        with pytest.raises(Exception, match="unusable video"):
            tracks.with_videos(spark.createDataFrame(rows, TRACK), spark.createDataFrame(bad, videos.schema)).collect()


@pytest.mark.parametrize("window", [5, 5000])
def test_velocity_of_long_tracks_at_any_window(spark, window):
    r = random.Random(window)
    rows, x, y, f = [], 5000.0, 900.0, 1_000_000
    for k in range(9000):
        f, x, y = f + r.choice([1, 1, 1, 2, 7]), x + r.uniform(-3, 4), y + r.uniform(-2, 2)
        rows.append((1, 1, f, k, x, y))
    df = spark.createDataFrame(rows, TRACK).withColumn("session", F.lit(0))
    got = {x.frame_number: x.raw_speed_px_s for x in tracks.trailing_velocity(df, 10.0, window / 10.0, 0.0).collect()}
    a = np.array([x[2:] for x in rows], float)
    assert len(got) == len(rows)
    for k in [0, 1, 2, 3, 4, 50, *r.sample(range(len(rows)), 150)]:
        w = a[(a[:, 0] <= a[k, 0]) & (a[k, 0] - a[:, 0] <= window)]
        if len(w) < 4:
            assert got[int(a[k, 0])] is None
            continue
        t = (w[:, 0] - a[k, 0]) / 10.0
        want = np.hypot(np.polyfit(t, w[:, 2], 1)[0], np.polyfit(t, w[:, 3], 1)[0])
        assert abs(got[int(a[k, 0])] - want) < 1e-5


def test_smoothing_of_long_tracks(spark):
    r = random.Random(4)
    raw = [None if r.random() < 0.1 else r.choice([0.0, r.uniform(0, 300)]) for _ in range(3000)]
    df = spark.createDataFrame([(1, 1, 0, 7 * k, v) for k, v in enumerate(raw)], "video_id long, tracker_id long, session long, frame_number long, raw_speed_px_s double")
    got = {x.frame_number // 7: x.speed_px_s for x in tracks.smoothed_speed(df).collect()}
    last = None
    for k, v in enumerate(raw):
        if v is None:
            assert got[k] is None
            continue
        last = v if last is None else 0.25 * v + 0.75 * last
        assert abs(got[k] - last) < 1e-9
    assert "PythonUDF" not in (plan := tracks.smoothed_speed(df)._jdf.queryExecution().executedPlan().toString()) and "MapInPandas" not in plan


def test_unique_tracks_over_ranges_of_frames(spark):
    r = random.Random(8)
    rows = [(v, r.choice([-1, *range(40)]), r.choice([r.randint(0, 20_000), 4095, 4096]), 0, 0.0, 0.0) for v in (1, 2) for _ in range(300)]
    got = {(x.video_id, x.frame_number): (x.active, x.unique_tracks) for x in tracks.running_unique_tracks(spark.createDataFrame(rows, TRACK)).collect()}
    want = {(v, f): (sum(x[0] == v and x[2] == f for x in rows), len({x[1] for x in rows if x[0] == v and x[2] <= f and x[1] >= 0})) for v, _, f, *_ in rows}
    assert got == want


def test_ids_of_an_ended_video_are_freed(spark, tmp_path):
    schema = "video_id long, tracker_id long, frame_number long"
    parts = [[(1, t, f) for f in range(5) for t in range(f + 3)], [(1, 1, 3), (1, 9, 5), (2, 1, 6)], [(2, t, 900) for t in range(4)], [(2, 1, 1800)]]
    held = []
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = frames.append_to(frames.frame_status_stream(stream, 0.038, 10.0, "5 seconds"), str(tmp_path / "out"), str(tmp_path / "log"))
        query.awaitTermination()
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
    got = sorted((x.video_id, x.frame_number, x.active, x.unique_tracks, x.late) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 0, 3, 3, False), (1, 1, 4, 4, False), (1, 2, 5, 5, False), (1, 3, 1, 7, True), (1, 3, 6, 6, False), (1, 4, 7, 7, False), (1, 5, 1, 8, False), (2, 6, 1, 1, False), (2, 900, 4, 4, False), (2, 1800, 1, 1, False)]
    assert {x.unit for x in spark.read.parquet(str(tmp_path / "out")).collect()} == {"KM/H @ 0.0380 M/PX"} and held[1] > held[-1]


def test_late_rows_go(spark, tmp_path):
    t = Tracker()
    x = pd.DataFrame([(1, 5, 0, 0.0, 0.0, 9.0, 9.0, 0.9)], columns=["video_id", "frame_number", "det_no", "x1", "y1", "x2", "y2", "confidence"])
    assert len(t.run(x)) == 1 and len(t.run(x)) == 0


def test_evaluation(spark):
    box = "x1 double, y1 double, x2 double, y2 double"
    truth = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0), (1, 2, 20.0, 0.0, 30.0, 10.0), (2, 1, 0.0, 0.0, 10.0, 10.0)], f"image_id long, truth_no long, {box}")
    found = spark.createDataFrame([(1, 1, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 2, 0.8, 0.0, 0.0, 10.0, 8.0), (1, 3, 0.7, 20.0, 0.0, 30.0, 7.0), (3, 1, 0.95, 0.0, 0.0, 5.0, 5.0)], f"image_id long, det_no long, confidence double, {box}")
    matches = evaluate.match_detections(found, truth)
    at = lambda t: {(r.image_id, r.det_no, r.truth_no) for r in matches.filter(f"threshold = {t}").collect()}
    assert at(0.5) == at(0.7) == {(1, 1, 1), (1, 3, 2)} and at(0.75) == {(1, 1, 1)}
    points = evaluate.curve(found, matches, truth)
    half = [(r.confidence, round(r.precision, 4), round(r.recall, 4), round(r.envelope, 4)) for r in points.filter("threshold = 0.5").orderBy("confidence", ascending=False).collect()]
    assert half == [(0.95, 0.0, 0.0, 0.5), (0.9, 0.5, 0.3333, 0.5), (0.8, 0.3333, 0.3333, 0.5), (0.7, 0.5, 0.6667, 0.5)]
    ap = {r.metric: r.value for r in evaluate.average_precision(points).collect()}
    assert abs(ap["map_50"] - 67 * 0.5 / 101) < 1e-9 and abs(ap["map_75"] - 34 * 0.5 / 101) < 1e-9
    assert abs(ap["mar_500"] - (5 * 2 / 3 + 5 / 3) / 10) < 1e-9
    best = evaluate.f1_sweep(points).first()
    assert (best.confidence, best.precision) == (0.7, 0.5) and abs(best.f1 - 2 * 0.5 * 2 / 3 / (0.5 + 2 / 3)) < 1e-9


def test_late_rows_are_marked_and_state_expires(spark, tmp_path):
    schema = "video_id long, tracker_id long, frame_number long, cx double, cy double"
    parts = [[(1, 1, f, 2.0 * f, 0.0) for f in range(10)], [(1, 1, 8, 0.0, 0.0), *((1, 1, f, 2.0 * f, 0.0) for f in range(10, 20))], [(1, 2, f, 1.0 * f, 0.0) for f in range(1000, 1010)], [(1, 2, f, 1.0 * f, 0.0) for f in range(2000, 2010)]]
    held = []
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = frames.append_to(frames.speed_stream(stream, 10.0, lateness="5 seconds"), str(tmp_path / "out"), str(tmp_path / "log"))
        query.awaitTermination()
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert [r.frame_number for r in got.filter("late").collect()] == [8] and got.filter("late and speed_px_s is not null").count() == 0
    assert got.filter("not late").count() == 40
    assert abs(got.filter("frame_number = 19").first().speed_px_s - 20) < 1e-6
    assert held[-1] == held[0]  # the first track's state is gone


def test_ids_of_a_track_that_takes_a_detection_unseen(spark, tmp_path):
    """The sixth box is taken by the track, whose own box follows it by less than half; then the track is away for the whole buffer."""
    from boxlake.plans import registry
    from tests.compare import canonical

    boxes = [(0, 19289, 695, 39.0), (1, 19709, 695, 39.0), (2, 21029, 695, 39.0), (3, 21449, 695, 39.0), (4, 21869, 695, 39.0), (5, 3032, 550, 4.0), (18, 3032, 550, 4.0)]
    lines = [(16 * f, part, supp, 1, quantity, 1.0, "N") for f, part, supp, quantity in boxes]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    spark.createDataFrame(lines, names).withColumn("l_shipdate", F.lit("1995-01-01").cast("timestamp")).write.parquet(str(tmp_path / "lineitem.parquet"))
    shown = registry.queries()["link_tracks"](spark, str(tmp_path)).orderBy("frame_number").select("tracker_id").collect()
    assert [x.tracker_id for x in shown] == [-1, -1, 1, 1, 1, -1, 1]
    got = canonical(registry.queries()["linked_ids"](spark, str(tmp_path)).toPandas())
    sql = registry.oracle_sql()["linked_ids"]
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    pd.testing.assert_frame_equal(got, canonical(con.sql(sql).df()))


def test_streamed_rows_are_made_once(spark):
    """A row that is made again for each range would be counted again."""
    from boxlake.plans import videos

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = spark.createDataFrame([(1, i, f, 0.5 * f, 1.0) for i in (1, 2) for f in range(30)], "video_id long, tracker_id long, frame_number long, cx double, cy double")
    counted = rows.mapInPandas(count, rows.schema)
    got = videos._streamed(counted, lambda x: x).toPandas().sort_values(["tracker_id", "frame_number"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, rows.toPandas())
    assert made.value == 2 * 60  # for the last frame, and to be written
