"""Queries of detections, tracks, speeds, evaluation and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.functions.geometry import box_center, format_speed_label
from boxlake.operators import detections as det
from boxlake.operators import evaluate, tracks
from boxlake.operators.linking import Tracker
from boxlake.plans.fixtures import ctes, frame
from boxlake.scratch import discard, scratch_dir, stored
from boxlake.sources.labels import check_videos, read_detections
from boxlake.streaming import frames

FPS, WINDOW, SCALE = 12.0, 5.0, 0.038
_DET = ["video_id", "frame_number", "det_no", "x1", "y1", "x2", "y2", "confidence", "origin"]


def _detections(s, d):
    return frame(s, d, "fx_detections").select(*_DET)


def detections_in_range(s, d):
    """S7, P18."""
    return det.confidence_filter(read_detections(_detections(s, d), 20, 400))


_RANGE = ctes("fx_detections") + "SELECT " + ", ".join(_DET) + " FROM fx_detections WHERE frame_number >= 20 AND frame_number < 420 AND confidence >= 0.15e0"


def slice_grid(s, d):
    """Tiles of every picture, and a box of each tile in frame coordinates."""
    sizes = frame(s, d, "fx_images").select("image_id", "width", "height")
    tiles = det.slice_grid(sizes, 640, 160)
    local = tiles.select("image_id", "tile_x", "tile_y", F.lit(1.0).alias("x1"), F.lit(2.0).alias("y1"), (F.col("tile_width") - 1.0).alias("x2"), (F.col("tile_height") - 2.0).alias("y2"))
    return det.slice_to_frame(local)


_GRID = ctes("fx_images") + """, gx AS (SELECT image_id, width, height, unnest(list_append(list_filter(range(0, greatest(width - 640, 0) + 1, 480), lambda v: v < greatest(width - 640, 0)), greatest(width - 640, 0))) AS tx FROM fx_images),
gy AS (SELECT *, unnest(list_append(list_filter(range(0, greatest(height - 640, 0) + 1, 480), lambda v: v < greatest(height - 640, 0)), greatest(height - 640, 0))) AS ty FROM gx)
SELECT image_id, tx + 1.0e0 AS x1, ty + 2.0e0 AS y1, tx + least(640, width) - 1.0e0 AS x2, ty + least(640, height) - 2.0e0 AS y2 FROM gy"""


def iou_pairs(s, d):
    """J12."""
    return det.iou_pairs(_detections(s, d)).withColumn("iou", F.round("iou", 6))


_IOU = "greatest(0e0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0e0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
_OVER = "(" + _IOU + ") / (({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) + ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1) - " + _IOU + ")"
_PAIRS = ctes("fx_detections") + f"SELECT a.video_id, a.frame_number, a.det_no AS a_det_no, b.det_no AS b_det_no, round({_OVER.format(a='a', b='b')}, 6) AS iou FROM fx_detections a JOIN fx_detections b ON a.video_id = b.video_id AND a.frame_number = b.frame_number AND a.det_no < b.det_no WHERE {_OVER.format(a='a', b='b')} > 0.5e0"


def nms_merge(s, d):
    """U3, N1."""
    return det.merge_full_and_slices(_detections(s, d)).select("video_id", "frame_number", "det_no")


def _nms(name: str, rows: str) -> str:
    """A fold over each frame's boxes in order."""
    box = "{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'd': det_no}"
    over = "(greatest(0e0, least(q.x2, {r}.x2) - greatest(q.x1, {r}.x1)) * greatest(0e0, least(q.y2, {r}.y2) - greatest(q.y1, {r}.y1)))".format(r="bx[k + 1]")
    share = f"{over} / ((q.x2 - q.x1) * (q.y2 - q.y1) + (bx[k + 1].x2 - bx[k + 1].x1) * (bx[k + 1].y2 - bx[k + 1].y1) - {over})"
    return f""", {name}_l AS (SELECT video_id, frame_number, list({box} ORDER BY confidence DESC, det_no) AS bx FROM {rows} GROUP BY ALL),
{name}_r AS (SELECT video_id, frame_number, bx, 0 AS k, bx[1:0] AS kept FROM {name}_l UNION ALL
  SELECT video_id, frame_number, bx, k + 1, CASE WHEN len(list_filter(kept, lambda q: {share} > 0.5e0)) > 0 THEN kept ELSE list_append(kept, bx[k + 1]) END FROM {name}_r WHERE k < len(bx)),
{name} AS (SELECT video_id, frame_number, unnest(kept).d AS det_no FROM {name}_r WHERE k = len(bx))"""


_NMS = ctes("fx_detections") + _nms("sl", "(SELECT * FROM fx_detections WHERE origin = 'slice') z") + ", bo AS (SELECT * FROM fx_detections WHERE origin = 'full' UNION ALL SELECT f.* FROM fx_detections f JOIN sl USING (video_id, frame_number, det_no) WHERE origin = 'slice')" + _nms("al", "bo") + " SELECT video_id, frame_number, det_no FROM al"


def _links(s, d, held: bool = False):
    return tracks.link_tracks(det.confidence_filter(_detections(s, d).drop("origin")), FPS, held)


def link_tracks(s, d):
    """T1, with P15."""
    rows = _links(s, d).withColumn("c", box_center("x1", "y1", "x2", "y2"))
    return rows.select("video_id", "frame_number", "det_no", "tracker_id", "c.cx", "c.cy")


def box_centers(s, d):
    """P15."""
    return _detections(s, d).withColumn("c", box_center("x1", "y1", "x2", "y2")).select("video_id", "frame_number", "det_no", "c.cx", "c.cy")


_CENTERS = ctes("fx_detections") + "SELECT video_id, frame_number, det_no, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy FROM fx_detections"


def _tracks(s, d):
    return frame(s, d, "fx_tracks")


_T = ctes("fx_tracks") + """, se AS (SELECT *, sum(nw) OVER (PARTITION BY video_id, tracker_id ORDER BY frame_number) AS session FROM (SELECT *, CASE WHEN frame_number - lag(frame_number) OVER (PARTITION BY video_id, tracker_id ORDER BY frame_number) >= 62 THEN 1 ELSE 0 END AS nw FROM fx_tracks)),
ve AS (SELECT *, CASE WHEN n >= 4 THEN sqrt(vx * vx + vy * vy) END AS v FROM (SELECT *, regr_slope(cx, frame_number / 12e0) OVER w AS vx, regr_slope(cy, frame_number / 12e0) OVER w AS vy, count(*) OVER w AS n FROM se WINDOW w AS (PARTITION BY video_id, tracker_id, session ORDER BY frame_number RANGE BETWEEN 60 PRECEDING AND CURRENT ROW))),
rw AS (SELECT *, CASE WHEN v < 5 THEN 0 ELSE v END AS raw FROM ve),
sm AS (SELECT *, CASE WHEN raw IS NOT NULL THEN list_reduce(list(raw) FILTER (raw IS NOT NULL) OVER (PARTITION BY video_id, tracker_id, session ORDER BY frame_number), lambda a, b: 0.25e0 * b + 0.75e0 * a) END AS speed FROM rw)"""
_K = "video_id, tracker_id, frame_number"


def track_sessions(s, d):
    """W7."""
    return tracks.track_sessions(tracks.one_per_frame(_tracks(s, d)), FPS).select("video_id", "tracker_id", "frame_number", "session")


_SESSIONS = _T + f"SELECT {_K}, CAST(session AS BIGINT) AS session FROM se"


def trailing_velocity(s, d):
    """W4, W5, F13."""
    rows = tracks.trailing_velocity(tracks.track_sessions(_tracks(s, d), FPS), FPS, WINDOW)
    return rows.select("video_id", "tracker_id", "frame_number", F.round("raw_speed_px_s", 5).alias("raw_speed_px_s"))


_VELOCITY = _T + f"SELECT {_K}, round(raw, 5) AS raw_speed_px_s FROM rw"


def smoothed_speed(s, d):
    """W8 over W7, W4, W5."""
    return tracks.speeds(_tracks(s, d), FPS, WINDOW).select("video_id", "tracker_id", "frame_number", F.round("speed_px_s", 5).alias("speed_px_s"))


_SMOOTHED = _T + f"SELECT {_K}, round(speed, 5) AS speed_px_s FROM sm"


def speed_labels(s, d):
    """P16, P17; calibrated videos are those with even numbers."""
    rows = tracks.speeds(_tracks(s, d), FPS, WINDOW)
    label = F.when(F.col("video_id") % 2 == 0, format_speed_label("tracker_id", "speed_px_s", F.lit(SCALE))).otherwise(format_speed_label("tracker_id", "speed_px_s"))
    return rows.select("video_id", "tracker_id", "frame_number", label.alias("label"))


_LABELS = _T + f"SELECT {_K}, '#' || tracker_id || ' | ' || CASE WHEN video_id % 2 = 0 THEN CASE WHEN speed IS NULL THEN '-- km/h' ELSE printf('%.1f km/h', speed * 0.038e0 * 3.6e0) END WHEN speed IS NULL THEN '-- px/s' ELSE printf('%.0f px/s', speed) END AS label FROM sm"


def video_speeds(s, d):
    """Speeds of videos with frame rates and scales of their own."""
    rows = tracks.with_videos(_tracks(s, d), check_videos(frame(s, d, "fx_videos").withColumns({"width": F.lit(1), "height": F.lit(1), "frames": F.lit(1)})))
    found = tracks.speeds(rows, "fps", 2.0)
    status = tracks.frame_status(rows).select("video_id", "frame_number", "unit")
    label = format_speed_label("tracker_id", "speed_px_s", F.col("metres_per_pixel")).alias("label")
    return found.join(status, ["video_id", "frame_number"]).select("video_id", "tracker_id", "frame_number", "session", F.round("raw_speed_px_s", 5).alias("raw_speed_px_s"), F.round("speed_px_s", 5).alias("speed_px_s"), label, "unit")


_VIDEO_SPEEDS = ctes("fx_tracks", "fx_videos") + f""", tv AS (SELECT t.*, fps, known_m / measured_px AS scale, CASE fps WHEN 10e0 THEN 20 WHEN 25e0 THEN 50 ELSE 100 END AS w, 5 * CAST(fps AS BIGINT) AS stale FROM fx_tracks t JOIN fx_videos USING (video_id)),
se AS (SELECT *, sum(nw) OVER (PARTITION BY video_id, tracker_id ORDER BY frame_number) AS session FROM (SELECT *, CASE WHEN frame_number - lag(frame_number) OVER (PARTITION BY video_id, tracker_id ORDER BY frame_number) >= stale + 2 THEN 1 ELSE 0 END AS nw FROM tv)),
ve AS (SELECT *, CASE WHEN n >= 4 THEN sqrt(vx * vx + vy * vy) END AS v FROM (SELECT *, regr_slope(cx, frame_number / fps) OVER w AS vx, regr_slope(cy, frame_number / fps) OVER w AS vy, count(*) OVER w AS n FROM se WINDOW w AS (PARTITION BY video_id, tracker_id, session ORDER BY frame_number RANGE BETWEEN w PRECEDING AND CURRENT ROW))),
rw AS (SELECT *, CASE WHEN v < 5 THEN 0 ELSE v END AS raw FROM ve),
sm AS (SELECT *, CASE WHEN raw IS NOT NULL THEN list_reduce(list(raw) FILTER (raw IS NOT NULL) OVER (PARTITION BY video_id, tracker_id, session ORDER BY frame_number), lambda a, b: 0.25e0 * b + 0.75e0 * a) END AS speed FROM rw)
SELECT {_K}, CAST(session AS BIGINT) AS session, round(raw, 5) AS raw_speed_px_s, round(speed, 5) AS speed_px_s,
  '#' || tracker_id || ' | ' || CASE WHEN scale IS NOT NULL THEN CASE WHEN speed IS NULL THEN '-- km/h' ELSE printf('%.1f km/h', speed * scale * 3.6e0) END WHEN speed IS NULL THEN '-- px/s' ELSE printf('%.0f px/s', speed) END AS label,
  CASE WHEN scale IS NULL THEN 'PX/S' ELSE printf('KM/H @ %.4f M/PX', scale) END AS unit FROM sm"""


def linked_ids(s, d):
    """T1, by what holds of any linking: ids of a video are 1, 2, ... without gaps, none stands twice in a frame, none lives on beyond the buffer.

    A track lives on with the detections it takes, whether or not it is shown on them: an id's frames are those of both columns.
    """
    rows = _links(s, d, held=True).select("video_id", "frame_number", "tracker_id", "held_id")
    ids = rows.withColumn("id", F.explode(F.array_distinct(F.array("tracker_id", "held_id")))).filter("id > 0").repartition("video_id", "id")
    frames_ = ids.groupBy("video_id", "id", "frame_number").agg(F.count_if(F.col("tracker_id") == F.col("id")).alias("shown"), F.count_if(F.col("held_id") == F.col("id")).alias("held"))
    last = W.partitionBy("video_id", "id").orderBy("frame_number")
    steps = frames_.withColumn("gap", F.col("frame_number") - F.lag("frame_number").over(last))
    lives = steps.groupBy("video_id", "id").agg(F.max("shown").alias("shown"), F.max("held").alias("held"), F.max("gap").alias("gap"))
    each = lives.groupBy("video_id").agg(
        (F.max("id") == F.count("*")).alias("dense"),
        ((F.max("shown") <= 1) & (F.max("held") <= 1)).alias("single"),
        (F.coalesce(F.max("gap"), F.lit(0)) <= Tracker(FPS).buffer + 1).alias("within_buffer"),
    )
    return _detections(s, d).select("video_id").distinct().join(each, "video_id", "left").select("video_id", *(F.coalesce(c, F.lit(True)).alias(c) for c in ("dense", "single", "within_buffer")))


_LINKED = ctes("fx_detections") + "SELECT DISTINCT video_id, true AS dense, true AS single, true AS within_buffer FROM fx_detections"


def track_trace(s, d):
    """W9, as the number of points, the oldest frame and the sum of the centres."""
    rows = tracks.track_trace(_tracks(s, d), FPS)
    total = F.aggregate("trace", F.lit(0.0), lambda a, p: a + p["cx"] + p["cy"])
    return rows.select("video_id", "tracker_id", "frame_number", F.size("trace").alias("points"), F.col("trace")[0]["frame_number"].alias("oldest"), F.round(total, 4).alias("total"))


_TRACE = ctes("fx_tracks") + f"SELECT {_K}, count(*) OVER w AS points, min(frame_number) OVER w AS oldest, round(sum(cx + cy) OVER w, 4) AS total FROM fx_tracks WINDOW w AS (PARTITION BY video_id, tracker_id ORDER BY frame_number RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)"


def frame_status(s, d):
    """A13, W6."""
    return tracks.frame_status(_tracks(s, d))


_STATUS = ctes("fx_tracks") + """, fr AS (SELECT video_id, frame_number, count(*) AS active FROM fx_tracks GROUP BY ALL), fi AS (SELECT video_id, tracker_id, min(frame_number) AS f FROM fx_tracks WHERE tracker_id >= 0 GROUP BY ALL)
SELECT video_id, frame_number, active, (SELECT count(*) FROM fi WHERE fi.video_id = fr.video_id AND f <= frame_number) AS unique_tracks, 'PX/S' AS unit FROM fr"""


def video_summary(s, d):
    """A14."""
    return tracks.video_summary(_tracks(s, d))


_SUMMARY = ctes("fx_tracks") + "SELECT video_id, count(DISTINCT frame_number) AS frames, count(DISTINCT tracker_id) AS tracks FROM fx_tracks GROUP BY video_id"


#: Micro-batches that a registered stream is cut into by its frames, so that state is carried between them.
STREAM_BATCHES = 3


def _streamed(rows: DataFrame, how) -> DataFrame:
    """rows written to the shared folder in ranges of frames, streamed through how() a range at a time and read again. The rows are made once, and dealt to their ranges as they are written."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession)
    top = rows.agg(F.max("frame_number")).first()[0] or 0
    ends = [(top + 1) * k // STREAM_BATCHES for k in range(1, STREAM_BATCHES)]
    batch = sum(((F.col("frame_number") >= e).cast("int") for e in ends), F.lit(0))
    made = stored(rows.withColumn("_batch", batch), f"{path}/made", by=("_batch",))
    for k in range(STREAM_BATCHES):
        made.filter(F.col("_batch") == k).select(*rows.columns).write.mode("append").parquet(f"{path}/in")
        out = how(spark.readStream.schema(rows.schema).parquet(f"{path}/in"))
        frames.append_to(out, f"{path}/out", f"{path}/log").awaitTermination()  # what is new since the last range
    discard(spark, [f"{path}/made"])
    return spark.read.schema(out.schema).parquet(f"{path}/out")


def speed_stream(s, d):
    """R1, R2, R3, under a watermark that frees the state of tracks that have ended."""
    rows = _tracks(s, d).select("video_id", "tracker_id", "frame_number", "cx", "cy")
    return _streamed(rows, lambda x: frames.speed_stream(x, FPS, WINDOW, lateness="10 seconds")).select("video_id", "tracker_id", "frame_number", F.round("speed_px_s", 5).alias("speed_px_s"))


def frame_status_stream(s, d):
    """R5."""
    rows = _tracks(s, d).select("video_id", "tracker_id", "frame_number")
    return _streamed(rows, lambda x: frames.frame_status_stream(x, fps=FPS, lateness="10 seconds", idle=100_000)).drop("late")


def nms_stream(s, d):
    """R6."""
    rows, path = _detections(s, d), scratch_dir(s)
    rows.write.parquet(f"{path}/in")
    stream = s.readStream.schema(rows.schema).parquet(f"{path}/in")
    frames.nms_stream(stream, f"{path}/out", f"{path}/log").awaitTermination()
    return s.read.parquet(f"{path}/out").select("video_id", "frame_number", "det_no")


def link_tracks_stream(s, d):
    """R4."""
    rows = det.confidence_filter(_detections(s, d)).select(*_DET[:-1])
    return _streamed(rows, lambda x: frames.link_tracks_stream(x, FPS)).select("video_id", "frame_number", "det_no", "tracker_id")


def _evaluated(s, d):
    found, truth = frame(s, d, "fx_found"), frame(s, d, "fx_truth")
    return found, truth, evaluate.match_detections(found, truth)


def match_detections(s, d):
    """E1."""
    return _evaluated(s, d)[2]


def _match() -> str:
    over = _OVER.format(a="f", b="t")
    return ctes("fx_found", "fx_truth") + f""", od AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, det_no) AS rank FROM fx_found),
pa AS (SELECT f.image_id, f.det_no, t.truth_no, f.rank, {over} AS iou FROM od f JOIN fx_truth t ON f.image_id = t.image_id WHERE rank <= 500 AND {over} >= 0.5e0),
pl AS (SELECT image_id, threshold, list({{'d': det_no, 't': truth_no, 'i': iou}} ORDER BY rank, -iou, truth_no) AS p FROM pa CROSS JOIN (SELECT unnest([0.5e0, 0.55e0, 0.6e0, 0.65e0, 0.7e0, 0.75e0, 0.8e0, 0.85e0, 0.9e0, 0.95e0]) AS threshold) th GROUP BY ALL),
pf AS (SELECT image_id, threshold, p, 0 AS k, p[1:0] AS kept FROM pl UNION ALL
  SELECT image_id, threshold, p, k + 1, CASE WHEN p[k + 1].i < threshold OR len(list_filter(kept, lambda q: q.d = p[k + 1].d OR q.t = p[k + 1].t)) > 0 THEN kept ELSE list_append(kept, p[k + 1]) END FROM pf WHERE k < len(p)),
ma AS (SELECT threshold, image_id, unnest(kept).d AS det_no, unnest(kept).t AS truth_no FROM pf WHERE k = len(p))"""


_MATCH = _match() + " SELECT * FROM ma"
_CURVE = """, co AS (SELECT round(confidence, 6) AS confidence, count(*) AS n FROM od WHERE rank <= 500 GROUP BY 1), th AS (SELECT DISTINCT threshold FROM pl),
hi AS (SELECT threshold, round(confidence, 6) AS confidence, count(*) AS tp FROM od JOIN ma USING (image_id, det_no) GROUP BY ALL),
cu AS (SELECT threshold, confidence, tps / CAST(ns AS DOUBLE) AS precision, tps / CAST((SELECT count(*) FROM fx_truth) AS DOUBLE) AS recall FROM (
  SELECT threshold, confidence, sum(coalesce(tp, 0)) OVER w AS tps, sum(n) OVER w AS ns FROM th CROSS JOIN co LEFT JOIN hi USING (threshold, confidence) WINDOW w AS (PARTITION BY threshold ORDER BY confidence DESC)))"""


def average_precision(s, d):
    """E2."""
    found, truth, matches = _evaluated(s, d)
    return evaluate.average_precision(evaluate.curve(found, matches, truth)).withColumn("value", F.round("value", 6))


_AP = _match() + _CURVE + """, ap AS (SELECT threshold, avg(p) AS ap FROM (SELECT threshold, r, coalesce((SELECT max(precision) FROM cu WHERE cu.threshold = th.threshold AND recall >= r / 100e0 - 1e-11), 0) AS p FROM th CROSS JOIN (SELECT unnest(range(0, 101)) AS r)) GROUP BY 1),
ar AS (SELECT avg(m) AS v FROM (SELECT max(recall) AS m FROM cu GROUP BY threshold))
SELECT 'map_50_95' AS metric, round(avg(ap), 6) AS value FROM ap UNION ALL SELECT 'map_50', round(ap, 6) FROM ap WHERE threshold = 0.5e0 UNION ALL SELECT 'map_75', round(ap, 6) FROM ap WHERE threshold = 0.75e0 UNION ALL SELECT 'mar_500', round(v, 6) FROM ar"""


def f1_sweep(s, d):
    """E3."""
    found, truth, matches = _evaluated(s, d)
    best = evaluate.f1_sweep(evaluate.curve(found, matches, truth))
    return best.select("confidence", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


_F1 = _match() + _CURVE + " SELECT confidence, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f, 6) AS f1 FROM (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f FROM cu WHERE threshold = 0.5e0) ORDER BY f DESC, confidence DESC LIMIT 1"

QUERIES = {
    "detections_in_range": (detections_in_range, _RANGE),
    "slice_grid": (slice_grid, _GRID),
    "iou_pairs": (iou_pairs, _PAIRS),
    "nms_merge": (nms_merge, _NMS),
    "box_centers": (box_centers, _CENTERS),
    "link_tracks": (link_tracks, None),
    "track_sessions": (track_sessions, _SESSIONS),
    "trailing_velocity": (trailing_velocity, _VELOCITY),
    "smoothed_speed": (smoothed_speed, _SMOOTHED),
    "speed_labels": (speed_labels, _LABELS),
    "video_speeds": (video_speeds, _VIDEO_SPEEDS),
    "linked_ids": (linked_ids, _LINKED),
    "track_trace": (track_trace, _TRACE),
    "frame_status": (frame_status, _STATUS),
    "video_summary": (video_summary, _SUMMARY),
    "speed_stream": (speed_stream, _SMOOTHED),
    "frame_status_stream": (frame_status_stream, _STATUS),
    "nms_stream": (nms_stream, _NMS),
    "link_tracks_stream": (link_tracks_stream, None),
    "match_detections": (match_detections, _MATCH),
    "average_precision": (average_precision, _AP),
    "f1_sweep": (f1_sweep, _F1),
}
