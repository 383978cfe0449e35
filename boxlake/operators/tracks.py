"""Tracks: linking, sessions, speeds, traces, status.

`fps` is a number, or the name of a column with the frame rate of the row's video (see `with_videos`). All but the linking is DataFrame code. Speeds
need constant work a row whatever the window, and no step but the sessions holds or streams a whole track in one task: velocities come from sums within
blocks as long as the window, smoothing from sums within blocks of 64 samples, numbers of tracks from ranges of frames.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxlake.functions.geometry import unit_name
from boxlake.operators.linking import Tracker

TRACK = ["video_id", "tracker_id"]
SPEED_WINDOW, STATIONARY = 0.5, 5.0
ALPHA, MIN_SAMPLES = 0.25, 4
#: Frames of a range in sums over a video or track; samples of a block in smoothing, and earlier blocks that still count (what lies before weighs less than 0.75^192, about 10^-24).
RANGE, SAMPLES, REACH = 4096, 64, 4
#: Rows up to which the table of videos is broadcast; partitions a core that videos are dealt to for linking.
FEW_VIDEOS, VIDEO_PARTS = 100_000, 8

Fps = float | str


def window_frames(speed_window: float, fps: float) -> int:
    if speed_window <= 0 or fps <= 0:
        raise ValueError("speed_window and fps must be greater than zero")
    return max(3, round(speed_window * fps))


def stale_frames(fps: float) -> int:
    return 5 * round(fps)


def _rate(fps: Fps) -> Column:
    if isinstance(fps, str):
        return F.col(fps)
    if fps <= 0:
        raise ValueError("fps must be greater than zero")
    return F.lit(float(fps))


def _width(speed_window: float, fps: Fps) -> Column:
    """window_frames() of each row; halves to even, as there."""
    if not isinstance(fps, str):
        return F.lit(window_frames(speed_window, fps))
    if speed_window <= 0:
        raise ValueError("speed_window must be greater than zero")
    return F.greatest(F.lit(3), F.bround(F.lit(float(speed_window)) * F.col(fps), 0)).cast("int")


def with_videos(rows: DataFrame, videos: DataFrame) -> DataFrame:
    """rows with fps and metres_per_pixel (null: not calibrated) of their video.

    videos: video_id, fps and, where known, the length of something in metres (known_m) and in pixels (measured_px), or metres_per_pixel itself. The table is broadcast up to FEW_VIDEOS
    rows. Rows of an unlisted video, and of one whose rate or calibration isn't positive, fail.
    """
    if "metres_per_pixel" not in videos.columns:
        known = F.col("known_m").isNotNull() | F.col("measured_px").isNotNull()
        scale = F.col("known_m") / F.when(F.col("measured_px") > 0, F.col("measured_px"))
        wrong = known & ~F.coalesce(scale > 0, F.lit(False))
    else:
        scale = F.col("metres_per_pixel")
        wrong = F.coalesce(scale <= 0, F.lit(False))
    wrong = wrong | ~F.coalesce(F.col("fps") > 0, F.lit(False))
    told = videos.select("video_id", F.col("fps").cast("double").alias("fps"), scale.cast("double").alias("metres_per_pixel"), wrong.alias("wrong_video"))
    told = F.broadcast(told) if videos.limit(FEW_VIDEOS + 1).count() <= FEW_VIDEOS else told
    bad = F.coalesce("wrong_video", F.lit(True))
    fail = F.raise_error(F.concat(F.lit("unusable video "), F.coalesce(F.col("video_id").cast("string"), F.lit("null")))).cast("double")
    return rows.join(told, "video_id", "left").withColumn("fps", F.when(bad, fail).otherwise(F.col("fps"))).drop("wrong_video")


def one_per_frame(rows: DataFrame) -> DataFrame:
    """One row per track and frame: the least det_no, where there is one."""
    keys = [*TRACK, "frame_number"]
    order = "det_no" if "det_no" in rows.columns else "cx"
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def track_sessions(rows: DataFrame, fps: Fps) -> DataFrame:
    """rows with session (0, 1, ...): a track that was unseen for stale + 2 frames or more starts anew."""
    stale = 5 * F.bround(_rate(fps), 0)
    w = W.partitionBy(*TRACK).orderBy("frame_number")
    new = (F.col("frame_number") - F.lag("frame_number").over(w)) >= stale + 2
    return rows.withColumn("_new", F.coalesce(new.cast("int"), F.lit(0))).withColumn("session", F.sum("_new").over(w)).drop("_new")


def trailing_velocity(rows: DataFrame, fps: Fps, speed_window: float = SPEED_WINDOW, stationary: float = STATIONARY) -> DataFrame:
    """rows (cx, cy, session) with raw_speed_px_s: least-squares slopes over the trailing frames; null below four samples, 0 below stationary.

    A session is cut into blocks of as many frames as the window has, so a window is the end of one block and the beginning of the next. Sums of t, t*t, x, tx, y, ty
    from a block's beginning are running sums; sums to its end come from running sums the other way, in which a window's first frame stands as a row without weight. All of
    them count time and place from the block's beginning and its first sample, so no long sums cancel.
    """
    if stationary < 0:
        raise ValueError("stationary cannot be negative")
    width, key = _width(speed_window, fps), [*TRACK, "session"]
    names = ["n", "t", "tt", "x", "tx", "y", "ty"]
    rows = rows.withColumn("_w", width).withColumn("_b", F.floor(F.col("frame_number") / F.col("_w")))
    block = W.partitionBy(*key, "_b").orderBy("frame_number")

    def sums(t: Column, w: W) -> list[Column]:
        x, y = F.col("cx") - F.col("_x0"), F.col("cy") - F.col("_y0")
        return [F.sum(v).over(w).alias(f"_{k}") for k, v in zip(names, [F.lit(1.0), t, t * t, x, t * x, y, t * y], strict=True)]

    origin = W.partitionBy(*key, "_b").orderBy("frame_number").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumns({"_x0": F.first("cx").over(origin), "_y0": F.first("cy").over(origin)})
    began = placed.select("*", *sums((F.col("frame_number") - F.col("_b") * F.col("_w")).cast("double"), block))
    # samples as the next block sees them, and the first frames of windows as places among them
    plain = ["cx", "cy", "_x0", "_y0", "_w", *(f"_{k}" for k in names)]
    payload = [c for c in began.columns if c not in [*key, "_b", *plain]]
    later = began.select(*key, "_b", "_x0", "_y0", "_w", F.col("frame_number").alias("_at"), F.lit(1.0).alias("_m"), *(F.lit(None).cast(began.schema[c].dataType).alias(c) for c in payload if c != "frame_number"), F.lit(None).cast("bigint").alias("frame_number"), "cx", "cy", *(F.lit(None).cast("double").alias(f"_{k}") for k in names))
    asked = began.select(*key, (F.col("_b") - 1).alias("_b"), "_x0", "_y0", "_w", (F.col("frame_number") - F.col("_w")).alias("_at"), F.lit(0.0).alias("_m"), *(F.col(c) for c in payload if c != "frame_number"), F.col("frame_number").cast("bigint").alias("frame_number"), "cx", "cy", *(f"_{k}" for k in names))
    both = later.unionByName(asked)
    back = W.partitionBy(*key, "_b").orderBy(F.desc("_at"), F.desc("_m"))
    t = (F.col("_at") - (F.col("_b") + 1) * F.col("_w")).cast("double")
    x, y, m = F.col("cx") - F.col("_x0"), F.col("cy") - F.col("_y0"), F.col("_m")
    ended = both.select("*", *(F.sum(F.when(m == 1, v).otherwise(0.0)).over(back).alias(f"_e{k}") for k, v in zip(names, [F.lit(1.0), t, t * t, x, t * x, y, t * y], strict=True)))
    # the other block's first sample differs: its sums are moved from its place to this one's
    ended = ended.withColumns({"_fx": F.max(F.when(m == 1, F.col("_x0"))).over(W.partitionBy(*key, "_b")), "_fy": F.max(F.when(m == 1, F.col("_y0"))).over(W.partitionBy(*key, "_b"))}).filter("_m = 0")
    dx, dy = F.coalesce(F.col("_fx") - F.col("_x0"), F.lit(0.0)), F.coalesce(F.col("_fy") - F.col("_y0"), F.lit(0.0))
    e = {k: F.col(f"_e{k}") for k in names}
    moved = e | {"x": e["x"] + dx * e["n"], "tx": e["tx"] + dx * e["t"], "y": e["y"] + dy * e["n"], "ty": e["ty"] + dy * e["t"]}
    s = {k: F.col(f"_{k}") + moved[k] for k in names}
    below = s["n"] * s["tt"] - s["t"] * s["t"]
    slope = lambda v: (s["n"] * s["t" + v] - s["t"] * s[v]) / F.when(below > 0, below) * _rate(fps)
    raw = F.when(s["n"] >= MIN_SAMPLES, F.hypot(slope("x"), slope("y")))
    out = ended.withColumn("raw_speed_px_s", raw).withColumn("raw_speed_px_s", F.when(F.col("raw_speed_px_s") < stationary, 0.0).otherwise(F.col("raw_speed_px_s")))
    return out.select(*[c for c in rows.columns if c not in ("_w", "_b")], "raw_speed_px_s")


def _numbered(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """rows with 0, 1, ... by frame_number within each key: ranges of frames are counted, and rows numbered within theirs."""
    rows = rows.withColumn("_r", F.floor(F.col("frame_number") / RANGE))
    before = W.partitionBy(*key).orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    first = rows.groupBy(*key, "_r").agg(F.count("*").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(W.partitionBy(*key, "_r").orderBy("frame_number"))
    return rows.withColumn("_i", inside).join(first, [*key, "_r"]).withColumn(name, F.col("_first") + F.col("_i") - 1).drop("_r", "_i", "_first")


def smoothed_speed(rows: DataFrame) -> DataFrame:
    """rows with speed_px_s: 0.25 of the raw speed and 0.75 of the last smoothed one; nulls stay null and don't count.

    Smoothing is a composition of affine maps. Samples of a session are numbered and cut into blocks of SAMPLES; within a block the smoothed values from nothing are
    a running sum of r / 0.75^j times 0.75^j, the end of a block adds 0.75^(64 d) of itself to the d-th block after it, and each row adds what comes in. Blocks are keys of their own.
    """
    key, keep = [*TRACK, "session"], F.lit(1 - ALPHA)
    known = _numbered(rows.filter("raw_speed_px_s is not null").select(*key, "frame_number", "raw_speed_px_s"), key, "_k")
    known = known.withColumns({"_blk": F.floor(F.col("_k") / SAMPLES), "_j": F.col("_k") % SAMPLES})
    share = F.when(F.col("_k") == 0, 1.0).otherwise(ALPHA)
    within = F.sum(share * F.col("raw_speed_px_s") / F.pow(keep, F.col("_j"))).over(W.partitionBy(*key, "_blk").orderBy("_j")) * F.pow(keep, F.col("_j"))
    known = known.withColumn("_y", within)
    ends = known.filter(F.col("_j") == SAMPLES - 1).select(*key, "_blk", "_y", F.explode(F.array(*(F.lit(d) for d in range(1, REACH + 1)))).alias("_d"))
    carried = ends.groupBy(*key, (F.col("_blk") + F.col("_d")).alias("_blk")).agg(F.sum(F.col("_y") * F.pow(keep, SAMPLES * (F.col("_d") - 1))).alias("_in"))
    done = known.join(carried, [*key, "_blk"], "left").select(*key, "frame_number", (F.col("_y") + F.coalesce("_in", F.lit(0.0)) * F.pow(keep, F.col("_j") + 1)).alias("speed_px_s"))
    return rows.join(done, [*key, "frame_number"], "left").select(*rows.columns, "speed_px_s")


def speeds(rows: DataFrame, fps: Fps, speed_window: float = SPEED_WINDOW, stationary: float = STATIONARY) -> DataFrame:
    """All steps: sessions, velocity, smoothing."""
    return smoothed_speed(trailing_velocity(track_sessions(one_per_frame(rows), fps), fps, speed_window, stationary))


def track_trace(rows: DataFrame, fps: float) -> DataFrame:
    """rows with trace: the centres of the last max(30, round(fps)) frames, oldest first."""
    length = max(30, round(fps))
    w = W.partitionBy(*TRACK).orderBy("frame_number").rangeBetween(-(length - 1), 0)
    return rows.withColumn("trace", F.sort_array(F.collect_list(F.struct("frame_number", "cx", "cy")).over(w)))


def running_unique_tracks(rows: DataFrame) -> DataFrame:
    """video_id, frame_number, active, unique_tracks: rows of the frame, and tracks seen so far (ids from 0 on).

    First appearances are summed by ranges of frames; only the ranges of a video, not its frames, meet in one task.
    """
    first = rows.filter("tracker_id >= 0").groupBy(*TRACK).agg(F.min("frame_number").alias("frame_number")).groupBy("video_id", "frame_number").agg(F.count("*").alias("new"))
    frames = rows.groupBy("video_id", "frame_number").agg(F.count("*").alias("active")).join(first, ["video_id", "frame_number"], "left")
    frames = frames.withColumns({"new": F.coalesce("new", F.lit(0)), "_r": F.floor(F.col("frame_number") / RANGE)})
    before = W.partitionBy("video_id").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    carried = first.groupBy("video_id", F.floor(F.col("frame_number") / RANGE).alias("_r")).agg(F.sum("new").alias("_n"))
    ranges = frames.select("video_id", "_r").distinct().join(carried, ["video_id", "_r"], "left").select("video_id", "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.sum("new").over(W.partitionBy("video_id", "_r").orderBy("frame_number"))
    return frames.withColumn("_i", inside).join(ranges, ["video_id", "_r"]).select("video_id", "frame_number", "active", (F.col("_i") + F.col("_before")).alias("unique_tracks"))


def frame_status(rows: DataFrame, metres_per_pixel: float | None = None) -> DataFrame:
    """Per frame: active and unique tracks and the unit of speeds. rows may have the scale of their video as metres_per_pixel."""
    out = running_unique_tracks(rows)
    if "metres_per_pixel" not in rows.columns:
        return out.withColumn("unit", unit_name(F.lit(metres_per_pixel).cast("double")))
    scales = rows.groupBy("video_id").agg(F.max("metres_per_pixel").alias("_s"))
    return out.join(scales, "video_id", "left").withColumn("unit", unit_name("_s")).drop("_s")


def video_summary(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Frames and distinct tracks per video."""
    ids = F.when(F.col("tracker_id") >= 0, F.col("tracker_id"))
    return rows.groupBy("video_id").agg(F.countDistinct("frame_number").alias("frames"), (F.approx_count_distinct(ids) if approximate else F.countDistinct(ids)).alias("tracks"))


def link_tracks(rows: DataFrame, fps: Fps = 30.0, held: bool = False, **settings) -> DataFrame:
    """rows (video_id, frame_number, det_no, x1, y1, x2, y2, confidence) with tracker_id, -1 where untracked.

    Sequential within a video, so a video is one task; its rows are streamed, and only its tracks and one frame are held. Rows without
    a video are left untracked, where they are. Videos are dealt to more partitions than there are cores, so that few share a task and none waits for a whole row of others.

    held: also held_id, the id of the track that took the detection. tracker_id is given anew from the tracks' boxes after a frame, as the reference's library does, so a track whose
    box follows a detection by less than half takes it and isn't shown there.
    """
    added = ["tracker_id", "held_id"] if held else ["tracker_id"]
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in added)])
    named = isinstance(fps, str)
    Tracker(30.0 if named else fps, **settings)  # wrong settings fail here

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        video, tracker, open_rows = None, None, None
        for x in batches:
            if open_rows is not None:
                x = pd.concat([open_rows, x], ignore_index=True)
            for v, part in x.groupby("video_id", sort=False):
                if v != video:
                    video, tracker = v, Tracker(float(part[fps].iloc[0]) if named else fps, **settings)
                if v == x.video_id.iloc[-1]:  # the last frame may go on in the next batch
                    open_ = part.frame_number == part.frame_number.iloc[-1]
                    open_rows, part = part[open_], part[~open_]
                if len(part):
                    yield tracker.run(part, held)
        if open_rows is not None and len(open_rows):
            yield tracker.run(open_rows, held)

    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), VIDEO_PARTS * spark.sparkContext.defaultParallelism)
    dealt = rows.filter("video_id is not null").repartition(parts, "video_id").sortWithinPartitions("video_id", "frame_number", "det_no")
    linked = dealt.mapInPandas(link, schema)
    return linked.unionByName(rows.filter("video_id is null").withColumns({c: F.lit(-1).cast("bigint") for c in added}))
