"""Streams of frames: speeds, status, suppression and linking with keyed state.

Frames of a key arrive in order between micro-batches; within one, rows are sorted. A row whose frame isn't after the last one seen
is late: it changes no state and comes out marked `late`, without results, so that late rows can be counted.

State is typed and kept in RocksDB, each piece under a name of its own: a micro-batch rewrites the pieces it changes. Without `lateness` state stays for good. With it (a delay such as
"10 minutes" of the frames' own time, which all keys must share), Spark's watermark drops what is older, and a timer frees the state of a key that its rows can no longer reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from boxlake.operators.detections import merge_full_and_slices
from boxlake.operators.linking import STATE_FIELDS, Tracker
from boxlake.operators.tracks import ALPHA, MIN_SAMPLES, SPEED_WINDOW, STATIONARY, stale_frames, window_frames

#: The time of frame 0 in seconds: a watermark begins at 0, and what isn't after it is dropped.
FIRST = 86_400
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed(rows: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str, lateness: str | None) -> DataFrame:
    """The processor over each key's rows; the session's state store must be RocksDB, which is set here."""
    rows.sparkSession.conf.set(_PROVIDER, _ROCKSDB)
    if lateness is not None:
        rows = rows.withColumn("frame_time", F.timestamp_seconds(F.col("frame_number") / processor.fps + FIRST)).withWatermark("frame_time", lateness)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "None" if lateness is None else "EventTime")


class _Frames(StatefulProcessor):
    """What the processors share: the key's last frame and timers on it."""

    def __init__(self, fps: float, timed: bool):
        self.fps, self.timed = fps, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = self.states(handle)

    def states(self, handle: StatefulProcessorHandle) -> list:
        raise NotImplementedError

    def expire_after(self, frame: float, timers) -> None:
        """Free the key's state once the watermark has passed the frame; an earlier timer is dropped."""
        if not self.timed:
            return
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(max(int((frame / self.fps + FIRST) * 1000) + 1, timers.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for piece in self.pieces:
            piece.clear()
        return iter([])

    def close(self) -> None:
        pass


def _rows(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat([b for b in batches if len(b)]).sort_values(order)


def _slope(t: np.ndarray, v: np.ndarray) -> float:
    d = t - t.mean()
    return float((d * (v - v.mean())).sum() / (d * d).sum())


class _Speeds(_Frames):
    """State of a track: the trailing window's samples as a list; its last frame and last smoothed speed."""

    def __init__(self, fps: float, timed: bool, width: int, stationary: float):
        super().__init__(fps, timed)
        self.width, self.stale, self.stationary = width, stale_frames(fps), stationary

    def states(self, handle: StatefulProcessorHandle) -> list:
        self.window = handle.getListState("window", "frame bigint, cx double, cy double")
        self.last = handle.getValueState("last", "frame bigint, speed double")
        return [self.window, self.last]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, smooth = self.last.get() if self.last.exists() else (None, None)
        history = list(self.window.get()) if last is not None else []
        out = []
        for f, x, y in _rows(rows, ["frame_number"])[["frame_number", "cx", "cy"]].itertuples(index=False):
            f = int(f)
            if last is not None and f <= last:
                out.append((*key, f, float(x), float(y), None, None, True))
                continue
            if last is not None and f - last >= self.stale + 2:
                smooth, history = None, []
            history = [h for h in history if f - h[0] <= self.width] + [(f, float(x), float(y))]
            last, raw = f, None
            if len(history) >= MIN_SAMPLES:
                t, xs, ys = np.array(history, float).T
                raw = float(np.hypot(_slope(t / self.fps, xs), _slope(t / self.fps, ys)))
                raw = 0.0 if raw < self.stationary else raw
                smooth = raw if smooth is None else ALPHA * raw + (1 - ALPHA) * smooth
            out.append((*key, f, float(x), float(y), raw, smooth if raw is not None else None, False))
        self.window.put(history)
        self.last.update((last, smooth))
        self.expire_after(last + self.stale + 2, timerValues)
        yield pd.DataFrame(out, columns=["video_id", "tracker_id", "frame_number", "cx", "cy", "raw_speed_px_s", "speed_px_s", "late"]).astype({"raw_speed_px_s": float, "speed_px_s": float})


def speed_stream(rows: DataFrame, fps: float, speed_window: float = SPEED_WINDOW, stationary: float = STATIONARY, lateness: str | None = None) -> DataFrame:
    """A stream of (video_id, tracker_id, frame_number, cx, cy) with raw_speed_px_s, speed_px_s and late.

    State per track: the trailing window's samples, the last frame and the last smoothed speed; all of it is dropped when
    the track was unseen for stale + 2 frames.
    """
    schema = "video_id bigint, tracker_id bigint, frame_number bigint, cx double, cy double, raw_speed_px_s double, speed_px_s double, late boolean"
    return _keyed(rows, ["video_id", "tracker_id"], _Speeds(fps, lateness is not None, window_frames(speed_window, fps), stationary), schema, lateness)


class _Status(_Frames):
    """State of a video: an entry for each id seen; their number and the last frame."""

    def __init__(self, fps: float, timed: bool, unit: str, idle: int):
        super().__init__(fps, timed)
        self.unit, self.idle = unit, idle

    def states(self, handle: StatefulProcessorHandle) -> list:
        self.ids = handle.getMapState("ids", "id bigint", "frame bigint")
        self.last = handle.getValueState("last", "frame bigint, tracks bigint")
        return [self.ids, self.last]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, count = self.last.get() if self.last.exists() else (None, 0)
        out, asked = [], set()  # ids looked up in this micro-batch
        for f, ids in _rows(rows, ["frame_number"]).groupby("frame_number").tracker_id:
            late = last is not None and f <= last
            if self.timed and not late and last is not None and f - last > self.idle:  # whether or not the timer has gone off
                self.ids.clear()
                count, asked = 0, set()
            if not late:
                last = int(f)
                for i in {int(i) for i in ids if i >= 0} - asked:
                    asked.add(i)
                    if not self.ids.containsKey((i,)):
                        self.ids.updateValue((i,), (last,))
                        count += 1
            out.append((key[0], int(f), len(ids), count, self.unit, late))
        self.last.update((last, count))
        self.expire_after(last + self.idle, timerValues)
        yield pd.DataFrame(out, columns=["video_id", "frame_number", "active", "unique_tracks", "unit", "late"])


def frame_status_stream(rows: DataFrame, metres_per_pixel: float | None = None, fps: float = 30.0, lateness: str | None = None, idle: int | None = None) -> DataFrame:
    """A stream of tracks as (video_id, frame_number, active, unique_tracks, unit, late); state per video: the ids seen, an entry each.

    A frame's rows arrive in one micro-batch; those that come later are a late row of their own, and their ids don't count. With lateness a video that misses
    more than `idle` frames (as long as a session by default) has ended: its ids are freed, and frames after that are counted anew.
    """
    unit = "PX/S" if metres_per_pixel is None else f"KM/H @ {metres_per_pixel:.4f} M/PX"
    schema = "video_id bigint, frame_number bigint, active bigint, unique_tracks bigint, unit string, late boolean"
    return _keyed(rows, ["video_id"], _Status(fps, lateness is not None, unit, stale_frames(fps) if idle is None else idle), schema, lateness)


class _Links(_Frames):
    """State of a video: a row for each of its tracks; the next id, the last frame and the first."""

    NAMES = ["video_id", "frame_number", "det_no", "x1", "y1", "x2", "y2", "confidence", "tracker_id", "late"]

    def __init__(self, fps: float, timed: bool, settings: dict):
        super().__init__(fps, timed)
        self.settings = settings

    def states(self, handle: StatefulProcessorHandle) -> list:
        self.tracks = handle.getListState("tracks", ", ".join(STATE_FIELDS))
        self.numbers = handle.getValueState("numbers", "next_id bigint, frame bigint, first bigint")
        return [self.tracks, self.numbers]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tracker = Tracker(self.fps, **self.settings)
        if self.numbers.exists():
            tracker.load(tuple(self.numbers.get()), [tuple(x) for x in self.tracks.get()])
        got = _rows(rows, ["frame_number", "det_no"])
        before = tracker.frame
        late = got[got.frame_number <= before] if before is not None else got.iloc[:0]
        found = tracker.run(got).assign(late=False)
        numbers, tracks = tracker.state()
        self.numbers.update(numbers)
        self.tracks.put(tracks) if tracks else self.tracks.clear()
        self.expire_after(tracker.frame + tracker.buffer + 1, timerValues)
        yield pd.concat([found, late.assign(tracker_id=-1, late=True)])[self.NAMES] if len(late) else found[self.NAMES]


def link_tracks_stream(rows: DataFrame, fps: float = 30.0, lateness: str | None = None, **settings) -> DataFrame:
    """A stream of detections with tracker_id and late; state per video: its tracks. A video's state can go once no track of it can go on."""
    Tracker(fps, **settings)  # wrong settings fail here
    schema = "video_id bigint, frame_number bigint, det_no bigint, x1 double, y1 double, x2 double, y2 double, confidence double, tracker_id bigint, late boolean"
    return _keyed(rows, ["video_id"], _Links(fps, lateness is not None, settings), schema, lateness)


def nms_stream(rows: DataFrame, path: str, checkpoint: str, mode: str = "both") -> StreamingQuery:
    """Suppress each micro-batch (a frame arrives whole in one) and append it to a Parquet table, one folder per batch."""

    def one(batch: DataFrame, n: int) -> None:
        merge_full_and_slices(batch, mode).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a stream over what is available and append it to a Parquet table."""
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
