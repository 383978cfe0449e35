"""Linking one video's detections to tracks, frame by frame (the ByteTrack paper, arXiv 2110.06864).

A track's box moves by a Kalman filter over centre, aspect and height with constant velocities. All noises are independent by coordinate, so the
8 x 8 covariance falls into a 2 x 2 block (position, velocity) for each coordinate, and a frame's tracks are predicted and updated as arrays.

Matches are optimal assignments, not greedy ones: confident detections to confirmed and lost tracks by overlap times confidence; weaker detections to tracked ones that
are still free, by overlap; what is left of the confident ones to unconfirmed tracks, which go if they find none, and then to new tracks. Of a tracked and a lost track that
lie on one another the one with the shorter life goes.

Most frames have few boxes and few tracks, for which a call of an array function costs more than its sums: such frames go by plain numbers, others by arrays. Both take the same
operations in the same order, so a track's numbers are equal bit by bit whichever way its frames went.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

ACTIVATION, LOST_FRAMES, MATCH, CONSECUTIVE = 0.50, 30, 0.80, 2
#: Fixed values of the paper's implementation: least overlap costs of the second and the unconfirmed stage, least confidence of weak detections, margin of new tracks, overlap cost of doubles.
SECOND_MATCH, UNCONFIRMED_MATCH, LEAST, NEW_MARGIN, DOUBLE = 0.5, 0.7, 0.1, 0.1, 0.15
#: Standard deviations: of centre and height in heights, of the aspect as such.
POSITION, VELOCITY, ASPECT, ASPECT_VELOCITY, ASPECT_MEASURED = 1 / 20, 1 / 160, 1e-2, 1e-5, 1e-1

#: x, v: position and velocity of (centre x, centre y, aspect, height); pp, pv, vv: their covariances; id: 0 before the track is told; run: updates in a row;
#: seen, born: frames of the last and first detection; sure: confirmed.
TRACK = np.dtype([(k, "f8", 4) for k in ("x", "v", "pp", "pv", "vv")] + [(k, "i8") for k in ("id", "run", "seen", "born")] + [(k, "?") for k in ("sure", "lost")])
#: A track as a row of plain numbers: the first places of its fields, in the order of STATE_FIELDS.
X, V, PP, PV, VV, ID, RUN, SEEN, BORN, SURE, LOST = 0, 4, 8, 12, 16, 20, 21, 22, 23, 24, 25
#: Boxes and tracks of a frame up to which it goes by plain numbers, cells of a part of an assignment up to which that does, and the coordinates (in pixels) that plain numbers are used for.
FEW, FEW_CELLS, PLAIN = 24, 256, 1e100


def _noise(height: np.ndarray, weight: float, aspect: float) -> np.ndarray:
    """Variances of the four coordinates."""
    s = np.repeat(weight * height[:, None], 4, axis=1)
    s[:, 2] = aspect
    return s * s


def predict(t: np.ndarray) -> np.ndarray:
    """The tracks one frame later."""
    t = t.copy()
    h = t["x"][:, 3]
    q, r = _noise(h, POSITION, ASPECT), _noise(h, VELOCITY, ASPECT_VELOCITY)
    t["x"] += t["v"]
    t["pp"] += 2 * t["pv"] + t["vv"] + q
    t["pv"] += t["vv"]
    t["vv"] += r
    return t


def update(t: np.ndarray, measured: np.ndarray) -> np.ndarray:
    """The tracks after measurements (centre x, centre y, aspect, height)."""
    t = t.copy()
    s = t["pp"] + _noise(t["x"][:, 3], POSITION, ASPECT_MEASURED)
    a, b, off = t["pp"] / s, t["pv"] / s, measured - t["x"]
    t["x"] += a * off
    t["v"] += b * off
    t["vv"] -= b * t["pv"]
    t["pp"] -= a * t["pp"]
    t["pv"] -= a * t["pv"]
    return t


def initiate(measured: np.ndarray, frame: int) -> np.ndarray:
    t = np.zeros(len(measured), TRACK)
    h = measured[:, 3]
    t["x"], t["pp"], t["vv"] = measured, _noise(h, 2 * POSITION, ASPECT), _noise(h, 10 * VELOCITY, ASPECT_VELOCITY)
    t["seen"] = t["born"] = frame
    return t


def measurements(boxes: np.ndarray) -> np.ndarray:
    w, h = boxes[:, 2] - boxes[:, 0], np.maximum(boxes[:, 3] - boxes[:, 1], 1e-6)
    return np.column_stack([boxes[:, 0] + w / 2, boxes[:, 1] + h / 2, w / h, h])


def corners(x: np.ndarray) -> np.ndarray:
    w = x[:, 2] * x[:, 3]
    return np.column_stack([x[:, 0] - w / 2, x[:, 1] - x[:, 3] / 2, x[:, 0] + w / 2, x[:, 1] + x[:, 3] / 2])


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0])
    h = np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1])
    both = np.maximum(w, 0) * np.maximum(h, 0)
    size = lambda r: (r[:, 2] - r[:, 0]) * (r[:, 3] - r[:, 1])
    return both / np.maximum(size(a)[:, None] + size(b)[None, :] - both, 1e-9)


def rows_of(t: np.ndarray) -> list[list]:
    """Tracks as rows of plain numbers."""
    return [[*x, *v, *pp, *pv, *vv, *rest] for x, v, pp, pv, vv, *rest in zip(*(t[k].tolist() for k in TRACK.names), strict=True)]


def array_of(rows: list) -> np.ndarray:
    return np.array([tuple(r[k : k + 4] for k in range(0, 20, 4)) + tuple(r[20:]) for r in rows], TRACK) if len(rows) else np.zeros(0, TRACK)


def _predict_row(r: list) -> None:
    """predict() of one track, in place."""
    q, w = POSITION * r[3], VELOCITY * r[3]
    q, w = q * q, w * w
    for k in range(4):
        pv, vv = r[PV + k], r[VV + k]
        r[k] += r[V + k]
        r[PP + k] += 2 * pv + vv + (q if k != 2 else ASPECT * ASPECT)
        r[PV + k] = pv + vv
        r[VV + k] = vv + (w if k != 2 else ASPECT_VELOCITY * ASPECT_VELOCITY)


def _update_row(r: list, measured: tuple) -> None:
    """update() of one track, in place."""
    q = POSITION * r[3]
    q = q * q
    for k in range(4):
        pp, pv = r[PP + k], r[PV + k]
        s = pp + (q if k != 2 else ASPECT_MEASURED * ASPECT_MEASURED)
        a, b, off = pp / s, pv / s, measured[k] - r[k]
        r[k] += a * off
        r[V + k] += b * off
        r[VV + k] -= b * pv
        r[PP + k] = pp - a * pp
        r[PV + k] = pv - a * pv


def _initiate_row(measured: tuple, frame: int, sure: bool) -> list:
    """initiate() of one track."""
    h = measured[3]
    p, v = 2 * POSITION * h, 10 * VELOCITY * h
    p, v = p * p, v * v
    return [*measured, 0.0, 0.0, 0.0, 0.0, p, p, ASPECT * ASPECT, p, 0.0, 0.0, 0.0, 0.0, v, v, ASPECT_VELOCITY * ASPECT_VELOCITY, v, 0, 0, frame, frame, sure, False]


def _measured(b: list) -> tuple:
    """measurements() of one box."""
    w, h = b[2] - b[0], b[3] - b[1]
    h = h if h > 1e-6 else 1e-6
    return b[0] + w / 2, b[1] + h / 2, w / h, h


def _sized(x1: float, y1: float, x2: float, y2: float) -> tuple:
    return x1, y1, x2, y2, (x2 - x1) * (y2 - y1)


def _sized_track(r: list) -> tuple:
    """corners() of one track, with the area."""
    w, h = r[2] * r[3] / 2, r[3] / 2
    return _sized(r[0] - w, r[1] - h, r[0] + w, r[1] + h)


def _overlap(a: tuple, b: tuple) -> float:
    """overlaps() of two boxes with their areas."""
    w = (a[2] if a[2] < b[2] else b[2]) - (a[0] if a[0] > b[0] else b[0])
    h = (a[3] if a[3] < b[3] else b[3]) - (a[1] if a[1] > b[1] else b[1])
    if w <= 0 or h <= 0:
        return 0.0
    both = w * h
    whole = a[4] + b[4] - both
    return both / (whole if whole > 1e-9 else 1e-9)


def _least_sum_few(cost: list[list[float]]) -> list[int]:
    """_least_sum() of a small table, step by step the same."""
    n, m = len(cost), len(cost[0])
    row_of, u, v = [-1] * m, [0.0] * n, [0.0] * m
    for start in range(n):
        dist, via, done, seen = [math.inf] * m, [-1] * m, [False] * m, []
        i, j, at = start, -1, 0.0
        while True:
            row, ui, best, least = cost[i], u[i], -1, math.inf
            for k in range(m):
                if not done[k]:
                    new = at + row[k] - ui - v[k]
                    if new < dist[k]:
                        dist[k], via[k] = new, j
                    if dist[k] < least:
                        best, least = k, dist[k]
            j, at = best, least
            done[j] = True
            if row_of[j] < 0:
                break
            seen.append(j)
            i = row_of[j]
        u[start] += at
        for k in seen:
            off = at - dist[k]
            u[row_of[k]] += off
            v[k] -= off
        while j >= 0:
            k = via[j]
            row_of[j] = row_of[k] if k >= 0 else start
            j = k
    out = [-1] * n
    for j, i in enumerate(row_of):
        if i >= 0:
            out[i] = j
    return out


def _assigned_few(cost: list[list[float]], limit: float) -> list[tuple[int, int]]:
    """assigned() of a small table."""
    rows: dict[int, list[int]] = {}
    cols: dict[int, list[int]] = {}
    for i, row in enumerate(cost):
        for j, c in enumerate(row):
            if c <= limit:
                rows.setdefault(i, []).append(j)
                cols.setdefault(j, []).append(i)
    out = []
    while rows:
        i = next(iter(rows))
        part, held, edge = {i}, set(), [i]
        while edge:
            for j in rows.pop(edge.pop()):
                if j not in held:
                    held.add(j)
                    fresh = [k for k in cols[j] if k not in part]
                    part.update(fresh)
                    edge += fresh
        if len(part) == len(held) == 1:
            out.append((i, held.pop()))
            continue
        r, c, most = sorted(part), sorted(held), limit + 1e-4
        if len(r) <= len(c):
            found = _least_sum_few([[min(cost[i][j], most) for j in c] for i in r])
            pairs = [(i, c[k]) for i, k in zip(r, found, strict=True)]
        else:
            found = _least_sum_few([[min(cost[i][j], most) for i in r] for j in c])
            pairs = [(r[k], j) for j, k in zip(c, found, strict=True)]
        out += [(i, j) for i, j in pairs if cost[i][j] <= limit]
    return sorted(out)


def _least_sum(cost: np.ndarray) -> np.ndarray:
    """For each row (no more rows than columns) its column in an assignment of the least sum, by shortest augmenting paths with potentials."""
    n, m = cost.shape
    if n * m <= FEW_CELLS:
        return np.array(_least_sum_few(cost.tolist()), np.int64)
    row_of, u, v = np.full(m, -1), np.zeros(n), np.zeros(m)
    for start in range(n):
        dist, via, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        i, j, at = start, -1, 0.0
        while True:
            new = at + cost[i] - u[i] - v
            better = ~done & (new < dist)
            dist[better], via[better] = new[better], j
            j = int(np.argmin(np.where(done, np.inf, dist)))
            at = dist[j]
            done[j] = True
            if row_of[j] < 0:
                break
            i = row_of[j]
        seen = np.flatnonzero(done)
        u[start] += at
        inner = seen[seen != j]
        u[row_of[inner]] += at - dist[inner]
        v[inner] -= at - dist[inner]
        while j >= 0:  # turn the path around
            k = via[j]
            row_of[j] = row_of[k] if k >= 0 else start
            j = k
    out = np.full(n, -1)
    held = np.flatnonzero(row_of >= 0)
    out[row_of[held]] = held
    return out


def assigned(cost: np.ndarray, limit: float) -> np.ndarray:
    """Pairs (row, column), by row, of the matching with the greatest sum of limit - cost over pairs within the limit.

    Pairs beyond the limit connect nothing, so each connected part is solved for itself; a lone pair is its own solution.
    """
    rows, cols = np.nonzero(cost <= limit)
    if not len(rows):
        return np.zeros((0, 2), np.int64)
    lone = (np.bincount(rows)[rows] == 1) & (np.bincount(cols)[cols] == 1)
    out = [np.column_stack([rows[lone], cols[lone]])]
    next_to: dict[int, list[int]] = {}
    for i, j in zip(rows[~lone].tolist(), (cols[~lone] + len(cost)).tolist(), strict=True):
        next_to.setdefault(i, []).append(j)
        next_to.setdefault(j, []).append(i)
    while next_to:
        part, edge = set(), [next(iter(next_to))]
        while edge:
            k = edge.pop()
            if k not in part:
                part.add(k)
                edge += next_to.pop(k)
        r, c = np.array(sorted(k for k in part if k < len(cost))), np.array(sorted(k - len(cost) for k in part if k >= len(cost)))
        inner = np.minimum(cost[np.ix_(r, c)], limit + 1e-4)
        if len(r) <= len(c):
            pairs = np.column_stack([r, c[_least_sum(inner)]])
        else:
            pairs = np.column_stack([r[_least_sum(inner.T)], c])
        out.append(pairs[cost[pairs[:, 0], pairs[:, 1]] <= limit])
    found = np.concatenate(out)
    return found[np.argsort(found[:, 0], kind="stable")]


class Tracker:
    """Tracks of one video; `run` takes its rows in the order of frames, in any batches.

    A track gets its id with the `consecutive`-th detection after its first one without a break. Frames without rows pass as empty frames.
    """

    def __init__(self, fps: float = 30.0, activation: float = ACTIVATION, match: float = MATCH, lost: int = LOST_FRAMES, consecutive: int = CONSECUTIVE):
        if not 0 < activation < 1 or fps <= 0:
            raise ValueError("activation must be between 0 and 1 and fps greater than zero")
        self.activation, self.match, self.consecutive = activation, match, consecutive
        self.buffer = int(fps / 30 * lost)
        self.tracks: list | np.ndarray = []  # rows of plain numbers, or an array: as the last frame left them
        self.next_id, self.frame, self.first = 1, None, None
        self.plain = True  # no row so far that plain numbers aren't used for
        self.held = np.zeros(0, np.int64)

    def step(self, frame: int, boxes: np.ndarray, confidence: np.ndarray) -> np.ndarray:
        """The ids of a frame's detections; -1 where there is none. `held` has the ids of the tracks that took them, whether or not these are shown."""
        self.plain = self.plain and _is_plain(boxes, confidence)
        return self._step(frame, boxes, confidence)

    def _step(self, frame: int, boxes: np.ndarray, confidence: np.ndarray) -> np.ndarray:
        if self.first is None:
            self.first = frame
        for f in range(frame if self.frame is None else self.frame + 1, frame):
            if not len(self.tracks):
                break
            self._advance(f, boxes[:0], confidence[:0])
        self.held = np.full(len(boxes), -1, np.int64)
        self._advance(frame, boxes, confidence)
        self.frame = frame
        ids = np.full(len(boxes), -1, np.int64)
        if isinstance(self.tracks, list):
            shown = [(r[ID], _sized_track(r)) for r in self.tracks if r[SURE] and not r[LOST] and r[ID] > 0]
            if not shown or not len(boxes):
                return ids
            for d, k in _assigned_few([[1 - _overlap(b, t) for _, t in shown] for b in (_sized(*b) for b in boxes.tolist())], SECOND_MATCH):
                ids[d] = shown[k][0]
            return ids
        shown = self.tracks[self.tracks["sure"] & ~self.tracks["lost"] & (self.tracks["id"] > 0)]
        if not len(shown) or not len(boxes):
            return ids
        for d, k in assigned(1 - overlaps(boxes, corners(shown["x"])), SECOND_MATCH):
            ids[d] = shown["id"][k]
        return ids

    def _advance(self, frame: int, boxes: np.ndarray, confidence: np.ndarray) -> None:
        rows = isinstance(self.tracks, list)
        if self.plain and len(self.tracks) <= FEW and len(boxes) <= FEW:
            self.tracks = self.tracks if rows else rows_of(self.tracks)
            self._advance_few(frame, boxes.tolist(), confidence.tolist())
        else:
            self.tracks = array_of(self.tracks) if rows else self.tracks
            self._advance_many(frame, boxes, confidence)

    def _advance_few(self, frame: int, boxes: list, confidence: list) -> None:
        """_advance_many() by plain numbers."""
        t, n = self.tracks, len(self.tracks)
        sure, was_lost = [r[SURE] for r in t], [r[LOST] for r in t]
        for r in t:
            if r[SURE]:
                if r[LOST]:
                    r[V + 3] = 0.0
                _predict_row(r)
        at, seen = [_sized_track(r) for r in t], [_sized(*b) for b in boxes]
        high = [j for j, c in enumerate(confidence) if c > self.activation]
        low = [j for j, c in enumerate(confidence) if LEAST < c < self.activation]
        taken, found = [False] * len(boxes), [False] * n

        def match(which: list, dets: list, limit: float, weighted: bool) -> None:
            if not which or not dets:
                return
            cost = [[1 - _overlap(at[i], seen[j]) * confidence[j] for j in dets] for i in which] if weighted else [[1 - _overlap(at[i], seen[j]) for j in dets] for i in which]
            for i, j in _assigned_few(cost, limit):
                i, j = which[i], dets[j]
                r = t[i]
                found[i] = taken[j] = True
                _update_row(r, _measured(boxes[j]))
                at[i] = _sized_track(r)
                r[RUN] = 0 if r[LOST] else r[RUN] + 1
                if not r[LOST] and r[RUN] == self.consecutive:
                    r[SURE] = True
                    if r[ID] == 0:
                        r[ID] = self.next_id
                        self.next_id += 1
                r[LOST], r[SEEN] = False, frame
                self.held[j] = r[ID] or -1

        match([i for i in range(n) if sure[i]], high, self.match, True)
        free = [i for i in range(n) if sure[i] and not was_lost[i] and not found[i]]
        match(free, low, SECOND_MATCH, False)
        for i in free:
            if not found[i]:
                t[i][LOST] = True
        match([i for i in range(n) if not sure[i]], [j for j in high if not taken[j]], UNCONFIRMED_MATCH, True)
        kept = [i for i in range(n) if (not t[i][LOST] or frame - t[i][SEEN] <= self.buffer if sure[i] else found[i])]
        t, at = [t[i] for i in kept], [at[i] for i in kept]
        for j in high:
            if not taken[j] and confidence[j] >= self.activation + NEW_MARGIN:
                r = _initiate_row(_measured(boxes[j]), frame, frame == self.first)
                if self.consecutive <= 1:
                    r[ID] = self.held[j] = self.next_id
                    self.next_id += 1
                t.append(r)
                at.append(_sized_track(r))
        on, off, gone = [i for i, r in enumerate(t) if not r[LOST]], [i for i, r in enumerate(t) if r[LOST]], set()
        for i in on:
            for j in off:
                if 1 - _overlap(at[i], at[j]) < DOUBLE:
                    gone.add(j if t[i][SEEN] - t[i][BORN] > t[j][SEEN] - t[j][BORN] else i)
        self.tracks = [r for i, r in enumerate(t) if i not in gone] if gone else t

    def _advance_many(self, frame: int, boxes: np.ndarray, confidence: np.ndarray) -> None:
        t, seen = self.tracks, measurements(boxes)
        sure, lost = t["sure"].copy(), t["lost"].copy()
        if sure.any():
            t["v"][lost, 3] = 0
            t[sure] = predict(t[sure])
        high = np.flatnonzero(confidence > self.activation)
        low = np.flatnonzero((confidence > LEAST) & (confidence < self.activation))

        taken, found = np.zeros(len(boxes), bool), np.zeros(len(t), bool)

        def match(which: np.ndarray, dets: np.ndarray, limit: float, weighted: bool) -> None:
            if not len(which) or not len(dets):
                return
            share = overlaps(corners(t["x"][which]), boxes[dets])
            pairs = assigned(1 - share * confidence[dets] if weighted else 1 - share, limit)
            if not len(pairs):
                return
            a, b = which[pairs[:, 0]], dets[pairs[:, 1]]
            found[a], taken[b] = True, True
            t[a] = update(t[a], seen[b])
            back = t["lost"][a]
            t["run"][a] = np.where(back, 0, t["run"][a] + 1)
            told = a[~back & (t["run"][a] == self.consecutive)]
            t["sure"][told] = True
            fresh = told[t["id"][told] == 0]
            t["id"][fresh] = np.arange(self.next_id, self.next_id + len(fresh))
            self.next_id += len(fresh)
            t["lost"][a], t["seen"][a] = False, frame
            self.held[b] = np.where(t["id"][a] > 0, t["id"][a], -1)

        match(np.flatnonzero(sure), high, self.match, True)
        free = sure & ~lost & ~found
        match(np.flatnonzero(free), low, SECOND_MATCH, False)
        t["lost"][free & ~found] = True
        match(np.flatnonzero(~sure), high[~taken[high]], UNCONFIRMED_MATCH, True)
        keep = np.where(sure, ~t["lost"] | (frame - t["seen"] <= self.buffer), found)
        new = high[~taken[high] & (confidence[high] >= self.activation + NEW_MARGIN)]
        if len(new) or not keep.all():
            added = initiate(seen[new], frame)
            added["sure"] = frame == self.first
            if self.consecutive <= 1:
                added["id"] = self.held[new] = np.arange(self.next_id, self.next_id + len(added))
                self.next_id += len(added)
            t = np.concatenate([t[keep], added])
        self.tracks = self._single(t)

    @staticmethod
    def _single(t: np.ndarray) -> np.ndarray:
        """Without doubles: of a tracked and a lost track on one another the one with the shorter life goes, the tracked one if they are equal."""
        on, off = np.flatnonzero(~t["lost"]), np.flatnonzero(t["lost"])
        if not len(on) or not len(off):
            return t
        i, j = np.nonzero(1 - overlaps(corners(t["x"][on]), corners(t["x"][off])) < DOUBLE)
        life = t["seen"] - t["born"]
        longer = life[on[i]] > life[off[j]]
        return np.delete(t, np.r_[off[j[longer]], on[i[~longer]]])

    def run(self, rows: pd.DataFrame, held: bool = False) -> pd.DataFrame:
        """Rows of new frames with tracker_id, and held_id if asked for; rows of frames up to the last one seen are late and go."""
        rows = rows.sort_values(["frame_number", "det_no"])
        if self.frame is not None:
            rows = rows[rows.frame_number > self.frame]
        out, taken = np.full(len(rows), -1, np.int64), np.full(len(rows), -1, np.int64)
        frames = rows.frame_number.to_numpy()
        boxes, conf = rows[["x1", "y1", "x2", "y2"]].to_numpy(float), rows.confidence.to_numpy(float)
        self.plain = self.plain and _is_plain(boxes, conf)
        cut = [0, *(np.flatnonzero(np.diff(frames)) + 1).tolist(), len(frames)] if len(frames) else [0]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            out[a:b] = self._step(int(frames[a]), boxes[a:b], conf[a:b])
            taken[a:b] = self.held
        return rows.assign(tracker_id=out, held_id=taken) if held else rows.assign(tracker_id=out)

    def state(self) -> tuple[tuple, list[tuple]]:
        """Numbers of the video, and one row a track."""
        rows = self.tracks if isinstance(self.tracks, list) else rows_of(self.tracks)
        return (self.next_id, self.frame, self.first), [tuple(r) for r in rows]

    def load(self, numbers: tuple, tracks: list[tuple]) -> Tracker:
        self.next_id, self.frame, self.first = numbers
        self.tracks = [list(r) for r in tracks]
        self.plain = all(abs(x) < PLAIN for r in tracks for x in r[:PP])
        return self


def _is_plain(boxes: np.ndarray, confidence: np.ndarray) -> bool:
    """Whether no number is missing, infinite or huge."""
    return bool((np.abs(boxes) < PLAIN).all() and (np.abs(confidence) < PLAIN).all())


#: A track's row in a stream's state.
STATE_FIELDS = [*(f"{k}{i} double" for k in ("x", "v", "pp", "pv", "vv") for i in range(4)), "id bigint", "run bigint", "seen bigint", "born bigint", "sure boolean", "lost boolean"]
