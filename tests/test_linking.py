import itertools
import random

import numpy as np
import pytest

from boxlake.operators import linking


def best_by_search(cost, limit):
    """The greatest sum of limit + 1e-4 - cost over matchings, by trying all."""
    n, m = cost.shape
    best = 0.0
    for size in range(min(n, m) + 1):
        for rows in itertools.combinations(range(n), size):
            for cols in itertools.permutations(range(m), size):
                c = [cost[i, j] for i, j in zip(rows, cols, strict=True)]
                if all(x <= limit for x in c):
                    best = max(best, sum(limit + 1e-4 - x for x in c))
    return best


def test_assignments_are_optimal():
    r = np.random.default_rng(2)
    for _ in range(300):
        cost = r.random((r.integers(0, 5), r.integers(0, 6)))
        if r.random() < 0.3:
            cost = np.round(cost, 1)
        pairs = linking.assigned(cost, 0.6)
        assert len(set(pairs[:, 0])) == len(pairs) == len(set(pairs[:, 1]))
        got = sum(0.6 + 1e-4 - cost[i, j] for i, j in pairs)
        assert abs(got - best_by_search(cost, 0.6)) < 1e-9 and all(cost[i, j] <= 0.6 for i, j in pairs)


def test_large_assignment_has_the_least_sum():
    r = np.random.default_rng(3)
    cost = r.random((60, 80))
    col = linking._least_sum(cost)
    assert len(set(col)) == 60
    total = cost[np.arange(60), col].sum()
    for _ in range(2000):  # no exchange of two and no free column is better
        i, j = r.integers(0, 60, 2)
        k = r.integers(0, 80)
        assert cost[i, col[j]] + cost[j, col[i]] >= cost[i, col[i]] + cost[j, col[j]] - 1e-12
        assert k in col or cost[i, k] >= cost[i, col[i]] - 1e-12
    assert total < np.sort(cost, axis=1)[:, :2].sum()


class Filter:
    """The 8-dimensional filter with whole matrices."""

    def __init__(self, z):
        h = z[3]
        self.m = np.r_[z, np.zeros(4)]
        s = np.array([h / 10, h / 10, 1e-2, h / 10, h / 16, h / 16, 1e-5, h / 16])
        self.p = np.diag(s * s)

    def predict(self, lost):
        if lost:
            self.m[7] = 0
        f = np.eye(8)
        f[:4, 4:] = np.eye(4)
        h = self.m[3]
        s = np.array([h / 20, h / 20, 1e-2, h / 20, h / 160, h / 160, 1e-5, h / 160])
        self.m, self.p = f @ self.m, f @ self.p @ f.T + np.diag(s * s)

    def update(self, z):
        h, see = self.m[3], np.eye(4, 8)
        s = np.array([h / 20, h / 20, 1e-1, h / 20])
        inner = see @ self.p @ see.T + np.diag(s * s)
        gain = self.p @ see.T @ np.linalg.inv(inner)
        self.m, self.p = self.m + gain @ (z - see @ self.m), self.p - gain @ inner @ gain.T


def measured(b):
    return np.array([(b[0] + b[2]) / 2, (b[1] + b[3]) / 2, (b[2] - b[0]) / (b[3] - b[1]), b[3] - b[1]])


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    return both / max((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both, 1e-9)


def pairs_by_search(cost, limit):
    """The optimal matching of a small cost table (dict of pairs), by trying all for each row in turn."""
    rows = sorted({i for i, _ in cost})

    def go(k, used):
        if k == len(rows):
            return 0.0, []
        best = go(k + 1, used)
        for (i, j), c in cost.items():
            if i == rows[k] and j not in used and c <= limit:
                s, p = go(k + 1, used | {j})
                best = max(best, (s + limit + 1e-4 - c, [(i, j), *p]), key=lambda x: x[0])
        return best

    return go(0, frozenset())[1]


def model(rows, fps, activation=0.5, match=0.8, lost=30, consecutive=2):
    """(frame, det_no) -> id of one video's rows (frame, det_no, box, confidence): the paper's steps with plain lists of tracks."""
    buffer, tracks, ids, out = int(fps / 30 * lost), [], 0, {}
    if not rows:
        return out
    frames = sorted({r[0] for r in rows})

    def box(t):
        x = t["f"].m
        return (x[0] - x[2] * x[3] / 2, x[1] - x[3] / 2, x[0] + x[2] * x[3] / 2, x[1] + x[3] / 2)

    for f in range(frames[0], frames[-1] + 1):
        dets = sorted(r for r in rows if r[0] == f)
        high = [d for d in dets if d[6] > activation]
        low = [d for d in dets if 0.1 < d[6] < activation]
        pool = [t for t in tracks if t["sure"]]
        for t in pool:
            t["f"].predict(t["lost"])
        unsure = [t for t in tracks if not t["sure"]]
        news = []

        def stage(ts, ds, limit, weighted):
            nonlocal ids
            cost = {(i, j): 1 - overlap(box(t), d[2:6]) * (d[6] if weighted else 1) for i, t in enumerate(ts) for j, d in enumerate(ds)}
            found = pairs_by_search({k: c for k, c in cost.items() if c <= limit}, limit)
            for i, j in sorted(found):
                t = ts[i]
                t["f"].update(measured(ds[j][2:6]))
                if t["lost"]:
                    t["lost"], t["run"] = False, 0
                else:
                    t["run"] += 1
                    if t["run"] == consecutive:
                        t["sure"] = True
                        if not t["id"]:
                            ids += 1
                            t["id"] = ids
                t["seen"] = f
            return [ts[i] for i, _ in found], [ds[j] for _, j in found]

        was_lost = {id(t): t["lost"] for t in pool}
        a, b = stage(pool, high, match, True)
        free = [t for t in pool if not was_lost[id(t)] and not any(t is x for x in a)]
        c, _ = stage(free, low, 0.5, False)
        for t in free:
            if not any(t is x for x in c):
                t["lost"] = True
        left = [d for d in high if d not in b]
        a, b = stage(unsure, left, 0.7, True)
        gone = [t for t in unsure if not any(t is x for x in a)]
        for d in left:
            if d not in b and d[6] >= activation + 0.1:
                news.append({"f": Filter(measured(d[2:6])), "sure": f == frames[0], "lost": False, "id": 0, "run": 0, "seen": f, "born": f})
        gone += [t for t in tracks if t["lost"] and f - t["seen"] > buffer]
        tracks = [t for t in tracks if not any(t is g for g in gone)] + news
        double = []
        for p in tracks:
            for q in tracks:
                if not p["lost"] and q["lost"] and 1 - overlap(box(p), box(q)) < 0.15:
                    double.append(q if p["seen"] - p["born"] > q["seen"] - q["born"] else p)
        tracks = [t for t in tracks if not any(t is g for g in double)]
        shown = [t for t in tracks if t["sure"] and not t["lost"] and t["id"]]
        for d in dets:
            out[f, d[1]] = -1
        cost = {(i, j): 1 - overlap(d[2:6], box(t)) for i, d in enumerate(dets) for j, t in enumerate(shown)}
        for i, j in pairs_by_search({k: c for k, c in cost.items() if c <= 0.5}, 0.5):
            out[f, dets[i][1]] = shown[j]["id"]
    return out


def video(seed, cars=6, frames=60):
    r = random.Random(seed)
    at = [[r.uniform(0, 160), r.uniform(0, 160), r.uniform(-4, 4), r.uniform(-4, 4)] for _ in range(cars)]
    rows = []
    for f in range(frames):
        if r.random() < 0.1:
            continue
        for k, (x, y, vx, vy) in enumerate([c for c in at if r.random() < 0.85]):
            x, y = x + vx * f + r.uniform(-1, 1), y + vy * f + r.uniform(-1, 1)
            rows.append((f, k, x, y, x + r.uniform(24, 27), y + r.uniform(17, 19), r.choice([0.05, 0.3, 0.45, 0.5, 0.55, 0.7, 0.9])))
    return rows


def linked(rows, fps, cuts=1, **settings):
    """The tracker's ids, with its state told and read again between parts."""
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["frame_number", "det_no", "x1", "y1", "x2", "y2", "confidence"])
    out, state = {}, None
    for lo in range(cuts):
        part = frame[(frame.frame_number * cuts // 1000 == lo) if cuts > 1 else slice(None)]
        t = linking.Tracker(fps, **settings)
        if state:
            t.load(*state)
        for x in t.run(part).itertuples(index=False):
            out[x.frame_number, x.det_no] = x.tracker_id
        state = t.state()
    return out


@pytest.mark.parametrize("seed", range(8))
def test_equals_the_model(seed):
    rows = video(seed)
    want = model(rows, 12.0)
    assert linked(rows, 12.0) == want and max(want.values()) > 2 and -1 in want.values()


def test_state_goes_on_between_parts():
    rows = [(f * 15, *x) for f, *x in video(3)]
    assert linked(rows, 400.0, cuts=5) == linked(rows, 400.0)


def crossing():
    """Two cars that meet: the nearer pair of a greedy choice leaves the other detection without a track."""
    rows = []
    for f in range(24):
        for k, (x, v) in enumerate(((0.0, 6.0), (66.0, 1.0))):
            rows.append((f, k, x + v * f, 10.0 + k, x + v * f + 30, 40.0 + k, 0.95))
    return rows


def test_crossing_tracks_keep_their_ids():
    got = linked(crossing(), 30.0)
    seen = {k: {i for (f, d), i in got.items() if d == k and i > 0} for k in (0, 1)}
    assert seen == {0: {1}, 1: {2}} and got == model(crossing(), 30.0)


def test_optimal_where_greedy_fails():
    cost = np.array([[0.30, 0.35], [0.36, 0.95]])  # greedy takes 0.30 and leaves the second row alone
    assert linking.assigned(cost, 0.8).tolist() == [[0, 1], [1, 0]]


def test_doubles_go():
    t = np.concatenate([linking.initiate(linking.measurements(np.array([[0.0, 0, 20, 20]])), 5), linking.initiate(linking.measurements(np.array([[0.5, 0, 20.5, 20]])), 0)])
    t["seen"], t["lost"] = [9, 8], [False, True]
    left = linking.Tracker._single(t)
    assert left["born"].tolist() == [0]  # the lost one lived longer
    t["born"] = [0, 5]
    assert linking.Tracker._single(t)["born"].tolist() == [0]


def test_many_boxes_of_a_frame_take_little_time():
    import time

    r = np.random.default_rng(1)
    at = r.random((600, 2)) * 2000
    t, began = linking.Tracker(30.0), time.time()
    for f in range(8):
        xy = at + f * 2 + r.normal(0, 0.5, at.shape)
        ids = t.step(f, np.column_stack([xy, xy + 25]), np.full(600, 0.9))
    assert time.time() - began < 20 and len(set(ids[ids > 0])) == (ids > 0).sum() > 500


def sparse(seed, frames):
    """Frames of few boxes with confidences, with gaps."""
    r, f = np.random.default_rng(seed), 0
    for _ in range(frames):
        f += int(r.choice([1, 1, 1, 2, 20]))
        n = int(r.integers(0, 7))
        xy = r.permutation(6)[:n, None] * [9.0, 4.0] + r.normal(0, 2, (n, 2))
        yield f, np.hstack([xy, xy + r.uniform(20, 30, (n, 2))]), r.random(n) ** 0.5


@pytest.mark.parametrize("consecutive", [1, 2, 3])
def test_plain_numbers_equal_arrays(monkeypatch, consecutive):
    got = []
    for few, cells in ((24, 256), (-1, 0), (5, 9)):
        monkeypatch.setattr(linking, "FEW", few)
        monkeypatch.setattr(linking, "FEW_CELLS", cells)
        t = linking.Tracker(12.0, consecutive=consecutive)
        got.append([(t.step(*x).tolist(), t.held.tolist(), t.state()) for x in sparse(consecutive, 150)])
    assert got[0] == got[1] == got[2] and any(max(ids, default=0) > 2 for ids, _, _ in got[0])


def test_boxes_without_numbers_link_nothing():
    t = linking.Tracker(12.0)
    good, odd = [0.0, 0, 20, 20], [np.nan, 0, 20, 20]
    ids = [t.step(f, np.array([good, odd]), np.array([0.9, 0.9])).tolist() for f in range(4)]
    assert ids == [[-1, -1], [-1, -1], [1, -1], [1, -1]]


def test_frames_of_few_boxes_take_little_time(monkeypatch):
    import time

    frames, took = list(sparse(7, 1500)), []
    for few in (-1, 24):
        monkeypatch.setattr(linking, "FEW", few)
        t, began = linking.Tracker(12.0), time.time()
        for x in frames:
            t.step(*x)
        took.append(time.time() - began)
    assert took[1] < took[0] / 2
