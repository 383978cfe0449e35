import random

import numpy as np
import pytest

from boxlake.llm import pu_quality
from tests.llm.data import EDGE, docs, prose


def test_held_out(spark):
    r = random.Random(1)
    rows = [(i, prose(i, 80) if i % 3 else " ".join([r.choice(["junk", "spam"])] * 80), "en", "a") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 400, 2)] + [(5, None), (None, 1)], "doc_id bigint, quality int")
    got = pu_quality.classify(docs(spark, rows), labels).collect()
    held = [x for x in got if x.held_out]
    assert len(got) == 400 and len(held) > 40
    assert sum(x.predicted == int(x.doc_id % 3 > 0) for x in held) > 0.9 * len(held)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got)


def test_edge_rows(spark):
    labels = spark.createDataFrame([(4, 1), (7, 1), (8, 0)], "doc_id bigint, quality int")
    got = pu_quality.classify(docs(spark, EDGE), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= x.score <= 1 for x in got)
    none = pu_quality.classify(docs(spark, EDGE), labels.limit(0)).collect()
    assert {x.score for x in none} == {0.5}
    assert pu_quality.classify(docs(spark, []), labels).count() == 0


def brute_risk(x, positive, w, prior, decay, clip=True):
    loss = lambda z: np.log1p(np.exp(z))
    zp, zu = x[positive] @ w, x[~positive] @ w
    negative = loss(zu).mean() - prior * loss(zp).mean()
    return prior * loss(-zp).mean() + (max(negative, 0) if clip else negative) + decay * (w[:-1] ** 2).sum() / 2, negative, prior * loss(-zp).mean()


def sample(seed, shift):
    r = np.random.default_rng(seed)
    x = pu_quality.expanded(r.normal(size=(200, pu_quality.WIDTH)))
    positive = np.arange(200) < 60
    x[positive, 0] += shift
    return x, positive, r.normal(size=pu_quality.WEIGHTS) / 10


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_risk_and_derivatives_match_finite_differences(prior):
    x, positive, w = sample(1, 0.5)
    value, gradient, curve = pu_quality.risk(pu_quality.risk_sums(x, positive, w), w, prior, 1e-3)
    want, negative, _ = brute_risk(x, positive, w, prior, 1e-3)
    assert abs(value - want) < 1e-9 and negative > 0
    for k in range(0, len(w), 7):
        step = np.eye(len(w))[k] * 1e-5
        slope = (brute_risk(x, positive, w + step, prior, 1e-3)[0] - brute_risk(x, positive, w - step, prior, 1e-3)[0]) / 2e-5
        assert abs(slope - gradient[k]) < 1e-6
        ahead = pu_quality.risk(pu_quality.risk_sums(x, positive, w + step), w + step, prior, 1e-3)[1]
        back = pu_quality.risk(pu_quality.risk_sums(x, positive, w - step), w - step, prior, 1e-3)[1]
        assert np.abs((ahead - back) / 2e-5 - curve[k])[:-1].max() < 2e-3


def test_gradient_is_reversed_below_zero():
    x, positive, w = sample(2, 3.0)
    w[0], w[-1] = 4.0, -2.0
    prior = 0.95
    value, gradient, _ = pu_quality.risk(pu_quality.risk_sums(x, positive, w), w, prior, 0.0)
    want, negative, first = brute_risk(x, positive, w, prior, 0.0)
    assert negative < 0 and abs(value - first) < 1e-9 and abs(value - want) < 1e-9
    step = np.eye(len(w))[0] * 1e-5
    slope = (brute_risk(x, positive, w + step, prior, 0.0, False)[1] - brute_risk(x, positive, w - step, prior, 0.0, False)[1]) / 2e-5
    assert abs(gradient[0] + slope) < 1e-6


def test_scores_match_a_model_without_spark(spark):
    """The whole query against one matrix in memory: features, fold, labels, sums and Newton steps."""
    import zlib

    r = random.Random(5)
    rows = [(r.choice([None, *range(150)]), r.choice([prose(i, 60), "junk " * r.randint(1, 50), None, ""]), "en", "a") for i in range(300)]
    labels = [(i, int(i % 4 > 0)) for i in range(0, 150, 2)] + [(6, 0), (8, 1), (10, None), (None, 1)]
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0
    quality = {}
    for i, q in labels:
        if i is not None and q is not None and not out(i):
            quality[i] = max(quality.get(i, 0), q)
    prior = (sum(quality.values()) + 1) / (len(quality) + 2)
    x = np.array([pu_quality.features(t and t.encode()) for _, t, *_ in rows], np.float32).astype(float)
    training = np.array([not out(i) for i, *_ in rows])
    good = np.array([quality.get(i) == 1 for i, *_ in rows]) & training
    mean, scale = x[training].mean(0), x[training].std(0) + 1e-9
    e = pu_quality.expanded((x - mean) / scale)
    both, positive = np.vstack([e[training], e[good]]), np.r_[np.zeros(training.sum(), bool), np.ones(good.sum(), bool)]
    w = pu_quality.minimised(lambda w: pu_quality.risk_sums(both, positive, w), prior, decay=1 / good.sum())
    want = sorted(((i, round(float(s), 5)) for (i, *_), s in zip(rows, 1 / (1 + np.exp(-np.clip(e @ w, -30, 30))), strict=True)), key=str)
    got = pu_quality.classify(docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    for a, b in zip(sorted(((y.doc_id, round(y.score, 5)) for y in got), key=str), want, strict=True):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 2e-4
