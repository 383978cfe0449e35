"""Quality classifier by positive-unlabelled learning.

Positives are trusted labels (quality 1), the rest of the training text is unlabelled. A linear model over dense text
features minimises the non-negative unbiased risk: prior * loss(positives as positive) + max(0, loss(unlabelled as
negative) - prior * loss(positives as negative)); where the second part falls below zero, its gradient is reversed. The class prior is
estimated as the share of positives among the labelled training rows, smoothed by one row of each class.

Features of every text are written once. The risk under logistic loss, its gradient and its second derivatives are sums over all
positive and all unlabelled training rows, which Spark adds up in each of a few Newton steps; only these sums reach the driver (about 5,000 numbers). Labels come only
from rows outside the held-out fold; lang, source and doc_id are no features.

A null text counts as empty; empty texts get a score like any other. A very long text is compressed and counted in pieces. Without positives the score is the
prior everywhere. A null doc_id counts as empty text for the fold, which is the held-out one, so it never trains. Rows that repeat a doc_id train and are scored each for
itself. Labels that repeat count once (any 1 makes a positive), null labels not at all. An empty table gives an empty table. Only doc_id, text
and quality are read, so other columns can have any name.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import as_bytes, fold, stored

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
_KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".", "comma": b",", "mark": b"!?", "symbol": b"#*$%&|<>@=+_~^", "quote": b"\"'()[]{}", "line": b"\n"}
_PIECE = 1 << 16


def features(text: bytes | None) -> list[float]:
    text = text or b""
    words, n = text.split(), max(len(text), 1)
    out = [np.log1p(len(text)), np.log1p(len(words))]
    out += [np.sqrt(sum(map(text.count, (bytes([c]) for c in chars))) / n) for chars in _KINDS.values()]
    counts, m = Counter(words), max(len(words), 1)
    out.append(sum(a == b for a, b in zip(words, words[1:], strict=False)) / m)
    out.append(len(counts) / m)
    out.append(len(counts) / m * np.log1p(m))
    out.append(max(counts.values(), default=0) / m)
    out.append(sum(c for _, c in counts.most_common(5)) / m)
    size = np.fromiter(map(len, counts), float, len(counts)) if counts else np.zeros(1)
    out += [size.mean(), size.std(), float(size.max() > 40)]
    lines = [x for x in text.split(b"\n") if x.strip()]
    out.append(1 - len(set(lines)) / max(len(lines), 1))
    out.append(len(lines) / m)
    packed = sum(len(zlib.compress(text[i : i + _PIECE], 1)) for i in range(0, len(text), _PIECE))
    out.append(packed / n)
    pairs = len(set(zip(words, words[1:], strict=False)))
    out.append(pairs / max(len(words) - 1, 1))
    out.append(sum(text.count(bytes([c])) for c in range(0xC3, 0xC6)) / n)
    return out


WIDTH = len(features(b""))


#: Entries of a model's weights: expanded() features and the bias.
WEIGHTS = 2 * WIDTH + 1


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id and x (the features of its text, as floats) for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in as_bytes(b.column(1)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id bigint, x array<float>")


def expanded(x: np.ndarray) -> np.ndarray:
    """Standardised features, clipped, with their squares and a one for the bias."""
    x = np.clip(x, -6, 6)
    return np.hstack([x, x * x / 6, np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH).astype(float)


#: Tasks whose numbers are added first, in ranges.
RANGE = 256


def summed(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows (x, positive) of part(), which gives `size` numbers for a batch.

    Numbers of tasks are added by ranges of RANGE tasks and then across ranges, each time in a fixed order, so no list holds more than RANGE numbers, or one a range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for b in batches:
            if b.num_rows:
                out += part(_matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False))
        place = TaskContext.get().partitionId() // RANGE
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(np.full(size, place), pa.int32()), pa.array(out, pa.float64())], ["k", "place", "v"])

    added = F.aggregate(F.sort_array(F.collect_list("v")), F.lit(0.0), lambda a, v: a + v).alias("v")
    by_range = rows.select("x", "positive").mapInArrow(run, "k int, place int, v double").groupBy("k", "place").agg(added)
    got = by_range.groupBy("k").agg(added).collect()
    out = np.zeros(size)
    out[[r.k for r in got]] = [r.v for r in got]
    return out


def risk_sums(x: np.ndarray, positive: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of expanded rows x: unlabelled count, loss as negative, its gradient and second derivatives; positive count, loss as negative, its gradient, sum of x."""
    z = x @ w
    loss, s = np.logaddexp(0, z), 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    u, p = ~positive, positive
    curve = (x[u] * (s[u] * (1 - s[u]))[:, None]).T @ x[u]
    return np.concatenate([[u.sum(), loss[u].sum()], s[u] @ x[u], curve.ravel(), [p.sum(), loss[p].sum()], s[p] @ x[p], x[p].sum(0)])


def risk(sums: np.ndarray, w: np.ndarray, prior: float, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative risk (with decay), the gradient to follow, which is reversed where the clipped part is below zero, and the second derivatives."""
    d, at = len(w), 0

    def take(n: int) -> np.ndarray:
        nonlocal at
        at += n
        return sums[at - n : at]

    (n_u, loss_u), as_u, curve = take(2), take(d), take(d * d).reshape(d, d)
    (n_p, loss_p), as_p, sum_p = take(2), take(d), take(d)
    shrink = decay * np.r_[w[:-1], 0]
    negative = loss_u / n_u - prior * loss_p / n_p
    as_negative = as_u / n_u - prior * as_p / n_p
    as_positive = prior * (as_p - sum_p) / n_p
    value = prior * (loss_p - sum_p @ w) / n_p + max(negative, 0) + decay * (w[:-1] @ w[:-1]) / 2
    gradient = as_positive + as_negative + shrink if negative >= 0 else shrink - as_negative
    return value, gradient, curve / n_u + decay * np.eye(d)


def minimised(sums: Callable[[np.ndarray], np.ndarray], prior: float, rounds: int = 20, decay: float = 1e-4) -> np.ndarray:
    """The weights of the least risk that Newton steps (no entry moves by more than 2 in one) come to; sums(w) as of risk_sums()."""
    w = np.zeros(WEIGHTS)
    w[-1] = np.log(prior / (1 - prior))
    best = (np.inf, w)
    for _ in range(rounds):
        value, gradient, curve = risk(sums(w), w, prior, decay)
        if value < best[0]:
            best = (value, w)
        step = np.linalg.solve(curve, gradient)
        step /= max(1, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-4:
            break
        w = w - step
    return best[1]


def learn(rows: DataFrame, labels: DataFrame) -> tuple[tuple | None, float]:
    """Mean, scale and weights of the fitted model, or None without positives, and the estimated class prior; rows: vectors(), stored."""
    known = labels.select("doc_id", "quality").filter("quality is not null and doc_id is not null").filter(fold("doc_id", FOLDS) != HELD_OUT)
    known = stored(known.groupBy("doc_id").agg(F.max("quality").alias("quality")))
    n, good = known.agg(F.count("*"), F.coalesce(F.sum("quality"), F.lit(0))).first()
    prior = min(max((good + 1) / (n + 2), 0.01), 0.99)
    training = rows.filter(fold("doc_id", FOLDS) != HELD_OUT)
    positive = stored(training.join(known.filter("quality = 1").select("doc_id"), "doc_id", "left_semi").select("x", F.lit(True).alias("positive")))
    unlabelled = training.select("x", F.lit(False).alias("positive"))
    n_positive = positive.count()
    if not n_positive:
        return None, prior
    moments = summed(unlabelled, lambda x, _: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]), 2 * WIDTH + 1)
    mean = moments[1 : WIDTH + 1] / moments[0]
    scale = np.sqrt(np.maximum(moments[WIDTH + 1 :] / moments[0] - mean * mean, 0)) + 1e-9
    both = unlabelled.unionByName(positive)
    sums = lambda w: summed(both, lambda x, p: risk_sums(expanded((x - mean) / scale), p, w), 4 + 3 * WEIGHTS + WEIGHTS**2)
    # a ridge that weighs as much as one positive row
    return (mean, scale, minimised(sums, prior, decay=1 / n_positive)), prior


def score(rows: DataFrame, model: tuple[tuple | None, float]) -> DataFrame:
    """doc_id and score (0 to 1) for each row of vectors()."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, prior = shared.value
        for b in batches:
            out = np.full(b.num_rows, prior)
            if fitted and b.num_rows:
                mean, scale, w = fitted
                out = 1 / (1 + np.exp(-np.clip(expanded((_matrix(b.column(1)) - mean) / scale) @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    rows = stored(vectors(docs))
    scored = score(rows, learn(rows, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
