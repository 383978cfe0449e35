"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams (1 to 3 code points of the lower-cased text, hashed into ``BUCKETS``) are summed over every
training row by Spark; the matrix of log-probabilities, one row of buckets for each language, is broadcast in blocks of
``BLOCK`` languages (8 MB each). Texts are scored in numpy by sparse products: row offsets, buckets and counts of up to
``_TEXTS`` texts against a block, so the counts a task holds don't grow with its batches. A text passes through all blocks, which carry the best language so far and the sum of the
others, so any number of languages gives the result of one whole matrix.

A text that is null or has no letter is ``und`` with score 0; so is every text if nothing can be learned. Ties go to the
language that sorts first. Repeated rows count in training each time and are predicted each for itself. A very long text is counted in
steps of a million characters. An empty table gives an empty table. Only the id, text and lang columns are read; extra columns pass through `predict` and
`accepted`, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import fold, free_name, stored

BUCKETS = 1 << 13
BLOCK = 128
SMOOTHING = 0.1
UNKNOWN = "und"
_SHIFT = np.uint32(32 - 13)
_STEP = 1 << 20
#: Texts of one sparse matrix, and entries of a product, that are held at once.
_TEXTS, _ENTRIES = 256, 1 << 20
_M = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def ngram_counts(text: str) -> np.ndarray:
    """Counts by bucket of the 1- to 3-grams of a text."""
    out = np.zeros(BUCKETS, np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for i in range(0, len(code), _STEP):
        c = code[i : i + _STEP + 2]  # two more, so that n-grams across steps count
        h = c * _M[0]
        for order in range(3):
            if order:
                h = (h[: len(c) - order] ^ (h[: len(c) - order] >> np.uint32(15))) * _M[order] + c[order:]
                h = h * _M[0]
            # an n-gram belongs to the step in which it starts
            out += np.bincount((h[:_STEP] >> _SHIFT).astype(np.intp), minlength=BUCKETS)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def batch_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse rows of a batch: offsets (one more than texts), buckets and counts."""
    offsets, buckets, counts = [0], [], []
    for t in texts:
        n = ngram_counts(t)
        at = np.flatnonzero(n)
        offsets.append(offsets[-1] + len(at))
        buckets.append(at)
        counts.append(n[at])
    return np.array(offsets), np.concatenate([np.zeros(0, np.int64), *buckets]), np.concatenate([np.zeros(0, np.int64), *counts])


def sparse_product(offsets: np.ndarray, buckets: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(texts, languages): the sparse rows, none of them empty, times weight (buckets, languages)."""
    out = np.empty((len(offsets) - 1, weight.shape[1]))
    first, most = 0, max(_ENTRIES // weight.shape[1], 1)
    while first < len(out):
        last = max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1)
        a, b = offsets[first], offsets[last]
        out[first:last] = np.add.reduceat(counts[a:b, None] * weight[buckets[a:b]], offsets[first:last] - a)
        first = last
    return out


def batch_scores(texts: list[str], weight: np.ndarray) -> np.ndarray:
    """(texts, languages): log-probabilities; weight: (buckets and the log-prior, languages)."""
    return sparse_product(*batch_counts(texts), weight[:BUCKETS]) + weight[BUCKETS]


#: Languages and their (language, bucket) log-probabilities, with the log-prior in a last column, by blocks in the order of languages.
Model = list[tuple[list[str], np.ndarray]]


def train(rows: DataFrame) -> Model:
    """The model of rows (text, lang); rows with a null text or lang are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, x in sums.items():
                at = np.flatnonzero(x)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(x[at], pa.int64())], ["lang", "bucket", "n"])

        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if lang not in sums and len(sums) >= BLOCK:  # a task holds a block of languages at most
                    yield from counted()
                    sums.clear()
                x = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                x[:BUCKETS] += ngram_counts(text)
                x[BUCKETS] += 1
        yield from counted()

    known = rows.select("text", "lang").filter("text is not null and lang is not null")
    total = stored(known.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    texts = total.filter(F.col("bucket") == BUCKETS).select("lang", "n").collect()  # one row for each language
    langs, all_ = sorted(r.lang for r in texts), sum(r.n for r in texts)
    out = []
    for i in range(0, len(langs), BLOCK):
        names = langs[i : i + BLOCK]
        x = np.zeros((len(names), BUCKETS + 1))
        got = total.filter(F.col("lang").between(names[0], names[-1])).groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
        for r in got.toLocalIterator():
            x[names.index(r.lang), r.b] = r.n
        p = x[:, :BUCKETS] + SMOOTHING
        out.append((names, np.hstack([np.log(p / p.sum(1, keepdims=True)), np.log(x[:, BUCKETS:] / all_)])))
    return out


def predict(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str, str]:
    """docs with a predicted language and its posterior, and the names of these two columns."""
    pred, score, best, rest = (free_name(c, docs.columns) for c in ("lang_pred", "score", "best_so_far", "others_so_far"))
    place, width = docs.columns.index(text), len(docs.columns)
    none = F.lit(None)
    out = docs.withColumns({pred: none.cast("string"), best: none.cast("double"), rest: none.cast("double")})
    for names, weight in model:
        shared = docs.sparkSession.sparkContext.broadcast((names, np.ascontiguousarray(weight.T)))
        out = out.mapInArrow(_scorer(shared, place, width, out.columns), out.schema)
    known = F.col(pred).isNotNull()
    # the best one's share of the sum over all languages, both relative to the best
    out = out.withColumns({pred: F.coalesce(pred, F.lit(UNKNOWN)), score: F.when(known, 1 / F.col(rest)).otherwise(F.lit(0.0))})
    return out.select(*docs.columns, pred, score), pred, score


def _scorer(shared, place: int, width: int, names: list[str]):
    """Adds a block of languages to the last three columns: best language, its score, sum of exp(score - best)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weight = shared.value
        for b in batches:
            texts = b.column(place).to_pylist()
            at = [i for i, t in enumerate(texts) if has_letter(t)]
            pred, best, rest = (b.column(width + k).to_pylist() for k in range(3))
            if at:
                parts = [batch_scores([texts[i] for i in at[j : j + _TEXTS]], weight) for j in range(0, len(at), _TEXTS)]
                x = np.concatenate(parts)
                top = x.argmax(1)
                high = x[np.arange(len(at)), top]
                mass = np.exp(x - high[:, None]).sum(1)
                for i, k, h, m in zip(at, top.tolist(), high.tolist(), mass.tolist(), strict=True):
                    if pred[i] is None:
                        pred[i], best[i], rest[i] = langs[k], h, m
                    elif h > best[i]:
                        pred[i], best[i], rest[i] = langs[k], h, m + rest[i] * math.exp(best[i] - h)
                    else:
                        rest[i] += m * math.exp(h - best[i])
            new = [pa.array(pred, pa.string()), pa.array(best, pa.float64()), pa.array(rest, pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], *new], names)

    return run


def fit_on_fold(docs: DataFrame, k: int = 4, held_out: int = 2) -> Model:
    """Learn from the rows of docs whose fold of doc_id modulo k is not held_out."""
    return train(docs.filter(fold("doc_id", k) != held_out))


def identify(docs: DataFrame, k: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs."""
    model = fit_on_fold(docs, k, held_out)
    found, pred, score = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", k) == held_out).alias("held_out"), pred, score)


def accepted(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """The rows of docs with a language: not ``und``, and a posterior of at least min_score. The columns stay."""
    found, pred, score = predict(docs, fit_on_fold(docs))
    return found.filter((F.col(pred) != UNKNOWN) & (F.col(score) >= min_score)).drop(pred, score)
