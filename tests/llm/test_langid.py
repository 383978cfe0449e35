import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from boxlake.llm import langid
from tests.llm.data import EDGE, docs, prose

DE = ("der", "die", "und", "nicht", "schön", "über", "straße", "zwei")
FR = ("le", "élève", "dans", "où", "être", "ça", "vous", "garçon")


def rows():
    out = [(i, prose(i, 30), "en", "a") for i in range(100, 140)]
    out += [(i, prose(i, 30, DE), "de", "a") for i in range(200, 240)]
    return out + [(i, prose(i, 30, FR), "fr", "a") for i in range(300, 340)]


def test_counts_do_not_depend_on_steps(monkeypatch):
    text = prose(4, 500, FR)
    whole = langid.ngram_counts(text)
    assert whole.sum() == 3 * len(text) - 3
    monkeypatch.setattr(langid, "_STEP", 7)
    assert (langid.ngram_counts(text) == whole).all()


def test_held_out_accuracy(spark):
    frame = docs(spark, rows())
    got = langid.identify(frame).join(frame.select("doc_id", "lang"), "doc_id").collect()
    held = [x for x in got if x.held_out]
    assert len(held) > 10 and all(x.lang_pred == x.lang and x.score > 0.9 for x in held)


def test_edge_rows(spark):
    frame = docs(spark, [*rows(), *EDGE, (50, "123 456 !?", "en", "a")])
    got = langid.identify(frame).collect()
    assert len(got) == frame.count()
    for x in got:
        if x.doc_id in (1, 2, 3, 50):
            assert (x.lang_pred, x.score) == ("und", 0.0)
        else:
            assert x.lang_pred in ("en", "de", "fr") and 0 <= x.score <= 1
    kept = langid.accepted(frame)
    assert kept.columns == frame.columns
    assert not {1, 2, 3, 50} & {x.doc_id for x in kept.collect()} and kept.count() == frame.count() - 4


def test_nothing_to_learn(spark):
    got = langid.identify(docs(spark, [(i, t, None, s) for i, t, _, s in EDGE])).collect()
    assert {x.lang_pred for x in got} == {"und"}
    assert langid.identify(docs(spark, [])).count() == 0


def bucket(gram):
    """The hash of an n-gram, code point by code point in 32 bits."""
    low = (1 << 32) - 1
    h = ord(gram[0]) * 0x9E3779B1 & low
    for k, c in enumerate(gram[1:], 1):
        h = ((h ^ h >> 15) * (0x85EBCA77, 0xC2B2AE3D)[k - 1] + ord(c)) * 0x9E3779B1 & low
    return h >> 19


def brute(rows, train):
    """(doc_id, language, score) by exact dictionaries."""
    grams = lambda t: Counter(bucket(t.lower()[i : i + n]) for n in (1, 2, 3) for i in range(len(t.lower()) - n + 1))
    counts, texts = defaultdict(Counter), Counter()
    for i, t, la, *_ in rows:
        if t is not None and la is not None and train(i):
            counts[la] += grams(t)
            texts[la] += 1
    out = []
    for i, t, *_ in rows:
        if t is None or not any(c.isalpha() for c in t) or not texts:
            out.append((i, "und", 0.0))
            continue
        x = {}
        for la in sorted(texts):
            total = sum(counts[la].values()) + langid.SMOOTHING * langid.BUCKETS
            x[la] = math.log(texts[la] / sum(texts.values())) + sum(n * math.log((counts[la][b] + langid.SMOOTHING) / total) for b, n in grams(t).items())
        best = max(x, key=lambda la: x[la])
        out.append((i, best, 1 / sum(math.exp(v - x[best]) for v in x.values())))
    return out


@pytest.mark.parametrize("block", [128, 2, 1])
def test_scores_match_exact_dictionaries_at_every_block(spark, monkeypatch, block):
    import zlib

    r = random.Random(2)
    monkeypatch.setattr(langid, "BLOCK", block)
    monkeypatch.setattr(langid, "_ENTRIES", 1 << 12)
    monkeypatch.setattr(langid, "_TEXTS", 7)
    made = [(i, prose(i, r.randint(1, 12), r.choice([DE, FR, ("a", "ab", "ba")])), r.choice(["de", "fr", "xx", "yy", "zz", None]), "s") for i in range(80)]
    made += [(7, prose(3, 5, DE), "de", "s"), (7, prose(3, 5, DE), "de", "s"), (None, "über", "fr", "s"), (81, "", "de", "s"), (82, "12", "fr", "s"), (83, None, "de", "s")]
    want = brute(made, lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 4 != 2)
    got = langid.identify(docs(spark, made)).collect()
    for a, b in zip(sorted(((x.doc_id, x.lang_pred, x.score) for x in got), key=str), sorted(want, key=str), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6


def test_many_languages(spark):
    """More than a block, and than any matrix that was once the limit."""
    made = [(i, f"w{i:04d} " * 5, f"l{i:04d}", "s") for i in range(1200)]
    model = langid.train(docs(spark, made))
    assert [len(names) for names, _ in model] == [128] * 9 + [48]
    found, pred, _ = langid.predict(docs(spark, made[::40]), model)
    assert all(x[pred] == x.lang for x in found.collect())


def test_sparse_product():
    offsets, buckets, counts = langid.batch_counts(["abc", "b", "straße"])
    weight = np.random.default_rng(1).normal(size=(langid.BUCKETS, 3))
    want = [langid.ngram_counts(t) @ weight for t in ("abc", "b", "straße")]
    assert np.allclose(langid.sparse_product(offsets, buckets, counts, weight), want)
