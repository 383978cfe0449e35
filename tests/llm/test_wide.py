"""The near-duplicate stage's index over wide fingerprints."""

import random

import numpy as np
import pytest

import corpus_pipeline
from boxlake.llm import near_copies, simhash
from tests.llm.data import docs
from tests.llm.test_near_copies import changed, jaccard, text

MASK = (1 << 64) - 1


def brute_votes(hashes):
    votes = []
    for f in simhash._RANDOM[: simhash.WORDS].tolist():
        words = []
        for h in hashes:
            x = h * f & MASK
            x = (x ^ x >> 32) * int(simhash._MIX) & MASK
            words.append(x ^ x >> 29)
        votes.append(sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in words) > len(words)))
    return b"".join(v.to_bytes(8, "little") for v in votes)


def brute_wide(hashes):
    fine = []
    for h in hashes:
        for f in simhash._RANDOM[simhash.WORDS :].tolist():
            x = h * f & MASK
            fine.append((x ^ x >> 32) * int(simhash._MIX) & MASK)
    return (brute_votes(hashes) if len(hashes) >= 32 else b"") + (brute_votes(fine) if len(hashes) <= 40 else b"")


@pytest.mark.parametrize("n", [1, 4, 31, 32, 40, 41, 255, 256, 700])
def test_fingerprints_match_brute_force(n):
    hashes = [random.Random(n).getrandbits(64) for _ in range(n)]
    assert simhash.wide(np.array(hashes, np.uint64)) == brute_wide(hashes)


def test_bits_of_similar_sets_differ_as_stated():
    r, unlike = np.random.default_rng(1), []
    for _ in range(100):
        x = r.integers(0, 1 << 64, 100, np.uint64)
        a, b = (np.frombuffer(simhash.wide(s), np.uint8) for s in (x[:90], x[10:]))  # similarity 0.8
        unlike.append(np.bitwise_count(a ^ b).sum() / len(a) / 8)
    assert 0.145 < np.mean(unlike) < 0.16


def parts(fp):
    bits = int.from_bytes(fp[24:], "little")
    return [bits >> 12 * k & 0xFFF for k in range(96)]


def test_clusters_hold_every_pair_of_a_list_at_every_limit(spark):
    r, fps = random.Random(5), []
    for family in range(6):
        base = r.getrandbits(1344)
        for _ in range(30 if family else 90):  # near the limit of 56 of 192 bits, a hot one and others
            fps.append(base ^ sum(1 << k for k in range(1344) if r.random() < (0.16 if family % 2 else 0.04)))
    fps += [fps[0], fps[1]]
    fps = [x.to_bytes(168, "little") for x in fps]
    n = len(fps)
    frame = spark.createDataFrame([(i.to_bytes(2), 100, 1, fp) for i, fp in enumerate(fps)], "key binary, n int, copies bigint, fp binary")
    sketch = [int.from_bytes(fp[:24], "little") for fp in fps]
    part = [parts(fp) for fp in fps]

    def alike(x):
        return x.bit_count() <= 56 and sum(x >> 4 * k & 15 == 0 for k in range(48)) >= 8

    near = {(i, j) for i in range(n) for j in range(i) if alike(sketch[i] ^ sketch[j])}
    want = {(i, j) for i, j in near if any(x == y for x, y in zip(part[i], part[j], strict=True))}
    assert len(near) > len(want) > 1000
    for longest, block in ((1 << 14, 1 << 13), (7, 3), (40, 16)):
        held = {}
        for x in simhash.clusters(frame, 56, longest, block).collect():
            held.setdefault(x.h, set()).add(int.from_bytes(x.key))
        got = {(i, j) for s in held.values() for i in s for j in s if j < i}
        assert want <= got
        assert all(i // 30 == j // 30 or i < 90 or i >= n - 2 for i, j in got)  # clusters join no families


def test_a_later_call_holds_every_pair_of_unlike_roots(spark):
    r, fps = random.Random(6), []
    for _ in range(5):
        base = r.getrandbits(1344)
        fps += [base ^ sum(1 << k for k in range(1344) if r.random() < 0.08) for _ in range(40)]
    fps = [x.to_bytes(168, "little") for x in fps]
    n = len(fps)
    root = [[b"a", b"b" if i % 40 < 3 else b"c", None, b"d" if i % 40 else None, b"e"][i // 40] for i in range(n)]
    frame = spark.createDataFrame([(i.to_bytes(2), 100, 1, fp, root[i]) for i, fp in enumerate(fps)], "key binary, n int, copies bigint, fp binary, root binary")
    frame = frame.withColumn("fp", simhash.posting_words(3, 18))
    sketch, part = [int.from_bytes(fp[:24], "little") for fp in fps], [parts(fp)[16:] for fp in fps]

    def alike(x):
        return x.bit_count() <= 56 and sum(x >> 4 * k & 15 == 0 for k in range(48)) >= 8

    near = {(i, j) for i in range(n) for j in range(i) if alike(sketch[i] ^ sketch[j]) and (root[i] is None or root[i] != root[j])}
    want = {(i, j) for i, j in near if any(x == y for x, y in zip(part[i], part[j], strict=True))}
    assert len(want) > 500
    for longest, block in ((1 << 14, 1 << 13), (7, 3)):
        held = {}
        for x in simhash.clusters(frame, 56, longest, block).collect():
            held.setdefault(x.h, set()).add(int.from_bytes(x.key))
        assert want <= {(i, j) for s in held.values() for i in s for j in s if j < i}
        assert all(i // 40 not in (0, 4) for s in held.values() for i in s)  # nothing is left to do there


def test_short_texts_and_both_kinds_of_fingerprints_lose_no_copy(spark):
    rows, copies = [], set()
    for i in range(240):
        words = text(9000 + i, (8, 20, 36, 40, 44, 60)[i % 6])
        other = changed(words, 0.8) if len(words) > 30 else " ".join([*words, "more"])
        assert jaccard(" ".join(words), other) >= 0.8
        rows += [(i, " ".join(words), "en", "s"), (1000 + i, other, "en", "s")]
        copies.add(1000 + i)
    kept = {x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs(spark, rows), "").collect()}
    assert kept == set(range(240))


def test_the_stage_links_what_the_index_finds(spark, monkeypatch):
    words = text(3, 300)
    rows = [(1, " ".join(words), "en", "s"), (2, " ".join(words), "en", "s"), (3, changed(words, 0.85), "en", "s")]
    assert {x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs(spark, rows), "").collect()} == {1}
    monkeypatch.setattr(near_copies, "clusters", lambda texts: simhash.clusters(texts, -1))
    assert {x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs(spark, rows), "").collect()} == {1, 3}
