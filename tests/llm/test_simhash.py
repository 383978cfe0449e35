import hashlib
import random

import xxhash

from boxlake.llm import simhash
from tests.llm.data import EDGE, docs, prose


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, min(ids, default=None)))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_fingerprints_match_brute_force():
    texts = [None, "", " ", "One", "one two", "One two THREE", prose(5, 2000), prose(6, 450), "a b " * 700, "é è ê ë à"]
    assert [simhash.fingerprint(t and t.encode()) for t in texts] == [brute_fingerprint(t) for t in texts]


def test_edge_rows(spark):
    got = simhash.near_duplicates(docs(spark, EDGE)).collect()
    rows = [(i, brute_fingerprint(t)) for i, t, *_ in EDGE]
    assert order((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == order((d, fp, c) for (d, fp), (_, c) in zip(rows, brute_components(rows), strict=True))
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_links_of_random_clusters_at_every_list_limit(spark):
    r = random.Random(3)
    fps = set()
    for _ in range(6):
        c = r.getrandbits(64)
        for _ in range(40):
            c ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 4)))  # chains, some of them broken
            fps.add(c)
    fps = sorted(fps)
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp bigint")
    want = {d: c for d, c in brute_components([(i, x) for i, x in enumerate(fps)])}
    groups = {}
    for i, c in want.items():
        groups.setdefault(c, set()).add(fps[i])
    for limit in (1024, 3):
        tied = simhash.components(simhash.links(frame, limit)).collect()
        root = {x.node % (1 << 64): x.root % (1 << 64) for x in tied}
        got = {}
        for x in fps:
            got.setdefault(root.get(x, x), set()).add(x)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_dense_list_is_split_exactly(spark):
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (x << 8) for x in range(1 << 8)} | {base ^ (1 << a) ^ (1 << b) for a in range(40, 64) for b in range(40, 64) if a != b})
    frame = spark.createDataFrame([(x,) for x in fps if x < 1 << 63], "fp bigint")
    n = frame.count()
    for limit in (2, 16, 4096):
        tied = simhash.components(simhash.links(frame, limit))
        assert tied.select("root").distinct().count() == 1
        assert tied.count() == n - 1


def test_keep_one(spark):
    rows = [*EDGE, (9, EDGE[3][1] + "", "en", "z")]
    kept = simhash.keep_one(docs(spark, rows))
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 4, 6, 7, 8, None], key=str)
    assert kept.columns == docs(spark, rows).columns


def brute_kept(rows):
    """(doc_id, text) of the row that stays of each component of fingerprints."""
    left = {}
    texts = sorted({t or "" for _, t, *_ in rows})
    fps = [(i, brute_fingerprint(t)) for i, t in enumerate(texts)]
    root = dict(brute_components(fps))
    for d, t, *_ in rows:
        digest = hashlib.sha256((t or "").encode()).digest()[:16]
        k = root[texts.index(t or "")]
        left.setdefault(k, []).append(((d is None, d or 0, digest), (d, t or "")))
    return sorted((min(x)[1] for x in left.values()), key=str)


def test_keep_one_with_repeated_and_null_ids_and_unlike_texts(spark):
    a, b, c = prose(1, 60), prose(900, 60), prose(901, 80)
    for rows in (
        [(4, a, "en", "s"), (4, b, "en", "s")],
        [(2, a, "en", "s"), (4, a, "en", "s"), (4, b, "en", "s")],
        [(5, a, "en", "s"), (None, a, "en", "s"), (None, b, "en", "s")],
        [(None, a, "en", "s"), (None, a, "de", "t"), (None, b, "en", "s"), (None, None, "en", "s"), (3, "", "en", "s")],
    ):
        got = simhash.keep_one(docs(spark, rows)).collect()
        assert sorted(((x.doc_id, x.text or "") for x in got), key=str) == brute_kept(rows)
    r = random.Random(4)
    rows = [(r.choice([None, *range(12)]), r.choice([a, b, c, None, "", prose(r.randrange(5), 40)]), r.choice(["en", None]), r.choice("st")) for _ in range(80)]
    want = brute_kept(rows)
    for order_ in (rows, rows[::-1]):
        got = simhash.keep_one(docs(spark, order_).repartition(3)).collect()
        assert sorted(((x.doc_id, x.text or "") for x in got), key=str) == want
        kinds = sorted(((x.doc_id, x.lang, x.source) for x in got), key=str)
    assert kinds == sorted(((x.doc_id, x.lang, x.source) for x in simhash.keep_one(docs(spark, rows)).collect()), key=str)
