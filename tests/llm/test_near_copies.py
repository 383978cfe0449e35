import random
from hashlib import sha256

from pyspark.sql import functions as F

import corpus_pipeline
from boxlake.llm import near_copies, simhash
from boxlake.llm.common import text_key
from tests.llm.data import EDGE, docs


def text(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def jaccard(a, b):
    a, b = (x.lower().split() for x in (a, b))
    a, b = ({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for w in (a, b))
    return len(a & b) / len(a | b)


def changed(words, similarity):
    """Words replaced one by one, five apart at least, down to the similarity."""
    out, at = list(words), 3
    while True:
        trial = list(out)
        trial[at] = f"x{at}"
        if jaccard(" ".join(words), " ".join(trial)) < similarity:
            return " ".join(out)
        out, at = trial, at + 7


def test_planted_copies_go_and_others_stay(spark):
    rows, copies, apart = [], set(), set()
    for i in range(60):
        words = text(i, 300)
        rows.append((i, " ".join(words), "en", "s"))
        for k, s in enumerate((0.8, 0.85, 0.9, 0.95)):
            rows.append((1000 + 10 * i + k, changed(words, s), "en", "s"))
            assert s <= jaccard(rows[-1][1], rows[-k - 2][1]) < s + 0.05
            copies.add(rows[-1][0])
        far = words[:210] + text(5000 + i, 90)
        rows.append((9000 + i, " ".join(far), "en", "s"))
        assert 0.4 < jaccard(rows[-1][1], " ".join(words)) < 0.8
        apart.add(9000 + i)
    kept = {x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs(spark, rows), "").collect()}
    assert kept == set(range(60)) | apart
    eight = {x.doc_id for x in simhash.keep_one(docs(spark, rows)).collect()}
    assert len(eight & copies) > 60  # op8's contract of 3 bits is another one


def grouped(spark, rows):
    """Texts of each component, as sets of sets."""
    frame = docs(spark, rows)
    got = near_copies.groups(frame).join(frame.select(text_key("text").alias("key"), F.coalesce("text", F.lit("")).alias("t")).distinct(), "key")
    out = {}
    for x in got.collect():
        out.setdefault(bytes(x.root), set()).add(x.t)
    return sorted(map(sorted, out.values()))


def brute_groups(texts):
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a in texts:
        for b in texts:
            if a < b and jaccard(a, b) >= 0.8:
                parent[find(a)] = find(b)
    out = {}
    for t in texts:
        out.setdefault(find(t), set()).add(t)
    return sorted(map(sorted, out.values()))


def brute_kept(rows):
    """One row of each component: the least id, null ids last, then the least digest of the text."""
    out = []
    for group in brute_groups({x[1] or "" for x in rows}):
        out.append(min((x for x in rows if (x[1] or "") in group), key=lambda x: (x[0] is None, x[0] or 0, sha256((x[1] or "").encode()).digest()[:16])))
    return out


def test_chains_within_a_bucket(spark):
    words, rows = text(1, 200), []
    for i in range(40):  # each is like its neighbours only
        words = [f"c{i}.{k}" if 4 * i <= k < 4 * i + 4 else w for k, w in enumerate(words)]
        rows.append((i, " ".join(words), "en", "s"))
    assert jaccard(rows[0][1], rows[39][1]) < 0.2 and jaccard(rows[0][1], rows[1][1]) > 0.9
    assert len(grouped(spark, rows)) == 1


def test_a_hot_family_equals_brute_force_at_every_block_size(spark, monkeypatch):
    r = random.Random(8)
    base, rows = text(2, 120), []
    for i in range(150):  # near the limit: many pairs of a bucket are alike, many aren't
        words = list(base)
        for k in r.sample(range(120), r.randint(0, 5)):
            words[k] = f"y{r.randrange(40)}"
        rows.append((i, " ".join(words), "en", "s"))
    want = brute_groups({x[1] for x in rows})
    assert 5 < len(want) < 100
    assert grouped(spark, rows) == want
    monkeypatch.setattr(near_copies, "compared", lambda rest, sets, f=near_copies.compared: f(rest, sets, 16))
    assert grouped(spark, rows) == want


def test_a_large_group_is_posted_in_few_lists_and_loses_no_link(spark, monkeypatch):
    r = random.Random(9)
    base, rows, posted = text(4, 120), [], []
    for i in range(200):  # texts of many roots in one union
        words = list(base)
        for k in r.sample(range(120), r.randint(0, 7)):
            words[k] = f"y{r.randrange(40)}"
        rows.append((i, " ".join(words), "en", "s"))
    rows += [(300 + i, changed(text(700 + i // 2, 120), 0.85) if i % 2 else " ".join(text(700 + i // 2, 120)), "en", "s") for i in range(40)]

    def counted(texts, f=near_copies.clusters):
        out = f(texts)
        posted.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "clusters", counted)
    want = brute_groups({x[1] for x in rows})
    assert len(want) > 30
    assert grouped(spark, rows) == want
    assert sum(posted) < 30 * len(rows)  # 96 lists in all


def test_buckets_and_unions_give_the_same_groups(spark, monkeypatch):
    words, rows = text(5, 200), []
    for i in range(60):  # neighbours are alike, in buckets that overlap
        words = [f"c{i}.{k}" if 5 * i % 200 <= k < 5 * i % 200 + 5 + i % 9 else w for k, w in enumerate(words)]
        rows.append((i, " ".join(words), "en", "s"))
    want = brute_groups({x[1] for x in rows})
    for share in (0.0, 1e9):
        monkeypatch.setattr(near_copies, "unions", lambda near, _, s=share, f=near_copies.unions: f(near, s))
        assert grouped(spark, rows) == want
        monkeypatch.undo()


def test_edge_rows(spark):
    rows = [*EDGE, (9, "One two", "en", "z"), (10, " one\tTWO ", "en", "z"), (11, "one two three", "en", "z")]
    assert grouped(spark, rows) == brute_groups({x[1] or "" for x in rows})
    assert near_copies.groups(docs(spark, [])).count() == 0
    ids = sorted(x.doc_id if x.doc_id is not None else -1 for x in simhash.keep_one(docs(spark, rows), near_copies.groups(docs(spark, rows))).collect())
    assert ids == [-1, 1, 4, 6, 7, 8, 9, 11]
