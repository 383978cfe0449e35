import random
import re
from collections import Counter

import numpy as np
import pytest

from boxlake.llm import phrases
from tests.llm.data import EDGE, docs, prose

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=phrases.MIN_COUNT, top=phrases.TOP, nested=phrases.NESTED):
    f, total = {}, Counter()
    for _, t, lang, _ in rows:
        c = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for size in (1, 2, 3):
                c.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        found = []
        longer = Counter()
        for p, a in c.items():
            if len(p) == 3 and a >= least:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        for p, a in c.items():
            if len(p) == 1 or a < least or (len(p) == 2 and p in longer and 100 * longer[p] >= nested * a):
                continue
            cuts = [(1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def some(seed, n=60):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(40)] + ["Ünï", "DAS", "x" * 70, "y" * 90, "\xff"]
    runs = [[r.choice(vocab) for _ in range(r.randint(2, 4))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randint(0, 80)):
            words += r.choice(runs) if r.random() < 0.5 else [r.choice(vocab)]
        rows.append((i, "".join(w + r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0c"]) for w in words), r.choice(["en", "en", "de", None]), "s"))
    return rows


@pytest.mark.parametrize("words, pairs", [(phrases.WORDS, phrases.PAIRS), (15, phrases.PAIRS), (phrases.WORDS, 9), (7, 3)])
def test_matches_brute_force_at_all_bounds(spark, monkeypatch, words, pairs):
    if words < 20:
        monkeypatch.setattr(phrases, "CHUNK", 300)
    rows = [*EDGE, *some(words)]
    got = phrases.collocations(docs(spark, rows), least=5, words=words, pairs=pairs, top=50)
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got.columns == cols
    assert sorted(tuple(x) for x in got.collect()) == brute(rows, least=5, top=50)


def test_empty_and_default(spark):
    assert phrases.collocations(docs(spark, [])).count() == 0
    assert phrases.collocations(docs(spark, [(1, None, None, None), (2, " .. ", "en", "a")])).count() == 0
    rows = [(i, prose(i, 200), "en", "s") for i in range(20)]
    assert sorted(tuple(x) for x in phrases.collocations(docs(spark, rows)).collect()) == brute(rows)


def test_tiles():
    r = np.random.default_rng(1)
    t, want = phrases.Tiles(side=8, busy=2, fill=4, room=50), Counter()
    for n in (0, 3, 400, 200, 7):
        i, j = (r.zipf(1.4, n) % 60).astype(np.int64), (r.zipf(1.4, n) % 60).astype(np.int64)
        t.add(i, j)
        want.update(zip(i.tolist(), j.tolist(), strict=True))
    assert t.dense and t.lists
    got = Counter()
    for key, n in t.given():
        for k, c in zip(key.tolist(), n.tolist(), strict=True):
            got[k >> 32, k & 0xFFFFFFFF] += c
    assert got == want and not list(t.given())


def test_scores_are_exact(spark):
    rows = [(10**14, 10**14, 10**14), (99_999_999_999_999, 100_000_000_000_000, 99_999_999_999_999), (10, 30, 7000), (7, 7, 7)]
    got = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").select("a", "l", "r", phrases._score("a", "l", "r").alias("s")).collect()
    assert all(x.s == 1_000_000 * x.a * x.a // (x.l * x.r) for x in got)


def test_arguments(spark):
    with pytest.raises(ValueError):
        phrases.collocations(docs(spark, []), least=0)
