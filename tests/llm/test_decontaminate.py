import hashlib
import random
import re

import pytest

from boxlake.llm import decontaminate
from tests.llm.data import EDGE, docs, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, window=10):
    ws, hit, found = words(text), set(), set()
    for k, t in items:
        iw = words(t)
        n = min(len(iw), window)
        if not n:
            continue
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(ws) - n + 1):
            if tuple(ws[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(k))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(ws), len(hit), len(found), digest, bool(hit)


def item_frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("window", [1, 3, 10])
def test_random_texts_match_brute_force(spark, window):
    r = random.Random(window)
    vocabulary = ["a", "b", "c", "Über", "d4"]
    say = lambda n: "-".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(r.choice([0, 1, 2, 5, 9, 10, 11, 14]))) for i in range(25)] + [(25, None), (3, "a b a b")]
    rows = [(i, say(r.choice([0, 1, 8, 30, 90])), "en", "s") for i in range(40)]
    got = decontaminate.report(docs(spark, rows), item_frame(spark, items), window).collect()
    assert sorted(tuple(x) for x in got) == sorted((i, *brute(t, items, window)) for i, t, *_ in rows)


def test_edge_rows_and_planted_passage(spark):
    passage = prose(77, 25, ("zeta", "eta", "theta", "iota", "kappa"))
    rows = [*EDGE, (90, prose(5, 30) + " " + passage.upper() + " " + prose(6, 30), "en", "s")]
    items = [(1, passage), (2, passage), (3, None), (None, "wholly other words of an item that nobody has ever written")]
    frame = docs(spark, rows)
    got = {x.doc_id: x for x in decontaminate.report(frame, item_frame(spark, items)).collect()}
    for i, t, *_ in rows:
        x = got[i]
        assert (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) == brute(t, items)
    kept = decontaminate.clean(frame, item_frame(spark, items))
    assert kept.columns == frame.columns and kept.count() == len(EDGE)
    cut = decontaminate.clean(frame, item_frame(spark, items), max_coverage=0.5).filter("doc_id = 90").first()
    assert words(cut.text) == words(prose(5, 30)) + words(prose(6, 30))
    assert decontaminate.report(docs(spark, []), item_frame(spark, items)).count() == 0
    assert decontaminate.report(frame, item_frame(spark, [])).filter("contaminated").count() == 0


def test_passes_and_blocks_give_the_same(spark, monkeypatch):
    items = [(i, prose(i, 12)) for i in range(30)]
    rows = [(i, prose(i % 35, 12) + " " + prose(i + 1, 40), "en", "s") for i in range(50)]
    one = sorted(tuple(x) for x in decontaminate.report(docs(spark, rows), item_frame(spark, items)).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 150)
    assert sorted(tuple(x) for x in decontaminate.report(docs(spark, rows), item_frame(spark, items)).collect()) == one
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 700)
    assert sorted(tuple(x) for x in decontaminate.report(docs(spark, rows), item_frame(spark, items)).collect()) == one


@pytest.mark.parametrize("window", [1, 3, 10])
def test_packed_automaton_equals_unpacked(window):
    r = random.Random(50 + window)
    say = lambda n: [r.choice([b"a", b"b", b"c", b"d"]) for _ in range(n)]
    items = [(str(i), say(r.choice([0, 1, 2, 5, 10, 11, 14]))) for i in range(30)]
    plain, packed = decontaminate.Automaton(items, window), decontaminate.Automaton(items, window).pack()
    for _ in range(200):
        ws = say(r.choice([0, 1, 9, 40]))
        assert packed.scan(ws) == plain.scan(ws)


def test_passes_over_edge_rows(spark, monkeypatch):
    items = [(i, prose(100 + i, 12)) for i in range(30)] + [(40, None), (41, "ünï cödé")]
    rows = [*EDGE, (None, prose(103, 12), "en", "s"), (60, prose(104, 12).upper() + " ÜNÏ x ünï Cödé 𝕏a b", None, "s"), (60, prose(1, 9) + " " + prose(105, 12) + " " + prose(2, 30), "en", "s")]
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 300)
    got = decontaminate.report(docs(spark, rows), item_frame(spark, items)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute(t, items)) for i, t, *_ in rows), key=str)
    cut = decontaminate.clean(docs(spark, rows), item_frame(spark, items), max_coverage=0.9)
    assert cut.count() == len(EDGE) + 2 and all(x.n_chars == len(x.text) for x in cut.filter("text is not null").collect())
    assert decontaminate.clean(docs(spark, rows), item_frame(spark, items)).count() == len(EDGE)
