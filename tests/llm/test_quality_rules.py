import re
from collections import Counter

from boxlake.llm import quality_rules
from tests.llm.data import EDGE, docs, prose


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit |= set(range(i, i + 8))
    n, k = len(words), len(hit)
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), k, n < 20 or 100 * k > 30 * n


def test_base_counts_match_brute_force(spark):
    extra = [prose(1, 9) + " " + prose(2, 30) + " " + prose(1, 9), "a b c " * 40, "x\ny\n\nx\n \n \nx", "#a *b\r\n$%\x0b&|<>" * 9, prose(3, 50) + "\n" + prose(3, 50)]
    rows = [*EDGE, *((100 + i, t, "en", "s") for i, t in enumerate(extra))]
    got = quality_rules.judge(docs(spark, rows)).collect()
    key = lambda x: str(x)
    assert sorted(((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in got), key=key) == sorted(((i, *brute(t)) for i, t, *_ in rows), key=key)
    assert all(not x.kept for x in got if x.base_failed)


def test_divergence_separates(spark):
    good = [(i, prose(i, 200), "en", "s") for i in range(60)]
    odd = [(900, " ".join(f"{i}%{i * 7}" for i in range(200)), "en", "s"), (901, "ok " + prose(5, 25), "en", "s"), (902, odd_words(), None, "s")]
    got = {x.doc_id: x for x in quality_rules.judge(docs(spark, good + odd)).collect()}
    assert all(got[i].kept for i in range(60))
    assert not got[900].kept and got[901].kept and got[902].kept


def odd_words():
    return " ".join(f"{i}%{i * 7}" for i in range(200))


def test_distance(spark):
    F = quality_rules.F
    one = lambda *x: F.array(*(F.lit(float(v)) for v in x))
    row = spark.range(1).select(quality_rules.distance(one(2, 2), one(0.5, 0.5)).alias("a"), quality_rules.distance(one(3, 0), one(0, 1)).alias("b")).first()
    assert abs(row.a) < 1e-9 and abs(row.b - 1) < 1e-9


def test_empty(spark):
    assert quality_rules.judge(docs(spark, [])).count() == 0


def test_why_a_comparison_was_not_made(spark):
    rows = [*((i, prose(i, 100), "en", "s") for i in range(10)), (900, prose(900, 30), "en", "s"), (901, prose(901, 100), None, "s"), (902, None, "en", "s"), (903, odd_words(), "en", "s")]
    total = 10 * 100 + 30 + 200
    for limit, made in ((total, "made"), (total + 1, "no reference")):  # both sides of the limit
        got = {x.doc_id: x for x in quality_rules.judge(docs(spark, rows), limit).collect()}
        assert {got[i].word_test for i in range(10)} == {made} and {got[i].char_test for i in range(10)} == {"made"}
        assert (got[0].word_distance is None) == (made != "made")
        assert (got[900].word_test, got[902].word_test, got[902].char_test) == ("short", "short", "short")
        assert (got[901].word_test, got[901].char_test) == ("no reference", "no reference") and got[901].kept
    alone = quality_rules.judge(docs(spark, rows[:1]), total, docs(spark, rows)).first()
    assert alone == {x.doc_id: x for x in quality_rules.judge(docs(spark, rows), total).collect()}[0]


def test_language_of_long_words(spark):
    long = tuple(f"{w}zusammenhang" for w in ("alpha", "beta", "gamma", "delta", "eta", "theta", "iota", "kappa"))
    other = tuple(f"{w}verwandtschaft" for w in ("alpha", "beta", "gamma", "delta", "eta", "theta", "iota", "kappa"))
    rows = [*((i, prose(i, 200, long), "xx", "s") for i in range(60)), (900, prose(900, 200, other), "xx", "s")]
    got = {x.doc_id: x for x in quality_rules.judge(docs(spark, rows)).collect()}
    assert all(got[i].kept and got[i].word_distance < 0.3 for i in range(60))
    assert got[900].word_distance > 0.5 and not got[900].kept


def test_languages_beyond_the_broadcast(spark, monkeypatch):
    rows = [*EDGE, *((i, prose(i, 200), "en", "s") for i in range(20, 60)), *((i, prose(i, 90), f"l{i}", "s") for i in range(60, 70))]
    want = sorted(map(str, quality_rules.judge(docs(spark, rows)).collect()))
    monkeypatch.setattr(quality_rules, "BROADCAST_LANGS", 0)
    assert sorted(map(str, quality_rules.judge(docs(spark, rows)).collect())) == want
