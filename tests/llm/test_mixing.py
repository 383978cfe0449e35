import random
from collections import defaultdict
from hashlib import md5

from boxlake.llm import mixing
from tests.llm.data import EDGE, docs, prose


def weigh(level, name):
    return mixing.WEIGHTS[level].get(name, 1)


def fill(budget, children, level):
    """name -> cap; shares by repeated proportional filling."""
    given, open_ = dict.fromkeys(children, 0.0), set(children)
    left = budget
    while open_ and left > 1e-9:
        w = sum(weigh(level, c) for c in open_)
        full = {c for c in open_ if children[c] <= left * weigh(level, c) / w + 1e-9}
        if not full:
            for c in open_:
                given[c] = left * weigh(level, c) / w
            break
        for c in full:
            given[c] = children[c]
        left -= sum(children[c] for c in full)
        open_ -= full
    return {c: int(x + 1e-6) for c, x in given.items()}


def domain(source):
    return f"domain{int(md5((source or '').encode()).hexdigest()[:6], 16) % 3}"


def brute(rows, share=0.5, epochs=2):
    leaves = defaultdict(list)
    for i, t, la, so in rows:
        leaves[domain(so), la or "", so or ""].append((i, len((t or "").split())))
    tokens = {k: sum(n for _, n in v) for k, v in leaves.items()}
    cap = defaultdict(int)
    for k, t in tokens.items():
        for depth in range(1, 4):
            cap[k[:depth]] += t * epochs
    given = {(): int(share * sum(tokens.values()))}
    for depth, level in enumerate(mixing.LEVELS):
        for parent in [k for k in given if len(k) == depth]:
            kids = {k[depth]: c for k, c in cap.items() if len(k) == depth + 1 and k[:depth] == parent and c}
            for name, x in fill(given[parent], kids, level).items():
                given[(*parent, name)] = x
    out = []
    for k, members in leaves.items():
        b, t = given.get(k, 0), tokens[k]
        e, rest = divmod(b, t) if t else (0, 0)
        out += [(i, n, x) for x in range(1, e + 1) for i, n in members]
        by_order = defaultdict(list)
        for i, n in members:
            by_order[md5(f"42|{e + 1}|{'' if i is None else i}".encode()).hexdigest()].append((i, n))
        for h in sorted(by_order):
            rest -= sum(n for _, n in by_order[h])
            if rest < 0 or b == e * t:
                break
            out += [(i, n, e + 1) for i, n in by_order[h]]
    return sorted(out, key=str)


def selected(spark, rows):
    return sorted(((x.doc_id, x.n_tokens, x.epoch) for x in mixing.mixture(docs(spark, rows)).collect()), key=str)


def test_matches_brute_force(spark, monkeypatch):
    r = random.Random(9)
    rows = [(i, prose(i, r.randint(0, 60)), r.choice(["en", "en", "en", "de", "es", None]), r.choice(["src0"] * 4 + ["src1", "src2", "src3", None])) for i in range(300)]
    want = brute(rows)
    assert want and {e for *_, e in want} > {1}
    assert selected(spark, rows) == want
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 0)
    assert selected(spark, rows) == want


def test_edge_rows(spark):
    assert selected(spark, EDGE) == brute(EDGE)
    assert selected(spark, []) == []
    assert selected(spark, [(1, None, "en", "a"), (2, "", "en", "a")]) == []
    rows, _, epoch = mixing.select(docs(spark, EDGE))
    assert rows.columns == [*docs(spark, []).columns, epoch] and epoch == "epoch_"


def test_shortages_go_to_siblings_first(spark):
    rows = [(1, prose(1, 100), "en", "src1"), (2, prose(2, 1), "en", "src2"), (3, prose(3, 400), "de", "src1"), (4, prose(4, 400), "fr", "src1")]
    _, plan, _ = mixing.select(docs(spark, rows), weights={"domain": {}, "lang": {}, "source": {}}, domain=mixing.F.lit("d"))
    got = {(x.lang, x.source): x.budget for x in plan.collect()}
    total = int(0.5 * 901)
    assert got["en", "src2"] == 2 and got["en", "src1"] == total // 3 - 2  # the sibling takes what src2 lacks
    assert got["de", "src1"] == got["fr", "src1"] == total // 3
