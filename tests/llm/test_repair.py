import hashlib
import random
import re
import zlib
from itertools import count

import pytest

from boxlake.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, audit string, key string"
BLANKS = " \t\n\x0b\f\r"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def brute_edits(rows):
    """The least (cost, audit) over all edit sequences, by a search over all of them with at most three inserts in a row."""
    best = [None]

    def go(i, made, cost, audit, inserted):
        if best[0] is not None and cost > best[0][0]:
            return
        roles = "".join(r for r, _ in made)
        if not re.fullmatch(r"(s?(ua)*u?)?", roles):
            return
        if i == len(rows):
            if re.fullmatch(r"(s?(ua)+)?", roles) and (best[0] is None or (cost, audit) < best[0][:2]):
                best[0] = (cost, audit, made)
        else:
            role, text, must_go, more = rows[i]
            go(i + 1, made, cost + 2, audit + "D", 0)
            if not must_go:
                go(i + 1, [*made, (role[:1], f"{role}:{text}")], cost + more, audit + "K", 0)
                for new in ("user", "assistant"):
                    go(i + 1, [*made, (new[0], f"{new}:{text}")], cost + more + 1, audit + "R", 0)
        if inserted < 3:
            for new in ("user", "assistant"):
                go(i, [*made, (new[0], f"{new}:")], cost + 5, audit + "I", inserted + 1)

    go(0, [], 0, "", 0)
    return best[0]


def by_levels(rows, start=repair.START, ends=repair.ENDS, tail=True):
    """Least (cost, audit) by a plain pass over the rows: an independent model of long conversations."""
    labels = {start: (0, "")}

    def better(to, s, label):
        if s not in to or label < to[s]:
            to[s] = label

    def inserts(labels):
        out = dict(labels)
        for _ in range(3):
            for s, (c, w) in list(out.items()):
                better(out, repair.NEXT[s], (c + 5, w + "I"))
        return out

    for initial, must_go, more in rows:
        new = {}
        for s, (c, w) in inserts(labels).items():
            better(new, s, (c + 2, w + "D"))
            if not must_go:
                better(new, repair.NEXT[s], (c + 1 + more, w + "R"))
                if (s, initial) in repair.KEEP:
                    better(new, repair.KEEP[s, initial], (c + more, w + "K"))
        labels = new
    if tail:
        labels = inserts(labels)
    return min((labels[s] for s in ends if s in labels), default=None)


def brute(rows, searched=True):
    """rows: (conv_id, turn, role, text) before damage; one result a conversation."""
    out = []
    one = lambda x: " " if x is None else str(x)
    for conv in {r[0] for r in rows}:
        made = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = one(role), one(text)
            pick = zlib.crc32(f"{one(c)}:{one(turn)}".encode()) % 20
            if pick == 0:
                continue
            text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
            role = "user" if pick == 4 else role
            made += [(turn, role, text)] * (2 if pick == 3 else 1)
        made.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
        turns = {t for t, *_ in made if t is not None}
        seen, steps, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in made:
            shown = text.rstrip(BLANKS)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            steps.append((role, text, fault in ("blank", "duplicate"), 5 if fault == "truncated" else 0))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(made, made[1:]))
        if searched:
            cost, audit, lines = brute_edits(steps)
            lines = [x for _, x in lines]
        else:
            cost, audit = by_levels([(r[:1], g, m) for r, _, g, m in steps])
            lines = [f"{r}:{t}" for r, t in repair.repaired(audit, [(r, t) for r, t, *_ in steps], repair.START)]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def some(seed, convs, most):
    r = random.Random(seed)
    texts = ["Good.", "Why?", "no end", "", "  \n", "A. B", "Yes! ", None, "again."]
    rows = []
    for c in range(convs):
        at = count()
        for _ in range(r.randint(1, most)):
            turn = r.choice([next(at), next(at), next(at) + r.randint(0, 2), None])
            rows.append((c if c else None, turn, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), r.choice(texts)))
    return rows


def test_matches_a_search_of_all_edits(spark):
    rows = some(3, 60, 4)
    got = repair.report(table(spark, rows)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(rows)


@pytest.mark.parametrize("segment", [1, 3, 256])
def test_long_conversations_in_segments(spark, segment):
    rows = [*some(5, 25, 9), *((99, t, r, x) for _, t, r, x in some(6, 1, 700)), (98, None, None, None)]
    frame = table(spark, rows).repartition(5)
    got = repair.repair(repair.damaged(frame), frame.select("conv_id"), segment).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(rows, searched=False)


def test_search_from_both_ends():
    r = random.Random(1)
    for _ in range(400):
        rows = [(r.choice("uasx"), r.random() < 0.2, r.choice([0, 0, 5])) for _ in range(r.randint(0, 30))]
        assert repair.cheapest(rows) == by_levels(rows)
        if rows:
            for a in range(4):
                for b in range(4):
                    assert repair.cheapest(rows, a, (b,), False) == by_levels(rows, a, (b,), False)


def test_edges(spark):
    assert repair.report(table(spark, [])).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.report(table(spark, [(gone, 0, "user", "Hi.")])).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    with pytest.raises(ValueError):
        repair.repair(table(spark, []), table(spark, []), 0)
