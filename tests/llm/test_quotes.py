import random
import unicodedata

from boxlake.llm import quotes


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, path string, body string")


def as_tuples(df):
    return sorted(((x.conv_id, x.turn, x.body, x.reply_to, x.thread, x.depth, x.n_linked) for x in df.collect()), key=str)


def plain_parse(text):
    """Own words and passages (level, lines), by walking over characters."""
    own, passages, fence, level = [], [], False, 0
    for line in (text or "").split("\n"):
        at = n = end = 0
        while not fence:
            while at < len(line) and line[at] in " \t":
                at += 1
            if at == len(line) or line[at] != ">":
                break
            at, n = at + 1, n + 1
            end = at + (line[at : at + 1] == " ")
        if not n:
            if line.lstrip(" \t")[:3] in ("```", "~~~"):
                fence = not fence
            own.append(line)
        else:
            if n != level:
                passages.append((n, []))
                last = own[-1].rstrip(" \t") if own and not level else ""
                if last.endswith(":") and (last.startswith("On ") and last[:-1].rstrip(" \t").endswith(" wrote")):
                    own.pop()
            passages[-1][1].append(line[end:])
        level = n
    return "\n".join(own).strip(), passages


def plain_parts(lines):
    """The passage, its paragraphs and its lines by their normalised text itself, with its size."""
    same = lambda x: " ".join(unicodedata.normalize("NFKC", x).casefold().split())
    blocks = "\n".join(x if x.strip() else "" for x in lines).split("\n\n")
    out = {same("\n".join(lines))} | {same(x) for x in blocks} | {same(x) for x in lines}
    return {x: len(x) for x in out if x}


def brute(rows):
    """Earliest earlier message with the passage, its paragraph or line; most characters win."""
    own, said = {}, []
    for c, t, _, text in rows:
        body, passages = plain_parse(text)
        said.append((c, t, body, passages))
        if t is not None and c is not None:
            for k in plain_parts(body.split("\n")):
                own[c, k] = min(own.get((c, k), t), t)
    parent, linked = {}, {}
    for c, t, _, _ in said:
        votes, hit = {}, {}
        for c2, t2, _, passages in said:
            if (c2, t2) != (c, t) or c is None or t is None:
                continue
            seen = set()
            for i, (level, lines) in enumerate(passages):
                for k, size in plain_parts(lines).items():
                    o = own.get((c, k))
                    if o is not None and o < t and (level, i, k) not in seen:
                        seen.add((level, i, k))
                        votes.setdefault(level, {}).setdefault(o, set()).add((level, i, k, size))
                        hit.setdefault(level, set()).add(i)
        if votes:
            sums = {o: sum(s for *_, s in v) for o, v in votes[min(votes)].items()}
            parent[c, t] = max(sums, key=lambda o: (sums[o], o))
            linked[c, t] = sum(map(len, hit.values()))
    out = []
    for c, t, body, _ in said:
        at, depth = t, 0
        while (c, at) in parent:
            at, depth = parent[c, at], depth + 1
        out.append((c, t, body, parent.get((c, t)), at, depth, linked.get((c, t), 0)))
    return sorted(out, key=str)


THREAD = [
    (1, 0, "user", "First line.\nSecond line.\n\nA paragraph of its own."),
    (1, 1, "assistant", "On Monday A wrote:\n> First line.\n> Second line.\n\nReply one."),
    (1, 2, "user", "> > first   LINE.\n> Reply one.\n\nReply two.\n```\n> not a quote\n```"),
    (1, 3, "user", "> A paragraph of its own.\n\nBranch."),
    (1, 4, "assistant", "> Nobody said this.\nAlone."),
    (1, 5, "user", "> Reply two.\n> ```\n> not a quote\nAfter."),
    (2, 0, "user", "First line."),
    (2, 1, None, None),
    (2, 1, "user", "> First line.\nA twin turn."),
    (None, 1, "user", "> First line."),
    (2, None, "user", "> First line."),
]


def test_thread(spark):
    got = quotes.conversations(frame(spark, THREAD))
    assert as_tuples(got) == brute(THREAD)
    by = {(x.conv_id, x.turn): x for x in got.collect()}
    assert by[1, 1].body == "Reply one." and by[1, 1].reply_to == 0
    assert by[1, 2].reply_to == 1 and (by[1, 2].thread, by[1, 2].depth) == (0, 2) and by[1, 2].n_quotes == 2
    assert by[1, 3].reply_to == 0 and by[1, 4].reply_to is None
    text = quotes.chat(frame(spark, THREAD).filter("conv_id = 1")).select("turn").collect()
    assert [x.turn for x in text] == [0, 1, 2, 5, 3, 4]


def test_random_threads_match_brute_force(spark):
    r = random.Random(2)
    rows = []
    for c in range(5):
        texts = []
        for t in range(25):
            said = f"words {r.randint(0, 12)} of {c}\nline {r.randint(0, 5)}"
            quoted = []
            for _ in range(r.randint(0, 2)):
                if texts:
                    quoted += ["> " + x for x in r.choice(texts).split("\n")]
            texts.append("\n".join([*quoted, said]))
            rows.append((c, t, "user", texts[-1]))
    assert as_tuples(quotes.conversations(frame(spark, rows))) == brute(rows)


def in_reply_order(rows):
    """(thread, turn) depth first, answers by turn; rows: (turn, reply_to)."""
    answers = {}
    for t, up in rows:
        answers.setdefault(up, set()).add(t)
    out = []
    for root in sorted(answers.get(None, ())):
        waiting = [root]
        while waiting:
            t = waiting.pop()
            out.append((root, t))
            waiting += sorted(answers.get(t, ()), reverse=True)
    return out


def test_reply_order_of_branches(spark, monkeypatch):
    named = [(1, 0, "user", "A"), (1, 1, "user", "> A\nB"), (1, 2, "user", "> A\nC"), (1, 3, "user", "> B\nD"), (1, 4, "user", "> C\nE"), (1, 5, "user", "alone")]
    got = quotes.chat(frame(spark, named)).select("turn", "position", "chat").collect()
    assert [x.turn for x in got] == [0, 1, 3, 2, 4, 5] and [x.position for x in got] == [0, 1, 2, 3, 4, 0] and got[1].chat == "<|user|>\nB"
    r = random.Random(9)
    rows = []
    for c in range(6):
        for t in range(60):
            up = r.choice([None, 0, r.randrange(t), t - 1]) if t else None
            rows.append((c, t * 5, "user", f"m{c}-{t}" if up is None else f"> m{c}-{up}\nm{c}-{t}"))
    for bits in (16, 3):  # all answers in one range, and in many
        monkeypatch.setattr(quotes, "TURN_BITS", bits)
        got = quotes.chat(frame(spark, rows)).select("conv_id", "turn", "reply_to", "thread").collect()
        for c in range(6):
            mine = [x for x in got if x.conv_id == c]
            assert [(x.thread, x.turn) for x in mine] == in_reply_order([(x.turn, x.reply_to) for x in mine])


def test_attributions_and_fences():
    for named in ("On Monday, A wrote:", "On Monday, 1 May at 10:00\nA <a@example.org> wrote:", "On Monday,\n1 May at 10:00, A\n<a@example.org> wrote:", "Le lundi 1 mai,\nA a écrit :", "A writes:"):
        for blank in ("\n", "\n\n", "\n \n\n"):
            assert quotes.parse(f"Hello.\n\n{named}{blank}> First.\nMine.") == ("Hello.\n\nMine.", [(1, ["First."])])
    for kept in ("On Monday\n\nA wrote:", "Look here,\nA writes more:", "He is on.\nSo A wrote:"):
        assert quotes.parse(f"{kept}\n> First.")[0] == kept
    assert quotes.parse("```\n> a\n```\n> b\n```\nc\n> d") == ("```\n> a\n```\n```\nc", [(1, ["b"]), (1, ["d"])])


def test_long_chain_and_empty(spark):
    rows = [(1, 0, "user", "m0")] + [(1, i, "user", f"> m{i - 1}\nm{i}") for i in range(1, 40)]
    got = {x.turn: x.depth for x in quotes.conversations(frame(spark, rows)).collect()}
    assert got == {i: i for i in range(40)}
    assert quotes.conversations(frame(spark, [])).count() == 0


def test_table_with_quotes_made_of_its_own_messages(spark):
    """The given table, each odd turn with the turn before quoted above it: every such quote links to the earliest message that says it."""
    import os

    import pytest

    path = "/root/testdata/sf0.001/conversations.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the test tables")
    rows = [tuple(x) for x in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    said = {(c, t): x for c, t, _, x in rows}
    quoted = [(c, t, r, "\n".join("> " + y for y in said[c, t - 1].split("\n")) + "\n" + (x or "")) if t % 2 and said.get((c, t - 1)) else (c, t, r, x) for c, t, r, x in rows]
    got = quotes.conversations(frame(spark, quoted))
    assert as_tuples(got) == brute_by_conversation(quoted)
    assert got.filter("reply_to is not null").count() > 30


def brute_by_conversation(rows):
    by = {}
    for x in rows:
        by.setdefault(x[0], []).append(x)
    return sorted((y for part in by.values() for y in brute(part)), key=str)
