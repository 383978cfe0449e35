"""Repair of conversation structure: the cheapest edits that make a conversation's roles `(s?(ua)+)?`.

A conversation is a lattice of nodes (rows consumed, state of the role pattern); edits are its edges: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an
empty row of user or assistant 5, and 5 more for a truncated row that stays. `cheapest` is a Dijkstra search from both ends: a forward and a reverse heap of (cost, rows
consumed, audit) meet, all crossings of the least cost are finished, and the least concatenation of a forward audit, the crossing edge and a reverse audit is taken. An audit names its path, since the state
fixes what Rerole and Insert write; at one node no audit of the least cost is another's beginning (what follows would be inserts only, and cost more), so least audits concatenate.

Rows are dealt by ranges of (conversation, turn) and sorted, so a conversation of any length is shared by many tasks; each streams its rows and cuts them into segments of at most ``SEGMENT``
rows and about ``SEGMENT_CHARS`` characters. A conversation that lies in one segment is finished there. Of others, each segment gives the cheapest audits between all pairs of states, found the same
way (inserts before a row belong to its segment), and a second pass joins segments in order, with a label, an audit and a running SHA-256 for each of the four states. A hash is sequential, so this pass reads the repaired texts of a
long conversation in one task, as a stream: it holds one segment, and one letter of audit a row and state. Repeated rows are found by sums on (conversation, digest) before, and come in as marks that sort just before the rows they mark.

Nulls are one space, in conv_id only for the damage; a null conv_id is a conversation. Rows of one turn are taken by role, then by the digest of role and text; so repeated rows are adjacent. A row whose role is empty has no initial and can't be
kept, only rewritten or deleted. An empty table gives an empty table. Only conv_id, turn, role and text are read, so other columns can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import joined, stored

SEGMENT, SEGMENT_CHARS = 256, 1 << 23
FEW = 200_000
_BLANKS = " \t\n\x0b\f\r"
#: States of the role pattern: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
BEFORE = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
ENDS = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5

#: A row as the search sees it: initial of its role, whether it must go, what it costs more if it stays.
Row = tuple[str, bool, int]
Node = tuple[int, int]


def _after(rows: list[Row], node: Node, tail: bool) -> Iterator[tuple[Node, int, str]]:
    """Edges from a node: where to, cost, letter. tail: rows may be inserted after the last one."""
    i, s = node
    if i < len(rows):
        initial, must_go, more = rows[i]
        yield (i + 1, s), DELETE, "D"
        if not must_go:
            yield (i + 1, NEXT[s]), REROLE + more, "R"
            if (s, initial) in KEEP:
                yield (i + 1, KEEP[s, initial]), more, "K"
    if i < len(rows) or tail:
        yield (i, NEXT[s]), INSERT, "I"


def _before(rows: list[Row], node: Node, tail: bool) -> Iterator[tuple[Node, int, str]]:
    """Edges to a node: where from, cost, letter."""
    i, s = node
    if i < len(rows) or tail:
        for t in BEFORE.get(s, ()):
            yield (i, t), INSERT, "I"
    if i:
        initial, must_go, more = rows[i - 1]
        yield (i - 1, s), DELETE, "D"
        if not must_go:
            for t in BEFORE.get(s, ()):
                yield (i - 1, t), REROLE + more, "R"
            for t in (START, *BEFORE.get(s, ())) if s == SYSTEM else BEFORE.get(s, ()):
                if KEEP.get((t, initial)) == s:
                    yield (i - 1, t), more, "K"


def cheapest(rows: list[Row], start: int = START, ends: tuple[int, ...] = ENDS, tail: bool = True) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from state start to a state of ends, the least audit among equals; None if there are none.

    Labels leave a heap in the order of cost, rows consumed and audit: edges that cost nothing consume a row, so a label is final when it leaves. Once
    the two least costs add up to more than the best crossing, each cheapest path has an edge from a final node to a final node.
    """
    forward: dict[Node, tuple[int, str]] = {}
    reverse: dict[Node, tuple[int, str]] = {}
    ahead, back = [(0, 0, "", start)], []
    best: tuple[int, str] | None = None

    def crossing(cost: int, audit: str) -> None:
        nonlocal best
        if best is None or (cost, audit) < best:
            best = (cost, audit)

    def settle_forward() -> None:
        cost, i, audit, s = heappop(ahead)
        if (i, s) in forward:
            return
        forward[i, s] = (cost, audit)
        if (i, s) in reverse:
            crossing(cost + reverse[i, s][0], audit + reverse[i, s][1])
        for node, c, letter in _after(rows, (i, s), tail):
            if node in reverse:
                crossing(cost + c + reverse[node][0], audit + letter + reverse[node][1])
            if node not in forward:
                heappush(ahead, (cost + c, node[0], audit + letter, node[1]))

    def settle_reverse(cost: int, i: int, audit: str, s: int) -> None:
        if (i, s) in reverse:
            return
        reverse[i, s] = (cost, audit)
        if (i, s) in forward:
            crossing(forward[i, s][0] + cost, forward[i, s][1] + audit)
        for node, c, letter in _before(rows, (i, s), tail):
            if node in forward:
                crossing(forward[node][0] + c + cost, forward[node][1] + letter + audit)
            if node not in reverse:
                heappush(back, (cost + c, len(rows) - node[0], letter + audit, node[1]))

    for s in ends:
        settle_reverse(0, len(rows), "", s)
    while ahead and back and (best is None or ahead[0][0] + back[0][0] <= best[0]):
        if ahead[0][0] <= back[0][0]:
            settle_forward()
        else:
            cost, left, audit, s = heappop(back)
            settle_reverse(cost, len(rows) - left, audit, s)
    while ahead and not back and (best is None or ahead[0][0] <= best[0]):
        settle_forward()
    while back and not ahead and (best is None or back[0][0] <= best[0]):
        cost, left, audit, s = heappop(back)
        settle_reverse(cost, len(rows) - left, audit, s)
    return best


def repaired(audit: str, rows: list[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """The rows (role, text) that an audit leaves and writes."""
    i = 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield ROLE[state], ""
            continue
        role, text = rows[i]
        i += 1
        if letter == "K":
            state = KEEP[state, role[:1]]
            yield role, text
        elif letter == "R":
            state = NEXT[state]
            yield ROLE[state], text


class Joiner:
    """Segments of one conversation in order: for each state the cheapest label so far, with its hash and audit."""

    def __init__(self):
        self.labels = {START: (0, 0, hashlib.sha256(), None, False)}  # cost, rank of the audit, hash, audit as a chain, whether a row was written

    def add(self, ways: list[tuple[int, int, int, str]], rows: list[tuple[str, str]]) -> None:
        """ways: (from, to, cost, audit)."""
        best: dict[int, tuple] = {}
        for a, b, cost, audit in ways:
            if a in self.labels:
                now = (self.labels[a][0] + cost, self.labels[a][1], audit, a)
                best[b] = min(best.get(b, now), now)
        order = {b: k for k, b in enumerate(sorted(best, key=lambda b: best[b][1:3]))}
        out = {}
        for b, (cost, _, audit, a) in best.items():
            _, _, digest, chain, begun = self.labels[a]
            digest, begun = _hashed(digest.copy(), repaired(audit, rows, a), begun)
            out[b] = (cost, order[b], digest, (chain, audit), begun)
        self.labels = out

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and digest, after what has to be inserted at the end."""
        ends = []
        for state, (cost, rank, digest, chain, begun) in self.labels.items():
            tail = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}[state]
            ends.append((cost + INSERT * tail, rank, state, tail, digest, chain, begun))
        cost, _, state, tail, digest, chain, begun = min(ends, key=lambda x: x[:2])
        digest, _ = _hashed(digest, repaired("I" * tail, [], state), begun)
        parts = ["I" * tail]
        while chain:
            chain, audit = chain
            parts.append(audit)
        return cost, "".join(reversed(parts)), digest.hexdigest()


def _hashed(digest, rows: Iterator[tuple[str, str]], begun: bool):
    for role, text in rows:
        digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
        begun = True
    return digest, begun


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_PART = pa.schema(
    [
        ("key", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("done", pa.bool_()), *((c, pa.int64()) for c in _COUNTS), ("turns", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
        ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()),
        ("ways", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ]
)
_PART_DDL = (
    "key string, part int, seq bigint, done boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, low bigint, high bigint, first string, last string, "
    "cost bigint, audit string, sha string, ways array<struct<a: int, b: int, cost: bigint, audit: string>>, roles array<string>, texts array<string>"
)
_RESULT = pa.schema([("key", pa.string()), ("gaps", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_RESULT_DDL = "key string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class _Segment:
    """Rows of a conversation that lie together in a task."""

    def __init__(self, key: str):
        self.key, self.rows, self.texts, self.chars = key, [], [], 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn: int | None, role: str, text: str, duplicate: bool) -> None:
        shown = text.rstrip(_BLANKS)
        fault = "blank" if not shown else "duplicate" if duplicate else "truncated" if shown[-1] not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        if self.rows and self.rows[-1][0] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.rows.append((role[:1], fault in ("blank", "duplicate"), CUT_SHORT if fault == "truncated" else 0))
        self.texts.append((role, text))
        self.chars += len(text)
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self, part: int, seq: int, done: bool) -> dict:
        out = {"key": self.key, "part": part, "seq": seq, "done": done, **self.counts, "turns": self.turns, "low": self.low, "high": self.high}
        if done:
            cost, audit = cheapest(self.rows)
            digest, _ = _hashed(hashlib.sha256(), repaired(audit, self.texts, START), False)
            return out | {"cost": cost, "audit": audit, "sha": digest.hexdigest()}
        if self.rows:
            ways = [(a, b, cheapest(self.rows, a, (b,), False)) for a in range(4) for b in range(4)]
            out |= {"first": self.rows[0][0], "last": self.rows[-1][0]}
            out["ways"] = [{"a": a, "b": b, "cost": w[0], "audit": w[1]} for a, b, w in ways if w]
        return out | {"roles": [r for r, _ in self.texts], "texts": [t for _, t in self.texts]}


def _segments(size: int):
    """The task of the first pass: sorted rows to finished conversations and segments of open ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, made, chars = TaskContext.get().partitionId(), 0, [], 0
        now, edge, cut, mark, last = None, True, False, None, None  # edge: the partition's first conversation; cut: a segment of this one is out
        for batch in batches:
            for key, turn, role, digest, text, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        made.append(now.row(part, seq, not edge and not cut))
                        edge = False
                    chars += now.chars if now is not None else 0
                    now, cut, mark, last, seq = _Segment(key), False, None, None, seq + 1
                if kind == "mark":
                    mark = (turn, role, digest)
                elif kind == "row":
                    this = (turn, role, digest)
                    now.add(turn, role, text, this in (mark, last))
                    last = this
                    if len(now.rows) >= size or now.chars >= SEGMENT_CHARS:
                        made.append(now.row(part, seq, False))
                        chars += now.chars
                        now, cut, seq = _Segment(key), True, seq + 1
                if len(made) >= 4096 or chars >= SEGMENT_CHARS:
                    yield pa.RecordBatch.from_pylist(made, _PART)
                    made, chars = [], 0
        if now is not None:
            made.append(now.row(part, seq, False))
            yield pa.RecordBatch.from_pylist(made, _PART)

    return run


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task of the second pass: segments sorted by conversation and place to finished conversations."""
    key, joiner, total, turns, low, high, last = None, None, None, 0, None, None, None

    def finished() -> pa.RecordBatch:
        cost, audit, sha = joiner.result()
        gaps = 0 if low is None else high - low + 1 - turns
        return pa.RecordBatch.from_pylist([{"key": key, "gaps": gaps, **total, "cost": cost, "audit": audit, "repaired_sha256": sha}], _RESULT)

    for batch in batches:
        for k in range(batch.num_rows):
            x = batch.slice(k, 1).to_pylist()[0]
            if x["key"] != key:
                if key is not None:
                    yield finished()
                key, joiner, total, turns, low, high, last = x["key"], Joiner(), dict.fromkeys(_COUNTS, 0), 0, None, None, None
            if x["ways"] is None:
                continue
            joiner.add([(w["a"], w["b"], w["cost"], w["audit"]) for w in x["ways"]], list(zip(x["roles"], x["texts"], strict=True)))
            for c in _COUNTS:
                total[c] += x[c]
            total["illegal"] += last is not None and last + x["first"] not in LEGAL
            last = x["last"]
            if x["low"] is not None:
                turns += x["turns"] - (high == x["low"])
                low, high = (x["low"] if low is None else low), x["high"]
    if key is not None:
        yield finished()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversations with planted faults, by the crc32 of `conv_id:turn` modulo 20; no nulls in role and text."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    out = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), one("role").alias("role"), one("text").alias("text"), pick.alias("pick")).filter("pick <> 0")
    text = F.when(F.col("pick") == 1, "").when(F.col("pick") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("pick") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return out.select("conv_id", "turn", F.when(F.col("pick") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("c")).drop("c")


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))


def repair(rows: DataFrame, ids: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of ids.

    rows: conv_id, turn, role, text without nulls in role and text; ids: conv_id, in any number of rows; conversations without rows give zeros.
    """
    if segment < 1:
        raise ValueError("segment must be at least 1")
    kind = rows.schema["conv_id"].dataType
    rows = rows.select(_key().alias("key"), F.col("turn").cast("bigint").alias("turn"), "role", F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("digest"), "text", F.lit("row").alias("kind"))
    known = rows.select("key", "digest", "role", "turn").distinct()
    when = F.struct(F.col("turn").isNotNull(), "turn")
    repeated = stored(known.groupBy("key", "digest").agg(F.min(when).alias("since"), F.max(when).alias("until")).filter("since < until").drop("until"))
    marks = joined(known, repeated, ["key", "digest"], repeated.count() <= FEW).filter(when > F.col("since"))
    exists = ids.select(_key().alias("key")).distinct()
    empty = F.lit(None)
    every = rows.unionByName(marks.select("key", "turn", "role", "digest", empty.cast("string").alias("text"), F.lit("mark").alias("kind")))
    every = every.unionByName(exists.select("key", empty.cast("bigint").alias("turn"), empty.cast("string").alias("role"), empty.cast("binary").alias("digest"), empty.cast("string").alias("text"), F.lit("id").alias("kind")))
    order = [F.col("key"), F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("digest")]
    sorted_ = every.repartitionByRange(*order).sortWithinPartitions(*order, "kind")
    parts = stored(sorted_.mapInArrow(_segments(segment), _PART_DDL))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    done = parts.filter("done").select("key", gaps, *_COUNTS, "cost", "audit", F.col("sha").alias("repaired_sha256"))
    open_ = parts.filter("not done").repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(_join, _RESULT_DDL)
    conv_id = F.when(F.col("key") != "n", F.substr("key", F.lit(2))).cast(kind).alias("conv_id")
    return done.unionByName(open_).select(conv_id, "gaps", *_COUNTS, "cost", "audit", "repaired_sha256")


def report(conversations: DataFrame) -> DataFrame:
    """repair() of the damaged rows of conversations."""
    return repair(damaged(conversations), conversations.select("conv_id"))


def oracle() -> str:
    """The same by a fold over each conversation's rows, with all four states in one list; inserts come as a step of their own before each row and at the end."""
    blanks = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

    def on(label: str, cost: str, letter: str, line: str | None = None) -> str:
        rows = f"list_append({label}.o, {line})" if line else f"{label}.o"
        return f"CASE WHEN {label} IS NOT NULL THEN struct_pack(c := {label}.c + {cost}, w := concat({label}.w, '{letter}'), o := {rows}) END"

    twice = lambda x: f"CASE WHEN {x} IS NOT NULL THEN struct_pack(c := {x}.c + 10, w := concat({x}.w, 'II'), o := list_concat({x}.o, ['user:', 'assistant:'])) END"
    start, system, user, assistant = (f"a[{k}]" for k in (1, 2, 3, 4))
    insert = ", ".join(
        [
            start,
            system,
            f"list_min([{user}, {', '.join(on(x, '5', 'I', chr(39) + 'user:' + chr(39)) for x in (start, system, assistant))}])",
            f"list_min([{assistant}, {on(user, '5', 'I', chr(39) + 'assistant:' + chr(39))}, {twice(start)}, {twice(system)}])",
        ]
    )

    def stays(label: str, initial: str, role: str) -> list[str]:
        keep = f"CASE WHEN NOT x.go AND left(x.role, 1) = '{initial}' THEN {on(label, 'x.more', 'K', 'concat(x.role, chr(58), x.text)')} END"
        if not role:
            return [keep]
        rerole = "concat('" + role + ":', x.text)"
        return [keep, f"CASE WHEN NOT x.go THEN {on(label, '1 + x.more', 'R', rerole)} END"]

    step = ", ".join(
        [
            on(start, "2", "D"),
            f"list_min([{', '.join([on(system, '2', 'D'), *stays(start, 's', '')])}])",
            f"list_min([{', '.join([on(user, '2', 'D'), *stays(start, 'u', 'user'), *stays(system, 'u', 'user'), *stays(assistant, 'u', 'user')])}])",
            f"list_min([{', '.join([on(assistant, '2', 'D'), *stays(user, 'a', 'assistant')])}])",
        ]
    )
    crc = "xor(list_reduce([CAST(ascii(z) AS BIGINT) FOR z IN string_split(x, '')], lambda p, b: list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(p, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 20"
    label = "STRUCT(c BIGINT, w VARCHAR, o VARCHAR[])"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS x FROM conversations),
p AS (SELECT *, {crc} AS pick FROM c),
d AS (SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
    CASE pick WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN pick = 3 THEN 2 ELSE 1 END)) AS copy FROM p WHERE pick <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth,
    md5(concat(length(role), ':', role, text)) AS digest, rtrim(text, {blanks}) AS shown FROM d),
f AS (SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER w AS before, row_number() OVER w AS nr FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest, nth)),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND concat(before, left(role, 1)) NOT IN ('su', 'ua', 'au')) AS illegal,
    list(struct_pack(ins := false, role := role, text := text, go := fault IN ('blank', 'duplicate'), more := CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END) ORDER BY nr) AS rows
    FROM f GROUP BY conv_id),
s AS (SELECT *, struct_pack(ins := true, role := '', text := '', go := false, more := 0) AS gap FROM g),
t AS (SELECT * EXCLUDE (rows, gap), list_append(flatten([[gap, y] FOR y IN rows]), gap) AS steps FROM s),
u AS (SELECT * EXCLUDE (steps), list_reduce(steps, lambda a, x: CASE WHEN x.ins THEN [{insert}] ELSE [{step}] END,
    CAST([struct_pack(c := 0, w := '', o := CAST([] AS VARCHAR[])), NULL, NULL, NULL] AS {label}[])) AS a FROM t),
v AS (SELECT * EXCLUDE (a), list_min([a[1], a[4]]) AS best FROM u)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.w, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN v ON i.conv_id IS NOT DISTINCT FROM v.conv_id"""
