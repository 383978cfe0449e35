"""Chat formatting by quotation linking.

Messages are parsed into their own words and quoted passages with nested levels (lines that begin with ``>`` marks; lines in
code fences are own words; a fence that is never closed is none). The line before a quote that names its writer is dropped, also if blank lines follow it or if it is
wrapped over up to three lines. Passages, their paragraphs and lines are normalised (NFKC, case folded, white space collapsed) and hashed; so
are the own words of every message: the whole, its paragraphs and lines. A passage's hash is joined, within its
conversation, to the earliest message whose own words have it. A message replies to the message that holds most
of its outermost quoted characters (ties: the latest), or else of the next level that links. Replies make trees; a walk round each tree (into a message, through its answers by
turn, out again) is a list whose places are found by pointer doubling, with a few numbers a message however long the thread: they give the first message of a message's
thread, its depth below it and its position. Sorted by thread and position, each message is followed by its first answer with all that answers it, then the next.

Each key of a conversation has one original, so the join can't grow with the square of a group; a conversation of any size is spread over
tasks by its keys. Rows that repeat a turn share its links. A message with a null conv_id or turn, or without linked quotes, begins a thread of its
own; a null text is empty. A very long message is parsed line by line in one task. An empty table gives an empty table. Only conv_id, turn, role and text are read, so
other columns can have any name.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import stored

_MARKS = re.compile(r"^(?:[ \t]*>)+ ?")
_FENCE = re.compile(r"^[ \t]*(```|~~~)")
_ATTRIBUTION = re.compile(r"^(?:On .* wrote|.* writes|Le .* a écrit|Am .* schrieb.*|El .* escribió)[ \t]*:[ \t]*$")
_WRAPPED = re.compile(r"^(?:On .* wrote|Le .* a écrit|Am .* schrieb.*|El .* escribió)[ \t]*:[ \t]*$")
#: Lines that an attribution may be wrapped over.
_ATTRIBUTION_LINES = 3
#: Answers to a message are put in order by ranges of so many turns (as a power of two), so those to one message needn't meet in one task.
TURN_BITS = 16
_QUOTE = pa.struct([("level", pa.int32()), ("passage", pa.int32()), ("key", pa.int64()), ("size", pa.int64())])


def normalised(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split())


def key(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def parts(lines: list[str]) -> dict[int, int]:
    """Key to size of the passage as a whole, its paragraphs and its lines, where not empty."""
    out = {}
    paragraphs: list[list[str]] = [[]]
    for x in lines:
        if x.strip():
            paragraphs[-1].append(x)
        elif paragraphs[-1]:
            paragraphs.append([])
    for x in ["\n".join(lines), *("\n".join(p) for p in paragraphs), *lines]:
        if x := normalised(x):
            out[key(x)] = len(x)
    return out


def _drop_attribution(own: list[str]) -> None:
    """Drop the lines at the end that name the writer of the quote that follows, and blank ones after them."""
    end = len(own)
    while end and not own[end - 1].strip():
        end -= 1
    for n in range(1, min(_ATTRIBUTION_LINES, end) + 1):
        if n > 1 and not own[end - n].strip():
            return
        if (_ATTRIBUTION if n == 1 else _WRAPPED).match(" ".join(x.strip() for x in own[end - n : end])):
            del own[end - n :]
            return


def parse(text: str | None) -> tuple[str, list[tuple[int, list[str]]]]:
    """A message's own words, and its quoted passages as (level, lines without marks)."""
    lines = (text or "").split("\n")
    body, passages, unclosed = _parse(lines, None)
    if unclosed is not None:
        body, passages, _ = _parse(lines, unclosed)
    return body, passages


def _parse(lines: list[str], no_fence: int | None) -> tuple[str, list[tuple[int, list[str]]], int | None]:
    """Own words, passages, and the line of a fence that stays open; the line no_fence opens none."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    fence, level = None, 0
    for i, line in enumerate(lines):
        m = None if fence is not None else _MARKS.match(line)
        if m is None:
            if i != no_fence and _FENCE.match(line):
                fence = i if fence is None else None
            own.append(line)
            level = 0
            continue
        n = m[0].count(">")
        if n != level:
            passages.append((n, []))
            if not level:
                _drop_attribution(own)
        level = n
        passages[-1][1].append(line[m.end() :])
    return "\n".join(own).strip(), passages, fence


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, n_quotes, quotes, own (keys of own words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies, counts, quotes, own = [], [], [], []
            for t in b.column(3).to_pylist():
                body, passages = parse(t)
                bodies.append(body)
                counts.append(len(passages))
                quotes.append([{"level": n, "passage": i, "key": k, "size": s} for i, (n, lines) in enumerate(passages) for k, s in parts(lines).items()])
                own.append(list(parts(body.split("\n"))))
            new = [pa.array(bodies, pa.string()), pa.array(counts, pa.int32()), pa.array(quotes, pa.list_(_QUOTE)), pa.array(own, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *new], ["conv_id", "turn", "role", "body", "n_quotes", "quotes", "own"])

    rows = messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    schema = "conv_id bigint, turn bigint, role string, body string, n_quotes int, quotes array<struct<level:int,passage:int,key:bigint,size:bigint>>, own array<bigint>"
    return rows.mapInArrow(run, schema)


def replies(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_linked) of turns whose quotes link to an earlier turn; rows: parsed(), stored."""
    quoted = rows.filter("size(quotes) > 0 and conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*").distinct()
    quoted = stored(quoted)
    wanted = quoted.select("conv_id", "key").distinct()
    own = rows.filter("turn is not null").select("conv_id", "turn", F.explode("own").alias("key")).groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))
    first = stored(own.join(wanted, ["conv_id", "key"], "left_semi"))
    hits = quoted.join(first, ["conv_id", "key"]).filter("origin < turn")
    votes = hits.groupBy("conv_id", "turn", "level", "origin").agg(F.sum("size").alias("size"), F.collect_set("passage").alias("passages"))
    best = votes.groupBy("conv_id", "turn", "level").agg(F.max(F.struct("size", "origin")).alias("b"), F.array_distinct(F.flatten(F.collect_list("passages"))).alias("passages"))
    return best.groupBy("conv_id", "turn").agg(F.min_by(F.col("b.origin"), "level").alias("reply_to"), F.sum(F.size("passages")).cast("int").alias("n_linked"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth, position) of replies and of what they answer; links: replies(), stored.

    The walk is a list of two entries a message, its way in and its way out. The entry before a way in is the way out of the answer before it, or the way into the message
    answered; before a way out it is the way out of the last answer, or the message's own way in. Each entry is before one other only, so no key of the joins is hot.
    """
    roots = links.select("conv_id", F.col("reply_to").alias("turn")).join(links, ["conv_id", "turn"], "left_anti").distinct()
    answers = links.select("conv_id", "turn", "reply_to", F.shiftright("turn", TURN_BITS).alias("block"))
    group = ["conv_id", "reply_to", "block"]
    blocks = stored(answers.groupBy(*group).agg(F.max("turn").alias("last")))
    before = blocks.select(*group, F.lag("last").over(W.partitionBy("conv_id", "reply_to").orderBy("block")).alias("earlier"))
    answers = answers.withColumn("previous", F.lag("turn").over(W.partitionBy(*group).orderBy("turn"))).join(before, group)
    answers = answers.select("conv_id", "turn", "reply_to", F.coalesce("previous", "earlier").alias("previous"))
    last = blocks.groupBy("conv_id", F.col("reply_to").alias("turn")).agg(F.max("last").alias("last"))

    def entry(out: bool, up: Column, up_out: Column, places: int, depth: int, thread: Column) -> list[Column]:
        return ["conv_id", "turn", F.lit(out).alias("out"), up.alias("up"), up_out.alias("up_out"), F.lit(places).cast("bigint").alias("position"), F.lit(depth).alias("depth"), thread.alias("thread")]

    none, own = F.lit(None).cast("bigint"), F.col("turn")
    ways_in = answers.select(*entry(False, F.coalesce("previous", "reply_to"), F.col("previous").isNotNull(), 1, 1, none))
    first = roots.select(*entry(False, none, F.lit(False), 0, 0, own))
    ways_out = answers.select("conv_id", "turn").join(last, ["conv_id", "turn"], "left").select(*entry(True, F.coalesce("last", "turn"), F.col("last").isNotNull(), 0, -1, none))
    nodes = stored(ways_in.unionByName(first).unionByName(ways_out))
    while not nodes.filter("up is not null").isEmpty():
        above = nodes.select("conv_id", own.alias("up"), F.col("out").alias("up_out"), F.struct("up", "up_out", "position", "depth", "thread").alias("a"))
        open_ = nodes.filter("up is not null").drop("thread").join(above, ["conv_id", "up", "up_out"])
        more = [(F.col(x) + F.col(f"a.{x}")).alias(x) for x in ("position", "depth")]
        open_ = open_.select("conv_id", "turn", "out", F.col("a.up").alias("up"), F.col("a.up_out").alias("up_out"), *more, F.col("a.thread").alias("thread"))
        nodes = stored(nodes.filter("up is null").unionByName(open_))
    return nodes.filter("not out").select("conv_id", "turn", "thread", "depth", "position")


def conversations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, reply_to, thread, depth, position, n_quotes, n_linked for each row of messages.

    Sorted by (conv_id, thread, position), the bodies are the reply-ordered conversation without quotes.
    """
    rows = stored(parsed(messages))
    links = stored(replies(rows))
    placed = stored(links.join(threads(links), ["conv_id", "turn"]))
    out = rows.select("conv_id", "turn", "role", "body", "n_quotes").join(placed, ["conv_id", "turn"], "left")
    own = {"thread": F.coalesce("thread", "turn"), "depth": F.coalesce("depth", F.lit(0)), "position": F.coalesce("position", F.lit(0).cast("bigint")), "n_linked": F.coalesce("n_linked", F.lit(0))}
    return out.withColumns(own).select("conv_id", "turn", "role", "body", "reply_to", "thread", "depth", "position", "n_quotes", "n_linked")


def chat(messages: DataFrame) -> DataFrame:
    """conversations() with each message as chat text, in reply order."""
    rows = conversations(messages).sort("conv_id", "thread", "position", "turn")
    role = F.coalesce("role", F.lit("user"))
    return rows.withColumn("chat", F.concat(F.lit("<|"), role, F.lit("|>\n"), "body"))
