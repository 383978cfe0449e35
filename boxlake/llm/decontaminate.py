"""Benchmark decontamination with a generalised suffix automaton of the items' words.

The automaton of all items is built from their word numbers. A document's words are streamed through it; the
state after each word gives the longest suffix that occurs in some item. Where that length reaches the window
(10 words, or a whole item that is shorter), the window's words are hit and its items are looked up at the state.
Words that cannot lie in a window are skipped exactly: a window of w words lies in a run of at least w - 1 known
word pairs, and only such runs are streamed.

The items are broadcast in passes of at most ``PASS_BYTES`` of text; a larger set takes several passes over the
documents. A pass writes a row for each text that is hit, its digest, spans and items, and no text; the documents meet the hits of all passes
by the digest, in one join. Within a pass an automaton holds at most ``BLOCK_BYTES``. A worker builds
the automata of a pass once; where there are several, each is packed into flat arrays (about 20 bytes for a byte of text)
before the next one is built.

Nulls: a null text has no words; a null item id counts as the empty id. Repeated item ids count once, repeated documents each for itself. A very long text is one
array of word numbers. Empty tables give empty results. Only the id and text columns are read, so other columns can have any name.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxlake.llm.common import ASCII_LOWER, as_bytes, free_name, stored, text_key

WINDOW = 10
PASS_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20
_WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Lower-cases A-Z and turns every byte that is in no word into a blank.
_TO_WORDS = bytes(ASCII_LOWER[c] if ASCII_LOWER[c] in _WORD_BYTES else 32 for c in range(256))
_WORD_AT = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FILTER = 1 << 22
#: The word pattern in Java, whose characters are code points and not bytes.
_JAVA_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton of sequences of word numbers."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        items = [(k, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]) for k, ws in items if ws]
        for _, ids in items:
            at = 0
            for t in ids:
                at = self._extend(at, t)
        self.owners: dict[int, set[str]] = {}  # items of the window that ends in a state
        self.short: dict[int, list[tuple[int, str]]] = {}  # items below the window that end in a state
        for k, ids in items:
            at = 0
            for i, t in enumerate(ids):
                at = self.next[at][t]
                if i + 1 >= window:
                    at = self.suffix(at, window)
                    self.owners.setdefault(at, set()).add(k)
            if len(ids) < window:
                self.short.setdefault(self.suffix(at, len(ids)), []).append((len(ids), k))
        self.least = min((min(len(ids), window) for _, ids in items), default=0)
        width = np.int64(len(self.vocabulary) + 1)
        self.width = width
        pairs = {int(a * width + b) for _, ids in items for a, b in zip(ids, ids[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.maybe = np.zeros(_FILTER, bool)
        self.maybe[self._slot(self.pairs)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * np.int64(0x9E3779B1)) >> np.int64(7)) & np.int64(_FILTER - 1)

    def _state(self, length: int, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, t: int) -> int:
        """A copy of q for the suffixes up to length(p) + 1."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(t) == q:
            self.next[p][t] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, t: int) -> int:
        q = self.next[last].get(t)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, t)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and t not in self.next[p]:
            self.next[p][t] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][t]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, t)
        return new

    def suffix(self, state: int, length: int) -> int:
        """The state of the last `length` words of what ends in state."""
        while self.length[self.link[state]] >= length and state:
            state = self.link[state]
        return state

    def pack(self) -> Automaton:
        """Moves and owners as sorted arrays instead of dictionaries; nothing can be added afterwards."""
        moves = sorted((s * int(self.width) + t, to) for s, follow in enumerate(self.next) for t, to in follow.items())
        self.move_keys, self.move_to = array("q", [k for k, _ in moves]), array("i", [to for _, to in moves])
        self.next = None
        self.names = sorted({k for x in self.owners.values() for k in x})
        place = {k: i for i, k in enumerate(self.names)}
        owned = sorted((s, place[k]) for s, x in self.owners.items() for k in x)
        self.owned_states, self.owned_names = array("i", [s for s, _ in owned]), array("i", [i for _, i in owned])
        self.owners = None
        self.link, self.length = array("i", self.link), array("i", self.length)
        return self

    def move(self, state: int, t: int) -> int | None:
        """The state after one more word, if there is one."""
        if self.next is not None:
            return self.next[state].get(t)
        k = state * int(self.width) + t
        i = bisect_left(self.move_keys, k)
        return self.move_to[i] if i < len(self.move_keys) and self.move_keys[i] == k else None

    def owners_at(self, state: int) -> set[str]:
        """Items whose windows end in the state."""
        if self.owners is not None:
            return self.owners.get(state, set())
        i, out = bisect_left(self.owned_states, state), set()
        while i < len(self.owned_states) and self.owned_states[i] == state:
            out.add(self.names[self.owned_names[i]])
            i += 1
        return out

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Word ranges outside which no window can lie."""
        if not self.least or len(ids) < self.least:
            return
        if self.least == 1:
            good = ids > 0
        else:
            both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            code = ids[both] * self.width + ids[both + 1]
            kept = self.maybe[self._slot(code)]
            both, code = both[kept], code[kept]
            at = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
            good = np.zeros(len(ids) - 1, bool)
            if len(self.pairs):
                good[both[self.pairs[at] == code]] = True
        step = np.flatnonzero(np.diff(np.r_[0, good.astype(np.int8), 0]))
        more = 0 if self.least == 1 else 1
        for a, b in zip(step[::2].tolist(), step[1::2].tolist(), strict=True):
            if b - a + more >= self.least:
                yield a, b + more

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges (first, end), merged, and the items found."""
        get = self.vocabulary.get
        ids = np.fromiter([get(w, 0) for w in ws], np.int64, len(ws))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        move, link, length, window = self.move, self.link, self.length, self.window
        for a, b in self.runs(ids):
            state = matched = 0
            for i, t in enumerate(ids[a:b].tolist(), a):
                while (to := move(state, t)) is None and state:
                    state = link[state]
                    matched = length[state]
                if to is not None:
                    state = to
                    matched += 1
                if matched >= window:
                    found |= self.owners_at(self.suffix(state, window))
                    spans.append((i + 1 - window, i + 1))
                if self.short:
                    up = state
                    while up > 0:
                        for n, k in self.short.get(up, ()):
                            if n <= matched:
                                found.add(k)
                                spans.append((i + 1 - n, i + 1))
                        up = link[up]
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_BUILT: dict[tuple, list[Automaton]] = {}


def _automata(blocks: list[list], window: int) -> list[Automaton]:
    """The pass's automata, which stay in the worker until another pass needs others."""
    key = (hash(tuple((k, tuple(ws)) for block in blocks for k, ws in block)), len(blocks), window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = [Automaton(b, window) if len(blocks) == 1 else Automaton(b, window).pack() for b in blocks]
    return _BUILT[key]


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
_NO_SPANS = "cast(array() as array<struct<first:bigint,stop:bigint>>)"


def _pass(docs: DataFrame, text: int, shared, window: int, only_hits: bool) -> DataFrame:
    """docs with words, spans and items; text: the place of the text column. only_hits: rows without a hit go, and so does the text."""
    width = len(docs.columns)
    kept = [i for i in range(width) if not (only_hits and i == text)]
    new = [free_name(c, docs.columns) for c in ("n_words", "spans", "items")]
    kinds = [T.LongType(), T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())])), T.ArrayType(T.StringType())]
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), *(T.StructField(k, t) for k, t in zip(new, kinds, strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(shared.value, window)
        for b in batches:
            counts, spans, items = [], [], []
            for t in as_bytes(b.column(text)).to_pylist():
                ws = words(t)
                hits, names = [], set()
                for auto in automata:
                    hit, found = auto.scan(ws)
                    hits += hit
                    names |= found
                counts.append(len(ws))
                spans.append([{"first": x, "stop": y} for x, y in merged(hits)])
                items.append(sorted(names))
            out = pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))], schema.names)
            yield out.filter(pa.array([bool(x) for x in items], pa.bool_())) if only_hits else out

    return docs.mapInArrow(run, schema)


def _merged_hits(hits: DataFrame) -> DataFrame:
    """One row per key of hits (key, spans, items): all its items, and its spans as disjoint ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"first": x, "stop": y} for x, y in merged([(s["first"], s["stop"]) for s in row])] for row in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _SPANS), b.column(2)], ["key", "spans", "items"])

    found = hits.groupBy("key").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return found.mapInArrow(run, found.schema)


def annotate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, list[str]]:
    """docs with three more columns, and their names: number of words, hit word ranges, items found.

    docs: text and any other columns. items: item_id, text.
    """
    item = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("k"), F.col("text").cast("binary").alias("t"))
    size = item.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    passes = 1 + size // PASS_BYTES
    new = [free_name(c, docs.columns) for c in ("n_words", "spans", "items")]

    def scanned(n: int, rows: DataFrame, only_hits: bool) -> DataFrame:
        mine = (item.filter(F.pmod(F.xxhash64("k", "t"), F.lit(passes)) == n) if passes > 1 else item).collect()
        blocks: list[list] = [[]]
        room = BLOCK_BYTES
        for k, t in sorted((r.k, bytes(r.t or b"")) for r in mine):
            if room < len(t) and blocks[-1]:
                blocks.append([])
                room = BLOCK_BYTES
            room -= len(t)
            blocks[-1].append((k, words(t)))
        return _pass(rows, rows.columns.index("text"), rows.sparkSession.sparkContext.broadcast(blocks), window, only_hits)

    if passes == 1:
        return scanned(0, docs, False), new
    hits = None
    for n in range(passes):
        one = stored(scanned(n, docs.select(text_key("text").alias("key"), "text"), True).select("key", "spans", "items").dropDuplicates(["key"]))
        hits = one if hits is None else hits.unionByName(one)
    hits = stored(_merged_hits(hits))
    key, found = (free_name(c, [*docs.columns, *new]) for c in ("text_key", "found_key"))
    met = docs.withColumn(key, text_key("text")).join(hits.toDF(found, *new[1:]).hint("merge"), F.col(key) == F.col(found), "left")
    n_words = F.coalesce(F.regexp_count("text", F.lit(_JAVA_WORD)), F.lit(0)).cast("bigint")
    none = [F.coalesce(new[1], F.expr(_NO_SPANS)).alias(new[1]), F.coalesce(new[2], F.expr("cast(array() as array<string>)")).alias(new[2])]
    return met.select(*docs.columns, n_words.alias(new[0]), *none), new


def _hits(spans: str):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["first"])


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs."""
    found, (n_words, spans, names) = annotate(docs.select("doc_id", "text"), items, window)
    n_hit = _hits(spans)
    return found.select(
        "doc_id",
        n_words,
        n_hit.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(names)), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.0, min_span: int = 1, length: str | None = "n_chars") -> DataFrame:
    """docs without the benchmark's passages; the columns stay. The column `length`, where there is one, becomes the new number of characters of a text that is cut.

    A document whose hit words exceed max_coverage of its words is dropped (0: any hit drops it). From the others,
    hit spans of at least min_span words are cut.
    """
    place, width = docs.columns.index("text"), len(docs.columns)
    n = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, sizes = as_bytes(b.column(place)).to_pylist(), {}
            for i, spans in enumerate(b.column(width + 1).to_pylist()):
                cut = [(s["first"], s["stop"]) for s in spans if s["stop"] - s["first"] >= min_span]
                if cut:
                    at, out, last = [m.span() for m in _WORD_AT.finditer(texts[i])], [], 0
                    for first, stop in cut:
                        out.append(texts[i][last : at[first][0]])
                        last = at[stop - 1][1]
                    texts[i] = b"".join([*out, texts[i][last:]])
                    sizes[i] = len(texts[i].decode())
            columns = b.columns[:width]
            if n is not None and sizes:
                columns[n] = pa.array([sizes.get(i, x) for i, x in enumerate(columns[n].to_pylist())], columns[n].type)
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:width])

    found, (n_words, spans, _) = annotate(docs, items, window)
    found = found.filter(_hits(spans) <= F.col(n_words) * F.lit(max_coverage))
    return found.mapInArrow(run, docs.schema) if max_coverage > 0 else found.drop(*found.columns[width:])


def oracle(window: int = WINDOW) -> str:
    """DuckDB SQL for report(): windows of every length that an item has, as text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {split} AS ws FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {split} AS ws FROM benchmark),
s AS (SELECT item, ws, least(len(ws), {window}) AS n FROM i WHERE len(ws) > 0),
w AS (SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS g FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM s) x),
l AS (SELECT DISTINCT n FROM w),
o AS (SELECT rid, p, n, array_to_string(ws[p:p + n - 1], ' ') AS g FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d JOIN l ON len(ws) >= n) y),
h AS (SELECT rid, p, n, item FROM o JOIN w USING (n, g)),
c AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM h) z GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM h) v GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN m USING (rid)"""
