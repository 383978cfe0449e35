"""Phrases of two and three words that stand together more often than their parts: direct-address tiling.

Words get ids by falling frequency, so the pairs that occur most have small ids. Pairs of ids fall into square tiles: the busy ones, near the origin, are dense arrays filled by ``numpy.bincount``; the others are
sorted coordinate lists with counts. Each task counts its own documents in tiles and gives out what isn't zero once (or when its lists are full), so that only sums are shuffled and a frequent word or pair never meets in one
task. Frequent pairs are then ranked by frequency again and take the place of first words: triples are tiles of pair ranks and word ids. Both parts of a frequent triple are frequent pairs, so no other is counted.

What is sent to tasks is bounded: at most ``WORDS`` ids of words of up to ``LONG`` bytes, at most ``PAIRS`` pair keys; a histogram of counts finds the count from which on all fit. If some frequent words or
pairs are beyond that, phrases that may contain them are counted by their text with the same sums, and all others as above, so the result is the same whatever the bounds.
An infrequent word or pair ends a phrase: a phrase is at most as frequent as its parts.

Null texts are empty, a null lang is `und`. Repeated rows count each for itself. Ties in the order of a language's list can't occur: phrases differ. An empty table gives an empty table. Only lang and text are read, so other columns can have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import ASCII_LOWER, as_bytes, joined, stored

MIN_COUNT, TOP, NESTED = 10, 2000, 50
WORDS, PAIRS, LONG = 1 << 19, 1 << 21, 64
#: Side of a tile; tiles a side that may become dense; share of a tile's cells that a batch must hit.
SIDE, BUSY, FILL = 512, 6, 16
#: Coordinates in a task's lists, and entries of its text counts, before they are given out.
ROOM, TEXTS = 1 << 21, 200_000
SALTS = 64
#: Bytes of text whose words a task holds at once.
CHUNK = 1 << 20
ENDS = b".,;:!?\n\x0b\x0c\r"
_MARK = b"\xff"  # in no UTF-8 text
#: A-Z to a-z, ends of pieces to the mark, tabs to blanks.
_BYTES = bytes(255 if c in ENDS else 32 if c == 9 else ASCII_LOWER[c] for c in range(256))
BREAK, OPEN = -1, -2


def _parts(text: bytes) -> Iterator[bytes]:
    """A text's translated bytes, cut after about CHUNK bytes at the next end of a piece, which no phrase crosses."""
    text, at = text.translate(_BYTES), 0
    while len(text) - at > CHUNK:
        end = text.find(_MARK, at + CHUNK)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Words of the texts of a batch (lang, text) by language, with marks between pieces, about CHUNK bytes at a time."""
    found: dict[str, tuple[list[bytes], int]] = {}
    texts = as_bytes(batch.column(1))
    for k, lang in enumerate(batch.column(0).to_pylist()):
        for part in _parts(texts[k].as_py()):
            words, size = found.pop(lang, ([], 0))
            words += part.replace(_MARK, b" \xff ").split()
            words.append(_MARK)
            size += len(part)
            if size >= CHUNK:
                yield lang, words
            else:
                found[lang] = (words, size)
    for lang, (words, _) in found.items():
        yield lang, words


def _counted(counts: dict[str, Counter]) -> pa.RecordBatch:
    rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items() if w != _MARK]
    lang, w, n = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(w, pa.binary()), pa.array(n, pa.int64())], ["lang", "phrase", "n"])


class TextCounts:
    """Counts of byte strings by language, given out when there are many."""

    def __init__(self):
        self.counts: dict[str, Counter] = {}

    def add(self, lang: str, items: list[bytes]) -> None:
        self.counts.setdefault(lang, Counter()).update(items)

    def full(self) -> bool:
        return sum(map(len, self.counts.values())) > TEXTS

    def given(self) -> pa.RecordBatch:
        out, self.counts = _counted(self.counts), {}
        return out


class Tiles:
    """Counts of pairs of ids: dense square tiles near the origin, sorted coordinates elsewhere."""

    def __init__(self, side: int = SIDE, busy: int = BUSY, fill: int = FILL, room: int = ROOM):
        self.side, self.busy, self.least, self.room = side, busy, side * side // fill, room
        self.dense: dict[int, np.ndarray] = {}
        self.lists: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        low = (i < self.side * self.busy) & (j < self.side * self.busy)
        tile = np.where(low, (i // self.side) * self.busy + j // self.side, self.busy * self.busy)
        hits = np.bincount(tile, minlength=self.busy * self.busy + 1)
        for t in np.flatnonzero(hits[:-1]):
            if t in self.dense or hits[t] >= self.least:
                here = tile == t
                cells = np.bincount((i[here] % self.side) * self.side + j[here] % self.side, minlength=self.side * self.side)
                self.dense[t] = self.dense[t] + cells if t in self.dense else cells
        rest = ~np.isin(tile, list(self.dense)) if self.dense else np.ones(len(i), bool)
        key, n = np.unique((i[rest] << 32) | j[rest], return_counts=True)
        self.lists.append((key, n))
        self.held += len(key)
        if self.held > self.room:
            self._merge()

    def _merge(self) -> None:
        key, n = np.concatenate([k for k, _ in self.lists]), np.concatenate([c for _, c in self.lists])
        self.lists = []
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.lists = [(key[first], np.add.reduceat(n, first) if len(first) else n)]
        self.held = len(first)

    def full(self) -> bool:
        return self.held > self.room // 2

    def given(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys (i << 32 | j) with their counts; the tiles are empty afterwards."""
        for t, cells in self.dense.items():
            at = np.flatnonzero(cells)
            i, j = at // self.side + (t // self.busy) * self.side, at % self.side + (t % self.busy) * self.side
            yield (i << 32) | j, cells[at]
        if self.lists:
            self._merge()
            yield self.lists[0]
        self.dense, self.lists, self.held = {}, [], 0


class _Ids(dict):
    """Word to id; other words end a phrase, or are open where they may be frequent."""

    def __init__(self, beyond: bool, beyond_long: bool):
        super().__init__()
        self.beyond, self.beyond_long = beyond, beyond_long
        self[_MARK] = BREAK

    def __missing__(self, word: bytes) -> int:
        return OPEN if (self.beyond_long if len(word) > LONG else self.beyond) else BREAK


class Known:
    """What tasks get: the words with ids (by falling frequency), the pairs with ranks, and whether frequent ones lie beyond."""

    def __init__(self, words: pa.Table, beyond: bool, beyond_long: bool, pairs: np.ndarray | None = None, pairs_beyond: bool = False):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, words.schema) as out:
            out.write_table(words)
        self.words, self.beyond, self.beyond_long = sink.getvalue().to_pybytes(), beyond, beyond_long
        self.by_rank = pairs if pairs is not None else np.zeros(0, np.int64)
        self.pairs_beyond = pairs_beyond

    def load(self) -> None:
        table = pa.ipc.open_stream(self.words).read_all()
        self.ids: dict[str, _Ids] = {}
        for k, (lang, word) in enumerate(zip(table["lang"].to_pylist(), table["phrase"].to_pylist(), strict=True)):
            self.of(lang)[word] = k
        self.order = np.argsort(self.by_rank)
        self.keys = self.by_rank[self.order]

    def of(self, lang: str) -> _Ids:
        if lang not in self.ids:
            self.ids[lang] = _Ids(self.beyond, self.beyond_long)
        return self.ids[lang]

    def coded(self, lang: str, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.of(lang).__getitem__, words), np.int64, len(words))

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, OPEN where it may be frequent, BREAK where it isn't."""
        both = (first >= 0) & (second >= 0)
        key = np.where(both, (first << 32) | second, -1)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        hit = both & (self.keys[at] == key) if len(self.keys) else np.zeros(len(key), bool)
        out = np.where(both & (not self.pairs_beyond), BREAK, OPEN)
        out[(first == BREAK) | (second == BREAK)] = BREAK
        out[hit] = self.order[at[hit]]
        return out


_LOADED: dict[int, Known] = {}


def _loaded(sent) -> Known:
    """The broadcast of a step, made ready once in a worker; only the last one is held."""
    if sent.id not in _LOADED:
        known = sent.value
        known.load()
        _LOADED.clear()
        _LOADED[sent.id] = known
    return _LOADED[sent.id]


class _Sent:
    """A broadcast with a name of its own."""

    def __init__(self, spark, known: Known):
        self.broadcast = spark.sparkContext.broadcast(known)
        self.id = id(known)

    @property
    def value(self) -> Known:
        return self.broadcast.value


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """lang, phrase (bytes), n of words with n >= least, and per language a row with a null phrase and the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = TextCounts(), Counter()
        for batch in batches:
            for lang, words in _by_lang(batch):
                counts.add(lang, words)
                total[lang] += len(words) - words.count(_MARK)
                if counts.full():
                    yield counts.given()
        yield counts.given()
        rows = [{"lang": lang, "phrase": None, "n": n} for lang, n in total.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())]))

    rows = _texts(docs).mapInArrow(run, "lang string, phrase binary, n bigint")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("phrase").isNull() | (F.col("n") >= least))


def phrase_counts(docs: DataFrame, sent: _Sent, size: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Phrases of 2 or 3 words with n >= least: (key of the first two ids, third id or 0, n) of known ones, (lang, phrase, n) of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tiles, texts = _loaded(sent), Tiles(), TextCounts()

        def given() -> Iterator[pa.RecordBatch]:
            for key, n in tiles.given():
                third = np.zeros(len(key), np.int64)
                if size == 3:
                    key, third = known.by_rank[key >> 32], key & 0xFFFFFFFF
                for k in range(0, len(key), 1 << 16):
                    s = slice(k, k + (1 << 16))
                    none = pa.nulls(len(key[s]))
                    yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(third[s]), none.cast(pa.string()), none.cast(pa.binary()), pa.array(n[s].astype(np.int64))], _PHRASE)

        def told() -> pa.RecordBatch:
            b = texts.given()
            none = pa.nulls(b.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([none, none, b.column(0), b.column(1), b.column(2)], _PHRASE)

        for batch in batches:
            for lang, words in _by_lang(batch):
                x = known.coded(lang, words)
                first, second = x[:-1], x[1:]
                if size == 3:
                    pair = known.ranks(first, second)
                    first, second, last = pair[:-1], pair[1:], x[2:]
                    sure = (first >= 0) & (second >= 0)
                    tiles.add(first[sure], last[sure])
                else:
                    sure = (first >= 0) & (second >= 0)
                    tiles.add(first[sure], second[sure])
                maybe = ~sure & (first != BREAK) & (second != BREAK)
                texts.add(lang, [b" ".join(words[k : k + size]) for k in np.flatnonzero(maybe).tolist()])
                if tiles.full():
                    yield from given()
                if texts.full():
                    yield told()
        yield from given()
        yield told()

    rows = _texts(docs).mapInArrow(run, "key bigint, third bigint, lang string, phrase binary, n bigint")
    found = stored(rows.groupBy("key", "third", "lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
    return found.filter("key is not null").select("key", "third", "n"), found.filter("key is null").select("lang", "phrase", "n")


_PHRASE = ["key", "third", "lang", "phrase", "n"]


def _from_count(rows: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The rows with the largest n, at most `most` of them and whole counts only; whether rows lie beyond. A histogram of at most 70,000 counts decides."""
    n = F.col("n")
    bucket = F.when(n < 1 << 16, n).otherwise(F.lit(1 << 16) + F.floor(F.log2(n.cast("double")) * 64))
    total, cut, beyond = 0, None, False
    for b, c in sorted(((r.b, r.c) for r in rows.groupBy(bucket.alias("b")).agg(F.count("*").alias("c")).collect()), reverse=True):
        if total + c > most:
            beyond = True
            break
        total, cut = total + c, b
    return (rows.filter(bucket >= cut) if cut is not None else rows.filter("false")), beyond


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact in decimals of 38 digits for counts below 10^15."""
    count = lambda c: f"CAST({c} AS DECIMAL(15, 0))"
    return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7, 0)) * ({count(a)} * {count(a)})) DIV ({count(left)} * {count(right)}) AS BIGINT)")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, nested: int = NESTED, words: int = WORDS, pairs: int = PAIRS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases by score, a, phrase.

    a, l, r: occurrences of the phrase and of its parts at the cut with the least score floor(1000000 a a / (l r)); n: of all words. Phrases in a
    longer one with at least `nested` percent of their occurrences go. words, pairs: most words and pairs whose ids are sent to tasks.
    """
    if least < 1 or top < 1 or min(words, pairs) < 1:
        raise ValueError("least, top, words and pairs must be at least 1")
    spark = docs.sparkSession
    counted = stored(word_counts(docs, least))
    frequent, totals = counted.filter("phrase is not null"), counted.filter("phrase is null").select("lang", F.col("n").alias("total"))
    head, beyond = _from_count(frequent.filter(F.octet_length("phrase") <= LONG), words)
    beyond_long = bool(frequent.filter(F.octet_length("phrase") > LONG).limit(1).count())
    table = head.toArrow().sort_by([("n", "descending"), ("lang", "ascending"), ("phrase", "ascending")])
    ids = stored(spark.createDataFrame(table.select(["lang", "phrase"]).append_column("id", pa.array(np.arange(table.num_rows)))) if table.num_rows else head.select("lang", "phrase", F.lit(0).cast("bigint").alias("id")))

    coded, told = phrase_counts(docs, _Sent(spark, Known(table, beyond, beyond_long)), 2, least)
    best, pairs_beyond = _from_count(coded, pairs)
    ranked = best.select("key", "n").toArrow().sort_by([("n", "descending"), ("key", "ascending")])
    keys = pc.cast(ranked["key"], pa.int64()).to_numpy()
    coded3, told3 = phrase_counts(docs, _Sent(spark, Known(table, beyond, beyond_long, keys, pairs_beyond)), 3, least)

    def named(rows: DataFrame, k: int) -> DataFrame:
        ids_of = ids.select(F.col("id").alias("i"), F.col("lang").alias("lang_"), F.col("phrase").cast("string").alias(f"w{k}"))
        code = [F.col("key").bitwiseAND(F.lit(0)), F.shiftright("key", 32), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), F.col("third")][k]
        rows = rows.withColumn("i", code).join(F.broadcast(ids_of), "i").drop("i")
        return rows.withColumn("lang", F.col("lang_")).drop("lang_")

    def split(rows: DataFrame, size: int) -> DataFrame:
        parts = F.split(F.col("phrase").cast("string"), " ")
        return rows.select("lang", *(parts[k].alias(f"w{k + 1}") for k in range(size)), F.col("n").alias("a"))

    two = named(named(coded, 1), 2).select("lang", "w1", "w2", F.col("n").alias("a")).unionByName(split(told, 2))
    three = named(named(named(coded3, 1), 2), 3).select("lang", "w1", "w2", "w3", F.col("n").alias("a")).unionByName(split(told3, 3))
    two, three = stored(two), stored(three)

    small = not beyond and not beyond_long  # then at most `words` words of LONG bytes
    single = frequent.select("lang", F.col("phrase").cast("string").alias("w"), "n")

    def with_word(rows: DataFrame, word: str, name: str) -> DataFrame:
        return joined(rows, single.select("lang", F.col("w").alias(word), F.col("n").alias(name)), ["lang", word], small)

    def with_pair(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
        return rows.join(two.select("lang", F.col("w1").alias(a), F.col("w2").alias(b), F.col("a").alias(name)), ["lang", a, b])

    inside = three.select("lang", "w1", "w2", "a").unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longer = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    free = two.join(longer, ["lang", "w1", "w2"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < nested * F.col("a")))
    short = with_word(with_word(free, "w1", "l"), "w2", "r").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    both = with_pair(with_pair(with_word(with_word(three, "w1", "l1"), "w3", "r2"), "w1", "w2", "l2"), "w2", "w3", "r1")
    cuts = both.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", *(F.struct(F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"), _score("a", f"l{k}", f"r{k}").alias("score")).alias(f"c{k}") for k in (1, 2)))
    long = cuts.select("lang", "phrase", "a", F.when(F.col("c2.score") < F.col("c1.score"), F.col("c2")).otherwise(F.col("c1")).alias("c")).select("lang", "phrase", "a", "c.*")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = short.unionByName(long).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    listed = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    return listed.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def oracle() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    score = "CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT)"
    return f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM p),
o AS (SELECT lang, w, unnest(range(len(w))) AS k FROM w WHERE len(w) > 0),
f1 AS (SELECT lang, w[k + 1] AS w1, count(*) AS n FROM o GROUP BY ALL),
f2 AS (SELECT lang, w[k + 1] AS w1, w[k + 2] AS w2, count(*) AS n FROM o WHERE k + 2 <= len(w) GROUP BY ALL),
f3 AS (SELECT lang, w[k + 1] AS w1, w[k + 2] AS w2, w[k + 3] AS w3, count(*) AS a FROM o WHERE k + 3 <= len(w) GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
total AS (SELECT lang, sum(n) AS n FROM f1 GROUP BY lang),
longer AS (SELECT lang, w1, w2, max(a) AS m FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
two AS (SELECT f2.lang, concat(f2.w1, ' ', f2.w2) AS phrase, f2.n AS a, x.n AS l, y.n AS r, 1 AS cut
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN longer g ON g.lang = f2.lang AND g.w1 = f2.w1 AND g.w2 = f2.w2
  WHERE f2.n >= {MIN_COUNT} AND (m IS NULL OR 100 * m < {NESTED} * f2.n)),
three AS (SELECT f3.lang, concat(f3.w1, ' ', f3.w2, ' ', f3.w3) AS phrase, a, x.n AS l, y.n AS r, 1 AS cut
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL SELECT f3.lang, concat(f3.w1, ' ', f3.w2, ' ', f3.w3), a, x.n, y.n, 2
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
s AS (SELECT *, {score} AS score FROM (SELECT * FROM two UNION ALL SELECT * FROM three)),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT k.lang, k.rank, k.phrase, CAST(k.a AS BIGINT) AS a, CAST(k.l AS BIGINT) AS l, CAST(k.r AS BIGINT) AS r, CAST(total.n AS BIGINT) AS n, k.score
FROM k JOIN total ON total.lang = k.lang WHERE k.rank <= {TOP}"""
