"""Lines that repeat across documents: levelled sorted runs of line hashes, DataFrame operations only.

A line's key is the line without white space at both ends, A-Z lower-cased; keys of fewer than ``MIN_CHARS`` code points are of no interest. Documents come in batches.
Each batch's keys, one row a key with the number of its documents, are merge-joined against all runs so far; only keys that no run holds (the anti-join's rows) are
marked fresh and name their largest document as keeper. Then they become a run of their own, bucketed and sorted by hash, so that later batches
are shuffled to the runs and the runs never move. When a level has ``FANOUT`` runs, they are merged into one of the next level: a key's counts add up, its keeper comes
from its one fresh row. So a key is rewritten once a level, and a batch meets at most FANOUT - 1 runs a level.

`repeated_lines` deals a table into batches by falling doc_id, so the fresh row of a key lies in the batch of the largest document that holds it. A key that a third of all
documents hold is summed by document and then by key before it meets a run, so it is one row there; when the lines that go are found, keys with a thousandth of all lines or
more (a thousand at most) are broadcast, and no other is hot.

Hashes have 128 bits (two seeds of XXH64); texts move once at most, to meet the positions of their dropped lines.

Null and empty texts are one empty line. A document is a doc_id: rows that repeat one count once and are each rewritten; a null doc_id is one document, smaller than all others. Ties can't
occur, as one document alone is the largest. An empty table gives an empty table. Only doc_id and text are read, so other columns can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm.common import stored
from boxlake.scratch import dropped, plain, stored_sorted

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 8, 4
#: Keys with at least one in HEAVY lines are broadcast, so at most HEAVY of them, with 24 bytes each.
HEAVY = 1000
_BLANKS = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


class Runs:
    """The runs of line keys seen so far, by level; a run has h1, h2, docs and, in fresh rows, keeper."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, DataFrame]]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for _, run in level]

    def marked(self, keys: DataFrame) -> DataFrame:
        """keys (h1, h2, docs, keeper; one row a key) with fresh: whether no run holds the key. Runs are read where they lie."""
        seen = F.lit(False)
        for k, run in enumerate(self.runs()):
            keys = keys.join(run.filter("fresh").select(*HASH, F.lit(True).alias(f"in{k}")).hint("merge"), HASH, "left")
            seen = seen | F.coalesce(f"in{k}", F.lit(False))
        return keys.select(*HASH, "docs", F.when(~seen, F.col("keeper")).alias("keeper"), (~seen).alias("fresh"))

    def add(self, keys: DataFrame) -> None:
        """Marks the keys of a batch and adds them as a run; levels that are full are compacted."""
        self.levels[0].append(stored_sorted(self.marked(keys), HASH, self.buckets))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if len(self.levels) == level + 1:
                self.levels.append([])
            merged = stored_sorted(self._summed(self.levels[level]), HASH, self.buckets)
            old, self.levels[level] = self.levels[level], []
            self.levels[level + 1].append(merged)
            for n, _ in old:
                dropped(self.spark, n)
            level += 1

    def totals(self) -> DataFrame:
        """h1, h2, docs, keeper over all runs."""
        return self._summed([run for level in self.levels for run in level]).drop("fresh")

    def _summed(self, runs: list[tuple[str, DataFrame]]) -> DataFrame:
        keeper = F.max(F.when(F.col("fresh"), F.col("keeper"))).alias("keeper")
        rows = plain(self.spark, [name for name, _ in runs])
        return rows.groupBy(*HASH).agg(F.sum("docs").alias("docs"), keeper, F.bool_or("fresh").alias("fresh"))

    def close(self) -> None:
        for level in self.levels:
            for name, _ in level:
                dropped(self.spark, name)
        self.levels = [[]]


def _lines(docs: DataFrame, batch: Column, min_chars: int) -> DataFrame:
    """batch, d, doc_id, row (a hash of the row), pos, h1, h2 of each line with a long enough key."""
    rows = docs.select(batch.alias("batch"), "d", "doc_id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.filter(F.char_length("line") >= min_chars).withColumn("line", F.trim("line", F.lit(_BLANKS))).filter(F.char_length("line") >= min_chars)
    key = F.translate("line", _UPPER, _LOWER)
    return rows.select("batch", "d", "doc_id", "row", "pos", F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"))


def batch_keys(lines: DataFrame) -> DataFrame:
    """h1, h2, docs, keeper of lines (doc_id, h1, h2), summed by document first, so that no key's rows meet in one task."""
    each = lines.select(*HASH, "doc_id").distinct()
    return each.groupBy(*HASH).agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))


def _kept(text: Column, drops: Column) -> Column:
    """text without the lines at the positions drops (ascending, from 0): slices between them, so linear in the text."""

    def without(lines: Column) -> Column:
        def part(k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(drops, k - 1) + 1)
            stop = F.coalesce(F.get(drops, k), F.size(lines))
            return F.slice(lines, start + 1, stop - start)

        return F.concat_ws("\n", F.flatten(F.transform(F.sequence(F.lit(0), F.size(drops)), part)))

    return F.transform(F.array(F.split(text, "\n")), without)[0]  # the split text is bound once


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, n_lines, n_dropped and text (without the lines that go) of each row of docs (doc_id, text).

    Keys of at least min_chars code points in at least min_docs documents stay only in the largest doc_id that holds them.
    """
    if min_chars < 1 or min_docs < 2 or batches < 1:
        raise ValueError("min_chars and batches must be at least 1, min_docs at least 2")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("d", F.coalesce("doc_id", F.lit(0))).withColumn("row", F.xxhash64(F.col("doc_id").isNull(), F.col("text")))
    cuts = sorted(set(docs.agg(F.percentile_approx(F.col("doc_id").cast("bigint"), [k / batches for k in range(1, batches)] or [0.5], 1000)).first()[0] or []))
    batch = F.coalesce(sum((F.when(F.col("doc_id") <= c, 1).otherwise(0) for c in cuts), F.lit(0)), F.lit(0))
    batch = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(batch)  # 0: the largest ids
    lines = stored(_lines(rows, batch.cast("int"), min_chars), by=("batch",))

    runs = Runs(spark, fanout)
    for b in range(len(cuts) + 1):
        runs.add(batch_keys(lines.filter(F.col("batch") == b)))
    frequent = stored(runs.totals().filter(F.col("docs") >= min_docs))
    runs.close()

    heavy = F.col("docs") * HEAVY >= lines.count()
    lines, hot = lines.drop("batch"), F.broadcast(frequent.filter(heavy).select(*HASH, "keeper"))
    held = lines.join(hot, HASH).unionByName(lines.join(hot, HASH, "left_anti").join(frequent.filter(~heavy).select(*HASH, "keeper").hint("merge"), HASH))
    gone = held.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    drops = stored(gone.groupBy("d", "row").agg(F.array_sort(F.collect_set("pos")).alias("drops")))
    full = rows.join(drops.hint("merge"), ["d", "row"], "left")
    none = F.col("drops").isNull()
    return full.select(
        "doc_id",
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.when(none, 0).otherwise(F.size("drops")).cast("bigint").alias("n_dropped"),
        F.when(none, F.col("text")).otherwise(_kept(F.col("text"), F.col("drops"))).alias("text"),
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for each row of docs."""
    return dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def oracle() -> str:
    blanks = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, doc_id, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM s),
k AS (SELECT *, translate(trim(line, {blanks}), '{_UPPER}', '{_LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
g AS (SELECT r, k.doc_id, line, pos, coalesce(k.doc_id < keeper, false) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM g GROUP BY r, doc_id"""
