"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Candidates come from the SimHash index (``simhash.clusters``) over wide fingerprints of the shingle sets: byte positions, a count of shared half-bytes, then
the differing bits; a pair at exactly 0.8 is missed in about 2 of a million cases, and less above. Every candidate is verified
with its whole shingle sets, so no pair below the limit is linked. Equal texts are one node, found by their SHA-256.

A bucket is a cluster of one posting list. Its texts are compared with its lead first, the text with the most exact copies. What these links join
needs no further comparison. Where texts of a bucket are still apart, the bucket is compared in whole: blocks of about
``BLOCK`` texts meet block by block, a task counts the shared shingles of two blocks by products of their incidence
matrices, and only a spanning forest of what it links leaves the task. So no pairs become rows, and no bucket is cut short; the work on a
bucket of dissimilar texts is quadratic in it.

A large group of similar texts has buckets in all posting lists, and none equals another. So a sixth of the lists goes first. Buckets that overlap make a
union, which is compared once instead of them where that takes no more comparisons than its buckets in all lists. Then the other lists follow, without
the clusters whose texts are all of one root or of one compared union. So such a group is posted in whole in 16 lists, not in 96.

Words are as in the fingerprints. A text of fewer than five words has one shingle, all its words; a null text is an
empty one, and all empty texts are copies. A null doc_id never names a group unless all its members are null. A very long text is one
set of hashes, eight bytes a word. Repeated rows keep their rows in the groups. An empty table gives an empty table. Only ``doc_id`` and ``text`` are
read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import ASCII_LOWER, representatives, stored, text_key
from boxlake.llm.simhash import SEED, VERIFIED, clusters, components, posting_words, wide
from boxlake.llm.simhash import WORDS as WIDE_WORDS

WORDS = 5
BLOCK = 512
_COLUMNS = 1 << 12
#: Words of postings in a wide fingerprint, and how many of them go first.
POSTED, EARLY = WIDE_WORDS - VERIFIED, 3


def shingles(text: bytes | None) -> np.ndarray:
    """The distinct hashes of a UTF-8 text's five-word windows, sorted."""
    from xxhash import xxh64_intdigest

    words = (text or b"").translate(ASCII_LOWER).split()
    joined, n = b" ".join(words), len(words)
    if n < WORDS:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    spans = zip((end - size)[: n - WORDS + 1].tolist(), end[WORDS - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, n - WORDS + 1))


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        known: dict[bytes, tuple[int, bytes]] = {}  # copies within a batch are hashed once
        found = []
        for key, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if key not in known:
                s = shingles(text)
                known[key] = (len(s), wide(s))
            found.append(known[key])
        columns = [*b.columns[:2], pa.array([n for n, _ in found], pa.int32()), pa.array([fp for _, fp in found], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n", "fp"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            sets = [shingles(t).view(np.int64) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["key", "s"])


def alike(shared, a, b):
    """Whether sets of sizes a and b that share so many hashes have a Jaccard similarity of at least 0.8."""
    return 9 * shared >= 4 * (a + b)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (fp, other) of the pairs (key, other) whose sets (key, s: one row each) are alike enough."""
    left = pairs.join(sets.hint("merge"), "key")
    both = left.join(sets.select(F.col("key").alias("other"), F.col("s").alias("t")).hint("merge"), "other")
    return stored(both.filter(alike(F.size(F.array_intersect("s", "t")), F.size("s"), F.size("t"))).select(F.col("key").alias("fp"), "other"))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common hashes of each set on the left with each one on the right."""
    place, size = np.unique(np.concatenate([*left, *right]), return_inverse=True), [len(s) for s in (*left, *right)]
    column, row = place[1], np.repeat(np.arange(len(size)), size)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(place[0]), _COLUMNS):
        a, b = np.searchsorted(column, [first, first + _COLUMNS])
        there = np.zeros((len(size), _COLUMNS), np.float32)
        there[row[a:b], column[a:b] - first] = 1
        out += there[: len(left)] @ there[len(left) :].T
    return out


def block_links(rows: list[tuple], same: bool) -> list[tuple]:
    """A spanning forest of the links between two blocks; rows: (is_right, key, root, set), all of one block if same."""
    left = [r for r in rows if not r[0]]
    right = left if same else [r for r in rows if r[0]]
    if not left or not right:
        return []
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    a, b = (np.array([len(r[3]) for r in x]) for x in (left, right))
    near = alike(shared_counts([r[3] for r in left], [r[3] for r in right]), a[:, None], b[None, :])
    out = []
    for i, j in np.argwhere(np.triu(near, 1) if same else near).tolist():
        x, y = find(left[i][2]), find(right[j][2])
        if x != y:
            parent[y] = x
            out.append((left[i][1], right[j][1]))
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair of blocks; rows (h, lo, hi, block, key, root, s) come sorted by h, lo, hi."""
    open_, rows = None, []

    def links() -> pa.RecordBatch:
        found = block_links(rows, open_[1] == open_[2])
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], ["fp", "other"])

    for b in batches:
        h, lo, hi, block, key, root = (b.column(i).to_pylist() for i in range(6))
        for i in range(b.num_rows):
            group = (h[i], lo[i], hi[i])
            if group != open_:
                if rows:
                    yield links()
                open_, rows = group, []
            rows.append((lo[i] != hi[i] and block[i] == hi[i], key[i], root[i], b.column(6)[i].values.to_numpy()))
    if rows:
        yield links()


def compared(rest: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (fp, other) within buckets; rest: (h, key, root), where texts of one root need no link."""
    sizes = rest.groupBy("h").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = rest.join(sizes.hint("merge"), "h").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("far", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("h", F.least("block", "far").alias("lo"), F.greatest("block", "far").alias("hi"), "block", "key", "root")
    dealt = dealt.join(sets.hint("merge"), "key").select("h", "lo", "hi", "block", "key", "root", "s")
    dealt = dealt.repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi")
    return stored(dealt.mapInArrow(_blocks, "fp binary, other binary"))


def _place(id_: str) -> Column:
    return F.coalesce(id_, F.lit(-(1 << 63))).alias("place")


def rooted(tied: DataFrame) -> DataFrame:
    """components() as (key, root), with a row for each root itself."""
    return tied.select(F.col("node").alias("key"), "root").unionByName(tied.select(F.col("root").alias("key"), "root").distinct())


def unions(near: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """Buckets that overlap, where the union takes no more comparisons than `share` times its buckets: (key, union) of their texts, (h) of the buckets.

    near: (h, key, lead, size), a row for each text of a bucket but its lead.
    """
    tied = rooted(components(near.select(F.col("key").alias("fp"), F.col("lead").alias("other"))))
    tied = stored(tied.withColumnRenamed("root", "union"))
    texts = tied.groupBy("union").agg(F.count("*").alias("texts"))
    buckets = near.groupBy("h").agg(F.any_value("lead").alias("key"), F.any_value("size").cast("double").alias("size"))
    buckets = stored(buckets.join(tied.hint("merge"), "key").select("h", "union", "size"))
    cost = buckets.groupBy("union").agg(F.sum(F.col("size") * F.col("size")).alias("cost"))
    whole = stored(cost.join(texts.hint("merge"), "union").filter(F.col("texts").cast("double") * F.col("texts") <= share * F.col("cost")).select("union"))
    return tuple(stored(x.join(whole.hint("merge"), "union").select(*c)) for x, c in ((tied, ("key", "union")), (buckets, ("h",))))


def linked(rows: DataFrame, reps: DataFrame, texts: DataFrame, before: DataFrame | None, share: float) -> tuple[DataFrame, DataFrame]:
    """Links (fp, other) among the texts that clusters(texts) puts together, and (key, root): texts of one root are linked, or compared in whole.

    rows: (doc_id, key, text) of all documents; reps: (key, first_id) of all texts; before: links that are known; share: of unions(), 0 for none.
    """
    posted = stored(clusters(texts))
    buckets = posted.groupBy("h").agg(F.max(F.struct("copies", "key", "n")).alias("lead"), F.count("*").alias("size")).filter("size > 1")
    near = posted.join(buckets.hint("merge"), "h").filter(F.col("key") != F.col("lead.key"))
    near = stored(near.select("h", "key", "n", F.col("lead.key").alias("lead"), F.col("lead.n").alias("m"), "size"))
    # one row of each text that has to be compared; copies of it are spread by their ids
    wanted = near.select("key").unionByName(near.select(F.col("lead").alias("key"))).distinct()
    wanted = wanted.join(reps.select("key", _place("first_id")).hint("merge"), "key")
    sets = rows.select("key", _place("doc_id"), "text").join(wanted.hint("merge"), ["key", "place"], "left_semi").dropDuplicates(["key", "place"])
    sets = stored(sets.select("key", "text").mapInArrow(_sets, "key binary, s array<bigint>"))
    fits = 5 * F.least("n", "m") >= 4 * F.greatest("n", "m")
    first = verified(near.filter(fits).select("key", F.col("lead").alias("other")).distinct(), sets)
    if before is not None:
        first = before.unionByName(first)

    # what the first links leave apart within a bucket or a union; pairs with a bucket's lead are done
    tied = rooted(components(first))
    rest, done = near.filter("size > 2").select("h", "key"), tied
    if share:
        members, parts = unions(near, share)
        rest = rest.join(parts.hint("merge"), "h", "left_anti").unionByName(members.select(F.xxhash64("union").alias("h"), "key"))
        done = tied.join(members.hint("merge"), "key", "full").select("key", F.coalesce("union", "root").alias("root"))
    rest = rest.join(tied.hint("merge"), "key", "left")
    rest = stored(rest.select("h", "key", F.coalesce("root", "key").alias("root")))
    apart = rest.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("h")
    return first.unionByName(compared(rest.join(apart.hint("merge"), "h", "left_semi"), sets)), done


def groups(docs: DataFrame) -> DataFrame:
    """(key, first_id, repeats, root) for each distinct text of docs; texts of one root are near copies.

    key: text_key(). first_id: the text's least doc_id; repeats: rows with this text and id.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key("text").alias("key"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    reps = stored(representatives(stored(rows.mapInArrow(_printed, "doc_id bigint, key binary, n int, fp binary")), "n", "fp"))
    texts = ["key", "n", "copies"]
    links, done = linked(rows, reps, reps.select(*texts, posting_words(0, EARLY).alias("fp")), None, POSTED / EARLY)
    others = reps.select(*texts, posting_words(EARLY, POSTED).alias("fp")).join(stored(done).hint("merge"), "key", "left")
    links, _ = linked(rows, reps, others, links, 0)
    tied = components(links).withColumnRenamed("node", "key")
    each = reps.select("key", "first_id", "repeats").join(tied.hint("merge"), "key", "left")
    return each.select("key", "first_id", "repeats", F.coalesce("root", "key").alias("root"))
