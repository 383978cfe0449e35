"""SimHash near-duplicates by an inverted index over byte positions with count filtering.

Two fingerprints of 64 bits that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they share
at least 5 positional bytes. Any three byte positions lie in one of the 14 four-element sets of positions whose
exclusive or is zero (a Steiner system), hence the other four positions, which are again such a set, agree.
The index therefore has one posting per fingerprint and set: the bytes at those four positions. Pairs of one
posting list are tallied (equal positional bytes), pairs with fewer than 5 are dropped, the others are verified
by their differing bits.

A posting list longer than ``LIST_LIMIT`` is not paired but split exactly: its pairs share one of the other four
bytes too, and then three of the remaining six half-bytes, which leaves at most 4096 fingerprints in a list. Each
list returns a spanning forest of its links, never all of them, which keeps every component whole.

Wider limits, as a Jaccard similarity asks for, take wide fingerprints (``wide``): 192 bits that are tallied and verified, and
96 postings of a byte and a half-byte each. Pairs of a posting list that share fewer than ``MIN_HALVES`` half-bytes are
dropped, the others are verified by their differing bits, and what is linked leaves the list as one cluster (``clusters``).
Of texts whose sets of shingles have a similarity of 0.8, a bit differs with a probability of at most 0.156, so a pair
has no common list in 1.4, too few half-bytes in 0.2 and too many differing bits in 0.7 of a million cases. A posting list beyond
``WIDE_LIMIT`` is dealt out: those within the limit of its lead are one cluster, and blocks of the rest meet blocks of the whole list.

Nulls: a null text is an empty text, whose fingerprint is zero. A null doc_id never names a component unless all
its members are null. Repeated rows keep their rows. An empty table gives an empty table. Only ``doc_id`` and
``text`` are read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import ASCII_LOWER, free_name, representatives, stored, text_key

SEED = 42
SHINGLE = 3
MAX_BITS = 3
MIN_BYTES = 5
LIST_LIMIT = 1024
#: The 14 sets of four byte positions whose exclusive or is zero.
PLANES = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
_STEP = 1 << 18
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mask(positions, width: int = 8) -> int:
    return sum(((1 << width) - 1) << (width * p) for p in positions)


def fingerprint(text: bytes | None) -> int:
    """The unsigned SimHash of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n < SHINGLE:
        return xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: n - SHINGLE + 1], end[SHINGLE - 1 :]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(first), _STEP):
        spans = zip(first[i : i + _STEP].tolist(), last[i : i + _STEP].tolist(), strict=True)
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8").view(np.uint8).reshape(-1, 8)
        if len(h) < 400:
            counts += np.unpackbits(h, axis=1, bitorder="little").sum(0, dtype=np.int64)
        else:
            counts += np.concatenate([np.bincount(h[:, k], minlength=256) @ _BITS for k in range(8)])
    bits = (2 * counts > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


#: Wide fingerprints: words of 64 bits in all, words that are verified, bits of a posting, postings.
WORDS, VERIFIED, PART = 21, 3, 12
POSTINGS = (WORDS - VERIFIED) * 64 // PART
MIN_HALVES, WIDE_BITS = 8, 56
#: Sets of at most FINE[1] hashes have a fingerprint in which each hash counts as FINE_COPIES ones (few votes tie often); from FINE[0] on they have the plain one.
FINE, FINE_COPIES = (32, 40), 8
#: Rows of a posting list that one task compares; rows of a block of a longer one; lists up to PAIRED are compared many at once.
WIDE_LIMIT, WIDE_BLOCK, PAIRED = 1 << 14, 1 << 13, 256
_RANDOM = np.random.default_rng(SEED).integers(0, 1 << 64, WORDS + FINE_COPIES, np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LANES, _HALVES = np.uint64(0x0101010101010101), np.uint64(0x1111111111111111)


def _votes(hashes: np.ndarray) -> bytes:
    counts = np.zeros((8, WORDS * 8), np.int64)
    for i in range(0, len(hashes), 255):  # a byte counts up to 255 votes
        x = hashes[i : i + 255, None] * _RANDOM[:WORDS]
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x ^= x >> np.uint64(29)
        for k in range(8):
            counts[k] += ((x >> np.uint64(k)) & _LANES).sum(0, dtype=np.uint64).view(np.uint8)
    return np.packbits((2 * counts > len(hashes)).T.ravel(), bitorder="little").tobytes()


def wide(hashes: np.ndarray) -> bytes:
    """The wide SimHash of a set of 64-bit hashes: the plain fingerprint, the fine one, or both."""
    out = b""
    if len(hashes) >= FINE[0]:
        out += _votes(hashes)
    if len(hashes) <= FINE[1]:
        x = hashes[:, None] * _RANDOM[WORDS:]
        out += _votes(((x ^ (x >> np.uint64(32))) * _MIX).ravel())
    return out


def posting_words(first: int, last: int) -> Column:
    """Of wide fingerprints `fp`, the sketch and these of the words that make postings; three words make 16."""
    starts = (8 * WORDS * kind + 1 for kind in (0, 1))
    return F.concat(*(F.substring("fp", at + 8 * skip, 8 * n) for at in starts for skip, n in ((0, VERIFIED), (VERIFIED + first, last - first))))


def _unpacked(n: pa.Array, fp: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, words, kind) of the plain and of the fine fingerprints of a batch."""
    n, fp = n.to_numpy(zero_copy_only=False), fp.to_pylist()
    size = len(fp[0]) // (int(n[0] >= FINE[0]) + int(n[0] <= FINE[1])) if fp else 0
    for kind, rows in enumerate((np.flatnonzero(n >= FINE[0]), np.flatnonzero(n <= FINE[1]))):
        if len(rows):
            part = b"".join(fp[i][-size:] if kind else fp[i][:size] for i in rows.tolist())
            yield rows, np.frombuffer(part, "<u8").reshape(-1, size // 8), kind


_SKETCH = "a bigint, b bigint, c bigint"


def _arrays(words: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(words[:, i]).view(np.int64)) for i in range(VERIFIED)]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n, copies, fp) -> (key, n, copies, sketch)."""
    for b in batches:
        for rows, words, _ in _unpacked(b.column(1), b.column(3)):
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(rows)) for i in range(3)), *_arrays(words)], ["key", "n", "copies", "a", "b", "c"])


def _posted_wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, fp, root) -> (posting, root, sketch), a row for each posting."""
    for whole in batches:
        for i in range(0, whole.num_rows, 512):
            b = whole.slice(i, 512)
            for rows, words, kind in _unpacked(b.column(0), b.column(1)):
                x = np.ascontiguousarray(words[:, VERIFIED:]).view(np.uint8).reshape(len(words), -1, 3).astype(np.int32)
                x = x[:, :, 0] | x[:, :, 1] << 8 | x[:, :, 2] << 16
                parts = np.stack([x & 0xFFF, x >> PART], 2).reshape(len(words), -1)
                n = parts.shape[1]
                posting = parts | (np.arange(n, dtype=np.int32) + kind * POSTINGS) << PART
                root = pa.array(np.repeat(b.column(2).to_numpy()[rows], n))
                yield pa.RecordBatch.from_arrays([pa.array(posting.ravel()), root, *_arrays(np.repeat(words, n, 0))], ["posting", "root", "a", "b", "c"])


def near_sketches(x: np.ndarray, limit: int) -> np.ndarray:
    """Places of pairs within the limit; x: (VERIFIED, pairs), the exclusive or of their sketches."""
    y = x | x >> np.uint64(1)
    y |= y >> np.uint64(2)
    unlike = np.bitwise_count(y & _HALVES).sum(0, dtype=np.uint8)
    tallied = np.flatnonzero(unlike <= 16 * VERIFIED - MIN_HALVES)  # shared half-bytes
    return tallied[np.bitwise_count(x[:, tallied]).sum(0, dtype=np.int64) <= limit]


def _spread(fps: np.ndarray, limit: int) -> np.ndarray:
    """The component of each sketch, found by walking from a sketch to all that are left; fps: (VERIFIED, rows)."""
    label, left = np.arange(fps.shape[1]), np.arange(1, fps.shape[1])
    front, seed, rest = [0], 0, fps[:, 1:]
    while left.size:
        if not front:
            seed, left, rest = int(left[0]), left[1:], rest[:, 1:]
            front = [seed]
        near = near_sketches(rest ^ fps[:, front.pop(), None], limit)
        if near.size:
            label[left[near]] = seed
            front += left[near].tolist()
            left, rest = np.delete(left, near), np.delete(rest, near, 1)
    return label


def _paired(fps: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    """The component of each sketch of many lists; end: where a row's list ends."""
    label = np.arange(fps.shape[1])

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    far, d = np.flatnonzero(end - label > 1), 1
    while far.size:
        linked = False
        apart = far[label[far] != label[far + d]]  # what is linked already needs no comparison
        for i in range(0, len(apart), 1 << 15):
            at = apart[i : i + (1 << 15)]
            for x in at[near_sketches(fps[:, at] ^ fps[:, at + d], limit)].tolist():
                label[find(x + d)] = find(x)
                linked = True
        while linked:  # every row gets its root
            above = label[label]
            linked = bool((above != label).any())
            label = above
        d += 1
        far = far[end[far] - far > d]
    return label


def _clustered(limit: int, longest: int | None):
    """Clusters of the posting lists in sorted (list..., rest boolean, root, sketch) rows; rows of a list beyond `longest` as they are.

    Out: (posting, h, root, sketch) with posting -1 and h, a hash of the members, for clusters. A list's cluster without a `rest` row does not count,
    nor one whose rows have one root; root 0 is none.
    """
    out = ["posting", "h", "root", "a", "b", "c"]

    def found(label: np.ndarray, tags: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        """tags: (rest and root, rows)."""
        order = np.lexsort((*fps, label))
        label, (rest, root), fps = label[order], tags[:, order], fps[:, order]
        new = np.r_[True, np.diff(label) != 0]
        start = np.flatnonzero(new)
        counts = np.add.reduceat(rest, start) > 0
        once = new | np.r_[True, (np.diff(fps.view(np.int64)) != 0).any(0)]  # repeated sketches go
        group, fps = (np.cumsum(new) - 1)[once], fps[:, once]
        mixed = (fps * _RANDOM[:VERIFIED, None]).sum(0, dtype=np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
        h = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), np.flatnonzero(np.r_[True, np.diff(group) != 0]))
        apart = (np.minimum.reduceat(root, start) != np.maximum.reduceat(root, start)) | np.logical_or.reduceat(root == 0, start)
        good = (counts & apart & (np.bincount(group) > 1))[group]
        if good.any():
            n = int(good.sum())
            fixed = [pa.array(np.full(n, -1, np.int32)), pa.array(h[group[good]].view(np.int64)), pa.array(np.zeros(n, np.int64))]
            yield pa.RecordBatch.from_arrays([*fixed, *_arrays(fps[:, good].T)], out)

    def whole(end: np.ndarray, size: np.ndarray, tags: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of whole lists."""
        few = size <= PAIRED
        if few.any():
            at = np.flatnonzero(few)
            moved = np.cumsum(few)  # where a row is among those of short lists
            yield from found(_paired(fps[:, at], moved[end[at] - 1], limit), tags[:, at], fps[:, at])
        for i in np.unique(end[~few] - size[~few]).tolist():
            j = i + int(size[i])
            yield from found(_spread(fps[:, i:j], limit), tags[:, i:j], fps[:, i:j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over = None, None  # rows of the open list, at most the limit and a batch; the list that passes through
        for x in batches:
            names = len(x.columns) - VERIFIED - 2
            k = np.stack([x.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(names)])
            tags = np.stack([x.column(names + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1)])
            fps = np.stack([x.column(names + 2 + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(VERIFIED)]).view(np.uint64)
            if held is not None:
                k, tags, fps = (np.concatenate(z, 1) for z in zip(held, (k, tags, fps), strict=True))
                held = None
            rows = tags.shape[1]
            if not rows:
                continue
            cut = np.flatnonzero((np.diff(k) != 0).any(0)) + 1
            start, stop = np.r_[0, cut], np.r_[cut, rows]
            size = np.repeat(stop - start, stop - start)
            end = np.repeat(stop, stop - start)
            big = size > longest if longest else np.zeros(rows, bool)
            if over is not None and tuple(k[:, 0]) == over:
                big[: stop[0]] = True
            if big.any():
                yield pa.RecordBatch.from_arrays([pa.array(k[0, big].astype(np.int32)), pa.nulls(int(big.sum()), pa.int64()), pa.array(tags[1, big]), *_arrays(fps[:, big].T)], out)
            over = tuple(k[:, -1]) if big[-1] else None
            last = 0 if big[-1] else int(stop[-1] - start[-1])
            if last:
                held = (k[:, -last:], tags[:, -last:], fps[:, -last:])
            done = ~big
            done[rows - last :] = False
            if done.any():
                at = np.cumsum(done)
                yield from whole(at[end[done] - 1], size[done], tags[:, done], fps[:, done])
        if held is not None:
            n = held[1].shape[1]
            yield from whole(np.full(n, n), np.full(n, n), held[1], held[2])

    return run


def clusters(texts: DataFrame, limit: int = WIDE_BITS, longest: int = WIDE_LIMIT, block: int = WIDE_BLOCK) -> DataFrame:
    """(h, key, n, copies): any two texts that share a posting and are within the limit have an h in common.

    texts: (key, n, copies, fp), with n hashes and their wide(), or the same posting_words() of it, as fp. With a column root, which can be null, the texts
    have been through other postings: pairs of one root or of one sketch need no h.
    """
    again = "root" in texts.columns
    root = F.when(F.col("root").isNotNull(), F.xxhash64("root")).otherwise(0) if again else F.lit(0)
    sketch, out = ["a", "b", "c"], f"posting int, h bigint, root bigint, {_SKETCH}"
    posted = texts.select("n", "fp", root.cast("bigint").alias("root")).mapInArrow(_posted_wide, f"posting int, root bigint, {_SKETCH}")
    lists = posted.repartition("posting").sortWithinPartitions("posting").select("posting", F.lit(True).alias("rest"), "root", *sketch)
    first = stored(lists.mapInArrow(_clustered(limit, longest), out))
    known = first.filter("posting = -1").select("h", *sketch)
    over = first.filter("posting >= 0").select("posting", "root", *sketch)
    if not over.isEmpty():
        lead = over.groupBy("posting").agg(F.min(F.struct(F.xxhash64(*sketch).alias("order"), *sketch)).alias("lead"))
        unlike = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(f"lead.{x}"))) for x in sketch), F.lit(0))
        over = stored(over.join(lead.hint("merge"), "posting").select("posting", "root", *sketch, (unlike > limit).alias("rest")))
        blocks = [F.ceil(F.count(x) / block).cast("int") for x in ("*", F.when(F.col("rest"), 1))]
        sizes = over.groupBy("posting").agg(blocks[0].alias("blocks"), blocks[1].alias("rests"))
        dealt = over.join(sizes.hint("merge"), "posting").withColumn("x", F.xxhash64(*sketch)).filter("rests > 0")
        each, far = F.pmod("x", "blocks").cast("int"), F.pmod("x", "rests").cast("int")
        every = [F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("blocks", "rests")]
        met = dealt.select("posting", each.alias("i"), every[1].alias("j"), F.lit(False).alias("rest"), "root", *sketch)
        met = met.unionByName(dealt.filter("rest").select("posting", every[0].alias("i"), far.alias("j"), "rest", "root", *sketch))
        met = met.repartition("posting", "i", "j").sortWithinPartitions("posting", "i", "j").select("posting", "i", "j", "rest", "root", *sketch)
        crossed = stored(met.mapInArrow(_clustered(limit, None), out)).select("h", *sketch)
        close = over.filter("not rest")
        apart = close.groupBy("posting").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.bool_or(F.col("root") == 0).alias("free"))
        close = close.join(apart.filter("free or x <> y").select("posting").hint("merge"), "posting", "left_semi")
        known = known.unionByName(crossed).unionByName(close.select(F.xxhash64("posting").alias("h"), *sketch))
    sketched = texts.select("key", "n", "copies", "fp").mapInArrow(_sketched, f"key binary, n int, copies bigint, {_SKETCH}")
    if not again:  # texts of one sketch are a cluster, too
        alike = sketched.groupBy(*sketch).agg(F.count("*").alias("texts")).filter("texts > 1").select(F.xxhash64(*sketch).alias("h"), *sketch)
        known = known.unionByName(alike)
    return known.distinct().join(sketched.hint("merge"), sketch).select("h", "key", "n", "copies").distinct()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long; one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(1).to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints (unsigned), as two arrays of ends."""
    n = len(fps)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, right = [], []
    split = fps.view(np.uint8).reshape(-1, 8)
    for i in range(n - 1):
        tally = (split[i + 1 :] == split[i]).sum(1)  # shared positional bytes
        near = np.flatnonzero(tally >= MIN_BYTES) + i + 1
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= MAX_BITS]
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                left.append(fps[i])
                right.append(fps[j])
    return np.array(left, np.uint64), np.array(right, np.uint64)


def _lists(limit: int | None):
    """Links of each posting list of sorted (posting, fp) rows; of a list beyond the limit, its rows as they are."""
    out = ["posting", "fp", "other"]

    def emit(k, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(a.view(np.int64), pa.int64()), b], out)

    def whole(k: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """k, fp: rows of whole lists, none beyond the limit."""
        lefts, rights = [], []
        cut = np.flatnonzero(np.diff(k)) + 1
        start, stop = np.r_[0, cut], np.r_[cut, len(k)]
        two = stop - start == 2
        a, b = fp[start[two]], fp[start[two] + 1]
        if len(a):
            tally = (a.view(np.uint8).reshape(-1, 8) == b.view(np.uint8).reshape(-1, 8)).sum(1)
            near = (tally >= MIN_BYTES) & (np.bitwise_count(a ^ b) <= MAX_BITS)
            lefts.append(a[near])
            rights.append(b[near])
        for i, j in zip(start[stop - start > 2].tolist(), stop[stop - start > 2].tolist(), strict=True):
            a, b = forest(np.ascontiguousarray(fp[i:j]))
            lefts.append(a)
            rights.append(b)
        if lefts and (a := np.concatenate(lefts)).size:
            yield emit(np.full(len(a), -1), a, pa.array(np.concatenate(rights).view(np.int64), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of the list that is still open, at most the limit and a batch
        over = None  # the list that is beyond the limit and passes through
        for x in batches:
            k = x.column(0).to_numpy(zero_copy_only=False)
            p = x.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            fp = x.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if held:
                p, k, fp = (np.concatenate(z) for z in zip(*[(h[0], h[1], h[2]) for h in held], (p, k, fp), strict=True))
                held = []
            if not len(fp):
                continue
            cut = np.flatnonzero((np.diff(p) != 0) | (np.diff(k) != 0)) + 1
            group = np.zeros(len(fp), np.int64)
            group[cut] = 1
            group = np.cumsum(group)
            size = np.bincount(group)
            open_ = group == group[-1]
            big = size[group] > limit if limit else np.zeros(len(fp), bool)
            if over is not None and (p[0], k[0]) == over:
                big |= group == 0
            if big.any():
                yield emit(k[big].astype(np.int32), fp[big], pa.nulls(int(big.sum()), pa.int64()))
            over = (p[-1], k[-1]) if big[-1] else None
            if not big[-1]:
                held = [(p[open_], k[open_], fp[open_])]
            done = ~big & ~open_
            if done.any():
                yield from whole(group[done], fp[done])
        if held:
            yield from whole(np.zeros(len(held[0][2]), np.int64), held[0][2])

    return run


def _linked(postings: DataFrame, limit: int | None) -> DataFrame:
    """postings (posting int, part bigint, fp bigint) -> rows (posting, fp, other): links have posting -1."""
    dealt = postings.repartition("posting", "part").sortWithinPartitions("posting", "part", "fp")
    return stored(dealt.mapInArrow(_lists(limit), "posting int, fp bigint, other bigint"))


def _posted(rows: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """One posting for each (name, mask) of a row's fingerprint."""
    each = F.array(*[F.struct(F.lit(k).cast("int").alias("posting"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part")) for k, m in masks])
    return rows.select("fp", F.explode(each).alias("x")).select("x.posting", "x.part", "fp")


def links(fps: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links (fp, other) among distinct fingerprints that connect all that are linked within MAX_BITS."""
    is_link, is_over = F.col("posting") == -1, F.col("posting") >= 0
    first = _linked(_posted(fps, [(i, _mask(s)) for i, s in enumerate(PLANES)]), list_limit)
    found = first.filter(is_link)
    over = first.filter(is_over)
    if not over.isEmpty():
        fifth = [(i, s, p) for i, s in enumerate(PLANES) for p in range(8) if p not in s]
        more = [over.filter(F.col("posting") == i) for i in range(len(PLANES))]
        keyed = [_posted(more[i], [(8 * i + p, _mask((*s, p))) for j, s, p in fifth if j == i]) for i, s in enumerate(PLANES)]
        second = _linked(_union(keyed), list_limit)
        found = found.unionByName(second.filter(is_link))
        over = second.filter(is_over)
        if not over.isEmpty():
            keyed = []
            for i, s, p in fifth:
                fixed = {2 * b + h for b in (*s, p) for h in (0, 1)}
                triples = [(*fixed, *t) for t in combinations([x for x in range(16) if x not in fixed], 3)]
                rows = over.filter(F.col("posting") == 8 * i + p)
                keyed.append(_posted(rows, [(20 * (8 * i + p) + n, _mask(t, 4)) for n, t in enumerate(triples)]))
            found = found.unionByName(_linked(_union(keyed), None).filter(is_link))
    return found.select("fp", "other")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (fp, other): the least node that it is linked to.

    Alternating star contraction: each node's neighbours are tied to the least of them, first the larger ones,
    then the smaller ones, until nothing changes. Each round is written to the shared folder.
    """
    pairs = edges.select(F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v")).filter("u <> v").distinct()
    pairs = stored(pairs)
    last = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
        # large star: neighbours above the node go to the least of its neighbourhood
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct())
        # small star: neighbours below the node, and the node, go to the least below
        below = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(below.select("u", F.col("m").alias("v")))
        pairs = stored(small.filter("u <> v").distinct())
        # a forest of stars whose sums stay the same is final
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now


def near_duplicates(docs: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id reachable over links."""
    rows = stored(fingerprints(docs))
    reps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    tied = components(links(reps.select("fp"), list_limit))
    rooted = reps.join(tied.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    rooted = stored(rooted)
    named = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classes = stored(rooted.join(named, "root").select("fp", "component_id"))
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def members(docs: DataFrame) -> DataFrame:
    """(key, first_id, repeats, root) for each distinct text of docs (see common.representatives); root: its component of fingerprints."""
    keyed = docs.select("doc_id", text_key("text").alias("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(2).to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fp, pa.int64())], ["doc_id", "key", "fp"])

    rows = keyed.select(F.col("doc_id").cast("bigint").alias("doc_id"), "key", F.col("text").cast("binary").alias("text"))
    reps = stored(representatives(stored(rows.mapInArrow(run, "doc_id bigint, key binary, fp bigint")), "fp"))
    tied = components(links(reps.select("fp").distinct()))
    return reps.join(tied.withColumnRenamed("node", "fp"), "fp", "left").select("key", "first_id", "repeats", F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rows of docs with one row of each component; the columns stay.

    groups: members(docs), the default, or near_copies.groups(docs). The row that stays is that of the least doc_id (a null id only where
    the component has no other), then of the least text_key(); of rows that repeat both, the one whose other columns come first as JSON.
    So doc_ids may repeat over unlike texts and be null.
    """
    groups = members(docs) if groups is None else groups
    order = F.min(F.struct(F.col("first_id").isNull().alias("last"), "first_id", "key", "repeats"))
    kept = stored(groups.groupBy("root").agg(order.alias("k")).select("k.first_id", "k.key", "k.repeats"))
    key, first, repeats = (free_name(x, docs.columns) for x in ("kept_key", "kept_id", "kept_repeats"))
    kept = kept.select(F.col("key").alias(key), F.col("first_id").alias(first), F.col("repeats").alias(repeats))
    # always by a shuffle of both sides: what is kept grows with the documents
    met = docs.withColumn("_k" + key, text_key("text")).join(kept.hint("merge"), (F.col("_k" + key) == F.col(key)) & F.col("doc_id").cast("bigint").eqNullSafe(F.col(first)))
    single = met.filter(F.col(repeats) == 1).select(*docs.columns)
    if kept.filter(F.col(repeats) > 1).isEmpty():
        return single
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rank = F.to_json(F.struct(*others)) if others else F.lit(0)
    again = met.filter(F.col(repeats) > 1).groupBy(key, first).agg(F.min_by(F.struct(*docs.columns), rank).alias("r"))
    return single.unionByName(again.select("r.*"))
