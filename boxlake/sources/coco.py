"""Annotation documents of any origin, layout and size: one JSON object with lists of images, annotations and categories.

A document (a file, or a folder of parts that make one in the order of their names) is never one row: it is read in byte ranges. Spark's text source cuts the ranges at closing
braces; what a range means depends on the text before it, which is told in two steps. First each range gives how it changes the state, for both
states it may begin in: whether it ends inside a string, and how many brackets it opens, counted outside strings. Sums of these over earlier ranges are each range's
true beginning. Then each range cuts out the objects of the document's lists; of an object that lies across ranges each gives its part, and parts meet by the range in which their object begins. The same
holds for the name of a list that begins in an earlier range.

Parts end at line ends, and not between a list's name and its bracket. Only the table of ranges (a row for each split of a scan) is held together. Lists of lists and lists deeper than the root's are no items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.scratch import discard, scratch_dir, stored

ITEMS = {
    "images": "id bigint, file_name string, width int, height int, source_dataset string, sequence_group string, raw_split string",
    "annotations": "id bigint, image_id bigint, category_id int, bbox array<double>, area double, iscrowd int",
    "categories": "id int, name string, supercategory string",
}
_NAME = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$')
_PLACE = ["file", "start"]


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """file, start, the pieces between closing braces, in their order within each range, and the file's size."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"), F.col("_metadata.file_size").alias("size"))


def _by_range(batch: pa.RecordBatch) -> Iterator[tuple[tuple, bytes, list]]:
    """Pieces of a batch by range, with the braces again, and the other columns of the range's first row."""
    files, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    cut = [k for k in range(len(files)) if k == 0 or (files[k], starts[k]) != (files[k - 1], starts[k - 1])] + [len(files)]
    values = batch.column(2).to_pylist()
    for a, b in zip(cut, cut[1:], strict=False):
        yield (files[a], starts[a]), b"}".join(values[a:b]) + b"}", [c[a].as_py() for c in batch.columns[3:]]


def structure(data: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets, whether they are outside strings, +1 or -1 for each, and the number of quotes. inside: data begins in a string, not after a backslash."""
    a = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(a == 34)
    if len(quotes) and (slashes := a == 92).any():
        last = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(a))))  # the last byte so far that is no backslash
        run = np.where(quotes > 0, quotes - 1 - last[quotes - 1], 0)
        quotes = quotes[run % 2 == 0]
    at = np.flatnonzero((a == 123) | (a == 91) | (a == 125) | (a == 93))
    outside = (np.searchsorted(quotes, at) + inside) % 2 == 0
    return at, outside, np.where((a[at] == 123) | (a[at] == 91), 1, -1), len(quotes)


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: odd (whether it has an odd number of quotes), the brackets it opens if it begins outside or inside a string, and its bytes, with a brace after each piece."""
    place, odd, flat, inner, size, total, out = None, 0, 0, 0, 0, 0, []
    for batch in batches:
        for here, data, (size_,) in _by_range(batch):
            if here != place:
                if place is not None:
                    out.append((*place, odd, flat, inner, size, total))
                place, odd, flat, inner, size, total = here, 0, 0, 0, size_, 0
            total += len(data)
            _, outside, step, quotes = structure(data, bool(odd))
            flat += int(step[outside].sum())
            inner += int(step[~outside].sum())
            odd = (odd + quotes) % 2
    if place is not None:
        out.append((*place, odd, flat, inner, size, total))
    yield pa.RecordBatch.from_pylist([dict(zip(_CHANGES.names, x, strict=True)) for x in out], _CHANGES)


_CHANGES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("odd", pa.int32()), ("flat", pa.int64()), ("inner", pa.int64()), ("size", pa.int64()), ("total", pa.int64())])
_CUT = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("section", pa.string()), ("text", pa.binary())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects of each range (whole), parts of those that lie across ranges (begin, inner, end), and a row for the range with its last list: whether it
    leaves open an object that it began (open), lies within an item (same) or neither (range)."""
    place, made, owed, ends = None, [], b"", False
    inside, depth, section, held, began = 0, 0, None, None, True

    def add(kind: str, text: bytes | None) -> None:
        made.append({"file": place[0], "start": place[1], "kind": kind, "section": section, "text": text})

    def closed() -> None:
        if ends:
            feed(owed)
        if held is not None:
            add("begin" if began else "inner", b"".join(held))
        add("range" if held is None else "open" if began else "same", None)

    def feed(data: bytes) -> None:
        nonlocal inside, depth, section, held, began
        at, outside, step, quotes = structure(data, bool(inside))
        inside = (inside + quotes) % 2
        at, step = at[outside], step[outside]
        after = depth + np.cumsum(step)
        lists = (step > 0) & (after == 2)
        head = (step > 0) & (after == 3)
        tail = (step < 0) & (after == 2)
        done = 0  # bytes of data that an open object has taken
        for k in np.flatnonzero(lists | head | tail):
            p, byte = int(at[k]), data[at[k]]
            if lists[k]:
                name = _NAME.search(data, max(0, p - 4096), p) if byte == 91 else None
                section = name.group(1).decode("utf-8", "replace") if name else ""
            elif head[k]:
                if byte == 123 and held is None:
                    held, began, done = [], True, p
            elif held is not None:  # a bracket here ends a list that began in an earlier range
                held.append(data[done : p + 1])
                if byte == 125:
                    add("whole" if began else "end", b"".join(held))
                held, began = None, True
        if held is not None:
            held.append(data[done:])
        depth = int(after[-1]) if len(after) else depth

    for batch in batches:
        for here, data, (odd, level, whole) in _by_range(batch):
            if here != place:
                if place is not None:
                    closed()
                place, inside, depth, section, ends, owed = here, odd, level, None, whole, b""
                held, began = ([], False) if depth >= 3 else (None, True)
            feed(owed + data[:-1])  # a brace is owed until it is known to be there
            owed = data[-1:]
            if len(made) >= 4096:
                yield pa.RecordBatch.from_pylist(made, _CUT)
                made = []
    if place is not None:
        closed()
    yield pa.RecordBatch.from_pylist(made, _CUT)


def items(spark: SparkSession, path: str, made: list[str] | None = None) -> DataFrame:
    """section and text of each object in the lists of one document; path: a file, or a folder of its parts. made: is told the folders of tables that the rows are read from."""
    order = W.orderBy(*_PLACE).rowsBetween(W.unboundedPreceding, -1)  # one row a range
    changes = _ranges(spark, path).select("file", "start", "value", "size").mapInArrow(_changes, "file string, start bigint, odd int, flat bigint, inner bigint, size bigint, total bigint")
    # no brace follows the last piece of a file that ends otherwise
    file = W.partitionBy("file")
    found = changes.withColumn("whole", (F.sum("total").over(file) == F.col("size")) | (F.max("start").over(file) != F.col("start")))
    spare = lambda odd: F.when(~F.col("whole") & (F.col("odd") == odd), 1).otherwise(0)
    found = stored(found.withColumns({"flat": F.col("flat") + spare(0), "inner": F.col("inner") + spare(1)}).drop("size", "total"))
    begun = found.withColumn("inside", F.coalesce(F.sum("odd").over(order), F.lit(0)) % 2)
    step = F.when(F.col("inside") == 0, F.col("flat")).otherwise(F.col("inner"))
    begun = stored(begun.withColumn("step", step).select(*_PLACE, F.col("inside").cast("int").alias("inside"), F.coalesce(F.sum("step").over(order), F.lit(0)).cast("int").alias("depth"), "whole"))
    pieces = _ranges(spark, path).join(F.broadcast(begun), _PLACE)  # a row a split of the scan; the order of pieces stays
    place = scratch_dir(spark)
    cut = stored(pieces.select("file", "start", "value", "inside", "depth", "whole").mapInArrow(_cut, "file string, start bigint, kind string, section string, text binary"), place, compression="zstd")
    if made is not None:
        made.append(place)
    left = F.last(F.when(F.col("kind") != "same", F.struct("kind", *_PLACE)), ignorenulls=True).over(order)
    ranges = cut.filter("text is null").select(*_PLACE, F.last("section", ignorenulls=True).over(order).alias("before"), left.alias("left"))
    rows = cut.filter("text is not null").join(F.broadcast(ranges), _PLACE)
    told = F.coalesce("section", "before")
    whole = rows.filter("kind = 'whole'").select(told.alias("section"), F.col("text").cast("string").alias("text"))
    own = F.when(F.col("kind") == "begin", F.struct(*_PLACE)).when(F.col("left.kind") == "open", F.struct("left.file", "left.start"))
    parts = rows.filter("kind <> 'whole'").filter(own.isNotNull()).select(own.alias("of"), *_PLACE, F.when(F.col("kind") == "begin", told).alias("section"), "text")
    joined = parts.groupBy("of").agg(F.max("section").alias("section"), F.sort_array(F.collect_list(F.struct(*_PLACE, "text"))).alias("p"))
    across = joined.select("section", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["text"])).cast("string").alias("text"))
    return whole.unionByName(across)


def read_coco(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """images, annotations and categories tables of one document per split; paths: split name to a file or a folder of parts.

    A document without images or annotations has no rows there, and one without categories an empty list. Fields that are missing or of another type are null.
    """
    rows, made = None, []
    for split, path in paths.items():
        one = items(spark, path, made).withColumn("split", F.lit(split))
        rows = one if rows is None else rows.unionByName(one)
    rows = stored(rows.filter(F.col("section").isin(*ITEMS)), compression="zstd")
    discard(spark, made)

    def of(section: str) -> DataFrame:
        item = F.explode(F.array(F.from_json("text", ITEMS[section]))).alias("r")
        return rows.filter(F.col("section") == section).select("split", item).select("split", "r.*")

    box = {k: F.when(F.size("bbox") == 4, F.get("bbox", F.lit(i))) for i, k in enumerate("xywh")}
    kinds = of("categories").groupBy("split").agg(F.sort_array(F.collect_list(F.struct("id", "name", "supercategory"))).alias("categories"))
    splits = spark.createDataFrame([(s,) for s in paths], "split string")
    none = F.expr("cast(array() as array<struct<id: int, name: string, supercategory: string>>)")
    return {
        "images": of("images").withColumnRenamed("id", "image_id"),
        "annotations": of("annotations").withColumnRenamed("id", "annotation_id").withColumns(box).drop("bbox"),
        "categories": splits.join(kinds, "split", "left").select("split", F.coalesce("categories", none).alias("categories")),
    }
