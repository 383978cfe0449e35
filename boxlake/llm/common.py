"""What the training-data operators share: scratch tables, word patterns and id folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.scratch import scratch_dir, stored

__all__ = ["ASCII_LOWER", "WORD", "as_bytes", "fold", "free_name", "joined", "representatives", "scratch_dir", "stored", "table", "text_key"]

#: A-Z to a-z over UTF-8 bytes; other bytes stay.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Java's form of the word pattern of the quality rules and fingerprints.
WORD = r"[^\x20\x09-\x0D]+"


def fold(id_column: str, k: int) -> Column:
    """crc32 of the id's text modulo k; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % k


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batched(items: list, size: int):
    for i in range(0, len(items), size):
        yield items[i : i + size]


def free_name(name: str, taken: list[str]) -> str:
    """name, or with underscores appended until no column is called so."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def as_bytes(column):
    """An Arrow string column as binary, without a copy."""
    import pyarrow as pa

    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary())
    return column.cast(pa.binary())


def text_key(text: str) -> Column:
    """The first 16 bytes of a text's SHA-256; a null text is an empty one."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256), 1, 32))


def representatives(rows: DataFrame, *more: str) -> DataFrame:
    """(key, first_id, repeats, copies) and the columns `more`, which are the same in all rows of a key; rows: doc_id, key.

    first_id: the least doc_id, null if all are; repeats: rows with this id; copies: rows of the key. A key with many rows is first
    summed by id, so its rows don't meet in one task.
    """
    each = rows.groupBy("key", "doc_id").agg(F.count("*").alias("c"), *(F.any_value(x).alias(x) for x in more))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "c"))
    out = each.groupBy("key").agg(first.alias("f"), F.sum("c").alias("copies"), *(F.any_value(x).alias(x) for x in more))
    return out.select("key", F.col("f.doc_id").alias("first_id"), F.col("f.c").alias("repeats"), "copies", *more)


#: Parts of a key's rows where both sides of a join are dealt out by key.
SALTS = 64


def joined(rows: DataFrame, small: DataFrame, on: list[str], broadcast: bool, how: str = "inner") -> DataFrame:
    """rows with the columns of small (one row per key), which is broadcast, or else dealt out with each key in SALTS parts.

    So a key that holds a third of all rows is shared by that many tasks.
    """
    if broadcast:
        return rows.join(F.broadcast(small), on, how)
    salt = free_name("salt", [*rows.columns, *small.columns])
    dealt = rows.withColumn(salt, (F.rand(7) * SALTS).cast("int"))
    each = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(each.hint("merge"), [*on, salt], how).drop(salt)
