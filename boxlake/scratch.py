"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, which driver and executors share.

    Only a session in one local process may go without the setting (tests); it gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-boxlake-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/boxlake-{uuid.uuid4().hex}"


#: Tables of this process that discard() hasn't removed.
_tables: list[str] = []
#: Paths of the tables of stored_sorted() by name.
_paths: dict[str, str] = {}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends: a table that is written needs them no more."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def stored(df: DataFrame, path: str | None = None, by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage and survives lost executors. by: columns that become folders; options: of the writer."""
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    with shuffles_freed(spark):
        df.write.options(**options).partitionBy(*by).parquet(path)
    _tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_sorted(df: DataFrame, by: list[str], buckets: int) -> tuple[str, DataFrame]:
    """As stored(), dealt into buckets by a hash of the columns `by` and sorted in each: joins on them read it without a shuffle. Also gives the table's name, for dropped()."""
    path = scratch_dir(df.sparkSession)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    with shuffles_freed(df.sparkSession):
        df.write.bucketBy(buckets, *by).sortBy(*by).format("parquet").option("path", path).saveAsTable(name)
    _tables.append(path)
    _paths[name] = path
    return name, df.sparkSession.table(name)


def plain(spark: SparkSession, names: list[str]) -> DataFrame:
    """The rows of tables of stored_sorted() with one schema, as one scan without their buckets."""
    return spark.read.schema(spark.table(names[0]).schema).parquet(*(_paths[n] for n in names))


def dropped(spark: SparkSession, name: str) -> None:
    """Remove a table of stored_sorted()."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    discard(spark, [_paths.pop(name)])


def tables() -> list[str]:
    """Paths of what stored() has written and discard() hasn't removed, oldest first."""
    return list(_tables)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that no DataFrame in use reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in _tables:
            _tables.remove(path)
