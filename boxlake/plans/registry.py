"""All queries of the detection-data jobs and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boxlake.plans import datasets, labels, videos

Query = Callable[[SparkSession, str], DataFrame]
_ALL = labels.QUERIES | datasets.QUERIES | videos.QUERIES


def queries() -> dict[str, Query]:
    return {k: q for k, (q, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _ALL.items() if sql}
