"""A session with the settings that the jobs assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "boxlake", cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, settings come from spark-submit."""
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.adaptive.enabled": "true",
    }
    conf |= {k.replace("__", "."): v for k, v in settings.items()}
    return SparkSession.builder.master(f"local[{cores}]").appName(name).config(map=conf).getOrCreate()
