"""Parallelism of row work right after a scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPREAD_CONF = "commitlens.scan.tasks"
SHUFFLE_BYTES_CONF = "commitlens.shuffle.bytes"
SHUFFLE_BYTES = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal rows round-robin over ``commitlens.scan.tasks`` tasks where the session sets it; otherwise ``df`` itself.

    A Parquet file of one row group is read by one task however large it is. A session whose inputs are a few such
    files (a laptop, the benchmark) can set the option; the plan never depends on what the input looks like.
    """
    tasks = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(tasks)) if tasks else df


def shuffle_settings(spark: SparkSession, stored: int) -> dict[str, str]:
    """Session settings for shuffles of whole tables that have ``stored`` bytes on disk.

    A fixed number of partitions gives each more rows the larger the tables are, until their sorts spill. Here a partition
    is about ``commitlens.shuffle.bytes`` of the tables (16 MB, some 900,000 rows of ``lineitem``), and AQE merges
    small ones up to that size only. The session's number of partitions is the least.
    """
    size = int(spark.conf.get(SHUFFLE_BYTES_CONF, str(SHUFFLE_BYTES)))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {"spark.sql.shuffle.partitions": str(max(least, -(-stored // size))),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{size}b"}


def state_partitions(spark: SparkSession) -> str:
    """Partitions of a stateful stream: the session's, but no more than keep every core busy twice over (12 at least). Each
    costs stores, files and metrics for every operator and micro-batch, and every task reports the metrics of all."""
    most = max(2 * spark.sparkContext.defaultParallelism, 12)
    return str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), most))
