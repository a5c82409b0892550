"""Order-dependent window operators that do not put one hot key into one task. One plan for every size.

``Window.partitionBy(k)`` sends every row of a key to one task. Here the caller names a *bucket*: an expression of the
row that never decreases along the order (a day of the time, a block of positions). Rows are windowed inside
``(key, bucket)``, so a hot key is spread over as many tasks as it has buckets; what crosses a bucket's edge (the rows
before it, the row next to it) comes from one aggregate row per (key, bucket), windowed per key and joined back. No row
count is taken beforehand, nothing is sampled, and no plan depends on the size of the input.

A global order has no such key; :func:`global_running_sum` range-sorts the rows once into a table in the shared
checkpoint folder and adds the sizes of the partitions before each one (one row per partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

__all__ = ["row_number_within", "running_sum_within", "shift_within", "global_row_number", "global_running_sum",
           "position_block"]

#: Positions per bucket of a sequence.
BLOCK = 1 << 16


def position_block(pos: str = "pos") -> Column:
    """Bucket of a 0-based position."""
    return F.floor(F.col(pos) / F.lit(BLOCK))


def _bucketed(df: DataFrame, part: Sequence[str], bucket: Column) -> DataFrame:
    """Rows with ``_k``, their key and bucket as one value: equal where all parts are, nulls included. Windows,
    aggregates and joins on it share one partitioning, so the rows are shuffled and sorted once."""
    return df.withColumn("_k", F.struct(*[F.col(p).alias(f"p{i}") for i, p in enumerate(part)], bucket.alias("b")))


def _along(part: Sequence[str]) -> WindowSpec:
    """The buckets of a key, in order."""
    return Window.partitionBy(*[f"_k.p{i}" for i in range(len(part))]).orderBy("_k.b")


def row_number_within(df: DataFrame, part: Sequence[str], order: Sequence[str], bucket: Column,
                      name: str = "rn") -> DataFrame:
    """Adds ``name`` = 1-based ``row_number() over (partition by part order by order)``.

    ``order`` must be a total order within ``part`` (ascending column names); ``bucket`` must not decrease along it.
    """
    columns = df.columns
    rows = _bucketed(df, part, bucket)
    sizes = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(_along(part).rowsBetween(Window.unboundedPreceding, -1))
    # A key's first bucket has nothing before it; most keys have no other.
    offsets = sizes.select("_k", before.alias("_before")).where(F.col("_before").isNotNull())
    local = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("_k").orderBy(*order)))
    return local.join(offsets, "_k", "left").select(
        *columns, (F.col("_rn") + F.coalesce("_before", F.lit(0))).cast("long").alias(name))


def running_sum_within(df: DataFrame, part: Sequence[str], order: Sequence[str], value: Column, bucket: Column,
                       name: str) -> DataFrame:
    """Adds ``name`` = the sum of ``value`` (whole numbers) over this row and all rows before it within ``part``.

    ``order`` and ``bucket`` are as in :func:`row_number_within`; nulls in ``value`` count as nothing.
    """
    columns = df.columns
    rows = _bucketed(df.withColumn("_v", F.coalesce(value.cast("long"), F.lit(0))), part, bucket)
    sums = rows.groupBy("_k").agg(F.sum("_v").alias("_n"))
    before = F.sum("_n").over(_along(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("_k", before.alias("_before")).where(F.col("_before").isNotNull())
    upto = Window.partitionBy("_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_upto", F.sum("_v").over(upto))
    return local.join(offsets, "_k", "left").select(
        *columns, (F.col("_upto") + F.coalesce("_before", F.lit(0))).alias(name))


def shift_within(df: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str], bucket: Column,
                 offset: int = -1, suffix: str | None = None) -> DataFrame:
    """``lag`` (offset -1) or ``lead`` (offset +1) of ``cols`` within ``part`` ordered by ``order``.

    Adds ``<col><suffix>`` columns (default suffix ``_prev`` / ``_next``); NULL at the start/end of a key.
    """
    if offset not in (-1, 1):
        raise ValueError("offset must be -1 (lag) or +1 (lead)")
    suffix = suffix or ("_prev" if offset < 0 else "_next")
    fn, edge = (F.lag, F.max_by) if offset < 0 else (F.lead, F.min_by)
    columns = df.columns
    rows = _bucketed(df, part, bucket)
    near = F.struct(*[F.col(c).alias(c) for c in cols])
    edges = rows.groupBy("_k").agg(edge(near, F.struct(*order)).alias("_edge"))
    edges = edges.select("_k", fn("_edge").over(_along(part)).alias("_edge")).where(F.col("_edge").isNotNull())
    local = rows.withColumn("_near", fn(near).over(Window.partitionBy("_k").orderBy(*order)))
    joined = local.join(edges, "_k", "left")
    value = F.coalesce("_near", "_edge")
    return joined.select(*columns, *[value[c].alias(c + suffix) for c in cols])


def global_running_sum(df: DataFrame, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Adds ``name`` = the sum of ``value`` over this row and all rows before it in a global total order.

    The rows are range-partitioned and landed once with their partition's number (range bounds are sampled, so two
    plans over the same input could differ); each partition is summed by itself and gets the sums of the partitions
    before it from a table of one row per partition, which is what bounds the broadcast.
    """
    from commitlens.session import scratch_path
    path = scratch_path(df.sparkSession, "global-order")
    (df.repartitionByRange(*order).withColumns({"_pid": F.spark_partition_id(), "_v": value.cast("long")})
     .write.parquet(path))
    rows = df.sparkSession.read.parquet(path)
    sizes = rows.groupBy("_pid").agg(F.sum("_v").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(sizes.select("_pid", F.coalesce(before, F.lit(0)).alias("_before")))
    upto = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_rn", F.sum("_v").over(upto))
    return local.join(offsets, "_pid").select(*df.columns, (F.col("_rn") + F.col("_before")).cast("long").alias(name))


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "rn") -> DataFrame:
    """1-based position in a global total order (see :func:`global_running_sum`)."""
    return global_running_sum(df, order, F.lit(1), name)
