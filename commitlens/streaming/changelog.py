"""Every intermediate value of a keyed running total on a stream (T1, T2; decision D-2).

A keyed ``reduce`` emits a row for each record; Spark's update mode emits a row for each key and micro-batch. These operators
emit the reduce's rows: for every record, in event-time order, the total of its key up to and including it. Rows wait for the
watermark by time bucket and are emitted once it has passed their bucket.

* :func:`run_running_total` is built of ordinary parts. A windowed aggregate keeps the waiting rows, each as a group of its
  own, so no state value grows with a key; a micro-batch takes over the buckets that are complete, sums them inside
  (key, bucket) and adds the totals that the micro-batch before left, one row a key. No Python process takes part, any state
  store will do, and a hot key is spread over its buckets.
* :func:`running_total_stream` is the same as one streaming DataFrame on keyed state (:mod:`ordered`): a key's total is part of
  the state, so a key is one task, as it is for the reduce.

The batch form is ``questions.ext_changelog``.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens.functions.fields import explode_files, extension
from commitlens.operators.ordered import running_sum_within
from commitlens.session import files_under, path_exists
from commitlens.streaming.ordered import OrderedProcessor, ordered_rows, run_ordered

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # see ordered.py


class RunningTotal(OrderedProcessor):
    """State of a key: its total."""

    def __init__(self, keys: list[str], bucket_us: int):
        super().__init__(bucket_us)
        self.columns = [*keys, "at_us", "total"]

    def open(self, handle):
        self.totals = handle.getListState("totals", "name string, total long")

    def new(self):
        return [0]

    def load(self):
        return {name: [total] for name, total in self.totals.get()} if self.totals.exists() else {}

    def step(self, state, us, order, value):
        state[0] += value
        return [(us, state[0])]

    def store(self, states, horizon_us):
        if states:
            self.totals.put([(name, int(total)) for name, (total,) in states.items()])
        return None


def running_total_stream(events: DataFrame, keys: list[str], time: str, order: list[str | Column], value: Column,
                         bucket_seconds: int = 3600) -> DataFrame:
    """``(*keys, at, total)`` for every row of a stream whose ``time`` has a watermark. Key columns are text, values are
    whole numbers (null counts as nothing and still emits a row)."""
    rows = ordered_rows(events, keys, time, order, F.coalesce(value.cast("long"), F.lit(0)))
    out = run_ordered(rows, keys, RunningTotal(keys, bucket_seconds * 1_000_000), "at_us long, total long")
    return out.select(*keys, F.timestamp_micros("at_us").alias("at"), "total")


def closed_rows(events: DataFrame, keys: list[str], time: str, order: list[str | Column], value: Column,
                bucket_seconds: int = 3600) -> DataFrame:
    """``(*keys, bucket_, us_, order_, value_, n_)``: the rows of a stream once the watermark has passed their time bucket;
    ``n_`` rows that agree in everything are one."""
    rows = ordered_rows(events, keys, time, order, F.coalesce(value.cast("long"), F.lit(0)))
    bucket = F.window(time, f"{bucket_seconds} seconds").alias("window_")
    closed = rows.groupBy(*keys, bucket, "us_", "order_", "value_").agg(F.count(F.lit(1)).alias("n_"))
    return closed.select(*keys, F.unix_micros("window_.start").alias("bucket_"), "us_", "order_", "value_", "n_")


def totals_sink(root: str, keys: list[str]):
    """The ``foreachBatch`` function over :func:`closed_rows`: a table for each of three folders and micro-batch.

    ``closed`` holds the batch's rows, as a stateful plan is to run once; ``rows`` the answer, ``totals`` the total of every
    key so far, from which the next batch goes on. A batch that runs again writes only what is not complete, so it changes
    nothing.
    """
    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table = lambda name, n: f"{root}/{name}/batch={n}"

        def write(df: DataFrame, name: str) -> None:
            if not path_exists(spark, f"{table(name, number)}/_SUCCESS"):
                df.write.mode("overwrite").parquet(table(name, number))

        write(batch, "closed")
        came = spark.read.schema(batch.schema).parquet(table("closed", number))
        schema = T.StructType([*[batch.schema[k] for k in keys], T.StructField("total", T.LongType())])
        known = (spark.read.schema(schema).parquet(table("totals", number - 1)) if number else
                 spark.createDataFrame([], schema))
        added = F.col("value_") * F.col("n_")
        sums = known.unionByName(came.select(*keys, added.alias("total"))).groupBy(*keys)
        write(sums.agg(F.sum("total").alias("total")), "totals")

        running = running_sum_within(came, keys, ["us_", "order_", "value_"], added, F.col("bucket_"), "upto_")
        carried = known.select(F.struct(*keys).alias("key_"), F.col("total").alias("carry_"))
        each = running.withColumn("key_", F.struct(*keys)).join(carried, "key_", "left").select(
            "*", F.explode(F.sequence(F.lit(1).cast("long"), "n_")).alias("i_"))
        total = F.coalesce("carry_", F.lit(0)) + F.col("upto_") - F.col("value_") * (F.col("n_") - F.col("i_"))
        write(each.select(*keys, F.timestamp_micros("us_").alias("at"), total.cast("long").alias("total")), "rows")
    return sink


def run_running_total(spark: SparkSession, events: DataFrame, keys: list[str], time: str, order: list[str | Column],
                      value: Column, name: str, bucket_seconds: int = 3600) -> DataFrame:
    """The rows of :func:`running_total_stream`, drained and read back as a batch DataFrame."""
    from commitlens.streaming import runner
    closed = closed_rows(events, keys, time, order, value, bucket_seconds)
    root = runner.run_batches(spark, closed, lambda folder: totals_sink(folder, keys), name, runner.ROCKSDB)
    schema = T.StructType([*[closed.schema[k] for k in keys], T.StructField("at", T.TimestampType()),
                           T.StructField("total", T.LongType())])
    rows = f"{root}/rows"
    files = [p for p, _, _ in files_under(spark, rows)] if path_exists(spark, rows) else []
    folders = sorted({p.rsplit("/", 1)[0] for p in files})
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _named_files(commits: DataFrame, exts: tuple[str, ...]) -> DataFrame:
    files = explode_files(commits, ["sha", "filename", "status", "changes"],
                          keep=["ts", F.col("sha").alias("commit_sha")], prefix="f_")
    rows = files.where(F.col("f_filename").isNotNull()).withColumn("ext", extension("f_filename", no_dot="self"))
    return rows.where(F.col("ext").isin(list(exts)))


def _ext_events(commits: DataFrame, exts: tuple[str, ...]) -> tuple[DataFrame, list[str], str, list[str | Column], Column]:
    """Rows, keys, time, order and value of the running total."""
    return _named_files(commits, exts), ["ext"], "ts", ["commit_sha", "f_sha", "f_filename"], F.lit(1)


def _ext_status_events(commits: DataFrame,
                       exts: tuple[str, ...]) -> tuple[DataFrame, list[str], str, list[str | Column], Column]:
    """T2, likewise."""
    files = _named_files(commits, exts).where(F.col("f_status").isNotNull()).withColumnRenamed("f_status", "status")
    order = ["commit_sha", "f_sha", F.lpad(F.coalesce("f_changes", F.lit(0)).cast("string"), 20, "0")]
    return files, ["ext", "status"], "ts", order, F.col("f_changes")


def _ext_answer(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("at").alias("ts"), "ext", F.col("total").alias("n"))


def _ext_status_answer(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("at").alias("ts"), "ext", "status", F.col("total").alias("changes"))


def ext_changelog_stream(commits: DataFrame, exts: tuple[str, ...] = ("java", "scala"),
                         bucket_seconds: int = 86400) -> DataFrame:
    """``(ts, ext, n)`` for every file of the given extensions, as ``questions.ext_changelog`` gives it."""
    return _ext_answer(running_total_stream(*_ext_events(commits, exts), bucket_seconds))


def run_ext_changelog(spark: SparkSession, commits: DataFrame, name: str, exts: tuple[str, ...] = ("java", "scala"),
                      bucket_seconds: int = 86400) -> DataFrame:
    """T1, drained by :func:`run_running_total`."""
    return _ext_answer(run_running_total(spark, *_ext_events(commits, exts), name, bucket_seconds))


def ext_status_changelog_stream(commits: DataFrame, exts: tuple[str, ...] = ("js", "py"),
                                bucket_seconds: int = 86400) -> DataFrame:
    """``(ts, ext, status, changes)``, the summed changes of (extension, status) after every file."""
    return _ext_status_answer(running_total_stream(*_ext_status_events(commits, exts), bucket_seconds))


def run_ext_status_changelog(spark: SparkSession, commits: DataFrame, name: str, exts: tuple[str, ...] = ("js", "py"),
                             bucket_seconds: int = 86400) -> DataFrame:
    """T2, drained by :func:`run_running_total`."""
    return _ext_status_answer(run_running_total(spark, *_ext_status_events(commits, exts), name, bucket_seconds))
