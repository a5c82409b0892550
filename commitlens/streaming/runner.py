"""Run a stream question to completion over a folder of JSON-lines files and read the result back.

Sources (S2, S3): ``stream_commits`` / ``stream_geo`` - one JSON record per line, as a commit feed delivers them.
Sink: Parquet in append mode (or ``foreachBatch`` upserts for update-mode totals), trigger ``availableNow`` so
a finite input is drained in bounded micro-batches; state lives in the RocksDB state store when the session
configures it. All folders are under the shared checkpoint folder (``spark.checkpoint.dir``).

A finite table is replayed as a feed in time slices: files are read in order of their modification time, so slices are
written one after the other, each by as many tasks as its bytes ask for. A micro-batch takes as many files as the
largest slice has; it may hold the end of one slice and the start of the next, so the feed is out of order by at most
two slices, and that is its watermark delay.

Closing the last windows on finite input (D-21): event-time windows and timers only fire once the watermark
passes them, and nothing follows the last real row. A feed therefore ends with a far-future *sentinel* record (its own
key); it moves the watermark past all real data, the trailing no-data batch emits every remaining window and timer, and
the sentinel's own window is never complete, so it never reaches the output.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from commitlens.functions.partitions import state_partitions
from commitlens.session import checkpoint_root, files_under, path_exists, scratch_path, session_conf
from commitlens.sources.commits import stream_commits, stream_geo

SENTINEL_SHA = "__sentinel__"
SENTINEL_TS = "2999-01-01 00:00:00"
SENTINEL_URL = "https://api.github.com/repos/__sentinel__/__sentinel__/commits/__sentinel__"


def sentinel_commit(spark: SparkSession) -> DataFrame:
    row = spark.range(1).select(
        F.struct(F.lit(SENTINEL_SHA).alias("$oid")).alias("_id"), F.lit(SENTINEL_SHA).alias("node_id"),
        F.lit(SENTINEL_SHA).alias("sha"), F.lit(SENTINEL_URL).alias("url"),
        F.struct(
            F.struct(F.lit(SENTINEL_SHA).alias("name"), F.lit(None).cast("string").alias("email"),
                     F.to_timestamp(F.lit(SENTINEL_TS)).alias("date")).alias("author"),
            F.struct(F.lit(SENTINEL_SHA).alias("name"), F.lit(None).cast("string").alias("email"),
                     F.to_timestamp(F.lit(SENTINEL_TS)).alias("date")).alias("committer"),
            F.lit("").alias("message"),
        ).alias("commit"),
        # Zero stats so that row filters such as ``stats IS NOT NULL`` (which Catalyst may push below the
        # watermark node) keep it; no files, so it never changes a file count.
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("additions"),
                 F.lit(0).cast("long").alias("deletions")).alias("stats"),
    )
    return row


def sentinel_geo(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(SENTINEL_SHA).alias("sha"), F.to_timestamp(F.lit(SENTINEL_TS)).alias("createdAt"),
                                 F.lit(SENTINEL_SHA).alias("continent"))


#: A feed is written once and read a few times: the lowest level takes a third less time to write a slice.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


@dataclass(frozen=True)
class Feed:
    """A landed feed: its folder, the files a micro-batch takes, and how far it is out of order."""

    folder: str
    files_per_trigger: int
    delay_us: int

    @property
    def delay(self) -> str:
        return f"{self.delay_us} microseconds"


def land(df: DataFrame, folder: str, n_slices: int, time_col: str, sentinel: DataFrame | None,
         write: Callable[[DataFrame], None] | None = None) -> Feed:
    """Replay ``df`` as a feed: ``n_slices`` equal-width event-time slices, written one after another.

    ``write`` appends a slice to the folder (gzip JSON lines, if not given).

    A slice is a range of ``time_col``, which a stored table's statistics serve, so the table is read about once, and
    it is written as it is read, without a shuffle: a scan task gives a file, so a slice's number of files follows the
    table's bytes, and no file needs to be split. Equal timestamps always share a slice.
    """
    t = F.unix_micros(F.col(time_col))
    lo, hi = df.agg(F.min(t), F.max(t)).first()
    if lo is None:
        lo, hi = 0, 0
    width = max((hi - lo) // n_slices + 1, 1)
    spark = df.sparkSession
    most = done = 1
    for i in range(n_slices):
        start, stop = (F.timestamp_micros(F.lit(lo + width * k)) for k in (i, i + 1))
        part = df.where((F.col(time_col) >= start) & (F.col(time_col) < stop))
        if write is None:
            part.write.mode("append").options(**GZIP).json(folder)
        else:
            write(part)
        now = len(files_under(spark, folder))
        most, done = max(most, now - done), now
    if sentinel is not None:
        sentinel.coalesce(1).write.mode("append").json(folder)
    return Feed(folder, most, 2 * width)


class LateRows(StreamingQueryListener):
    """Rows dropped as late (behind the watermark), summed over every progress event of every query, by run.

    ``recentProgress`` keeps only the latest events; a listener sees all of them.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        self._end(str(event.runId))

    def onQueryProgress(self, event):
        p = event.progress
        run = str(p.runId)
        self.rows[run] = self.rows.get(run, 0) + sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._end(str(event.runId)).set()

    def total(self, query, timeout: float = 60.0) -> int:
        """Late rows of a finished query, once its last event has been seen."""
        if not self._end(str(query.runId)).wait(timeout):
            raise TimeoutError("the query's end was not reported")
        return self.rows.get(str(query.runId), 0)


_LISTENERS: dict[str, LateRows] = {}


def late_row_listener(spark: SparkSession) -> LateRows:
    """The application's listener, registered on first use."""
    app = spark.sparkContext.applicationId
    if app not in _LISTENERS:
        _LISTENERS[app] = LateRows()
        spark.streams.addListener(_LISTENERS[app])
    return _LISTENERS[app]


LAST_QUERY: dict[str, object] = {}


def late_rows(spark: SparkSession, name: str) -> int:
    """Rows that the finished query ``name`` dropped as late."""
    return late_row_listener(spark).total(LAST_QUERY[name])


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How RocksDB runs where the session does not say: all stores of an executor share one bounded cache, a micro-batch leaves
#: its changes instead of the files of a store, and no store looks up each key it writes only to count its rows.
ROCKSDB_SETTINGS = {"spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
                    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
                    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def state_settings(spark: SparkSession, state: str | None) -> dict[str, str]:
    """Session settings for a query on the state store provider ``state``."""
    known = ROCKSDB_SETTINGS if state == ROCKSDB else {}
    return {**{k: spark.conf.get(k, v) for k, v in known.items()}, **({STATE_STORE: state} if state else {})}


def _finish(spark: SparkSession, writer, name: str, path: str | None = None, state: str | None = None,
            settings: dict[str, str] | None = None) -> None:
    with session_conf(spark, {**state_settings(spark, state), **(settings or {})}):
        q = writer.trigger(availableNow=True).start(path) if path else writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    LAST_QUERY[name] = q


def append_table(spark: SparkSession, steps: list[DataFrame], name: str, state: str | None = None) -> str:
    """Run a streaming DataFrame in append mode to Parquet with ``availableNow``; return the table's path.

    ``steps`` are the same question over further input (usually one): they run one after the other on one checkpoint,
    so the state goes on. ``state`` is the state store provider (the session's, if not given). Keyed processors run on
    :data:`ROCKSDB` only; what keeps rows, not totals, should: Spark's default holds all state in the executors' heap. The
    last finished query is kept in ``LAST_QUERY[name]``.
    """
    late_row_listener(spark)
    checkpoint_root(spark)
    path, checkpoint = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    settings = {"spark.sql.shuffle.partitions": state_partitions(spark)}
    for out in steps:
        _finish(spark, out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint),
                name, path, state, settings)
    return path


def run_append(spark: SparkSession, steps: list[DataFrame], name: str, state: str | None = None) -> DataFrame:
    """:func:`append_table`, read as a batch DataFrame."""
    return spark.read.schema(steps[0].schema).parquet(append_table(spark, steps, name, state))


def run_update(spark: SparkSession, out: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Update-mode totals (keyed running reduce, D-2): every micro-batch's changed rows are appended with their
    batch id; the final total per key is its row from the latest batch (a max_by per key, no driver work)."""
    late_row_listener(spark)
    checkpoint_root(spark)
    path = scratch_path(spark, f"{name}-changes")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(path)

    _finish(spark, out.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", scratch_path(spark, f"{name}-ckpt")), name)
    values = [c for c in out.columns if c not in keys]
    if not path_exists(spark, path):  # no micro-batch produced a change: empty result with the right columns
        return spark.createDataFrame([], out.schema)
    changes = spark.read.parquet(path)
    latest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("_batch")).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def run_router(spark: SparkSession, arrivals: list[Callable[[], DataFrame]], time: Column, delay_us: int,
               name: str) -> str:
    """Drain message streams into the tables of :mod:`commitlens.streaming.routing`; return their root folder.

    ``arrivals`` are the same stream at several times: each call may bring further files before it returns the stream.
    """
    from commitlens.streaming import routing
    late_row_listener(spark)
    checkpoint_root(spark)
    root, checkpoint = scratch_path(spark, f"{name}-routed"), scratch_path(spark, f"{name}-ckpt")
    for arrive in arrivals:
        _finish(spark, routing.parsed(arrive()).writeStream.foreachBatch(routing.router(root, time, delay_us))
                .option("checkpointLocation", checkpoint), name)
    return root


def run_batches(spark: SparkSession, out: DataFrame, sink: Callable[[str], Callable[[DataFrame, int], None]], name: str,
                state: str | None = None) -> str:
    """Run a streaming DataFrame in append mode into the ``foreachBatch`` function that ``sink`` gives for a root folder;
    return that folder. ``state`` is as in :func:`append_table`."""
    late_row_listener(spark)
    checkpoint_root(spark)
    root, checkpoint = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    _finish(spark, out.writeStream.outputMode("append").foreachBatch(sink(root)).option("checkpointLocation", checkpoint),
            name, state=state)
    return root


def message_rows(commits: DataFrame, cut: Column) -> DataFrame:
    """Commits as text messages ``(value, date)``; those that ``cut`` names are broken off in the middle."""
    rows = commits.select(F.to_json(F.struct("*")).alias("value"), cut.alias("cut"),
                          F.col("commit.committer.date").alias("date"))
    half = F.expr("substring(value, 1, length(value) div 2)")
    return rows.select(F.when(F.col("cut"), half).otherwise(F.col("value")).alias("value"), "date")


def commit_stream(spark: SparkSession, feed: Feed) -> DataFrame:
    """S2 over a landed feed."""
    return stream_commits(spark, feed.folder, feed.files_per_trigger)


def geo_stream(spark: SparkSession, feed: Feed) -> DataFrame:
    """S3 over a landed feed, with its watermark."""
    return stream_geo(spark, feed.folder, feed.files_per_trigger).withWatermark("createdAt", feed.delay)


def landed_commit_feed(spark: SparkSession, commits: DataFrame, n_slices: int = 4) -> Feed:
    """Land the commit view as a JSON-lines feed (plus sentinel)."""
    return land(commits, scratch_path(spark, "commit-feed"), n_slices, "commit.committer.date", sentinel_commit(spark))


def landed_geo_feed(spark: SparkSession, geo: DataFrame, n_slices: int = 4) -> Feed:
    return land(geo, scratch_path(spark, "geo-feed"), n_slices, "createdAt", sentinel_geo(spark))
