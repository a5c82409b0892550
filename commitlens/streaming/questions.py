"""T1-T6 and J3 as DataFrame functions that run unchanged on a batch DataFrame (the twin) or a streaming one.

Input: commits with an event-time column ``ts`` (see :func:`with_event_time`). On a stream, the caller applies
``withWatermark("ts", delay)`` first (T0); windows are epoch-aligned tumbling/sliding windows, so 7-day windows
start on Thursdays as with offset-0 event-time windows elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.functions.fields import committer_name, explode_files, extension, owner_repo
from commitlens.functions.labels import size_label


def with_event_time(commits: DataFrame, column: str = "commit.committer.date") -> DataFrame:
    """Expose the commit time as a top-level ``ts`` column (watermarks need a top-level column)."""
    return commits.withColumn("ts", F.col(column))


def ext_counts(commits: DataFrame, exts: tuple[str, ...] = ("java", "scala")) -> DataFrame:
    """T1 / D-3: occurrences of files whose extension is exactly one of ``exts`` (files without a name dropped)."""
    files = explode_files(commits, ["filename"])
    e = extension("filename", no_dot="self")
    return (files.where(F.col("filename").isNotNull()).select(e.alias("ext")).where(F.col("ext").isin(list(exts)))
            .groupBy("ext").agg(F.count(F.lit(1)).alias("n")))


def ext_changelog(commits: DataFrame, exts: tuple[str, ...] = ("java", "scala")) -> DataFrame:
    """T1 batch changelog (D-2): one row per matching file with the running count of its extension,
    in event-time order - the per-record output of a keyed running reduce."""
    from commitlens.operators.ordered import row_number_within
    files = explode_files(commits, ["sha", "filename"], keep=["ts", F.col("sha").alias("commit_sha")], prefix="f_")
    e = extension("f_filename", no_dot="self")
    rows = files.where(F.col("f_filename").isNotNull()).withColumn("ext", e).where(F.col("ext").isin(list(exts)))
    return row_number_within(rows, ["ext"], ["ts", "commit_sha", "f_sha", "f_filename"], F.to_date("ts"),
                             name="n").select("ts", "ext", "n")


def ext_status_changes(commits: DataFrame, exts: tuple[str, ...] = ("js", "py")) -> DataFrame:
    """Summed ``changes`` per (extension, status) for the given extensions."""
    files = explode_files(commits, ["filename", "status", "changes"])
    e = extension("filename", no_dot="self")
    return (files.where(F.col("filename").isNotNull() & F.col("status").isNotNull())
            .select(e.alias("ext"), "status", "changes").where(F.col("ext").isin(list(exts)))
            .groupBy("ext", "status").agg(F.sum("changes").alias("changes")))


def daily_commits(commits: DataFrame) -> DataFrame:
    """Commits per day (non-keyed tumbling 1-day window), the day as ``dd-MM-yyyy``."""
    g = commits.groupBy(F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.date_format("window.start", "dd-MM-yyyy").alias("date"), "n")


def size_windows(commits: DataFrame, limit: int = 20, length: str = "48 hours", every: str = "12 hours") -> DataFrame:
    """T4: small/large commits (stats required) per sliding window of ``length`` every ``every``."""
    g = (commits.where(F.col("stats").isNotNull())
         .groupBy(F.window("ts", length, every), size_label(F.col("stats.total"), limit).alias("kind"))
         .agg(F.count(F.lit(1)).alias("n")))
    return g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "kind", "n")


def repo_daily_summary(commits: DataFrame, more_than: int = 20) -> DataFrame:
    """T5: daily summary per owner/repo, kept when commits > ``more_than`` and committers <= 2.

    Commits without stats are not counted. Two mergeable levels, (day, repo, committer) then (day, repo). The second
    keeps only the lowest and the highest committer by (count, name): with at most two committers, the question's
    bound, these are all of them, so no window holds a list of names. Ties are comma-joined, sorted.
    """
    c = commits.where(F.col("stats").isNotNull()).select(
        "ts", owner_repo().alias("repo"), committer_name().alias("committer"), F.col("stats.total").alias("total"))
    per = c.groupBy(F.window("ts", "1 day"), "repo", "committer").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("changes"))
    who = F.struct(F.col("n").alias("n"), F.col("committer").alias("committer"))
    day = per.groupBy("window", "repo").agg(
        F.sum("n").alias("amountOfCommits"), F.count(F.lit(1)).alias("amountOfCommitters"),
        F.sum("changes").alias("totalChanges"), F.min(who).alias("_low"), F.max(who).alias("_high"))
    # At most two committers are left, so the lowest and the highest by (n, name) are all of them.
    both = (F.col("_low.n") == F.col("_high.n")) & (F.col("amountOfCommitters") == 2)
    top = F.when(both, F.concat_ws(",", "_low.committer", "_high.committer")).otherwise(F.col("_high.committer"))
    return (day.where((F.col("amountOfCommits") > more_than) & (F.col("amountOfCommitters") <= 2))
            .select("repo", F.date_format("window.start", "dd-MM-yyyy").alias("date"),
                    "amountOfCommits", "amountOfCommitters", "totalChanges", top.alias("topCommitter")))


def geo_join(commits: DataFrame, geo: DataFrame, before: str = "1 hour", after: str = "30 minutes") -> DataFrame:
    """Interval join on sha with ``geo.createdAt`` in ``[ts - before, ts + after]`` (bounds inclusive).

    ``event_ts`` is the later of the two times, the timestamp an interval join gives its output.
    """
    g = geo.select(F.col("sha").alias("g_sha"), F.col("createdAt").alias("geo_ts"), "continent")
    cond = ((F.col("sha") == F.col("g_sha"))
            & (F.col("geo_ts") >= F.col("ts") - F.expr(f"INTERVAL {before}"))
            & (F.col("geo_ts") <= F.col("ts") + F.expr(f"INTERVAL {after}")))
    return commits.join(g, cond, "inner").drop("g_sha").withColumn("event_ts", F.greatest("ts", "geo_ts"))


def file_changes(commits: DataFrame, ext: str = "java") -> DataFrame:
    """T6 input: (sha, ts, changes) per file of one type. Taken before the join, so that its state holds three narrow
    columns instead of commits."""
    files = explode_files(commits, ["filename", "changes"], keep=["sha", "ts"])
    return (files.where(F.col("filename").isNotNull() & (extension("filename", no_dot="self") == ext))
            .select("sha", "ts", "changes"))


def weekly_changes(joined: DataFrame, time_col: str = "event_ts") -> DataFrame:
    """T6 / D-18: weekly summed changes per continent of ``geo_join(file_changes(commits), geo)``."""
    g = joined.groupBy(F.window(time_col, "7 days"), "continent").agg(F.sum("changes").alias("amount"))
    return g.select(F.col("window.start").alias("window_start"), "continent", "amount")


def status_rows(commits: DataFrame, more: tuple[str, ...] = ("changes",)) -> DataFrame:
    """Pattern input: (repo, filename, status, ts, sha, file_sha, *more) of every named file; ``more`` are file fields."""
    files = explode_files(commits, ["sha", "filename", "status", *more],
                          keep=["ts", F.col("sha").alias("commit_sha"), owner_repo().alias("repo")], prefix="f_")
    return (files.where(F.col("f_filename").isNotNull())
            .select("repo", F.col("f_filename").alias("filename"), F.col("f_status").alias("status"), "ts",
                    F.col("commit_sha").alias("sha"), F.col("f_sha").alias("file_sha"),
                    *[F.col(f"f_{c}").alias(c) for c in more]))


def added_removed_rows(commits: DataFrame) -> DataFrame:
    """T7 input: (repo, filename, status, ts, sha, file_sha) for named files with status added/removed only."""
    return status_rows(commits, ()).where(F.col("status").isin("added", "removed"))


def added_then_removed(commits: DataFrame, within_seconds: int = 86400) -> DataFrame:
    """T7 batch twin / W3 / D-19: per (repo, file), an ``added`` directly followed by ``removed`` (other statuses
    filtered out first) less than ``within_seconds`` later. Every match is emitted (repo, filename).

    The lead runs inside (repo, file, month), so a hot file is split over tasks.
    """
    from commitlens.operators.ordered import shift_within
    rows = added_removed_rows(commits)
    nxt = shift_within(rows, ["repo", "filename"], ["ts", "sha", "file_sha", "status"], ["status", "ts"],
                       F.trunc("ts", "month"), offset=1)
    gap = F.unix_micros(F.col("ts_next")) - F.unix_micros(F.col("ts"))
    return (nxt.where((F.col("status") == "added") & (F.col("status_next") == "removed")
                      & (gap < F.lit(within_seconds * 1_000_000)))
            .select("repo", "filename"))


def weekly_changes_chained(joined: DataFrame) -> DataFrame:
    """T6 / D-18 on a stream, in the same query as its join: weekly summed changes per continent by the time of the join's
    output, the later of the two times.

    A stream's event time cannot be redefined by a projection, so rows are first summed by the week of ``ts``, which has the
    watermark: apart those whose ``event_ts`` lies in that week and those that reach into the next one (the join's
    interval is shorter than a week). A window over two of these weeks then adds a week's own rows to what the week
    before left it. Watermarks go on from the join to both windows.
    """
    week = lambda c: F.floor(F.unix_micros(F.col(c)) / F.lit(7 * 86400 * 1_000_000))
    own = week("event_ts") == week("ts")
    per = joined.groupBy(F.window("ts", "7 days").alias("week"), "continent").agg(
        F.count(F.when(own, 1)).alias("own_n"), F.sum(F.when(own, F.col("changes"))).alias("own"),
        F.count(F.when(~own, 1)).alias("next_n"), F.sum(F.when(~own, F.col("changes"))).alias("next"))
    pairs = per.withColumn("pair", F.window(F.window_time("week"), "14 days", "7 days"))
    first = F.col("week.start") == F.col("pair.start")
    both = pairs.select("pair", "continent", F.when(first, F.col("next_n")).otherwise(F.col("own_n")).alias("n"),
                        F.when(first, F.col("next")).otherwise(F.col("own")).alias("amount"))
    g = both.groupBy("pair", "continent").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    return g.where(F.col("n") > 0).select((F.col("pair.start") + F.expr("INTERVAL 7 DAYS")).alias("window_start"),
                                          "continent", "amount")
