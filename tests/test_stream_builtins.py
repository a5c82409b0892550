"""Patterns and chained weeks on streams are built-in aggregates: any state store will do, and no Python process takes part."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from commitlens.session import scratch_path
from commitlens.streaming import questions as S
from commitlens.streaming import runner
from commitlens.streaming.patterns import added_then_removed_stream, reworked_files, reworked_files_stream
from fixtures import commit, commits_df, rows


@contextmanager
def plain_store(spark):
    before = spark.conf.get(runner.STATE_STORE)
    spark.conf.set(runner.STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(runner.STATE_STORE, before)


def _live(spark, recs):
    feed = runner.land(commits_df(spark, recs), scratch_path(spark, "fx-plain"), 2, "commit.committer.date",
                       runner.sentinel_commit(spark))
    return S.with_event_time(runner.commit_stream(spark, feed)).withWatermark("ts", feed.delay)


def test_patterns_need_no_keyed_state(spark):
    recs = [commit(f"p{i}", date=f"2019-{i // 28 % 12 + 1:02d}-{i % 28 + 1:02d}T0{i % 9}:00:00Z",
                   files=[("f", ["added", "added", "modified", "removed", "modified", "added", "removed"][i % 7], 58 + i % 5, 0),
                          ("g", ["added", "removed"][i % 2], 1, 0)])
            for i in range(60)]
    twin = S.with_event_time(commits_df(spark, recs))
    with plain_store(spark):
        for bucket in (86400 * 3, 86400 * 200):
            got = runner.run_append(spark, [reworked_files_stream(_live(spark, recs), bucket)], "plain-reworked")
            assert rows(got) == rows(reworked_files(twin)) and got.count() > 0
        out = added_then_removed_stream(_live(spark, recs), within_seconds=2 * 86400, bucket_seconds=86400 * 5)
        assert "Python" not in out._jdf.queryExecution().analyzed().toString()
        got = runner.run_append(spark, [out], "plain-removed")
        assert rows(got) == rows(S.added_then_removed(twin, 2 * 86400)) and got.count() > 0


def test_chained_weeks_need_no_keyed_state(spark):
    """Weeks with rows of their own, rows left by the week before, both, and only null changes."""
    recs = [commit("v1", date="2019-01-02T23:50:00Z", files=[("a.java", "added", 3, 0)]),
            commit("v2", date="2019-01-09T12:00:00Z", files=[("a.java", "added", 5, 0)]),
            commit("v3", date="2019-01-09T23:55:00Z", files=[("a.java", "added", 7, 0)]),
            commit("v4", date="2019-01-12T00:00:00Z", files=[("a.java", "added", 9, 0)]),
            commit("v5", date="2019-02-20T00:00:00Z", files=[("a.java", "added", None, 0)])]
    geo = spark.createDataFrame(
        [("v1", "2019-01-03 00:05:00"), ("v2", "2019-01-09 12:01:00"), ("v3", "2019-01-10 00:05:00"),
         ("v4", "2019-01-12 00:00:00"), ("v5", "2019-02-20 00:00:00")], "sha string, t string").select(
        "sha", F.to_timestamp("t").alias("createdAt"), F.lit("ASIA").alias("continent"))
    geo_feed = runner.land(geo, scratch_path(spark, "fx-plain-geo"), 2, "createdAt", runner.sentinel_geo(spark))
    joined = S.geo_join(S.file_changes(_live(spark, recs)), runner.geo_stream(spark, geo_feed))
    with plain_store(spark):
        got = runner.run_append(spark, [S.weekly_changes_chained(joined)], "plain-weeks")
    twin = S.weekly_changes(S.geo_join(S.file_changes(S.with_event_time(commits_df(spark, recs))), geo))
    assert rows(got) == rows(twin) and sorted(r.amount or 0 for r in got.collect()) == [0, 8, 16]
