"""Stream questions on fixtures: edge cases, and every stream result equals its batch twin."""

import json

from pyspark.sql import functions as F

from commitlens.schemas import COMMIT
from commitlens.session import scratch_path
from commitlens.sources.commits import stream_commits
from commitlens.streaming import questions as S
from commitlens.streaming import runner
from commitlens.streaming.patterns import added_then_removed_stream
from fixtures import commit, commits_df, rows


def _stream(spark, records, build, files=3, geo=None):
    feed = runner.land(commits_df(spark, records), scratch_path(spark, "fx-feed"), files, "commit.committer.date",
                       runner.sentinel_commit(spark))
    streams = [_wm(runner.commit_stream(spark, feed), feed.delay)]
    if geo is not None:
        streams.append(runner.geo_stream(spark, runner.land(geo, scratch_path(spark, "fx-geo"), files, "createdAt",
                                                            runner.sentinel_geo(spark))))
    return runner.run_append(spark, [build(*streams)], "fx")


def _read(spark, folder, delay="0 seconds"):
    return _wm(stream_commits(spark, folder, 1), delay)


def _wm(c, delay="0 seconds"):
    return S.with_event_time(c).withWatermark("ts", delay)


def _t5_records():
    recs = []
    day = "2019-05-01T{:02d}:00:00Z"
    for i in range(22):  # r1: 11 + 11 commits, tied; one extra without stats is not counted
        recs.append(commit(f"r1-{i}", repo="r1", committer="b" if i % 2 else "a", date=day.format(i), stats=(2, 1, 1)))
    recs.append(commit("r1-x", repo="r1", committer="z", date=day.format(23), stats=None))
    for i in range(20):  # r2: exactly 20 commits -> not more than 20
        recs.append(commit(f"r2-{i}", repo="r2", committer="a", date=day.format(i), stats=(1, 1, 0)))
    for i in range(21):  # r3: 21 commits by 3 committers -> too many committers
        recs.append(commit(f"r3-{i}", repo="r3", committer="abc"[i % 3], date=day.format(i), stats=(1, 1, 0)))
    for i in range(21):  # r4: 21 commits by one committer
        recs.append(commit(f"r4-{i}", repo="r4", committer="d", date=day.format(i), stats=(3, 2, 1)))
    return recs


def test_t5_daily_summary_batch_and_stream(spark):
    recs = _t5_records()
    expected = [("own/r1", "01-05-2019", 22, 2, 44, "a,b"), ("own/r4", "01-05-2019", 21, 1, 63, "d")]
    twin = S.repo_daily_summary(S.with_event_time(commits_df(spark, recs)))
    assert rows(twin) == expected
    assert rows(_stream(spark, recs, S.repo_daily_summary)) == expected


def _t7_records():
    f = lambda name, status: (name, status, 1, 0)
    return [
        commit("a1", date="2019-01-01T00:00:00Z", files=[f("f1", "added"), f("f2", "added"), f("f3", "added"),
                                                          f("f4", "added")]),
        commit("a2", date="2019-01-01T06:00:00Z", files=[f("f3", "modified"), f("f4", "added")]),
        commit("a3", date="2019-01-01T12:00:00Z", files=[f("f3", "removed"), f("f4", "removed")]),
        commit("a4", date="2019-01-01T23:59:59Z", files=[f("f1", "removed")]),
        commit("a5", date="2019-01-02T00:00:00Z", files=[f("f2", "removed")]),
        commit("b1", repo="other", date="2019-01-01T01:00:00Z", files=[f("f1", "added"), f(None, "added")]),
    ]


def test_t7_added_then_removed(spark):
    expected = [("own/repo", "f1"), ("own/repo", "f3"), ("own/repo", "f4")]
    twin = S.added_then_removed(S.with_event_time(commits_df(spark, _t7_records())))
    assert rows(twin) == expected
    got = _stream(spark, _t7_records(), added_then_removed_stream)
    assert rows(got) == expected


def test_t7_stream_out_of_order_files(spark):
    # the removal arrives in an earlier file than the addition; a watermark delay absorbs it
    recs = [commit("x2", date="2019-01-01T05:00:00Z", files=[("g", "removed", 1, 0)]),
            commit("x1", date="2019-01-01T01:00:00Z", files=[("g", "added", 1, 0)])]
    folder = scratch_path(spark, "fx-ooo")
    for r in recs:  # written one after the other, in this (wrong) order
        spark.read.schema(COMMIT).json(spark.sparkContext.parallelize([json.dumps(r)], 1)).write.mode("append").json(folder)
    for _ in range(2):
        runner.sentinel_commit(spark).write.mode("append").json(folder)
    got = runner.run_append(spark, [added_then_removed_stream(_read(spark, folder, "1 day"))], "ooo")
    assert rows(got) == [("own/repo", "g")]


def test_j3_interval_bounds(spark):
    recs = [commit(f"c{i}", date="2019-01-01T12:00:00Z") for i in range(4)]
    offs = ["-1 hours", "-3601 seconds", "30 minutes", "1801 seconds"]
    geo = spark.createDataFrame([(f"c{i}", o) for i, o in enumerate(offs)], "sha string, off string").select(
        "sha", (F.to_timestamp(F.lit("2019-01-01 12:00:00"))
                + F.when(F.col("off") == "-1 hours", F.expr("INTERVAL -1 HOURS"))
                .when(F.col("off") == "-3601 seconds", F.expr("INTERVAL -3601 SECONDS"))
                .when(F.col("off") == "30 minutes", F.expr("INTERVAL 30 MINUTES"))
                .otherwise(F.expr("INTERVAL 1801 SECONDS"))).alias("createdAt"),
        F.lit("EUROPE").alias("continent"))
    twin = S.geo_join(S.with_event_time(commits_df(spark, recs)), geo)
    assert rows(twin, "sha") == [("c0",), ("c2",)]
    got = _stream(spark, recs, lambda commits, geo: S.geo_join(commits, geo)
                  .where(F.col("sha") != runner.SENTINEL_SHA).select("sha"), geo=geo)
    assert rows(got) == [("c0",), ("c2",)]


def test_windows_edges_stream_equals_twin(spark):
    recs = [commit("w1", date="2019-01-01T23:59:59Z", stats=(20, 10, 10)),
            commit("w2", date="2019-01-02T00:00:00Z", stats=(21, 11, 10)),
            commit("w3", date="2019-01-02T12:00:00Z", stats=(5, 5, 0)),
            commit("w4", date="2019-01-05T00:00:00Z", stats=None)]
    df = S.with_event_time(commits_df(spark, recs))
    assert rows(S.daily_commits(df)) == [("01-01-2019", 1), ("02-01-2019", 2), ("05-01-2019", 1)]
    twin4 = rows(S.size_windows(df))
    assert sum(r[3] for r in twin4) == 12  # three commits with stats x four windows each
    assert rows(_stream(spark, recs, S.daily_commits)) == rows(S.daily_commits(df))
    assert rows(_stream(spark, recs, S.size_windows)) == twin4


def test_update_mode_totals_equal_twin(spark):
    recs = [commit(f"u{i}", date=f"2019-01-0{i + 1}T00:00:00Z",
                   files=[("a.java", "added", 1, 0), ("b.scala", "modified", 2, 1), ("c.js", "removed", 0, 3),
                          ("d.myjava", "added", 1, 1), (None, "added", 1, 1)]) for i in range(5)]
    df = commits_df(spark, recs)
    folder = scratch_path(spark, "fx-upd")
    runner.land(df, folder, 3, "commit.committer.date", None)
    got = runner.run_update(spark, S.ext_counts(_read(spark, folder)), ["ext"], "u")
    assert rows(got) == rows(S.ext_counts(df)) == [("java", 5), ("scala", 5)]
    log = S.ext_changelog(S.with_event_time(df))
    assert sorted(r.n for r in log.where(F.col("ext") == "java").collect()) == [1, 2, 3, 4, 5]


def test_t8_late_rows_are_dropped_and_counted(spark):
    # a commit older than the watermark arrives in a later file: it is dropped and counted, not aggregated.
    # Late rows are judged against the previous batch's watermark, so it comes two files after the newer one.
    recs = [commit("l1", date="2019-01-05T00:00:00Z"), commit("l3", date="2019-01-05T01:00:00Z"),
            commit("l2", date="2019-01-01T00:00:00Z")]
    folder = scratch_path(spark, "fx-late")
    for r in recs:
        spark.read.schema(COMMIT).json(spark.sparkContext.parallelize([json.dumps(r)], 1)).write.mode("append").json(folder)
    for _ in range(2):
        runner.sentinel_commit(spark).write.mode("append").json(folder)
    got = runner.run_append(spark, [S.daily_commits(_read(spark, folder))], "late")
    assert rows(got) == [("05-01-2019", 2)]
    assert runner.late_rows(spark, "late") == 1


def test_t8_counts_late_rows_of_every_micro_batch(spark):
    """More micro-batches than a query keeps progress of: the listener has seen them all."""
    folder = scratch_path(spark, "fx-many")
    late = [commit(f"m{i}", date="2019-01-01T00:00:00Z") for i in range(109)]
    recs = [commit("first", date="2019-02-05T00:00:00Z"), commit("second", date="2019-02-05T01:00:00Z"), *late]
    import os
    import time
    path = folder.removeprefix("file:")
    os.makedirs(path)
    now = time.time() - 1000
    for i, r in enumerate(recs):
        with open(f"{path}/{i:04d}.json", "w") as out:
            out.write(json.dumps(r) + "\n")
        os.utime(f"{path}/{i:04d}.json", (now + i, now + i))
    q = S.daily_commits(_read(spark, folder))
    runner.run_append(spark, [q], "many")
    assert len(runner.LAST_QUERY["many"].recentProgress) <= 100
    assert runner.late_rows(spark, "many") == len(late)


def test_update_mode_without_matches_is_empty(spark):
    recs = [commit("e1", files=[("a.txt", "added", 1, 0)])]
    folder = scratch_path(spark, "fx-empty")
    runner.land(commits_df(spark, recs), folder, 1, "commit.committer.date", None)
    got = runner.run_update(spark, S.ext_counts(_read(spark, folder)), ["ext"], "e")
    assert got.columns == ["ext", "n"] and got.count() == 0


def test_console_sink_prints_stream(spark):
    from commitlens.sources import sinks
    folder = scratch_path(spark, "fx-console")
    runner.land(commits_df(spark, [commit("k1"), commit("k2")]), folder, 1, "commit.committer.date", None)
    q = sinks.console(spark.readStream.schema(COMMIT).json(folder).select("sha"), available_now=True,
                      checkpoint=scratch_path(spark, "fx-console-ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == 2
