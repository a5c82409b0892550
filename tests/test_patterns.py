"""Event patterns, changelogs, one-query weeks and routed messages: streams against batch forms and plain loops."""

import json
import random

import pytest
from pyspark.sql import functions as F

from commitlens.schemas import COMMIT
from commitlens.session import path_exists, scratch_path
from commitlens.streaming import changelog, patterns as P, routing, runner
from commitlens.streaming import questions as S
from fixtures import commit, commits_df, rows

HOUR = 3600


def _events(n, seed, keys=3, spread=40):
    rng = random.Random(seed)
    # Not from the epoch itself, where a stream's first watermark stands.
    return [(f"k{rng.randrange(keys)}", (240 + rng.randrange(spread)) * HOUR, f"e{i:03d}", rng.choice("abcx"))
            for i in range(n)]


def _plain(events, steps, within):
    """steps: (letters, strict). One automaton a key, every start by itself."""
    out = []
    for k in {e[0] for e in events}:
        mine = sorted(e[1:] for e in events if e[0] == k)
        for i, (t0, _, v) in enumerate(mine):
            if v not in steps[0][0]:
                continue
            at, j, end = 1, i, t0
            while at < len(steps) and j + 1 < len(mine):
                j += 1
                if mine[j][2] in steps[at][0]:
                    at, end = at + 1, mine[j][0]
                elif steps[at][1]:
                    break
            if at == len(steps) and end - t0 < within:
                out.append((k, t0, end))
    return sorted(out)


def _frame(spark, events):
    df = spark.createDataFrame(events, "k string, s long, id string, v string")
    return df.select("k", F.timestamp_seconds("s").alias("ts"), "id", "v")


def _pattern(steps, within):
    return P.Pattern(tuple(P.Step(F.col("v").isin(list(x)), strict) for x, strict in steps), within)


def _result(df):
    return sorted((r.k, int(r.a), int(r.b)) for r in df.select(
        "k", F.unix_seconds("started").alias("a"), F.unix_seconds("ended").alias("b")).collect())


CASES = [([("a", False), ("b", True)], 5 * HOUR), ([("a", False), ("b", False), ("c", True)], 9 * HOUR),
         ([("ab", False), ("bc", False), ("a", False), ("x", True)], 30 * HOUR), ([("a", False)], HOUR)]


@pytest.mark.parametrize("steps,within", CASES)
def test_batch_patterns(spark, steps, within):
    for seed in (1, 2):
        events = _events(120, seed)
        want = _plain(events, steps, within)
        assert want and _result(P.pattern_matches(_frame(spark, events), ["k"], "ts", ["id"], _pattern(steps, within))) == want


@pytest.mark.parametrize("case,bucket", [(1, HOUR), (2, 7 * HOUR)])
def test_stream_patterns_out_of_order(spark, case, bucket):
    """Rows arrive in four files in disorder; the watermark delay covers it. Buckets neither divide nor fill the limit."""
    steps, within = CASES[case]
    events = _events(120, 7)
    folder = scratch_path(spark, "events")
    rng = random.Random(3)
    at = [min(e[1] // (10 * HOUR) - 24 + (rng.random() < 0.3), 3) for e in events]
    for i in range(4):
        _frame(spark, [e for e, a in zip(events, at) if a == i]).coalesce(1).write.mode("append").parquet(folder)
    for _ in range(2):
        spark.range(1).select(F.lit("end").alias("k"), F.to_timestamp(F.lit("2200-01-01 00:00:00")).alias("ts"),
                              F.lit("").alias("id"), F.lit("x").alias("v")).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("k string, ts timestamp, id string, v string").option("maxFilesPerTrigger", 1).parquet(
        folder).withWatermark("ts", "2 days")
    got = runner.run_append(spark, [P.pattern_stream(stream, ["k"], "ts", ["id"], _pattern(steps, within), bucket)], "pat")
    assert _result(got) == _plain(events, steps, within)


def test_pattern_limits():
    with pytest.raises(ValueError):
        P.Pattern((), 5)
    with pytest.raises(ValueError):
        P.Pattern((P.Step,), 0)


def _feed(spark, recs, files=3):
    return runner.land(commits_df(spark, recs), scratch_path(spark, "fx-log"), files, "commit.committer.date",
                       runner.sentinel_commit(spark))


def test_changelog_emits_every_record(spark):
    recs = [commit(f"u{i}", date=f"2019-01-{i % 9 + 1:02d}T0{i % 3}:00:00Z",
                   files=[("a.java", "added", i, 0), ("b.js", "modified", 2, i), ("c.js", "removed", None, 3)]) for i in range(25)]
    df = S.with_event_time(commits_df(spark, recs))
    feed = _feed(spark, recs)
    live = lambda: S.with_event_time(runner.commit_stream(spark, feed)).withWatermark("ts", feed.delay)
    got = runner.run_append(spark, [changelog.ext_changelog_stream(live(), bucket_seconds=7200)], "log1")
    assert rows(got) == rows(S.ext_changelog(df)) and got.count() == 25
    got = runner.run_append(spark, [changelog.ext_status_changelog_stream(live())], "log2")
    assert got.count() == 50
    last = {(r.ext, r.status): r.changes for r in got.groupBy("ext", "status").agg(F.max("changes").alias("changes")).collect()}
    assert last == {("js", "modified"): 25 * 2 + sum(range(25)), ("js", "removed"): 0}


def test_weeks_of_the_join_time_in_one_query(spark):
    """A commit of one week whose geo event falls into the next counts there."""
    recs = [commit("w1", date="2019-01-02T23:50:00Z", files=[("a.java", "added", 3, 0)]),
            commit("w2", date="2019-01-02T23:00:00Z", files=[("a.java", "added", 5, 0), ("x.js", "added", 1, 0)]),
            commit("w3", date="2019-01-03T00:10:00Z", files=[("a.java", "added", 7, 0)])]
    geo = spark.createDataFrame([("w1", "2019-01-03 00:10:00"), ("w2", "2019-01-02 23:10:00"), ("w3", "2019-01-02 23:30:00")],
                                "sha string, t string").select("sha", F.to_timestamp("t").alias("createdAt"),
                                                               F.lit("EUROPE").alias("continent"))
    feed = _feed(spark, recs)
    geo_feed = runner.land(geo, scratch_path(spark, "fx-geo2"), 3, "createdAt", runner.sentinel_geo(spark))
    live = S.with_event_time(runner.commit_stream(spark, feed)).withWatermark("ts", "1 day")
    joined = S.geo_join(S.file_changes(live), runner.geo_stream(spark, geo_feed))
    got = runner.run_append(spark, [S.weekly_changes_chained(joined)], "weeks")
    twin = S.weekly_changes(S.geo_join(S.file_changes(S.with_event_time(commits_df(spark, recs))), geo))
    assert rows(got) == rows(twin) and sorted(r.amount for r in got.collect()) == [5, 10]


def test_messages_are_routed_once(spark):
    """Good, late and bad messages; a batch that runs again changes nothing, an incomplete one is written over."""
    lines = [json.dumps(commit("a", date="2019-01-10T00:00:00Z")), "{broken", "", "[]", '{"url": "no sha"}', "null"]
    late = [json.dumps(commit("b", date="2019-01-08T00:00:00Z")), json.dumps(commit("c", date="2019-01-09T12:00:00Z")),
            '{"sha": "no time"}']
    messages = lambda x: spark.createDataFrame([(m,) for m in x], "value string")
    root = scratch_path(spark, "routes")
    route = routing.router(root, F.col("record.commit.committer.date"), 86400 * 10**6)

    def state():
        return {k: rows(routing.routed(spark, root, k), "sha" if k != "bad" else "raw") for k in routing.KINDS}

    route(routing.parsed(messages(lines)), 0)
    route(routing.parsed(messages(late)), 1)
    want = {"good": [("a",), ("c",), ("no time",)], "late": [("b",)], "bad": sorted((m,) for m in lines[1:])}
    assert state() == want
    route(routing.parsed(messages(late)), 1)
    assert state() == want
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/rows/batch=1/_SUCCESS")
    fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs, False)
    assert not path_exists(spark, f"{root}/rows/batch=1/_SUCCESS") and state()["late"] == []
    route(routing.parsed(messages(late)), 1)
    assert state() == want
    assert {r.raw: r.reason for r in routing.routed(spark, root, "bad").collect()}['{"url": "no sha"}'] == "no sha"
    assert routing.routed(spark, root, "good").schema == COMMIT


def test_routed_stream_loses_nothing(spark):
    recs = [commit(f"m{i}", date=f"2019-02-{i + 1:02d}T00:00:00Z") for i in range(20)]
    folder = scratch_path(spark, "messages")
    steps = []
    for part in (recs[:10], [recs[0], recs[9]], recs[10:]):
        def arrive(part=part):
            spark.createDataFrame([(json.dumps(r),) for r in part], "value string").coalesce(1).write.mode("append").text(folder)
            return routing.message_stream(spark, folder)
        steps.append(arrive)
    root = runner.run_router(spark, steps, F.col("record.commit.committer.date"), 3 * 86400 * 10**6, "fx-route")
    assert rows(routing.routed(spark, root, "late"), "sha") == [("m0",)]
    good = S.with_event_time(routing.routed_stream(spark, root)).withWatermark("ts", "3 days")
    runner.run_append(spark, [S.daily_commits(good)], "fx-days")
    assert runner.late_rows(spark, "fx-days") == 0
