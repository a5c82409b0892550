"""The changelog queries are windowed aggregates and micro-batches that go on from totals: no Python process, any state store."""

from pyspark.sql import functions as F

from commitlens.operators.ordered import running_sum_within
from commitlens.plans import testbed
from commitlens.plans.bindings import QUERIES
from commitlens.session import scratch_path
from commitlens.streaming import changelog, runner
from commitlens.streaming import questions as S
from fixtures import commit, commits_df, rows


def _recs():
    """Equal times, a file listed twice, null changes, null status, two hot keys over many days."""
    f = lambda name, status, add, sha: (name, status, add, 0, sha)
    return [commit(f"k{i}", date=f"2019-{i % 4 + 1:02d}-{i // 4 + 1:02d}T0{i % 3}:00:00Z",
                   files=[f("a.js", "added", i + 1, "x"), f("a.js", "added", i + 1, "x"), f("b.py", None, 1, "y"),
                          f("c.py", "removed", None if i % 5 == 0 else i, "z"), f("d.java", "added", 1, "u"),
                          f("e.js", ["added", "removed"][i % 2], 3, "w")])
            for i in range(40)]


def _expected(recs):
    """The reduce, row by row."""
    found = sorted((r["commit"]["committer"]["date"], r["sha"], f["sha"], f["changes"] or 0, f["filename"].split(".")[-1],
                    f["status"]) for r in recs for f in r["files"]
                   if f["filename"].endswith((".js", ".py")) and f["status"])
    totals, out = {}, []
    for date, _, _, changes, ext, status in found:
        totals[ext, status] = totals.get((ext, status), 0) + changes
        out.append((date[:10] + " " + date[11:19], ext, status, totals[ext, status]))
    return sorted(out)


def test_status_changelog_by_micro_batches_equals_the_reduce(spark):
    recs = _recs()
    for slices, bucket in ((4, 86400), (1, 3600), (7, 86400 * 30)):
        feed = runner.land(commits_df(spark, recs), scratch_path(spark, "fx-log"), slices, "commit.committer.date",
                           runner.sentinel_commit(spark))
        live = S.with_event_time(runner.commit_stream(spark, feed)).withWatermark("ts", feed.delay)
        got = changelog.run_ext_status_changelog(spark, live, "fx-log", bucket_seconds=bucket)
        got = got.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "ext", "status", "changes")
        assert rows(got) == _expected(recs)
        assert runner.late_rows(spark, "fx-log") == 0


def test_changelog_without_matching_files_is_empty(spark):
    feed = runner.land(commits_df(spark, [commit("e1", files=[("a.txt", "added", 1, 0)])]), scratch_path(spark, "fx-log0"),
                       1, "commit.committer.date", runner.sentinel_commit(spark))
    live = S.with_event_time(runner.commit_stream(spark, feed)).withWatermark("ts", feed.delay)
    got = changelog.run_ext_changelog(spark, live, "fx-log0")
    assert got.columns == ["ts", "ext", "n"] and got.count() == 0


def test_a_batch_that_runs_again_changes_nothing(spark):
    root = scratch_path(spark, "fx-again")
    batch = lambda *found: spark.createDataFrame(
        found, "ext string, bucket_ long, us_ long, order_ string, value_ long, n_ long")
    sink = changelog.totals_sink(root, ["ext"])
    first, second = batch(("js", 0, 5, "a", 2, 3), (None, 0, 6, "a", 1, 1), ("js", 10, 11, "b", 1, 1)), batch(
        ("js", 20, 21, "a", 4, 2), (None, 20, 22, "a", 7, 1))
    for df, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        sink(df, number)
    got = spark.read.parquet(f"{root}/rows/batch=0", f"{root}/rows/batch=1").select("ext", F.unix_micros("at"), "total")
    assert sorted((r[0] or "", r[1], r[2]) for r in got.collect()) == [
        ("", 6, 1), ("", 22, 8), ("js", 5, 2), ("js", 5, 4), ("js", 5, 6), ("js", 11, 7), ("js", 21, 11), ("js", 21, 15)]


def test_running_sum_within_goes_over_buckets(spark):
    df = spark.createDataFrame([(k, i, i * (-1) ** i if i % 4 else None) for k in ("a", None) for i in range(30)],
                               "k string, i long, v long")
    got = running_sum_within(df, ["k"], ["i"], F.col("v"), F.floor(F.col("i") / 7), "s")
    total, expected = 0, {}
    for i in range(30):
        total += i * (-1) ** i if i % 4 else 0
        expected[i] = total
    assert sorted((r.k or "", r.i, r.s) for r in got.collect()) == [(k, i, expected[i]) for k in ("", "a") for i in range(30)]


def test_registered_changelogs_use_no_keyed_python_state(spark, monkeypatch):
    recs = _recs()
    monkeypatch.setattr("commitlens.plans.stream_queries.landed_commits", lambda spark, sf: _landed(spark, recs))

    def refuse(*_):
        raise AssertionError("keyed Python state")
    monkeypatch.setattr("commitlens.streaming.changelog.run_ordered", refuse)
    assert rows(QUERIES["stream_ext_status_changelog"](spark, "none")) == _expected(recs)
    twin = S.ext_changelog(S.with_event_time(commits_df(spark, recs)))
    twin = twin.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "ext", "n")
    assert rows(QUERIES["stream_ext_changelog"](spark, "none")) == rows(twin) and twin.count() == 40


def _landed(spark, recs):
    from commitlens.session import path_exists
    if not _LANDED or not path_exists(spark, _LANDED[0]):
        _LANDED[:] = [scratch_path(spark, "fx-view")]
        commits_df(spark, recs).write.parquet(_LANDED[0])
    return spark.read.schema(testbed.COMMIT).parquet(_LANDED[0])


_LANDED: list[str] = []
