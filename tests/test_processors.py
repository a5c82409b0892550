"""Keyed processors start where the package is not installed and where the session names no state store."""

import subprocess
import sys

import pytest
from pyspark.serializers import CPickleSerializer

from commitlens.streaming import questions as S
from commitlens.streaming import runner
from commitlens.streaming.changelog import RunningTotal
from commitlens.streaming.patterns import PatternProcessor, added_then_removed_stream
from commitlens.streaming.restamp import RestampProcessor
from fixtures import commit, commits_df, rows


@pytest.mark.parametrize("processor", [RunningTotal(["k"], 1), PatternProcessor(["k"], [False], 1, 1),
                                       RestampProcessor(["k"])])
def test_processor_loads_without_the_package(processor, tmp_path):
    file = tmp_path / "processor"
    file.write_bytes(CPickleSerializer().dumps(processor))
    code = ("import pickle, sys; p = pickle.load(open(sys.argv[1], 'rb')); "
            "print(p.columns[0], any(m.startswith('commitlens') for m in sys.modules))")
    got = subprocess.run([sys.executable, "-c", code, str(file)], cwd=tmp_path, env={}, capture_output=True, text=True)
    assert got.stdout.split() == ["k", "False"], got.stderr


def test_keyed_stream_without_a_state_store_in_the_session(spark):
    recs = [commit("x1", date="2019-01-01T01:00:00Z", files=[("g", "added", 1, 0)]),
            commit("x2", date="2019-01-01T05:00:00Z", files=[("g", "removed", 1, 0)])]
    before = spark.conf.get(runner.STATE_STORE)
    spark.conf.set(runner.STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        feed = runner.landed_commit_feed(spark, commits_df(spark, recs), 1)
        commits = S.with_event_time(runner.commit_stream(spark, feed)).withWatermark("ts", feed.delay)
        assert rows(runner.run_append(spark, [added_then_removed_stream(commits)], "no-store", runner.ROCKSDB)) == [
            ("own/repo", "g")]
        assert spark.conf.get(runner.STATE_STORE).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(runner.STATE_STORE, before)
