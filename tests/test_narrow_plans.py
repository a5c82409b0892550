"""What grows with the tables is shuffled narrow, read once, and stored compressed."""

from pyspark.sql import functions as F

from commitlens.plans.testbed import commits, landed_commits
from commitlens.session import files_under
from commitlens.streaming import runner
from commitlens.streaming.patterns import reworked_files
from commitlens.streaming.questions import with_event_time
from fixtures import commit, commits_df


def tables(spark, folder):
    """Five orders (one without lines, one without customer), lines with nulls and repeats."""
    spark.createDataFrame([(k, 1 if k < 5 else 99, f"1995-01-0{k}") for k in range(1, 6)],
                          "o_orderkey long, o_custkey long, o_orderdate string").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, "Customer#1", 3)], "c_custkey long, c_name string, c_nationkey long").write.parquet(
        f"{folder}/customer.parquet")
    spark.createDataFrame([(1, 8, 2, 5.9, "A"), (1, None, 1, 3.0, "R"), (2, 23, 1, None, None), (2, 23, 1, None, None),
                           (None, 4, 1, 1.0, "A"), (4, 7, 1, 2.0, "N")],
                          "l_orderkey long, l_partkey long, l_linenumber long, l_quantity double, l_returnflag string"
                          ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_view_shuffles_only_columns_of_its_tables(spark, tmp_path):
    view = commits(spark, tables(spark, tmp_path))
    plan = view._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "blob_url" not in below and "raw_url" not in below
    got = {r.sha: r for r in view.collect()}
    assert sorted(got) == ["c1", "c2", "c3", "c4"]
    assert [(f.sha, f.filename, f.status, f.additions, f.deletions, f.changes) for f in got["c1"].files] == [
        ("f1-1", None, "removed", 3, None, None), ("f1-2", "src/p8.py", "added", 5, 8, 13)]
    assert [f.sha for f in got["c2"].files] == ["f2-1", "f2-1"] and got["c3"].files == [] and got["c3"].stats is None
    assert got["c1"].stats[:] == (16, 8, 8)


def test_feed_is_compressed(spark):
    feed = runner.landed_commit_feed(spark, commits_df(spark, [commit(f"z{i}") for i in range(50)]), 2)
    assert any(path.endswith(".json.gz") for path, _, _ in files_under(spark, feed.folder))


def test_pattern_reads_a_block_once(spark):
    plan = reworked_files(with_event_time(commits_df(spark, [commit("a")])))._jdf.queryExecution().toString()
    assert "unboundedfollowing" not in plan.lower().replace(" ", "")
