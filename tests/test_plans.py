"""Plan checks: no Python on the hot path, filters and column pruning reach the scan, results do not depend on
the number of shuffle partitions."""

import pytest

from commitlens.operators import commits as Q
from commitlens.plans.bindings import QUERIES
from commitlens.plans.testbed import landed_commits

SF = "/root/testdata/sf0.001"
BATCH = {k: q for k, q in QUERIES.items() if not k.startswith("stream_")}
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(BATCH))
def test_no_python_in_batch_plans(spark, key):
    plan = _plan(BATCH[key](spark, SF))
    assert not any(n in plan for n in PY_NODES), key


def test_date_filter_pushed_to_scan(spark):
    df = Q.repo_year_counts(landed_commits(spark, SF), 1998)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(commit.committer.date), GreaterThanOrEqual(commit.committer.date" in plan


@pytest.fixture
def full_metadata(spark):
    """Printed scan schemas are cut at 100 characters by default."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


FILE_FIELDS = {"commit_ext_freq": {"filename"}, "commit_top_formats": {"filename"}, "commit_js_hour": {"filename"},
               "commit_big_deletion_files": {"filename", "deletions"}, "twin_ext_counts": {"filename"},
               "twin_ext_status_changes": {"filename", "status", "changes"},
               "twin_weekly_java_continent": {"filename", "changes"},
               "twin_added_removed": {"sha", "filename", "status"}, "twin_ext_changelog": {"sha", "filename"},
               "commit_repo_file_stats": {"filename", "additions", "deletions", "changes"},
               "commit_repo_file_blobs": {"sha", "filename"}, "commit_repo_file_shas": {"filename"}}


@pytest.mark.parametrize("key", sorted(FILE_FIELDS))
def test_file_questions_read_only_their_fields(spark, full_metadata, key):
    import re
    plan = _plan(BATCH[key](spark, SF))
    read = [m for m in re.findall(r"ReadSchema: struct<(.*)", plan) if "files:" in m]
    assert read
    for schema in read:
        fields = re.search(r"files:array<struct<([^>]*)>>", schema)[1]
        assert {f.split(":")[0] for f in fields.split(",")} <= FILE_FIELDS[key], schema
        assert "message" not in schema and "patch" not in schema


@pytest.mark.parametrize("key", ["commit_repo_file_shas", "commit_repo_file_stats", "commit_top_author"])
def test_repository_filter_reaches_the_scan(spark, full_metadata, key):
    assert "EqualTo(repo_key,repo3)" in _plan(BATCH[key](spark, SF))


@pytest.mark.parametrize("key", ["commit_days_since_prev", "commit_author_rank", "twin_added_removed",
                                 "seq_every_other", "commit_repo_latest_files", "twin_repo_daily_summary"])
def test_partition_count_invariance(spark, key):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(tuple, BATCH[key](spark, SF).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("key", ["commit_author_rank", "commit_days_since_prev", "twin_ext_changelog", "seq_every_other",
                                 "text_top_words_cat"])
def test_no_nested_loops(spark, key):
    plan = _plan(BATCH[key](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
