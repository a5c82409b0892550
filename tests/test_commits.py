"""Commit questions on hand-made fixtures, one case per semantics decision (D-n)."""

from pyspark.sql import functions as F

from commitlens.operators import commits as Q
from commitlens.operators import graph, lineage, stats
from fixtures import commit, commits_df, rows


def test_stats_filters_and_missing_names(spark):
    # D-6 / D-20: NULL stats alone for a key, mixed NULL / non-NULL, NULL filename and status
    df = commits_df(spark, [
        commit("c1", author="ann", committer="ann", stats=None, files=[(None, None, 1, 40)]),
        commit("c2", author="bob", committer="bob", stats=(30, 25, 5), files=[("x.py", "added", 25, 5)]),
        commit("c3", author="bob", committer="bob", stats=None, files=[]),
    ])
    assert rows(Q.big_additions(df)) == [("c2",)]
    assert rows(Q.big_deletion_files(df)) == [("",)]
    got = rows(Q.committer_repo_stats(df))
    assert got == [("ann", "repo", None, None, None), ("bob", "repo", 30, 25, 5)]
    assert rows(Q.committer_stats(df, ["bob", "ann", "nobody"])) == [("ann", 0, 0, 0), ("bob", 30, 25, 5)]
    assert rows(Q.avg_additions(df)) == [(25,)]


def test_latest_file_per_repo_d4(spark):
    # same filename twice in a repo: the newer has fewer changes
    df = commits_df(spark, [
        commit("old", date="2019-01-01T00:00:00Z", files=[("a.java", "added", 50, 0)]),
        commit("new", date="2019-02-01T00:00:00Z", files=[("a.java", "modified", 1, 1), (None, "added", 1, 0)]),
    ])
    newest = Q.repo_latest_files(df).select("filename", "commit_sha", "changes").collect()
    assert [tuple(r) for r in newest] == [("a.java", "new", 2)]
    most = Q.repo_latest_files(df, order="changes").select("filename", "commit_sha", "changes").collect()
    assert [tuple(r) for r in most] == [("a.java", "old", 50)]


def test_repo_match_d9(spark):
    df = commits_df(spark, [commit("c1", owner="x", repo="foo", files=[("a", "added", 1, 0)]),
                            commit("c2", owner="x", repo="foobar", files=[("b", "added", 1, 0)]),
                            commit("c3", owner="foo", repo="zzz", files=[("c", "added", 1, 0)])])
    assert [r.filename for r in Q.repo_file_shas(df, "foo").collect()] == ["a"]
    assert rows(Q.repo_file_sha_rows(df, "foo")) == [("a", "c1")]
    assert rows(Q.repo_file_stats(df, "foo")) == [("a", 1, 1, 1, 0)]
    assert sorted(r.filename for r in Q.repo_file_shas(df, "foo", match="contains").collect()) == ["a", "b", "c"]
    got = Q.repo_file_shas(df, "x/foo", sha="file").collect()
    assert [(r.filename, list(r.shas)) for r in got] == [("a", ["c1-f0"])]


def test_revert_streaks_a8(spark):
    df = commits_df(spark, [
        commit("c1", author="a", message='Revert "Revert x"'),
        commit("c2", author="a", message="Oops, Revert Revert y"),
        commit("c3", author="a", message="RevertRevert z"),
        commit("c4", author="b", message='Revert "Revert q"'),
        commit("c5", author="b", message='Revert "Revert r"'),
    ])
    assert rows(Q.revert_streaks(df)) == [("a", 2, 1), ("b", 2, 2)]


def test_days_since_previous_d13(spark):
    df = commits_df(spark, [
        commit("s1", committer="solo", date="2019-03-01T10:00:00Z"),
        commit("m1", committer="mid", date="2019-03-01T23:59:00Z"),
        commit("m2", committer="mid", date="2019-03-02T00:01:00Z"),
        commit("m3", committer="mid", date="2019-03-10T00:00:00Z"),
    ])
    got = rows(Q.days_since_previous(df), "name", "sha", "time_diff")
    assert got == [("mid", "m1", 0), ("mid", "m2", 1), ("mid", "m3", 8), ("solo", "s1", 0)]
    one = Q.days_since_previous(df, name="mid")
    assert one.count() == 3


def test_author_rank_d14(spark):
    df = commits_df(spark, [commit("1", author="bob"), commit("2", author="Bob"), commit("3", author="al"),
                            commit("4", author="al"), commit("5", author="zed")])
    got = [tuple(r) for r in Q.author_rank(df).orderBy("rank").collect()]
    assert got == [(0, "al", 2), (1, "Bob", 1), (2, "bob", 1), (3, "zed", 1)]


def test_owner_xor_author_u1(spark):
    df = commits_df(spark, [commit("1", owner="onlyowner", author="both"), commit("2", owner="both", author="onlyauthor")])
    assert rows(Q.owner_xor_author(df)) == [("onlyauthor",), ("onlyowner",)]


def test_branch_points_and_forks_d12(spark):
    base = [commit("p", owner="o", repo="r"),
            commit("c1", owner="o", repo="r", parents=["p"]),
            commit("c2", owner="fork", repo="r", parents=["p"]),
            commit("c3", owner="o", repo="r", parents=["p", "absent"]),
            commit("c4", owner="o", repo="r", parents=["absent"]),
            commit("c5", owner="o", repo="r", parents=["absent"])]
    dup = base + [commit("c1", owner="o", repo="r", parents=["p"])]  # duplicated commit row
    assert rows(lineage.branch_points(commits_df(spark, base))) == [("p", 3)]
    assert rows(lineage.branch_points(commits_df(spark, dup))) == [("p", 4)]
    assert rows(lineage.forks(commits_df(spark, base))) == [("o/r", "fork/r", "p", "c2")]


def test_graph_counts(spark):
    df = commits_df(spark, [commit("1", owner="o", repo="a", committer="x"), commit("2", owner="o", repo="a", committer="x"),
                            commit("3", owner="o", repo="b", committer="x"), commit("4", owner="p", repo="a", committer="y")])
    assert graph.graph_edges(df).count() == 3  # distinct (committer, repo) pairs
    v = graph.graph_vertices(df)
    assert rows(v, "name", "kind") == [("o/a", "repository"), ("o/b", "repository"), ("p/a", "repository"),
                                      ("x", "developer"), ("y", "developer")]


def test_time_columns_and_weeks_d7(spark):
    df = commits_df(spark, [commit("1", date="2019-12-30T23:30:00Z", author_date="2019-12-30T23:00:00Z"),
                            commit("2", date="2018-12-31T00:30:00Z")])
    assert rows(Q.with_commit_time_diff(df), "sha", "commit_time_diff") == [("1", 1800), ("2", 0)]
    assert rows(Q.repo_week_counts(df)) == [("repo", 1, 2018, 1), ("repo", 1, 2019, 1)]
    assert rows(Q.repo_week_counts(df, iso_year=True)) == [("repo", 1, 2019, 1), ("repo", 1, 2020, 1)]
    assert rows(Q.day_of_week_counts(df)) == [(2, 2)]
    age = Q.with_age(df, "2020-01-01 00:00:00").where(F.col("sha") == "1").first()["age"]
    assert age == 25 * 3600


def test_top_k_and_parts(spark):
    df = commits_df(spark, [
        commit("1", date="2019-01-01T05:00:00Z", files=[("a.js", "added", 1, 0), ("b.js", "added", 1, 0)]),
        commit("2", date="2019-01-01T21:00:00Z", files=[("README", "added", 1, 0), ("c.js", "added", 1, 0)]),
        commit("3", date="2019-01-01T04:00:00Z", files=[("x.py", "added", 1, 0)]),
    ])
    assert rows(Q.js_hour(df)) == [(5, 2)]
    assert rows(Q.most_productive_part(df)) == [("night", 2)]
    assert [tuple(r) for r in Q.top_file_formats(df, 2).collect()] == [("js", 3), ("README", 1)]
    assert rows(Q.top_author(df, "repo")) == [("alice", 3)]
    assert rows(Q.repo_year_counts(df, 2019)) == [("own/repo", 3)]


def test_summary_and_sample(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "v double")
    r = stats.summary(df, "v").first()
    assert (r["count"], r["mean"], round(r["stddev"], 6), r["min"], r["max"]) == (4, 2.5, 1.290994, 1.0, 4.0)
    big = spark.range(10000)
    a = stats.sample_rows(big, 0.2, seed=0, key="id")
    b = stats.sample_rows(big.repartition(7), 0.2, seed=0, key="id")
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert 1700 < a.count() < 2300
    m1 = stats.sample_rows(big, 0.2, seed=0, key="id", hash="md5")
    m2 = stats.sample_rows(big.repartition(3), 0.2, seed=0, key="id", hash="md5")
    assert sorted(r[0] for r in m1.collect()) == sorted(r[0] for r in m2.collect())


def test_schema_check_and_multiline_source(spark, tmp_path):
    import json as _json
    from commitlens.sources.commits import check_commits, read_commits
    from fixtures import commit as _commit
    good = _json.dumps(_commit("g1"))
    (tmp_path / "lines.json").write_text(good + "\nnot json at all\n{broken\n")
    r = check_commits(spark, str(tmp_path / "lines.json")).first()
    assert (r.valid, r.invalid) == (1, 2)
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "one.json").write_text(_json.dumps(_commit("m1"), indent=2))
    df = read_commits(spark, str(tmp_path / "dump"), multiline=True)
    assert [r.sha for r in df.collect()] == ["m1"]


def test_avg_additions_empty_is_null_under_ansi(spark):
    df = commits_df(spark, [commit("n1", stats=None)])
    assert rows(Q.avg_additions(df)) == [(None,)]


def test_a_parent_listed_twice_counts_twice(spark):
    """D-22: every listed parent counts, as the questions' own code does."""
    from commitlens.operators import lineage
    df = commits_df(spark, [commit("p", repo="a"), commit("c", repo="b", parents=["p", "p"])])
    assert rows(lineage.branch_points(df)) == [("p", 2)]
    assert rows(lineage.forks(df), "parent_sha", "child_sha") == [("p", "c"), ("p", "c")]
