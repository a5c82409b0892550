"""Commit lineage: branch points (J1) and forks.

D-22: every listed parent counts, as the questions' own code does; a commit that lists one parent twice is two children
of it (J1) and two fork rows (J2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.functions.fields import owner_repo_between


def branch_points(commits: DataFrame, more_than: int = 1) -> DataFrame:
    """J1 / D-12: shas present in the data that are parent of more than ``more_than`` commits, with the count.

    Aggregate first (partial + final, so a hot parent is combined map-side), then a left-semi join with the known
    shas: a duplicated commit row cannot inflate the count, and only the aggregate is joined.
    """
    parents = commits.select(F.explode("parents.sha").alias("sha"))
    counted = parents.groupBy("sha").agg(F.count(F.lit(1)).alias("times_parent")).where(
        F.col("times_parent") > more_than)
    return counted.join(commits.select("sha"), "sha", "left_semi")


def forks(commits: DataFrame) -> DataFrame:
    """Child commits whose parent lives in another owner/repo.

    Inner equi-join on the parent sha (sort-merge or AQE broadcast; AQE splits a hot parent sha on the child side).
    """
    child = commits.select(owner_repo_between().alias("child_repo_name"), F.col("sha").alias("child_sha"),
                           F.explode("parents.sha").alias("parent_sha"))
    parent = commits.select(owner_repo_between().alias("repo_name"), F.col("sha").alias("parent_sha"))
    return (child.join(parent, "parent_sha")
            .where(F.col("repo_name") != F.col("child_repo_name"))
            .select("repo_name", "child_repo_name", "parent_sha", "child_sha"))
