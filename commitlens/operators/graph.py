"""Developer-repository graph (G1) with stable 64-bit vertex ids (G2). Two DataFrames; no graph runtime."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.functions.fields import committer_name, md5_long, owner_repo_between

DEVELOPER = "developer"
REPOSITORY = "repository"


def _pairs(commits: DataFrame) -> DataFrame:
    return commits.select(committer_name().alias("developer"), owner_repo_between().alias("repository")).distinct()


def graph_edges(commits: DataFrame) -> DataFrame:
    """G1 / D-16: one edge per distinct (committer, owner/repo): developer -> repository."""
    p = _pairs(commits)
    return p.select(md5_long("developer").alias("src"), md5_long("repository").alias("dst"),
                    F.col("developer").alias("src_name"), F.col("repository").alias("dst_name"),
                    F.lit("committed_to").alias("relationship"))


def graph_vertices(commits: DataFrame) -> DataFrame:
    """G1: one vertex per distinct committer (``developer``) and per distinct owner/repo (``repository``)."""
    devs = commits.select(committer_name().alias("name"), F.lit(DEVELOPER).alias("kind"))
    repos = commits.select(owner_repo_between().alias("name"), F.lit(REPOSITORY).alias("kind"))
    v = devs.unionByName(repos).distinct()
    return v.select(md5_long("name").alias("id"), "name", "kind")
