"""Commit questions (P1-P14, A1-A16, W1, W2, W4, O1-O3, U1) as DataFrame -> DataFrame functions.

Every function takes the nested commit DataFrame (schema ``commitlens.schemas.COMMIT``), batch or stream where
Spark allows, and returns a DataFrame. Aggregations are partial + final hash aggregates (map-side combine), so
a hot committer or repository is reduced before the shuffle. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.functions.fields import (author_date, author_name, committer_date, committer_name, count_if,
                                         day_label, explode_files, extension, owner, owner_repo, repo_name)
from commitlens.functions.labels import label_counts, size_label
from commitlens.operators.ordered import global_row_number, shift_within

def _names_filter(df: DataFrame, column: Column, names: Sequence[str] | DataFrame) -> DataFrame:
    """Keep rows whose ``column`` is in ``names``: an IN list of the caller's literals, or a semi-join with the first
    column of a DataFrame (for long lists)."""
    if isinstance(names, DataFrame):
        nm = names.select(F.col(names.columns[0]).alias("_name")).distinct()
        # Broadcast is left to AQE's size check (autoBroadcastJoinThreshold); no unconditional hint.
        return df.join(nm, column == F.col("_name"), "left_semi")
    return df.where(column.isin(list(names)))


def repo_match(commits: DataFrame, repository: str, match: str = "equal") -> Column:
    """P9 / D-9: choose a repository. ``equal``: repo name or owner/repo equals; ``contains``: url substring.

    A table that was landed with ``owner_key`` and ``repo_key`` columns (see ``with_repo_keys``) is filtered on them,
    so the predicate reaches the scan; otherwise the parts are taken from the url.
    """
    if match == "contains":
        return F.col("url").contains(repository)
    keyed = {"owner_key", "repo_key"} <= set(commits.columns)
    own, repo = (F.col("owner_key"), F.col("repo_key")) if keyed else (owner(), repo_name())
    if "/" in repository:
        first, _, second = repository.partition("/")
        return (own == first) & (repo == second)
    return repo == repository


def with_repo_keys(commits: DataFrame) -> DataFrame:
    """Adds ``owner_key`` and ``repo_key``, plain columns that a stored table can be filtered on."""
    return commits.withColumn("owner_key", owner()).withColumn("repo_key", repo_name())


# ---------------------------------------------------------------- projections and filters

def shas(commits: DataFrame) -> DataFrame:
    """The sha of every commit."""
    return commits.select("sha")


def big_additions(commits: DataFrame, min_additions: int = 20) -> DataFrame:
    """Shas of commits with at least ``min_additions`` additions (missing stats: dropped, D-20)."""
    return commits.where(F.col("stats.additions") >= min_additions).select("sha")


def big_deletion_files(commits: DataFrame, min_deletions: int = 30) -> DataFrame:
    """Names of files with more than ``min_deletions`` deletions; a missing name is ''."""
    files = explode_files(commits, ["filename", "deletions"])
    return files.where(F.col("deletions") > min_deletions).select(F.coalesce("filename", F.lit("")).alias("filename"))


def with_age(commits: DataFrame, snapshot: str) -> DataFrame:
    """Append ``age`` = seconds from the author date to the ``snapshot`` instant (UTC text)."""
    return commits.withColumn("age", F.unix_timestamp(F.to_timestamp(F.lit(snapshot))) - F.unix_timestamp(author_date()))


def with_commit_time_diff(commits: DataFrame) -> DataFrame:
    """P5: append ``commit_time_diff`` = committer time minus author time, in seconds."""
    return commits.withColumn("commit_time_diff", F.unix_timestamp(committer_date()) - F.unix_timestamp(author_date()))


def by_committers(commits: DataFrame, names: Sequence[str] | DataFrame) -> DataFrame:
    """Commits of the given committers -> committer, sha, timestamp (author date), ordered by time."""
    df = commits.select(committer_name().alias("committer"), "sha", author_date().alias("timestamp"))
    return _names_filter(df, F.col("committer"), names).orderBy("timestamp", "sha")


# ---------------------------------------------------------------- aggregations

def commit_count(commits: DataFrame) -> DataFrame:
    """A1: number of commits."""
    return commits.agg(F.count(F.lit(1)).alias("n_commits"))


def extension_counts(commits: DataFrame, no_dot: str = "unknown") -> DataFrame:
    """A2: file-extension frequency; no dot or no file name -> ``unknown`` (D-3)."""
    files = explode_files(commits, ["filename"])
    return files.groupBy(extension("filename", no_dot).alias("ext")).agg(F.count(F.lit(1)).alias("n"))


def committer_stats(commits: DataFrame, names: Sequence[str] | DataFrame) -> DataFrame:
    """A3: summed stats of the given committers; missing stats count as 0; unknown names are absent."""
    df = commits.select(committer_name().alias("committer"), "stats")
    df = _names_filter(df, F.col("committer"), names)
    z = F.lit(0).cast("long")
    return df.groupBy("committer").agg(
        F.sum(F.coalesce("stats.total", z)).alias("total"),
        F.sum(F.coalesce("stats.additions", z)).alias("additions"),
        F.sum(F.coalesce("stats.deletions", z)).alias("deletions"))


def repo_committer_rows(commits: DataFrame) -> DataFrame:
    """A4, long form: one row per (repository name, committer) with the committer's and the repository's number of
    commits. No list: a repository with any number of committers is as many rows."""
    pairs = commits.groupBy(repo_name().alias("repo"), committer_name().alias("committer")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = pairs.groupBy(F.col("repo").alias("_repo")).agg(F.sum("n").alias("n_commits"))
    return pairs.join(totals, F.col("repo").eqNullSafe(F.col("_repo"))).select("repo", "n_commits", "committer", "n")


def repo_committers(commits: DataFrame) -> DataFrame:
    """A4 in the question's shape (bound: the committers of one repository): per repository name: number of commits and the sorted distinct committer names.

    Two-level aggregate: (repo, committer) counts first, so a hot repository is spread over the first shuffle
    and the second level only sees its distinct committers (the output itself).
    """
    pairs = commits.groupBy(repo_name().alias("repo"), committer_name().alias("committer")).agg(
        F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("repo").agg(
        F.sum("n").alias("n_commits"),
        F.sort_array(F.collect_list("committer")).alias("committers"))


def repo_latest_files(commits: DataFrame, order: str = "newest") -> DataFrame:
    """A5 / D-4: per (repository name, file name) one file row.

    ``newest``: the file of the latest commit (committer date, then shas); ``changes``: the one with most changes.
    Files without a name are discarded. ``max_by`` is a mergeable aggregate, so hot files are reduced map-side.
    """
    files = explode_files(commits, ["sha", "filename", "status", "additions", "deletions", "changes"],
                          keep=[repo_name().alias("repo"), F.col("sha").alias("commit_sha"),
                                committer_date().alias("date")], prefix="f_")
    files = files.where(F.col("f_filename").isNotNull())
    rec = F.struct(F.col("f_sha").alias("file_sha"), F.col("f_status").alias("status"),
                   F.col("f_additions").alias("additions"), F.col("f_deletions").alias("deletions"),
                   F.col("f_changes").alias("changes"), F.col("commit_sha"), F.col("date"))
    if order == "newest":
        key = F.struct("date", "commit_sha", "f_sha", "f_changes", "f_status", "f_additions", "f_deletions")
    elif order == "changes":
        key = F.struct("f_changes", "date", "commit_sha", "f_sha", "f_status", "f_additions", "f_deletions")
    else:
        raise ValueError("order must be 'newest' or 'changes'")
    return (files.groupBy("repo", F.col("f_filename").alias("filename"))
            .agg(F.max_by(rec, key).alias("file")).select("repo", "filename", "file.*"))


def _repo_files(commits: DataFrame, repository: str, match: str, fields: list[str]) -> DataFrame:
    """``commit_sha`` and the named file fields (``f_`` prefixed) of one repository; a missing name is ''."""
    picked = commits.where(repo_match(commits, repository, match))
    files = explode_files(picked, ["filename", *fields], keep=[F.col("sha").alias("commit_sha")], prefix="f_")
    return files.withColumn("f_filename", F.coalesce("f_filename", F.lit("")))


def _sha_of(sha: str) -> tuple[list[str], Column]:
    return ([], F.col("commit_sha")) if sha == "commit" else (["sha"], F.coalesce("f_sha", F.lit("")))


_FILE_STATS = ["changes", "additions", "deletions"]


def _file_sums() -> list[Column]:
    return [F.sum("f_changes").alias("total"), F.sum("f_additions").alias("additions"),
            F.sum("f_deletions").alias("deletions")]


def repo_file_sha_rows(commits: DataFrame, repository: str, match: str = "equal", sha: str = "commit") -> DataFrame:
    """A6 / D-5, long form: one (file name, sha) row per change of a file in one repository (duplicates kept).

    ``sha="commit"`` gives commit shas (as the question asks); ``sha="file"`` the file blob shas. A missing name
    is ''. Nothing is collected, so a file changed by a third of all commits is still spread over tasks.
    """
    fields, value = _sha_of(sha)
    return _repo_files(commits, repository, match, fields).select(F.col("f_filename").alias("filename"), value.alias("sha"))


def repo_file_stats(commits: DataFrame, repository: str, match: str = "equal") -> DataFrame:
    """A6 / D-5: per file of one repository: number of changes (shas) and summed file stats."""
    rows = _repo_files(commits, repository, match, _FILE_STATS)
    return rows.groupBy(F.col("f_filename").alias("filename")).agg(F.count(F.lit(1)).alias("n_shas"), *_file_sums())


def repo_file_shas(commits: DataFrame, repository: str, match: str = "equal", sha: str = "commit") -> DataFrame:
    """A6 / D-5 in the question's shape: per file, the sorted list of shas and the summed stats.

    The list per file is bounded by that file's history, not by the table; for files with unbounded histories
    use :func:`repo_file_sha_rows` + :func:`repo_file_stats`, which hold no list.
    """
    fields, value = _sha_of(sha)
    rows = _repo_files(commits, repository, match, [*fields, *_FILE_STATS])
    return rows.groupBy(F.col("f_filename").alias("filename")).agg(
        F.sort_array(F.collect_list(value)).alias("shas"), *_file_sums())


def committer_repo_stats(commits: DataFrame) -> DataFrame:
    """A7 / D-6: per (committer, repository name) summed stats; NULL only when every commit lacks stats."""
    return commits.groupBy(committer_name().alias("committer"), repo_name().alias("repo")).agg(
        F.sum("stats.total").alias("total"), F.sum("stats.additions").alias("additions"),
        F.sum("stats.deletions").alias("deletions"))


def revert_streak(message: str | Column = "commit.message") -> Column:
    """Number of space-separated tokens containing ``Revert`` (counted only for messages starting with it)."""
    m = F.col(message) if isinstance(message, str) else message
    return count_if(F.split(m, " "), lambda t: t.contains("Revert"))


def revert_streaks(commits: DataFrame) -> DataFrame:
    """Per author: the longest revert streak and how often it occurs."""
    rv = commits.where(F.col("commit.message").startswith("Revert")).select(
        author_name().alias("author"), revert_streak().alias("streak"))
    per = rv.groupBy("author", "streak").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("author").agg(F.max("streak").alias("streak"), F.max_by("n", "streak").alias("n"))


def repo_week_counts(commits: DataFrame, iso_year: bool = False) -> DataFrame:
    """A9 / D-7: commits per repository name, ISO week and (calendar, or ISO with ``iso_year``) year."""
    d = committer_date()
    year = F.year(F.date_add(F.to_date(d), 3 - ((F.dayofweek(d) + 5) % 7))) if iso_year else F.year(d)
    return commits.groupBy(repo_name().alias("repository"), F.weekofyear(d).alias("week"),
                           year.alias("year")).agg(F.count(F.lit(1)).alias("count"))


def day_of_week_counts(commits: DataFrame) -> DataFrame:
    """A10 / D-8: commits per day of week (Sunday = 1) as ``day``, ``commits_per_day``."""
    return commits.groupBy(F.dayofweek(committer_date()).alias("day")).agg(
        F.count(F.lit(1)).alias("commits_per_day"))


def avg_additions(commits: DataFrame) -> DataFrame:
    """Integer mean of additions over commits that have stats (NULL for no such commit)."""
    return commits.agg(F.expr("sum(stats.additions) div nullif(count(stats.additions), 0)").alias("avg_additions"))


def _top1(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def js_hour(commits: DataFrame, suffix: str = ".js") -> DataFrame:
    """UTC hour with the most changed ``.js`` files, and that number (ties: lowest hour)."""
    per = commits.select(F.hour(committer_date()).alias("hour"),
                         count_if("files.filename", lambda name: name.endswith(suffix)).alias("js"))
    by_hour = per.groupBy("hour").agg(F.sum("js").alias("n_files"))
    return _top1(by_hour, [F.desc("n_files"), F.asc("hour")])


def top_author(commits: DataFrame, repository: str, match: str = "equal") -> DataFrame:
    """The author with most commits to one repository (ties: name ascending)."""
    per = commits.where(repo_match(commits, repository, match)).groupBy(author_name().alias("author")).agg(
        F.count(F.lit(1)).alias("n_commits"))
    return _top1(per, [F.desc("n_commits"), F.asc("author")])


def repo_year_counts(commits: DataFrame, year: int) -> DataFrame:
    """Commits per owner/repo within one calendar year (a range predicate, pushable to the scan)."""
    d = committer_date()
    lo, hi = F.to_timestamp(F.lit(f"{year}-01-01 00:00:00")), F.to_timestamp(F.lit(f"{year + 1}-01-01 00:00:00"))
    return commits.where((d >= lo) & (d < hi)).groupBy(owner_repo().alias("repo")).agg(
        F.count(F.lit(1)).alias("n_commits"))


def top_file_formats(commits: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent file types (a name without a dot is its own type; ties: type asc)."""
    counts = extension_counts(commits, no_dot="self").where(F.col("ext").isNotNull())
    return counts.orderBy(F.desc("n"), F.asc("ext")).limit(k)


def most_productive_part(commits: DataFrame) -> DataFrame:
    """A16 / D-10: the part of day with most commits (ties: label ascending)."""
    per = commits.groupBy(day_label(F.hour(committer_date())).alias("part")).agg(F.count(F.lit(1)).alias("n_commits"))
    return _top1(per, [F.desc("n_commits"), F.asc("part")])


def size_label_counts(commits: DataFrame, limit: int = 20) -> DataFrame:
    """Commits with stats labelled small (total <= limit) / large, counted per label."""
    return label_counts(commits.where(F.col("stats").isNotNull()), size_label(F.col("stats.total"), limit))


# ---------------------------------------------------------------- windows and ranks

def days_since_previous(commits: DataFrame, name: str | None = None) -> DataFrame:
    """W1 / D-13: per committer, whole days since their previous commit (first commit: 0), chronological.

    All committers at once; the lag runs inside (name, day), so a committer owning a third of all commits is split
    over many tasks. ``name`` optionally keeps one committer.
    """
    df = commits.select(F.col("_id.$oid").alias("oid"), committer_name().alias("name"),
                        committer_date().alias("date"), "sha")
    if name is not None:
        df = df.where(F.col("name") == name)
    shifted = shift_within(df, ["name"], ["date", "sha"], ["date"], F.to_date("date"), offset=-1)
    return shifted.select("oid", "name", "date", "sha",
                          F.coalesce(F.datediff("date", "date_prev"), F.lit(0)).alias("time_diff"))


def author_rank(commits: DataFrame) -> DataFrame:
    """W2 / O2 / D-14: zero-based rank of authors by commit count (desc), ties by lower-case then raw name."""
    per = commits.groupBy(author_name().alias("author")).agg(F.count(F.lit(1)).alias("n_commits"))
    keyed = per.withColumn("_neg", -F.col("n_commits")).withColumn("_low", F.lower("author"))
    ranked = global_row_number(keyed, ["_neg", "_low", "author"], name="_rn")
    return ranked.select((F.col("_rn") - 1).alias("rank"), "author", "n_commits")


# ---------------------------------------------------------------- set operations

def owner_xor_author(commits: DataFrame) -> DataFrame:
    """Names that are only a repository owner or only a commit author (one aggregate, one shuffle)."""
    tagged = commits.select(F.explode(F.array(
        F.struct(owner().alias("name"), F.lit(True).alias("is_owner"), F.lit(False).alias("is_author")),
        F.struct(author_name().alias("name"), F.lit(False).alias("is_owner"), F.lit(True).alias("is_author")),
    )).alias("t")).select("t.*")
    g = tagged.groupBy("name").agg(F.bool_or("is_owner").alias("o"), F.bool_or("is_author").alias("a"))
    return g.where(F.col("o") != F.col("a")).select("name")


def owner_and_author(commits: DataFrame) -> DataFrame:
    """Names that are both a repository owner and a commit author."""
    return commits.select(owner().alias("name")).intersect(commits.select(author_name().alias("name")))


def author_not_owner(commits: DataFrame) -> DataFrame:
    """U4: commit authors that own no repository."""
    return commits.select(author_name().alias("name")).subtract(commits.select(owner().alias("name")))
