"""Bindings of the commit questions to the testbed view, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from commitlens.operators import commits as Q
from commitlens.operators import graph, lineage, stats
from commitlens.operators.ordered import global_row_number
from commitlens.plans.registry import ext_sql, md5_long_sql, register, ts_sql
from commitlens.plans.testbed import ORACLE_CTE, VIEW_TABLES, landed_commits
from commitlens.sources import commits as commit_source
from commitlens.sources.text import read_lines

# Parameters of the bindings (fixed values of this test bed).
NAMES = ["GitHub", "Customer#000000001", "Customer#000000007", "Customer#000000042", "nobody"]
REPO = "repo3"
YEAR = 1998
SNAPSHOT = "2002-01-01 00:00:00"

W = "WITH " + ORACLE_CTE
NAMES_SQL = ", ".join(f"'{n}'" for n in NAMES)


@register("commit_shas", W + "SELECT sha FROM cm")
def commit_shas(spark, sf):
    return Q.shas(landed_commits(spark, sf))


@register("commit_big_additions", W + "SELECT sha FROM cm WHERE additions >= 20")
def commit_big_additions(spark, sf):
    return Q.big_additions(landed_commits(spark, sf))


@register("commit_big_deletion_files", W + "SELECT coalesce(filename, '') AS filename FROM fl WHERE deletions > 30")
def commit_big_deletion_files(spark, sf):
    return Q.big_deletion_files(landed_commits(spark, sf))


@register("commit_age", W + f"SELECT sha, date_diff('second', author_ts, TIMESTAMP '{SNAPSHOT}') AS age FROM cm")
def commit_age(spark, sf):
    return Q.with_age(landed_commits(spark, sf), SNAPSHOT).select("sha", "age")


@register("commit_time_diff", W + "SELECT sha, date_diff('second', author_ts, committer_ts) AS commit_time_diff FROM cm")
def commit_time_diff(spark, sf):
    return Q.with_commit_time_diff(landed_commits(spark, sf)).select("sha", "commit_time_diff")


@register("commit_by_committers", W + f"""
SELECT row_number() OVER (ORDER BY author_ts, sha) AS position, committer_name AS committer, sha,
       {ts_sql('author_ts')} AS timestamp FROM cm WHERE committer_name IN ({NAMES_SQL})""")
def commit_by_committers(spark, sf):
    """The order of the answer (O1) is part of the check: each row carries its position."""
    found = Q.by_committers(landed_commits(spark, sf), NAMES)
    return global_row_number(found, ["timestamp", "sha"], "position")


@register("commit_count", W + "SELECT count(*) AS n_commits FROM cm")
def commit_count(spark, sf):
    return Q.commit_count(landed_commits(spark, sf))


@register("commit_ext_freq", W + f"""
SELECT CASE WHEN filename IS NULL OR strpos(filename, '.') = 0 THEN 'unknown' ELSE {ext_sql()} END AS ext,
       count(*) AS n
FROM fl GROUP BY 1""")
def commit_ext_freq(spark, sf):
    return Q.extension_counts(landed_commits(spark, sf))


@register("commit_committer_stats", W + f"""
SELECT committer_name AS committer, CAST(sum(coalesce(total, 0)) AS BIGINT) AS total,
       CAST(sum(coalesce(additions, 0)) AS BIGINT) AS additions, CAST(sum(coalesce(deletions, 0)) AS BIGINT) AS deletions
FROM cm WHERE committer_name IN ({NAMES_SQL}) GROUP BY 1""")
def commit_committer_stats(spark, sf):
    return Q.committer_stats(landed_commits(spark, sf), NAMES)


@register("commit_repo_committers", W + """
SELECT repo, count(*) AS n_commits, array_to_string(list_sort(list_distinct(list(committer_name))), ',') AS committers
FROM cm GROUP BY repo""")
def commit_repo_committers(spark, sf):
    return Q.repo_committers(landed_commits(spark, sf))


@register("commit_repo_committer_rows", W + """
, p AS (SELECT repo, committer_name AS committer, count(*) AS n FROM cm GROUP BY ALL)
SELECT repo, CAST(sum(n) OVER (PARTITION BY repo) AS BIGINT) AS n_commits, committer, n FROM p""")
def commit_repo_committer_rows(spark, sf):
    return Q.repo_committer_rows(landed_commits(spark, sf))


@register("commit_repo_largest_files", W + f"""
SELECT repo, filename, file_sha, status, additions, deletions, changes, commit_sha, date FROM (
  SELECT cm.repo, fl.filename, fl.file_sha, fl.status, fl.additions, fl.deletions, fl.changes, cm.sha AS commit_sha,
         {ts_sql('cm.committer_ts')} AS date,
         row_number() OVER (PARTITION BY cm.repo, fl.filename ORDER BY fl.changes DESC, cm.committer_ts DESC, cm.sha DESC,
                            fl.file_sha DESC, fl.status DESC, fl.additions DESC, fl.deletions DESC) AS rn
  FROM fl JOIN cm ON fl.k = cm.k WHERE fl.filename IS NOT NULL) WHERE rn = 1""")
def commit_repo_largest_files(spark, sf):
    """A5 as coded (D-4): the file row with most changes instead of the newest."""
    return Q.repo_latest_files(landed_commits(spark, sf), order="changes")


@register("commit_repo_latest_files", W + f"""
SELECT repo, filename, file_sha, status, additions, deletions, changes, commit_sha, date FROM (
  SELECT cm.repo, fl.filename, fl.file_sha, fl.status, fl.additions, fl.deletions, fl.changes, cm.sha AS commit_sha,
         {ts_sql('cm.committer_ts')} AS date,
         row_number() OVER (PARTITION BY cm.repo, fl.filename ORDER BY cm.committer_ts DESC, cm.sha DESC,
                            fl.file_sha DESC, fl.changes DESC, fl.status DESC, fl.additions DESC, fl.deletions DESC) AS rn
  FROM fl JOIN cm ON fl.k = cm.k WHERE fl.filename IS NOT NULL) WHERE rn = 1""")
def commit_repo_latest_files(spark, sf):
    return Q.repo_latest_files(landed_commits(spark, sf))


@register("commit_repo_file_shas", W + f"""
SELECT coalesce(fl.filename, '') AS filename, cm.sha FROM fl JOIN cm ON fl.k = cm.k WHERE cm.repo = '{REPO}'""")
def commit_repo_file_shas(spark, sf):
    return Q.repo_file_sha_rows(landed_commits(spark, sf), REPO)


@register("commit_repo_file_blobs", W + f"""
SELECT coalesce(fl.filename, '') AS filename, fl.file_sha AS sha FROM fl JOIN cm ON fl.k = cm.k
WHERE cm.repo = '{REPO}'""")
def commit_repo_file_blobs(spark, sf):
    """A6 with the files' own shas (D-5)."""
    return Q.repo_file_sha_rows(landed_commits(spark, sf), REPO, sha="file")


@register("commit_repo_file_sha_lists", W + f"""
SELECT coalesce(fl.filename, '') AS filename, string_agg(cm.sha, ',' ORDER BY cm.sha) AS shas,
       CAST(sum(fl.changes) AS BIGINT) AS total, CAST(sum(fl.additions) AS BIGINT) AS additions,
       CAST(sum(fl.deletions) AS BIGINT) AS deletions
FROM fl JOIN cm ON fl.k = cm.k WHERE cm.repo = '{REPO}' GROUP BY 1""")
def commit_repo_file_sha_lists(spark, sf):
    """A6 in the question's shape."""
    return Q.repo_file_shas(landed_commits(spark, sf), REPO)


@register("commit_repo_file_stats", W + f"""
SELECT coalesce(fl.filename, '') AS filename, count(*) AS n_shas, CAST(sum(fl.changes) AS BIGINT) AS total,
       CAST(sum(fl.additions) AS BIGINT) AS additions, CAST(sum(fl.deletions) AS BIGINT) AS deletions
FROM fl JOIN cm ON fl.k = cm.k WHERE cm.repo = '{REPO}' GROUP BY 1""")
def commit_repo_file_stats(spark, sf):
    return Q.repo_file_stats(landed_commits(spark, sf), REPO)


@register("commit_committer_repo_stats", W + """
SELECT committer_name AS committer, repo, CAST(sum(total) AS BIGINT) AS total, CAST(sum(additions) AS BIGINT) AS additions,
       CAST(sum(deletions) AS BIGINT) AS deletions
FROM cm GROUP BY 1, 2""")
def commit_committer_repo_stats(spark, sf):
    return Q.committer_repo_stats(landed_commits(spark, sf))


@register("commit_revert_streaks", W + """
, r AS (SELECT author_name AS author, len(list_filter(string_split(message, ' '), lambda t: contains(t, 'Revert'))) AS streak
        FROM cm WHERE starts_with(message, 'Revert')),
p AS (SELECT author, streak, count(*) AS n FROM r GROUP BY ALL)
SELECT author, max(streak) AS streak, arg_max(n, streak) AS n FROM p GROUP BY author""")
def commit_revert_streaks(spark, sf):
    return Q.revert_streaks(landed_commits(spark, sf))


@register("commit_repo_week", W + """
SELECT repo AS repository, weekofyear(committer_ts) AS week, year(committer_ts) AS year, count(*) AS count
FROM cm GROUP BY ALL""")
def commit_repo_week(spark, sf):
    return Q.repo_week_counts(landed_commits(spark, sf))


@register("commit_day_of_week", W + "SELECT dayofweek(committer_ts) + 1 AS day, count(*) AS commits_per_day FROM cm GROUP BY 1")
def commit_day_of_week(spark, sf):
    return Q.day_of_week_counts(landed_commits(spark, sf))


@register("commit_avg_additions", W + "SELECT CAST(sum(additions) // count(additions) AS BIGINT) AS avg_additions FROM cm")
def commit_avg_additions(spark, sf):
    return Q.avg_additions(landed_commits(spark, sf))


@register("commit_js_hour", W + """
SELECT hour, n_files FROM (
  SELECT hour(cm.committer_ts) AS hour, count(fl.k) AS n_files
  FROM cm LEFT JOIN fl ON fl.k = cm.k AND fl.filename LIKE '%.js' GROUP BY 1)
ORDER BY n_files DESC, hour LIMIT 1""")
def commit_js_hour(spark, sf):
    return Q.js_hour(landed_commits(spark, sf))


@register("commit_top_author", W + f"""
SELECT author_name AS author, count(*) AS n_commits FROM cm WHERE repo = '{REPO}'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def commit_top_author(spark, sf):
    return Q.top_author(landed_commits(spark, sf), REPO)


@register("commit_repo_year", W + f"""
SELECT owner_repo AS repo, count(*) AS n_commits FROM cm
WHERE committer_ts >= TIMESTAMP '{YEAR}-01-01' AND committer_ts < TIMESTAMP '{YEAR + 1}-01-01' GROUP BY 1""")
def commit_repo_year(spark, sf):
    return Q.repo_year_counts(landed_commits(spark, sf), YEAR)


@register("commit_top_formats", W + f"""
SELECT ext, n FROM (SELECT {ext_sql()} AS ext, count(*) AS n FROM fl WHERE filename IS NOT NULL GROUP BY 1)
ORDER BY n DESC, ext LIMIT 5""")
def commit_top_formats(spark, sf):
    return Q.top_file_formats(landed_commits(spark, sf))


@register("commit_part_of_day", W + """
SELECT part, n_commits FROM (
  SELECT CASE WHEN hour(committer_ts) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(committer_ts) BETWEEN 12 AND 16 THEN 'afternoon'
              WHEN hour(committer_ts) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS part, count(*) AS n_commits
  FROM cm GROUP BY 1)
ORDER BY n_commits DESC, part LIMIT 1""")
def commit_part_of_day(spark, sf):
    return Q.most_productive_part(landed_commits(spark, sf))


@register("commit_size_labels", W + """
SELECT CASE WHEN total > 20 THEN 'large' ELSE 'small' END AS label, count(*) AS n FROM cm WHERE has_stats GROUP BY 1""")
def commit_size_labels(spark, sf):
    return Q.size_label_counts(landed_commits(spark, sf))


_W1_SQL = f"""
, w1 AS (
  SELECT 'oid' || CAST(k AS VARCHAR) AS oid, committer_name AS name, committer_ts, sha,
         coalesce(date_diff('day', CAST(lag(committer_ts) OVER w AS DATE), CAST(committer_ts AS DATE)), 0) AS time_diff
  FROM cm WINDOW w AS (PARTITION BY committer_name ORDER BY committer_ts, sha))
"""


@register("commit_days_since_prev", W + _W1_SQL + f"""
SELECT oid, name, {ts_sql('committer_ts')} AS date, sha, time_diff FROM w1""")
def commit_days_since_prev(spark, sf):
    return Q.days_since_previous(landed_commits(spark, sf))


@register("commit_describe", W + _W1_SQL + """
SELECT count(time_diff) AS count, round(avg(time_diff), 6) AS mean, round(stddev_samp(time_diff), 6) AS stddev,
       min(time_diff) AS min, max(time_diff) AS max FROM w1""")
def commit_describe(spark, sf):
    return stats.summary(Q.days_since_previous(landed_commits(spark, sf)), "time_diff")


@register("commit_author_rank", W + """
SELECT row_number() OVER (ORDER BY n_commits DESC, lower(author), author) - 1 AS rank, author, n_commits
FROM (SELECT author_name AS author, count(*) AS n_commits FROM cm GROUP BY 1)""")
def commit_author_rank(spark, sf):
    return Q.author_rank(landed_commits(spark, sf))


@register("commit_owner_xor_author", W + """
SELECT name FROM ((SELECT owner AS name FROM cm UNION SELECT author_name FROM cm)
                  EXCEPT (SELECT owner FROM cm INTERSECT SELECT author_name FROM cm))""")
def commit_owner_xor_author(spark, sf):
    return Q.owner_xor_author(landed_commits(spark, sf))


@register("commit_owner_and_author", W + "SELECT owner AS name FROM cm INTERSECT SELECT author_name FROM cm")
def commit_owner_and_author(spark, sf):
    return Q.owner_and_author(landed_commits(spark, sf))


@register("commit_author_not_owner", W + "SELECT author_name AS name FROM cm EXCEPT SELECT owner FROM cm")
def commit_author_not_owner(spark, sf):
    return Q.author_not_owner(landed_commits(spark, sf))


@register("commit_json_check", W + """
SELECT count(*) FILTER (k % 50 <> 0) AS valid, count(*) FILTER (k % 50 = 0) AS invalid FROM cm""")
def commit_json_check(spark, sf):
    """S10 over the commits as JSON lines, of which every 50th (by order) was cut in the middle."""
    lines = _json_lines(spark, sf, cut=True)
    return commit_source.check_commits(spark, lines)


@register("commit_parsed_lines", W + f"SELECT sha, url, {ts_sql('committer_ts')} AS date FROM cm")
def commit_parsed_lines(spark, sf):
    """JSON text lines read from files and parsed into commits."""
    lines = read_lines(spark, _json_lines(spark, sf, cut=False))
    parsed = commit_source.parse_commits(lines)
    return parsed.select("sha", "url", F.col("commit.committer.date").alias("date"))


def _dump(spark, sf, drift):
    """The commits as one JSON array in one file, written once per application and view; with ``drift``, another field and
    another type in some records."""
    from commitlens.schemas import COMMIT
    from commitlens.session import landed_view
    from commitlens.sources.dump import write_dump
    rows = landed_commits(spark, sf).select(*COMMIT.names)
    if drift:
        odd = F.substring("sha", 2, 18).cast("long") % 97 == 0
        rows = rows.withColumn("branch", F.when(odd, "main")).withColumn("node_id", F.length("node_id"))
    return landed_view(spark, f"commit-dump-{drift}", sf, VIEW_TABLES, lambda path: write_dump(rows, path))


@register("commit_dump_shas", W + f"SELECT sha, url, total, {ts_sql('committer_ts')} AS date FROM cm")
def commit_dump_shas(spark, sf):
    """A dump as one JSON array in one file, read by several tasks."""
    from commitlens.sources.dump import read_dump
    return read_dump(spark, _dump(spark, sf, False)).select(
        "sha", "url", F.col("stats.total").alias("total"), F.col("commit.committer.date").alias("date"))


@register("commit_dump_drift", """
SELECT * FROM (VALUES ('branch', NULL, 'string', 'new'), ('node_id', 'string', 'bigint', 'type'),
  ('commit.verification.signature', 'string', NULL, 'missing'), ('commit.verification.payload', 'string', NULL, 'missing'),
  ('files[].patch', 'string', NULL, 'missing')) AS t(field, expected, found, drift)""")
def commit_dump_drift(spark, sf):
    """Where the schema of all records differs from the declared one."""
    from commitlens.sources.dump import read_dump_records, schema_drift
    return schema_drift(spark, read_dump_records(spark, _dump(spark, sf, True))).where("drift <> 'same'")


def _json_lines(spark, sf, cut):
    """Path of the landed commits written as JSON text lines."""
    from commitlens.session import scratch_path
    c = landed_commits(spark, sf)
    line = F.to_json(F.struct(*c.columns))
    if cut:
        order = F.substring("sha", 2, 20).cast("long")
        line = F.when(order % 50 == 0, F.left(line, F.lit(40))).otherwise(line)
    path = scratch_path(spark, "commit-lines")
    # A scan task gives a file, so none needs to be split.
    c.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path


@register("commit_branch_points", W + """
SELECT parent AS sha, count(*) AS times_parent FROM pa WHERE parent IN (SELECT sha FROM cm)
GROUP BY parent HAVING count(*) > 1""")
def commit_branch_points(spark, sf):
    return lineage.branch_points(landed_commits(spark, sf))


@register("commit_forks", W + """
SELECT p.owner_repo AS repo_name, c.owner_repo AS child_repo_name, pa.parent AS parent_sha, c.sha AS child_sha
FROM pa JOIN cm c ON pa.k = c.k JOIN cm p ON p.sha = pa.parent WHERE p.owner_repo <> c.owner_repo""")
def commit_forks(spark, sf):
    return lineage.forks(landed_commits(spark, sf))


@register("graph_vertices", W + f"""
SELECT {md5_long_sql('name')} AS id, name, kind FROM (
  SELECT DISTINCT committer_name AS name, 'developer' AS kind FROM cm
  UNION SELECT DISTINCT owner_repo AS name, 'repository' AS kind FROM cm)""")
def graph_vertices(spark, sf):
    return graph.graph_vertices(landed_commits(spark, sf))


@register("graph_edges", W + f"""
SELECT {md5_long_sql('committer_name')} AS src, {md5_long_sql('owner_repo')} AS dst, committer_name AS src_name,
       owner_repo AS dst_name, 'committed_to' AS relationship
FROM (SELECT DISTINCT committer_name, owner_repo FROM cm)""")
def graph_edges(spark, sf):
    return graph.graph_edges(landed_commits(spark, sf))


@register("commit_sample", W + """
SELECT sha, committer_name AS committer FROM cm
WHERE (('0x' || substr(md5('0:' || sha), 1, 8))::BIGINT) % 1048576 < 209715""")
def commit_sample(spark, sf):
    """A 20 % sample of commits (seed 0), the same rows on any layout and in any engine."""
    c = landed_commits(spark, sf).select("sha", F.col("commit.committer.name").alias("committer"))
    return stats.sample_rows(c, 0.2, seed=0, key="sha", hash="md5")
