"""Deterministic commit view over the supplied TPC-H-style tables.

The reference's commit dump is not available, so commit questions run on this view: one commit per order,
one file per lineitem, the author from the customer. It is plain projection, aggregation and join, so it scales
with the tables: lineitem's own columns are shuffled on ``l_orderkey``, gathered per order and joined to orders on the same
key, so both sides of that join share one hash partitioning. The customer join comes first, while rows are narrow, and is
left to Catalyst/AQE (broadcast only when the measured side is under ``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens.functions.partitions import spread
from commitlens.schemas import COMMIT
from commitlens.session import ensure_utc

# Fixed values of the view: file types by l_partkey % 5, and file status by l_returnflag.
EXTENSIONS = ["java", "scala", "js", "py", "md"]
STATUS_BY_FLAG = {"A": "added", "R": "removed", "N": "modified"}
API = "https://api.github.com/repos/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


FILE_COLUMNS = ["l_partkey", "l_linenumber", "l_quantity", "l_returnflag"]


def _file(order: Column, line: Column) -> Column:
    """The file struct of a lineitem: the order's key and a struct of :data:`FILE_COLUMNS`."""
    pk = line["l_partkey"]
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (pk % 5 + 1).cast("int"))
    filename = (F.when(pk % 23 == 0, F.lit(None).cast("string"))
                .when(pk % 7 == 0, F.lit("README"))
                .otherwise(F.concat(F.lit("src/p"), (pk % 20).cast("string"), F.lit("."), ext)))
    status = F.coalesce(*[F.when(line["l_returnflag"] == k, F.lit(v)) for k, v in STATUS_BY_FLAG.items()],
                        F.lit("modified"))
    adds, dels = line["l_quantity"].cast("long"), (pk % 60).cast("long")
    sha = F.concat(F.lit("f"), order.cast("string"), F.lit("-"), line["l_linenumber"].cast("string"))
    return F.struct(
        sha.alias("sha"), filename.alias("filename"), status.alias("status"), adds.alias("additions"),
        dels.alias("deletions"), (adds + dels).alias("changes"),
        F.concat(F.lit("https://github.com/blob/"), sha).alias("blob_url"),
        F.concat(F.lit("https://github.com/raw/"), sha).alias("raw_url"),
        F.concat(F.lit("https://api.github.com/contents/"), sha).alias("contents_url"),
        F.lit(None).cast("string").alias("patch"))


def commits(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """The nested commit DataFrame (schema :data:`commitlens.schemas.COMMIT`).

    Only the tables' own columns are shuffled and sorted; the texts of the view are made of them afterwards. With
    ``by_date``, rows are sorted by committer date inside each task.
    """
    ensure_utc(spark)
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", *FILE_COLUMNS)).repartition("l_orderkey")
    lines = li.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(*FILE_COLUMNS)).alias("_lines"), F.sum(F.col("l_quantity").cast("long")).alias("_adds"),
        F.sum((F.col("l_partkey") % 60).cast("long")).alias("_dels"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    k = F.col("o_orderkey")
    base = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner").join(
        lines.hint("merge"), orders.o_orderkey == lines.l_orderkey, "left")
    cdate_s = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + (k * 7919) % 86400
    cdate = F.timestamp_seconds(cdate_s)
    if by_date:
        base = base.sortWithinPartitions(cdate)
    files = F.sort_array(F.transform("_lines", lambda line: _file(k, line)))

    sha = F.concat(F.lit("c"), k.cast("string"))
    own = F.concat(F.lit("Customer#"), F.lpad((F.col("c_nationkey") % 5).cast("string"), 9, "0"))
    repo = F.concat(F.lit("repo"), (F.col("o_custkey") % 8).cast("string"))
    url = F.concat(F.lit(API), own, F.lit("/"), repo, F.lit("/commits/"), sha)
    adate = F.timestamp_seconds(cdate_s - (k % 3) * 86400)
    cname = F.when(k % 5 == 0, F.lit("GitHub")).otherwise(F.col("c_name"))
    aname = F.col("c_name")
    message = F.concat(F.repeat(F.lit("Revert "), (k % 4).cast("int")), F.lit("fix"))
    parents = F.array_distinct(F.filter(F.array(
        F.struct(F.concat(F.lit("c"), F.expr("o_orderkey div 2").cast("string")).alias("sha")),
        F.when((k % 10 == 0) & (k > 0), F.struct(F.concat(F.lit("c"), (k - 1).cast("string")).alias("sha"))),
    ), lambda p: p.isNotNull()))
    has_stats = F.col("_lines").isNotNull() & (k % 11 != 0)
    stats = F.when(has_stats, F.struct(
        (F.col("_adds") + F.col("_dels")).alias("total"), F.col("_adds").alias("additions"),
        F.col("_dels").alias("deletions")))
    login = F.lower(F.regexp_replace(aname, "#", ""))
    account = F.struct(F.col("o_custkey").alias("id"), login.alias("login"),
                       F.concat(F.lit("https://avatars/"), login).alias("avatar_url"),
                       F.lit("User").alias("type"), F.lit(False).alias("site_admin"))
    person = lambda name, date: F.struct(name.alias("name"),
                                         F.concat(F.lower(F.regexp_replace(name, "#", "")),
                                                  F.lit("@example.com")).alias("email"),
                                         date.alias("date"))
    return base.select(
        F.struct(F.concat(F.lit("oid"), k.cast("string")).alias("$oid")).alias("_id"),
        F.concat(F.lit("n"), k.cast("string")).alias("node_id"),
        sha.alias("sha"),
        url.alias("url"),
        F.struct(
            person(aname, adate).alias("author"),
            person(cname, cdate).alias("committer"),
            message.alias("message"),
            F.struct(F.concat(F.lit("t"), k.cast("string")).alias("sha")).alias("tree"),
            F.lit(0).cast("long").alias("comment_count"),
            F.struct(F.lit(False).alias("verified"), F.lit("unsigned").alias("reason"),
                     F.lit(None).cast("string").alias("signature"),
                     F.lit(None).cast("string").alias("payload")).alias("verification"),
        ).alias("commit"),
        account.alias("author"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(account).alias("committer"),
        parents.alias("parents"),
        stats.alias("stats"),
        F.coalesce(files, F.array().cast(COMMIT["files"].dataType)).alias("files"),
    )


def geo_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CommitGeo events: the commit time shifted by ``(o_orderkey % 121) - 60`` minutes, continent = region."""
    ensure_utc(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("o_orderkey")
    cdate_s = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + (k * 7919) % 86400
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.concat(F.lit("c"), k.cast("string")).alias("sha"),
                    F.timestamp_seconds(cdate_s + ((k % 121) - 60) * 60).alias("createdAt"),
                    F.col("r_name").alias("continent")))


# DuckDB formulation of the same view, flat (commits cm, files fl, parents pa, geo ge), used as the oracle's
# CTE prefix. It is written independently of the Spark code above, from the same definition.
ORACLE_CTE = r"""
cm0 AS (
  SELECT o.o_orderkey AS k,
         'c' || CAST(o.o_orderkey AS VARCHAR) AS sha,
         'Customer#' || lpad(CAST(cu.c_nationkey % 5 AS VARCHAR), 9, '0') AS owner,
         'repo' || CAST(o.o_custkey % 8 AS VARCHAR) AS repo,
         cu.c_name AS author_name,
         CASE WHEN o.o_orderkey % 5 = 0 THEN 'GitHub' ELSE cu.c_name END AS committer_name,
         CAST(o.o_orderdate AS TIMESTAMP) + to_seconds(CAST((o.o_orderkey * 7919) % 86400 AS BIGINT)) AS committer_ts,
         repeat('Revert ', CAST(o.o_orderkey % 4 AS INTEGER)) || 'fix' AS message,
         cu.c_nationkey AS nationkey
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey),
fl AS (
  SELECT l_orderkey AS k, 'c' || CAST(l_orderkey AS VARCHAR) AS sha,
         'f' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS file_sha,
         CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'README'
              ELSE 'src/p' || CAST(l_partkey % 20 AS VARCHAR) || '.' ||
                   (CASE l_partkey % 5 WHEN 0 THEN 'java' WHEN 1 THEN 'scala' WHEN 2 THEN 'js' WHEN 3 THEN 'py' ELSE 'md' END)
         END AS filename,
         CASE l_returnflag WHEN 'A' THEN 'added' WHEN 'R' THEN 'removed' ELSE 'modified' END AS status,
         CAST(trunc(l_quantity) AS BIGINT) AS additions,
         CAST(l_partkey % 60 AS BIGINT) AS deletions,
         CAST(trunc(l_quantity) AS BIGINT) + CAST(l_partkey % 60 AS BIGINT) AS changes
  FROM lineitem),
st AS (SELECT k, CAST(sum(additions) AS BIGINT) AS additions, CAST(sum(deletions) AS BIGINT) AS deletions,
              CAST(sum(changes) AS BIGINT) AS total FROM fl GROUP BY k),
cm AS (
  SELECT cm0.*, cm0.committer_ts - to_days(CAST(cm0.k % 3 AS INTEGER)) AS author_ts,
         'https://api.github.com/repos/' || cm0.owner || '/' || cm0.repo || '/commits/' || cm0.sha AS url,
         cm0.owner || '/' || cm0.repo AS owner_repo,
         (st.k IS NOT NULL AND cm0.k % 11 <> 0) AS has_stats,
         CASE WHEN st.k IS NOT NULL AND cm0.k % 11 <> 0 THEN st.additions END AS additions,
         CASE WHEN st.k IS NOT NULL AND cm0.k % 11 <> 0 THEN st.deletions END AS deletions,
         CASE WHEN st.k IS NOT NULL AND cm0.k % 11 <> 0 THEN st.total END AS total
  FROM cm0 LEFT JOIN st ON cm0.k = st.k),
pa AS (
  SELECT DISTINCT k, sha, parent FROM (
    SELECT k, sha, 'c' || CAST(k // 2 AS VARCHAR) AS parent FROM cm0
    UNION ALL
    SELECT k, sha, 'c' || CAST(k - 1 AS VARCHAR) AS parent FROM cm0 WHERE k % 10 = 0 AND k > 0)),
ge AS (
  SELECT cm0.sha, cm0.committer_ts + to_minutes(CAST((cm0.k % 121) - 60 AS BIGINT)) AS geo_ts, r.r_name AS continent
  FROM cm0 JOIN nation n ON cm0.nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


VIEW_TABLES = ["lineitem", "orders", "customer"]


def landed_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit view written once per application as Parquet in the shared checkpoint folder, then read back.

    Like the reference's commit dump, questions then read a stored nested table: Parquet prunes nested columns
    (``explode(arrays_zip(files.a, files.b))`` reads only ``a`` and ``b``) and the write cuts the view's lineage.
    ``owner_key`` and ``repo_key`` are stored beside the record, so a question about one repository filters the scan.
    Files are sorted by committer date inside each task so row-group statistics serve date-range filters.
    """
    from commitlens.operators.commits import with_repo_keys
    from commitlens.schemas import REPO_KEYS
    from commitlens.session import landed_view
    ensure_utc(spark)
    path = landed_view(spark, "testbed-commits", sf_dir, VIEW_TABLES, lambda p: with_repo_keys(
        commits(spark, sf_dir, by_date=True)).write.option("compression", "zstd").parquet(p))
    return spark.read.schema(T.StructType([*COMMIT.fields, *REPO_KEYS])).parquet(path)


def landed_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commitlens.schemas import GEO
    from commitlens.session import landed_view
    path = landed_view(spark, "testbed-geo", sf_dir, ["orders", "customer", "nation", "region"],
                       lambda p: geo_events(spark, sf_dir).write.parquet(p))
    return spark.read.schema(GEO).parquet(path)
