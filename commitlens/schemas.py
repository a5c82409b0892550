"""Explicit schemas (never inferred: inference costs a pass and differs between batch and stream)."""

from pyspark.sql import types as T

_PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("date", T.TimestampType()),
])

_ACCOUNT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("login", T.StringType()),
    T.StructField("avatar_url", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("site_admin", T.BooleanType()),
])

STATS = T.StructType([
    T.StructField("total", T.LongType()),
    T.StructField("additions", T.LongType()),
    T.StructField("deletions", T.LongType()),
])

FILE = T.StructType([
    T.StructField("sha", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("additions", T.LongType()),
    T.StructField("deletions", T.LongType()),
    T.StructField("changes", T.LongType()),
    T.StructField("blob_url", T.StringType()),
    T.StructField("raw_url", T.StringType()),
    T.StructField("contents_url", T.StringType()),
    T.StructField("patch", T.StringType()),
])

COMMIT = T.StructType([
    T.StructField("_id", T.StructType([T.StructField("$oid", T.StringType())])),
    T.StructField("node_id", T.StringType()),
    T.StructField("sha", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("commit", T.StructType([
        T.StructField("author", _PERSON),
        T.StructField("committer", _PERSON),
        T.StructField("message", T.StringType()),
        T.StructField("tree", T.StructType([T.StructField("sha", T.StringType())])),
        T.StructField("comment_count", T.LongType()),
        T.StructField("verification", T.StructType([
            T.StructField("verified", T.BooleanType()),
            T.StructField("reason", T.StringType()),
            T.StructField("signature", T.StringType()),
            T.StructField("payload", T.StringType()),
        ])),
    ])),
    T.StructField("author", _ACCOUNT),
    T.StructField("committer", _ACCOUNT),
    T.StructField("parents", T.ArrayType(T.StructType([T.StructField("sha", T.StringType())]))),
    T.StructField("stats", STATS),
    T.StructField("files", T.ArrayType(FILE)),
])

GEO = T.StructType([
    T.StructField("sha", T.StringType()),
    T.StructField("createdAt", T.TimestampType()),
    T.StructField("continent", T.StringType()),
])

#: Columns stored beside a landed commit record (see ``operators.commits.with_repo_keys``).
REPO_KEYS = [T.StructField("owner_key", T.StringType()), T.StructField("repo_key", T.StringType())]
