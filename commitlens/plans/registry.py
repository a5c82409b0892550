"""Query registry: key -> (spark, sf_dir) -> DataFrame, and key -> DuckDB oracle SQL.

Results are normalised for the side-by-side check: integers as BIGINT, timestamps as ``yyyy-MM-dd HH:mm:ss``
text, doubles rounded to 6 places. Keys without an oracle entry get the weaker rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TS_FMT_SPARK = "yyyy-MM-dd HH:mm:ss"
TS_FMT_DUCK = "%Y-%m-%d %H:%M:%S"


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_FMT_SPARK)
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(key: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def ts_sql(expr: str) -> str:
    return f"strftime({expr}, '{TS_FMT_DUCK}')"


def ext_sql(x: str = "filename") -> str:
    """DuckDB form of the extension rule (trailing dots stripped; dots only -> unknown)."""
    s = f"regexp_replace({x}, '\\.+$', '')"
    return f"(CASE WHEN {s} = '' THEN 'unknown' ELSE string_split({s}, '.')[-1] END)"


def md5_long_sql(x: str) -> str:
    h2 = f"md5(regexp_replace(md5({x}), '^0+', ''))"
    top = f"(substr({h2}, 1, 12) || '3' || substr({h2}, 14, 3))"
    v = f"(('0x' || {top})::HUGEINT)"
    return f"CAST(CASE WHEN {v} >= 9223372036854775808 THEN {v} - 18446744073709551616 ELSE {v} END AS BIGINT)"


def epoch_sql(x: str) -> str:
    return f"date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {x})"
