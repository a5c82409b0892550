"""Web-server logs rendered from the ``events`` table (the reference's log files are not available).

One access-log line per event, in event_id order, in the common log format:
``<ip> - - [dd/MMM/yyyy:HH:mm:ss +0000] "<METHOD> <path> HTTP/1.1" <status> <size>``
and one error-log line per event. Deterministic; the DuckDB oracle renders the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.functions.partitions import spread
from commitlens.plans.testbed import table
from commitlens.session import ensure_utc

# Fixed values of the rendering: method and status per event type; every 50th click searches for "POST".
METHOD = {"purchase": "POST", "signup": "POST", "view": "GET", "click": "GET", "error": "DELETE"}


def _ip(uid):
    return F.concat_ws(".", F.lit("10"), (uid / 65536 % 256).cast("long").cast("string"),
                       (uid / 256 % 256).cast("long").cast("string"), (uid % 256).cast("string"))


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    et = F.col("event_type")
    method = F.coalesce(*[F.when(et == k, F.lit(v)) for k, v in METHOD.items()], F.lit("GET"))
    path = (F.when((et == "click") & (F.col("event_id") % 50 == 0),
                   F.concat(F.lit("/search?q=POST&page="), (F.col("event_id") % 7).cast("string")))
            .otherwise(F.concat(F.lit("/"), et, F.lit("/"), (F.col("event_id") % 97).cast("string"))))
    status = F.when(et == "error", F.lit("500")).otherwise(F.lit("200"))
    size = F.when(et == "error", F.lit("-")).otherwise(F.round(F.col("value") * 100).cast("long").cast("string"))
    ts = F.col("ts").cast("timestamp")
    line = F.concat(_ip(F.col("user_id")), F.lit(" - - ["), F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"),
                    F.lit(" +0000] \""), method, F.lit(" "), path, F.lit(" HTTP/1.1\" "), status, F.lit(" "), size)
    return ev.select(line.alias("value"), F.lit("access_log").alias("file"), F.col("event_id").alias("line"))


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    ts = F.col("ts").cast("timestamp")
    head = F.concat(F.lit("["), F.date_format(ts, "EEE MMM dd HH:mm:ss yyyy"), F.lit("] "))
    client = F.concat(F.lit("[client "), _ip(F.col("user_id")), F.lit("] "))
    msg = (F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 != 0),
                  F.concat(F.lit("[error] "), client, F.lit("File does not exist: /var/www/html/"),
                           (F.col("event_id") % 97).cast("string")))
           .when(F.col("event_type") == "error", F.concat(F.lit("[error] "), client, F.lit("Invalid method in request")))
           .otherwise(F.concat(F.lit("[notice] child pid "), F.col("event_id").cast("string"), F.lit(" exit signal"))))
    return ev.select(F.concat(head, msg).alias("value"), F.lit("error_log").alias("file"),
                     F.col("event_id").alias("line"))


_IP_SQL = ("'10.' || CAST((user_id // 65536) % 256 AS VARCHAR) || '.' || CAST((user_id // 256) % 256 AS VARCHAR)"
           " || '.' || CAST(user_id % 256 AS VARCHAR)")

ACCESS_LOG_CTE = f"""
al AS (
  SELECT event_id AS line,
         {_IP_SQL} || ' - - [' || strftime(CAST(ts AS TIMESTAMP), '%d/%b/%Y:%H:%M:%S') || ' +0000] "' ||
         (CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'POST' WHEN 'view' THEN 'GET'
                          WHEN 'click' THEN 'GET' WHEN 'error' THEN 'DELETE' ELSE 'GET' END) || ' ' ||
         (CASE WHEN event_type = 'click' AND event_id % 50 = 0 THEN '/search?q=POST&page=' || CAST(event_id % 7 AS VARCHAR)
               ELSE '/' || event_type || '/' || CAST(event_id % 97 AS VARCHAR) END) || ' HTTP/1.1" ' ||
         (CASE WHEN event_type = 'error' THEN '500' ELSE '200' END) || ' ' ||
         (CASE WHEN event_type = 'error' THEN '-' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END) AS value
  FROM events)
"""

ERROR_LOG_CTE = f"""
el AS (
  SELECT event_id AS line,
         '[' || strftime(CAST(ts AS TIMESTAMP), '%a %b %d %H:%M:%S %Y') || '] ' ||
         (CASE WHEN event_type = 'error' AND event_id % 3 <> 0
               THEN '[error] [client ' || {_IP_SQL} || '] File does not exist: /var/www/html/' || CAST(event_id % 97 AS VARCHAR)
               WHEN event_type = 'error' THEN '[error] [client ' || {_IP_SQL} || '] Invalid method in request'
               ELSE '[notice] child pid ' || CAST(event_id AS VARCHAR) || ' exit signal' END) AS value
  FROM events)
"""
