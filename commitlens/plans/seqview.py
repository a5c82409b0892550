"""Sequence views over the supplied tables, landed once per application (lineage cut in the checkpoint folder).

* ``quantities``: one sequence per order (``seq_id = l_orderkey``), items in a total order of the lineitem
  columns; ``value`` = quantity, ``opt`` = the same but undefined (NULL) when ``l_partkey % 13 = 0``,
  ``rf`` = return flag, ``pk`` = ``l_partkey % 100``.
* ``order_keys``: every order key, so empty sequences (orders without lineitems) exist.
* ``event_types``: per user the event types in time order; ``customer_orders``: per customer the order keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.operators.ordered import position_block, row_number_within
from commitlens.plans.testbed import table

LINEITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate"]


def _land(spark: SparkSession, name: str, sf_dir: str, source: str, build) -> DataFrame:
    from commitlens.session import landed_view
    return spark.read.parquet(landed_view(spark, f"seq-{name}", sf_dir, [source],
                                          lambda path: build().write.parquet(path)))


def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "seq_id")
        r = row_number_within(li, ["seq_id"], LINEITEM_ORDER, position_block("l_linenumber"), name="_rn")
        q = F.col("l_quantity").cast("long")
        return r.select("seq_id", (F.col("_rn") - 1).alias("pos"), q.alias("value"),
                        F.when(F.col("l_partkey") % 13 == 0, F.lit(None).cast("long")).otherwise(q).alias("opt"),
                        F.col("l_returnflag").alias("rf"), (F.col("l_partkey") % 100).alias("pk"))
    return _land(spark, "quantities", sf_dir, "lineitem", build)


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq_id"))


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("seq_id"), "ts", "event_id", "event_type")
        r = row_number_within(ev, ["seq_id"], ["ts", "event_id"], F.to_date("ts"), name="_rn")
        return r.select("seq_id", (F.col("_rn") - 1).alias("pos"), F.col("event_type").alias("value"))
    return _land(spark, "events", sf_dir, "events", build)


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("seq_id"), "o_orderdate", "o_orderkey")
        r = row_number_within(o, ["seq_id"], ["o_orderdate", "o_orderkey"], F.trunc("o_orderdate", "month"), name="_rn")
        return r.select("seq_id", (F.col("_rn") - 1).alias("pos"), F.col("o_orderkey").alias("value"))
    return _land(spark, "custorders", sf_dir, "orders", build)


ORACLE_CTE = """
sq AS (SELECT l_orderkey AS seq_id,
              row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS pos,
              CAST(trunc(l_quantity) AS BIGINT) AS value,
              CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(trunc(l_quantity) AS BIGINT) END AS opt,
              l_returnflag AS rf, l_partkey % 100 AS pk
       FROM lineitem),
ks AS (SELECT o_orderkey AS seq_id FROM orders),
ev AS (SELECT user_id AS seq_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
              event_type AS value FROM events),
co AS (SELECT o_custkey AS seq_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos,
              o_orderkey AS value FROM orders)
"""
