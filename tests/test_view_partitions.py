"""Tasks that build a view take a bounded part of its tables, however few shuffle partitions the session has."""

from commitlens.functions.partitions import SHUFFLE_BYTES, SHUFFLE_BYTES_CONF, shuffle_settings
from commitlens.plans import seqview
from commitlens.session import files_under


def test_partitions_follow_the_bytes_of_the_tables(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for stored, n in ((0, least), (SHUFFLE_BYTES * least, least), (SHUFFLE_BYTES * 300 + 1, 301)):
        assert shuffle_settings(spark, stored)["spark.sql.shuffle.partitions"] == str(n)


def test_view_of_more_bytes_is_built_by_more_tasks(spark, tmp_path):
    spark.range(4000).selectExpr(
        "id div 4 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(id % 4 AS int) AS l_linenumber",
        "CAST(id % 50 AS double) AS l_quantity", "0.5D AS l_extendedprice", "0.0D AS l_discount", "0.0D AS l_tax",
        "'A' AS l_returnflag", "'O' AS l_linestatus", "TIMESTAMP'2019-01-01' AS l_shipdate").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    stored = sum(size for _, size, _ in files_under(spark, f"{tmp_path}/lineitem.parquet"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set(SHUFFLE_BYTES_CONF, str(stored // 5))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        q = seqview.quantities(spark, str(tmp_path))
        assert len(q.inputFiles()) >= 4
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1"
    finally:
        for name in (SHUFFLE_BYTES_CONF, "spark.sql.adaptive.coalescePartitions.minPartitionSize",
                     "spark.sql.adaptive.coalescePartitions.parallelismFirst"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r.seq_id, r.pos, r.value) for r in q.collect()) == [(i // 4, i % 4, i % 50) for i in range(4000)]
