"""Two-pass external shuffle of a corpus into shards, with DataFrame functions only.

First pass: every row gets a number, a seeded hash of the number names one of the buckets, and the exchange scatters the
rows so that a partition is one bucket. The number of buckets follows the corpus (its text bytes over ``bucket_bytes``),
so a bucket fits into a task's memory however large the corpus is; the hash sees row numbers, never values, so a source,
id or text that a third of all rows share is spread like any other. Second pass: each bucket is put into row order,
shuffled by Fisher-Yates (Spark's ``shuffle`` of an array is that algorithm, seeded) and written. The buckets one after
the other are a random permutation of the corpus; cutting it into equal runs gives shards whose row counts differ by at
most one (law ``rows``), and a row's place in its run is its slot.

Rows are numbered in the order of the input's partitions. Give it stored tables, as every caller here does: a scan repeats
its rows in the same order when a lost executor's tasks run again. The written buckets cut the lineage; bucket sizes, one
row for each bucket, are counted from them. The same input files, session and seed give the same shards.

Nulls: a null text has no bytes, a null id is like any other. Empty texts and repeated rows are rows of their own. An
empty table gives an empty result. Extra columns travel with the row inside ``doc``, so their names cannot clash. A text
longer than ``bucket_bytes`` makes its bucket as large as itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.llm.common import landed

SHARDS = 8
SEED = 20_011
#: Text bytes of a bucket. A task holds a few copies of one bucket; a cluster with larger executors can raise it.
BUCKET_BYTES = 32 << 20


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus one."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def shuffled_buckets(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Both passes: a written table ``(bucket, place, doc)``, ``place`` counted from 0 inside a bucket."""
    total = docs.agg(F.sum(text_bytes(F.col("text")))).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(n)).cast("int")
    scattered = rows.select(bucket.alias("bucket"), F.struct("row", "doc").alias("item")).repartitionById(n, "bucket")
    by_row = F.array_sort(F.collect_list("item"), lambda a, b: F.when(a["row"] < b["row"], -1).otherwise(1))
    mixed = scattered.groupBy("bucket").agg(by_row.alias("items")).select(
        "bucket", F.posexplode(F.shuffle("items", seed)).alias("place", "item"))
    return landed(mixed.select("bucket", F.col("place").cast("long").alias("place"), "item.doc"), "shuffled")


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(doc, shard, slot)`` of every row: ``shards`` runs of the shuffled corpus, slots counted from 0 in each."""
    rows = shuffled_buckets(docs, seed, bucket_bytes)
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.orderBy("bucket")
    starts = sizes.select(
        "bucket", (F.sum("n").over(everything) - F.col("n")).alias("before"),
        F.sum("n").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    at, small, longer = F.col("before") + F.col("place"), F.expr(f"total div {shards}"), F.expr(f"total % {shards}")
    # One row for each bucket, which is a partition of the exchange above: the driver tracks as many tasks anyway.
    placed = rows.join(F.broadcast(starts), "bucket").select("doc", at.alias("at"), small.alias("small"), longer.alias("longer"))
    placed = placed.withColumn("edge", F.expr("longer * (small + 1)"))
    inside = "at < edge"
    shard = F.expr(f"case when {inside} then at div (small + 1) else longer + (at - edge) div greatest(small, 1) end")
    slot = F.expr(f"case when {inside} then at % (small + 1) else (at - edge) % greatest(small, 1) end")
    return placed.select("doc", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED,
                 bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write the shards as Parquet folders ``shard=k``; the rows of a file are in the order of ``slot``."""
    (shuffled_shards(docs, shards, seed, bucket_bytes).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The placement of every document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    return shuffled_shards(docs, shards).select(
        "doc.doc_id", text_bytes(F.col("doc.text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
