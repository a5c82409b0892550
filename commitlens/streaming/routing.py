"""Messages that cannot be read and rows that come too late, kept beside the good ones.

A message stream (one text a message, as a bus delivers it) is parsed under the declared schema and every micro-batch is
written once, in one job, as three kinds of rows: ``good``, ``late`` (behind the watermark of the batches before) and ``bad``
(no record under the schema: the raw text and the reason). Nothing is dropped: the three tables together hold every message.

*Exactly once.* A batch is one folder, written whole; its ``_SUCCESS`` file makes it part of the tables. A batch that runs
again after a failure is skipped if its folder is complete, else written over. Readers take complete folders only
(:func:`routed`).

*Watermark.* The highest event time seen so far stands in a one-row table of each batch, written after its rows; a batch
reads its predecessor's. A row is late if it is not after that time less the delay, which is what Spark's own watermark
says of it: a stateful query over the good rows with the same delay drops none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens.schemas import COMMIT
from commitlens.session import files_under, path_exists

REASON, RAW = "reason", "raw"
KINDS = ("good", "late", "bad")
CORRUPT = "_corrupt_record"


def message_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Text messages of a folder, one a line: ``(value)``."""
    r = spark.readStream
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.text(folder)


def parsed(messages: DataFrame, schema: T.StructType = COMMIT, required: tuple[str, ...] = ("sha",)) -> DataFrame:
    """``(raw, reason, record)``: the record of each message, or why there is none.

    A message is bad if it is null, is no JSON object under the schema, or lacks a required field.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = messages.select(F.col("value").alias(RAW), record.alias("record"))
    missing = [F.when(F.col(f"record.{c}").isNull(), F.lit(f"no {c}")) for c in required]
    reason = F.coalesce(F.when(F.col(RAW).isNull(), F.lit("empty")),
                        F.when(F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull(), F.lit("not a record")),
                        *missing)
    return rows.select(RAW, reason.alias(REASON), F.struct(*[F.col(f"record.`{c}`").alias(c) for c in schema.names])
                       .alias("record"))


def _folder(root: str, batch: int) -> str:
    return f"{root}/rows/batch={batch}"


def _complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def _clock(spark: SparkSession, root: str, batch: int) -> int | None:
    """Highest event time (microseconds) up to and including a batch."""
    if batch < 0:
        return None
    return spark.read.schema("high long").parquet(f"{root}/clock/batch={batch}").first()["high"]


def router(root: str, time: Column, delay_us: int):
    """The ``foreachBatch`` function: ``time`` is the event time in terms of ``record``."""
    def route(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        high = _clock(spark, root, number - 1)
        path = _folder(root, number)
        if not _complete(spark, path):
            us = F.unix_micros(time)
            kind = F.when(F.col(REASON).isNotNull(), "bad")
            if high is not None:
                kind = kind.when(us <= F.lit(high - delay_us), "late")
            rows = batch.select("*", us.alias("us"), kind.otherwise("good").alias("kind"))
            rows.withColumn(RAW, F.when(F.col("kind") == "bad", F.col(RAW))).write.mode("overwrite").parquet(path)
        if not _complete(spark, f"{root}/clock/batch={number}"):
            # Read back from what was written, one narrow column of this batch only.
            written = spark.read.parquet(path).where("kind <> 'bad'").agg(F.max("us").alias("high"))
            written.select(F.greatest("high", F.lit(high).cast("long")).alias("high")).coalesce(1).write.mode(
                "overwrite").parquet(f"{root}/clock/batch={number}")
    return route


def complete_batches(spark: SparkSession, root: str) -> list[str]:
    """Folders of the batches that are part of the tables: one name for each micro-batch, no contents."""
    names = {p.split("/rows/", 1)[1].split("/", 1)[0] for p, _, _ in files_under(spark, f"{root}/rows")}
    return sorted(f"{root}/rows/{n}" for n in names if _complete(spark, f"{root}/rows/{n}"))


def routed(spark: SparkSession, root: str, kind: str, schema: T.StructType = COMMIT) -> DataFrame:
    """One of the tables: the records of ``good`` and ``late``, or ``(raw, reason)`` of ``bad``."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    whole = T.StructType([T.StructField(RAW, T.StringType()), T.StructField(REASON, T.StringType()),
                          T.StructField("record", schema), T.StructField("us", T.LongType()),
                          T.StructField("kind", T.StringType())])
    folders = complete_batches(spark, root)
    rows = spark.read.schema(whole).parquet(*folders) if folders else spark.createDataFrame([], whole)
    rows = rows.where(F.col("kind") == kind)
    return rows.select(RAW, REASON) if kind == "bad" else rows.select("record.*")


def routed_stream(spark: SparkSession, root: str, schema: T.StructType = COMMIT) -> DataFrame:
    """The good records as a stream, a micro-batch for each folder at least. Start it when the router has stopped, or on
    a root that no batch is written over in."""
    whole = T.StructType([T.StructField("record", schema), T.StructField("kind", T.StringType())])
    stream = spark.readStream.schema(whole).option("maxBytesPerTrigger", str(1 << 28)).parquet(f"{root}/rows/*")
    return stream.where(F.col("kind") == "good").select("record.*")
