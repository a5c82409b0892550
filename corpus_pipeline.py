"""A training-corpus pipeline over ``documents``: each stage works on everything the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import landed, quoted, table
from commitlens.llm.decontaminate import leaks
from commitlens.llm.neardup import near_duplicates
from commitlens.llm.pieces import encode_pieces
from commitlens.llm.pii import redacted
from commitlens.llm.quality import drop_rejected

#: Sketches, seeds and piece models are not expressible in SQL; tests compare with brute force instead.
ORACLE_SQL = None
#: Documents at least this similar (Jaccard, in percent) are near copies here; ``op10_minhash`` keeps its own 85.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the hard rules or their host's verdict reject go (null and empty texts among them)."""
    return drop_rejected(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: the first by ``doc_id``, rows without an id last, then by row. Rows
    are numbered in a landed table and judged one by one, so rows that repeat an id, or have none, are documents of
    their own; rows without words all stay. The rows that stay grow with the documents, so the join is a sort-merge join
    at every size, and its keys are unique."""
    rows = landed(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "rows")
    groups = near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text"), percent=NEAR_PERCENT)
    named = groups.select(F.col("doc_id").alias("row"), "component_id").join(
        rows.select("row", "doc.doc_id").hint("merge"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))["row"]
    stays = landed(named.groupBy("component_id").agg(first.alias("row")).select("row"), "stays")
    return rows.join(stays.hint("merge"), "row", "left_semi").select("doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text leaks a benchmark item go. Rows are numbered in a landed table and judged one by one: a row without
    an id goes if it leaks, a row that repeats a leaking row's id stays if it does not. Null and empty texts stay."""
    rows = landed(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "rows")
    gone = leaks(rows.select(F.col("row").alias("doc_id"), "doc.text"), table(spark, sf_dir, "benchmark"))
    gone = landed(gone.select(F.col("doc_id").alias("row")).distinct(), "leaks")
    return rows.join(gone, "row", "left_anti").select("doc.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; every document stays. ``n_chars`` follows the text (null where
    there is none)."""
    rows = redacted(docs)
    size = F.length("text").cast("long")
    return rows.select(*[size.alias(c) if c == "n_chars" else F.col(quoted(c)) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_pieces, ids)`` of every row; a null or empty text has no pieces."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("redact", redact), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
