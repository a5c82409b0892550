"""Operator 9, host-level quality rules: rule failures by host, shrunk with an empirical beta prior, joined back.

Per document (built-in functions only): words, their characters, symbols, duplicate lines, words in repeated 3-word
windows. Hard rule: ``base_failed``. Soft rules fail on symbol-heavy text, repeated lines and odd word lengths; a soft
failure alone never rejects a document. Per host and soft rule the failure rate is shrunk towards all hosts:
``(failed + m * s) / (n + s)``, where the mean ``m`` and the strength ``s`` come from the rates of all hosts (method of
moments). The posterior of the host's rate is a beta distribution of that mean; the host is bad where the mean less
``CERTAINTY`` standard deviations is over ``HOST_FACTOR`` times the rate of all hosts. So the limit follows the corpus, a
host of few documents has to be worse to count, and hosts that are all alike (by chance a little up or down) never do. A
document that fails a soft rule is rejected where its host is bad by that rule: the host, not just the page, is bad.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import landed

#: Soft rules by name: a SQL condition over the per-document figures.
SOFT_RULES = {
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "lengths": "word_chars < 2 * n_words or word_chars > 12 * n_words",
}
HOST_FACTOR, CERTAINTY = 2.0, 2.0
MAX_STRENGTH = 1e6


def figures(docs: DataFrame, host_col: str = "source", carry: bool = False) -> DataFrame:
    """``(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed)`` per row of
    ``docs``, with the whole input row as the struct ``row`` where ``carry`` asks for it.

    Windows are compared as strings. A text whose windows are all different (most texts) needs one hash pass; others
    sort (window, position) and mark positions whose neighbour in that order has the same window, which is
    O(n log n) for the longest text too.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                       *([F.struct("*").alias("row")] if carry else []))
    kept = ["doc_id", "host", *(["row"] if carry else [])]
    rows = rows.select(
        *kept,
        F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "").alias("w"),
        (F.size(F.split("text", r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("l"))
    rows = rows.select(
        *kept, "n_symbols", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("w") - 3),
            lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).alias("g"))
    rows = rows.withColumn("g", F.when(
        F.size(F.array_distinct("g")) < F.size("g"),
        F.sort_array(F.transform("g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))

    def same(x: Column, i: Column) -> Column:
        return (F.get(F.col("g"), i)["g"] == x["g"])

    twice = F.sort_array(F.transform(
        F.filter("g", lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False))),
        lambda x: x["i"]))
    covered = F.reduce(
        twice, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return (rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("g")
            .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")))


def host_verdicts(rows: DataFrame, factor: float = HOST_FACTOR) -> DataFrame:
    """``figures`` -> ``(host, bad_<rule>...)``: whether the host fails each soft rule credibly more than ``factor`` times
    as often as all hosts do.

    Both aggregates are partial sums, so a host with a third of all documents is one row per task before the shuffle.
    """
    counts = rows.groupBy("host").agg(F.count("*").alias("n"), *[
        F.count_if(F.expr(rule)).alias(name) for name, rule in SOFT_RULES.items()])
    long = counts.select("host", "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("f")) for name in SOFT_RULES])).alias("r"))
    long = long.select("host", "n", "r.rule", "r.f")
    prior = long.groupBy("rule").agg((F.sum("f") / F.sum("n")).alias("m"),
                                     (F.sum(F.col("f") * F.col("f") / F.col("n")) / F.sum("n")).alias("q"))
    spread = F.col("q") - F.col("m") * F.col("m")
    prior = prior.select("rule", "m", F.when(spread > 1e-12, F.least(F.greatest(
        F.col("m") * (1 - F.col("m")) / spread - 1, F.lit(1.0)), F.lit(MAX_STRENGTH)))
        .otherwise(MAX_STRENGTH).alias("s"))
    rate = (F.col("f") + F.col("m") * F.col("s")) / (F.col("n") + F.col("s"))
    long = long.join(prior, "rule").withColumn("rate", rate)
    sd = F.sqrt(F.greatest(F.col("rate") * (1 - F.col("rate")), F.lit(0.0)) / (F.col("n") + F.col("s") + 1))
    bad = long.select("host", "rule", (F.col("rate") - CERTAINTY * sd > factor * F.col("m")).alias("bad"))
    return bad.groupBy("host").agg(*[
        F.max(F.when(F.col("rule") == name, F.col("bad"))).alias(f"bad_{name}") for name in SOFT_RULES])


def _judged(rows: DataFrame, factor: float) -> DataFrame:
    """``figures`` with ``host_rejected`` and ``kept``."""
    rows = landed(rows, "quality")
    hosts = landed(host_verdicts(rows, factor), "hosts")
    failed = " or ".join(f"(bad_{name} and ({rule}))" for name, rule in SOFT_RULES.items())
    return (rows.join(hosts, "host").withColumn("host_rejected", F.expr(failed))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")))


def quality_verdicts(docs: DataFrame, host_col: str = "source", factor: float = HOST_FACTOR) -> DataFrame:
    """Per input row the figures, ``host_rejected`` and ``kept``.

    Null or empty text: no words, base_failed. A null host counts as the empty host. Repeated rows and ids are judged
    row by row; ties cannot occur (no ranking). An empty table gives an empty result. Other columns are ignored.
    """
    return _judged(figures(docs, host_col), factor)


def drop_rejected(docs: DataFrame, host_col: str = "source", factor: float = HOST_FACTOR) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged. The input rows are landed with their figures, so the host verdicts
    come back to them without a shuffle of texts (unless the table of hosts is itself too large to broadcast)."""
    return _judged(figures(docs, host_col, carry=True), factor).where("kept").select("row.*")
