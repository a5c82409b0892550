"""Event patterns per key: a sequence of conditions with strict or relaxed contiguity and a time limit.

A pattern is a list of steps. The first row that satisfies the first step starts a match; a step that is ``strict`` must be
satisfied by the very next row of the key, any other by the next row that satisfies it, whatever lies between. A match is
complete with its last step and counts if the last row is less than ``within`` after the first. Every row that satisfies
the first step starts a match of its own, and matches may share rows. Rows are ordered by (time, ``order`` columns).

Conditions are Column expressions that Spark evaluates into one bit a step, so both forms only see bits:

* :func:`pattern_matches` (batch) follows a match from its end to its start with one window function a step. The windows run
  inside (key, time block); a block is as long as ``within`` and sees the next block's rows too, so a hot key is spread
  over its blocks and every match lies in the rows of the block that its first row belongs to.
* :func:`pattern_stream` (streams) collects the rows of (key, window) until the watermark has passed the window, which is
  a bucket and the time limit after it, and follows the matches that start in the bucket through the sorted rows. It is
  an ordinary windowed aggregate: no Python process takes part, and any state store will do. A task holds one window of a key.
* :class:`PatternProcessor` is the same as an automaton on keyed state, row by row in event-time order (:mod:`ordered`).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.streaming.ordered import OrderedProcessor, ordered_rows
from commitlens.streaming.questions import added_removed_rows, status_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # see ordered.py


@dataclass(frozen=True)
class Step:
    """A condition; ``strict``: of the row right after the step before (ignored for the first step)."""

    where: Column
    strict: bool = False


@dataclass(frozen=True)
class Pattern:
    steps: tuple[Step, ...]
    within_seconds: int

    def __post_init__(self):
        if not 1 <= len(self.steps) <= 62 or self.within_seconds <= 0:
            raise ValueError("a pattern has 1 to 62 steps and a positive time limit")

    @property
    def within_us(self) -> int:
        return self.within_seconds * 1_000_000

    def bits(self) -> Column:
        """One bit for each step that the row satisfies; a null condition is not satisfied."""
        bits = [F.when(s.where, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, s in enumerate(self.steps)]
        total = bits[0]
        for b in bits[1:]:
            total = total + b
        return total


def followed(first: Column, *rest: Column, within_seconds: int) -> Pattern:
    """``first``, then each of ``rest`` with anything between."""
    return Pattern((Step(first), *(Step(c) for c in rest)), within_seconds)


def pattern_matches(events: DataFrame, keys: list[str], time: str, order: list[str | Column], pattern: Pattern) -> DataFrame:
    """Batch: ``(*keys, started, ended)`` of every match."""
    rows = ordered_rows(events, keys, time, order, pattern.bits())
    block = F.floor(F.col("us_") / F.lit(pattern.within_us))
    rows = rows.withColumn("_block", F.explode(F.array(block, block - 1)))
    # From the last row to the first: a frame that grows from its first row is one pass over a block, one that shrinks
    # towards its last row is read again for every row.
    at = Window.partitionBy(*keys, "_block").orderBy(F.desc("us_"), F.desc("order_"))
    after = at.rowsBetween(Window.unboundedPreceding, -1)
    last = len(pattern.steps) - 1
    rows = rows.withColumn("_end", F.col("us_"))
    for k in range(last, 0, -1):
        # The end of a match whose step k is this row, wrapped so that "satisfied, but leads nowhere" is not null.
        here = F.when(F.col("value_").bitwiseAND(F.lit(1 << k)) != 0, F.struct("_end"))
        nxt = F.lag(here).over(at) if pattern.steps[k].strict else F.last(here, ignorenulls=True).over(after)
        rows = rows.withColumn("_end", nxt["_end"])
    starts = (F.col("value_").bitwiseAND(F.lit(1)) != 0) & (F.floor(F.col("us_") / F.lit(pattern.within_us)) == F.col("_block"))
    return rows.where(starts & (F.col("_end") - F.col("us_") < pattern.within_us)).select(
        *keys, F.col(time).alias("started"), F.timestamp_micros("_end").alias("ended"))


class PatternProcessor(OrderedProcessor):
    """State of a key: its partial matches, as the number of the step they wait for and their first row's time."""

    def __init__(self, keys: list[str], strict: list[bool], within_us: int, bucket_us: int):
        super().__init__(bucket_us)
        self.columns = [*keys, "start_us", "end_us"]
        self.strict, self.within_us = strict, within_us

    def open(self, handle):
        self.partial = handle.getListState("partial", "name string, step int, us long")

    def new(self):
        return []

    def load(self):
        states = {}
        if self.partial.exists():
            for name, at, start in self.partial.get():
                states.setdefault(name, []).append((at, start))
        return states

    def step(self, state, us, order, value):
        kept, done = [], []
        for at, start in state:
            if us - start >= self.within_us:
                continue
            if value >> at & 1:
                (done if at + 1 == len(self.strict) else kept).append((at + 1, start))
            elif not self.strict[at]:
                kept.append((at, start))
        if value & 1:
            (done if len(self.strict) == 1 else kept).append((1, us))
        state[:] = kept
        return [(start, us) for _, start in done]

    def store(self, states, horizon_us):
        kept = [(name, int(at), int(start)) for name, state in states.items() for at, start in state
                if start + self.within_us > horizon_us]
        if kept:
            self.partial.put(kept)
            return min(start for _, _, start in kept) + self.within_us
        self.partial.clear()
        return None


def pattern_stream(events: DataFrame, keys: list[str], time: str, order: list[str | Column], pattern: Pattern,
                   bucket_seconds: int | None = None) -> DataFrame:
    """Stream: the same rows as :func:`pattern_matches`; ``time`` has a watermark.

    ``bucket_seconds`` is how finely waiting rows are grouped (the time limit, if not given). A row waits in
    ``1 + within / bucket`` windows of its key: let it be a good part of the watermark delay, which rows wait for anyway.
    """
    bucket = bucket_seconds or pattern.within_seconds
    rows = ordered_rows(events, keys, time, order, pattern.bits())
    waiting = rows.groupBy(*keys, F.window(time, f"{bucket + pattern.within_seconds} seconds", f"{bucket} seconds")).agg(
        F.collect_list(F.struct("us_", "order_", "value_")).alias("rows"))
    found = waiting.select(*keys, F.unix_micros("window.start").alias("from_us"),
                           F.explode(_matches_of(F.sort_array("rows", asc=False), pattern)).alias("m"))
    return (found.where(F.col("m.start_us") < F.col("from_us") + bucket * 1_000_000)
            .select(*keys, F.timestamp_micros("m.start_us").alias("started"), F.timestamp_micros("m.end_us").alias("ended")))


def _matches_of(rows: Column, pattern: Pattern) -> Column:
    """``(start_us, end_us)`` of the matches in an array of a key's rows, the last row first: the fold of an array does
    what the windows of :func:`pattern_matches` do. It carries, for each step, the end of a match whose step is the next row
    (strict) or the next row that satisfies it, wrapped so that "satisfied, but leads nowhere" is not null."""
    last = len(pattern.steps) - 1
    none = F.lit(None).cast("struct<end:bigint>")
    start = F.struct(*[none.alias(f"n{k}") for k in range(last + 1)],
                     F.array().cast("array<struct<start_us:bigint,end_us:bigint>>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        here = [F.when(row["value_"].bitwiseAND(F.lit(1 << k)) != 0,
                       F.struct((row["us_"] if k == last else acc[f"n{k + 1}"]["end"]).alias("end")))
                for k in range(last + 1)]
        carried = [h if s.strict else F.coalesce(h, acc[f"n{k}"]) for k, (h, s) in enumerate(zip(here, pattern.steps))]
        match = F.array(F.struct(row["us_"].alias("start_us"), here[0]["end"].alias("end_us")))
        out = F.when(here[0]["end"] - row["us_"] < pattern.within_us, F.concat(acc["out"], match)).otherwise(acc["out"])
        return F.struct(*[c.alias(f"n{k}") for k, c in enumerate(carried)], out.alias("out"))

    return F.aggregate(rows, start, step, lambda acc: acc["out"])


FILE_KEYS, FILE_ORDER = ["repo", "filename"], ["sha", "file_sha", "status"]


def added_removed_pattern(within_seconds: int = 86400) -> Pattern:
    """``added``, directly followed by ``removed``, less than a day later."""
    return Pattern((Step(F.col("status") == "added"), Step(F.col("status") == "removed", strict=True)), within_seconds)


def added_then_removed_stream(commits: DataFrame, within_seconds: int = 86400,
                              bucket_seconds: int | None = None) -> DataFrame:
    """T7 on a streaming commit DataFrame that has ``ts`` and a watermark on it."""
    return pattern_stream(added_removed_rows(commits), FILE_KEYS, "ts", FILE_ORDER,
                          added_removed_pattern(within_seconds), bucket_seconds).select("repo", "filename")


def reworked_pattern(least_changes: int = 60, within_seconds: int = 60 * 86400) -> Pattern:
    """A file is added, some time later changed at large, and the change directly followed by its removal."""
    large = (F.col("status") == "modified") & (F.col("changes") > least_changes)
    return Pattern((Step(F.col("status") == "added"), Step(large), Step(F.col("status") == "removed", strict=True)),
                   within_seconds)


def _change_order() -> list[str | Column]:
    """Rows that agree in everything else are ordered by their changes."""
    return [*FILE_ORDER, F.lpad(F.col("changes").cast("string"), 20, "0")]


def reworked_files(commits: DataFrame, **limits) -> DataFrame:
    return pattern_matches(status_rows(commits), FILE_KEYS, "ts", _change_order(), reworked_pattern(**limits))


def reworked_files_stream(commits: DataFrame, bucket_seconds: int | None = None, **limits) -> DataFrame:
    return pattern_stream(status_rows(commits), FILE_KEYS, "ts", _change_order(), reworked_pattern(**limits),
                          bucket_seconds)
