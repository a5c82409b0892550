"""A new event-time column in the middle of a streaming query: what follows a join or a computed time is windowed by it.

The rows pass through a keyed operator that keeps nothing; its output declares the event-time column, and with it the
watermark goes on to the next stateful operator. The new time may not lie behind the watermark of the operator's input: for
the output of an interval join that holds, as the later of a pair's times is never behind the row that completed the pair.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor

from commitlens.streaming.ordered import state_group

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # see ordered.py


class RestampProcessor(StatefulProcessor):
    """Passes rows on."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            yield frame[self.columns]

    def close(self) -> None:
        pass


def restamped(rows: DataFrame, key: str, time: str) -> DataFrame:
    """``rows`` with ``time`` as their event time; ``key`` spreads them over tasks, by groups: each costs calls."""
    columns = rows.columns
    return rows.withColumn("group_", state_group(rows, key)).groupBy("group_").transformWithStateInPandas(
        RestampProcessor(columns), rows.schema, "append", "eventTime", eventTimeColumnName=time)
