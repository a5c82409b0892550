"""Keyed rows of a stream in event-time order: the state that patterns and changelogs are built on.

Every call of a state goes over a socket and may take tens of milliseconds, so keys do not call one by one: they are hashed
into as many groups as there are shuffle partitions, and a group has one state. Its rows wait in RocksDB until the watermark
has passed them, by time bucket. A micro-batch only appends: what a batch of Arrow rows brings for a bucket is one new entry,
and no row that waits is read or written again. One timer a group wakes it when its earliest bucket is complete; then the
complete buckets are read one after the other, sorted and handed on row by row. So memory holds one bucket of one group, the
state holds the rows inside the watermark delay, and the arrival order inside or across micro-batches does not matter. Rows reach Python by way of pandas, so their times lie in the years 1678 to 2261.

Rows carry their order as text (``order_``), which makes equal times a total order, and a ``value_`` that the subclass
understands; both are computed by Spark before.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# A stateful query first runs its processor in a Python process beside the driver, which sees neither the driver's
# sys.path nor files that were added to the session: processors travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class OrderedProcessor(StatefulProcessor):
    """Calls :meth:`step` for every row of a key in (time, order); subclasses keep their own state beside it."""

    #: Columns of the output, in order; set by the subclass.
    columns: list[str]

    def __init__(self, bucket_us: int):
        self.bucket_us = bucket_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "bucket long", "n long")
        self.rows = handle.getMapState("rows", "bucket long, part long",
                                       "us array<long>, ord array<string>, value array<long>, keys array<string>")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Further state of the subclass."""

    def new(self) -> object:
        """The subclass' state of a key that has none; it is changed in place."""

    def load(self) -> dict[str, object]:
        """The subclass' state of a group's keys, when complete buckets are about to be handed on."""
        return {}

    def step(self, state: object, us: int, order: str, value: int) -> Iterable[tuple]:
        raise NotImplementedError

    def store(self, states: dict[str, object], horizon_us: int) -> int | None:
        """Keep the states: every row before ``horizon_us`` has been handed on, none after it. Return the time that the
        horizon must reach for the group to be woken even without rows, or None."""

    def _waiting(self) -> dict[int, int]:
        """Entries of each bucket that waits."""
        return {int(b[0]): int(n[0]) for b, n in self.parts.iterator()}

    def _wake(self, at_us: int, timers: list[int]) -> None:
        for old in timers:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at_us // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, came = self._waiting(), set()
        for frame in rows:
            for bucket, part in frame.groupby(frame["us_"] // self.bucket_us):
                bucket = int(bucket)
                number = waiting.get(bucket, 0)
                self.rows.updateValue((bucket, number), (part["us_"].tolist(), part["order_"].tolist(),
                                                         part["value_"].tolist(), part["key_"].tolist()))
                waiting[bucket] = number + 1
                came.add(bucket)
        for bucket in came:
            self.parts.updateValue((bucket,), (waiting[bucket],))
        if came:
            end = (min(came) + 1) * self.bucket_us
            timers = list(self.handle.listTimers())
            if not timers or end // 1000 + 1 < min(timers):
                self._wake(end, timers)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        states = self.load()
        wake = None
        for bucket, n in sorted(self._waiting().items()):
            if (bucket + 1) * self.bucket_us > watermark:
                wake = (bucket + 1) * self.bucket_us
                break
            found = []
            for part in range(n):
                found.extend(zip(*self.rows.getValue((bucket, part))))
                self.rows.removeKey((bucket, part))
            self.parts.removeKey((bucket,))
            found.sort()
            names, out = {}, []
            for us, order, value, name in found:
                if name not in names:
                    names[name] = tuple(json.loads(name))
                    states.setdefault(name, self.new())
                out.extend(names[name] + tuple(x) for x in self.step(states[name], us, order, value))
            if out:
                yield pd.DataFrame(out, columns=self.columns)
        idle = self.store(states, watermark // self.bucket_us * self.bucket_us)
        if idle is not None:
            idle = -(-idle // self.bucket_us) * self.bucket_us
        wakes = [x for x in (wake, idle) if x is not None]
        if wakes:
            self._wake(min(wakes), list(self.handle.listTimers()))

    def close(self) -> None:
        pass


def state_group(df: DataFrame, *keys: str) -> Column:
    """Number of the group of keys that share a state: as many groups as the session's shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def ordered_rows(events: DataFrame, keys: list[str], time: str, order: list[str | Column], value: Column) -> DataFrame:
    """Rows as the processor reads them: the keys, ``time`` (for the watermark), ``us_``, ``order_``, ``value_``.

    ``order`` columns are text; they are compared one after the other, so none may hold U+0000.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    text = F.concat_ws("\x00", *[F.coalesce(c, F.lit("")) for c in columns])
    return events.select(*keys, time, F.unix_micros(time).alias("us_"), text.alias("order_"),
                         value.cast("long").alias("value_"))


def run_ordered(rows: DataFrame, keys: list[str], processor: OrderedProcessor, schema: str) -> DataFrame:
    """The processor over :func:`ordered_rows`; ``schema`` is that of its own output columns."""
    name = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]), {"ignoreNullFields": "false"})
    rows = rows.select(state_group(rows, *keys).alias("group_"), name.alias("key_"), *[c for c in rows.columns if c not in keys])
    return rows.groupBy("group_").transformWithStateInPandas(
        processor, ", ".join(f"{k} string" for k in keys) + f", {schema}", "append", "eventTime")
