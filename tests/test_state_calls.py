"""State calls of keyed processors are as many as groups and buckets ask for, not as keys; shuffles of bucketed windows."""

import pandas as pd
from pyspark.sql import functions as F

from commitlens.operators.ordered import row_number_within, shift_within
from commitlens.streaming.patterns import PatternProcessor
from commitlens.session import files_under, landed


class Handle:
    """State in memory that counts its calls."""

    def __init__(self):
        self.calls, self.timers = 0, []

    def getMapState(self, *_):
        return State(self)

    getListState = getMapState

    def listTimers(self):
        self.calls += 1
        return iter(list(self.timers))

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


class State:
    def __init__(self, handle):
        self.data, self.list, self.handle = {}, [], handle

    def __getattribute__(self, name):
        if name not in ("data", "list", "handle") and not name.startswith("_"):
            self.handle.calls += 1
        return object.__getattribute__(self, name)

    def iterator(self):
        return iter([(k, v) for k, v in self.data.items()])

    def updateValue(self, key, value):
        self.data[key] = value

    def getValue(self, key):
        return self.data[key]

    def removeKey(self, key):
        del self.data[key]

    def exists(self):
        return bool(self.list)

    def get(self):
        return iter(self.list)

    def put(self, rows):
        self.list = rows

    def clear(self):
        self.list = []


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_many_keys_of_a_group_share_state_calls():
    handle, processor = Handle(), PatternProcessor(["k"], [False, True], 10_000_000, 1_000_000)
    processor.init(handle)
    names = [f'["k{i}"]' for i in range(500)] + ["[null]"]

    def batch(us, value):
        frame = pd.DataFrame({"us_": us, "order_": "a", "value_": value, "key_": names})
        return list(processor.handleInputRows((0,), iter([frame]), None))

    assert batch(100, 1) == [] and batch(2_000_100, 2) == []
    early = list(processor.handleExpiredTimer((0,), Watermark(1_500), None))
    assert early == [] and len(handle.timers) == 1
    late = pd.concat(list(processor.handleExpiredTimer((0,), Watermark(5_000), None)))
    assert sorted(late["k"].dropna()) == sorted(f"k{i}" for i in range(500)) and late["k"].isna().sum() == 1
    assert set(late["start_us"]) == {100} and set(late["end_us"]) == {2_000_100}
    assert handle.calls < 60


def test_bucketed_windows_shuffle_rows_once(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.repeat(F.lit("x"), 5).alias("wide"))
    bucket = F.floor(F.col("id") / 100)
    for df in (row_number_within(rows, ["k"], ["id"], bucket), shift_within(rows, ["k"], ["id"], ["wide"], bucket)):
        plan = df.hint("merge")._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("Window")]
        assert above.count("Exchange") <= 1, plan  # the edges' own; the rows come from their window as they are


def test_landed_tables_are_zstd(spark):
    found = landed(spark.range(10).select("id"), "small")
    assert all(path.endswith(".zstd.parquet") for path, _, _ in files_under(spark, found.inputFiles()[0].rsplit("/", 1)[0]))
