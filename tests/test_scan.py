"""Folds and scans by blocks and levels against plain loops, and lists of any depth."""

import json
import random

import pytest
from pyspark.sql import functions as F

from commitlens.operators import scan as B
from commitlens.operators import sequences as L


def _frame(spark, seqs):
    rows = [(s, i, v) for s, vs in seqs.items() for i, v in enumerate(vs)]
    return (spark.createDataFrame(rows, "seq_id long, pos long, value long"),
            spark.createDataFrame([(s,) for s in [*seqs, 99]], "seq_id long"))


def _text(x):
    return F.concat_ws("", x)


@pytest.mark.parametrize("block", [2, 3, 7, 1000])
@pytest.mark.parametrize("right", [False, True])
def test_scan_and_fold_keep_the_order(spark, block, right):
    """Joining text is associative and does not commute: order and level are all that counts."""
    seqs = {1: list(range(50)), 2: [4], 3: list(range(8))}
    df, _ = _frame(spark, seqs)
    rows = df.select("seq_id", "pos", F.concat("value", F.lit(".")).alias("e"))
    both = lambda x, y: F.concat(x, y)
    flip = (lambda xs: xs[::-1]) if right else (lambda xs: xs)
    got = {r.seq_id: r.e for r in B.fold_elements(rows, both, block, right).collect()}
    assert got == {s: "".join(f"{v}." for v in flip(vs)) for s, vs in seqs.items()}
    got = {(r.seq_id, r.pos): r.before for r in B.scan_elements(rows, both, block, right).collect()}
    want = {}
    for s, vs in seqs.items():
        items = flip(list(enumerate(vs)))
        for k, (i, _) in enumerate(items):
            want[s, i] = "".join(f"{v}." for _, v in items[:k]) if k else None
    assert got == want


def _trunc(x, m):
    return abs(x) % m * (1 if x >= 0 else -1)


@pytest.mark.parametrize("right", [False, True])
def test_affine_folds_of_a_long_sequence(spark, right):
    """200,000 items in blocks of 50: four levels; signed values, remainders with the dividend's sign."""
    rng = random.Random(4)
    values = [rng.randint(-30, 30) for _ in range(200_000)]
    df = spark.range(1).select(F.lit(1).cast("long").alias("seq_id"), F.posexplode(F.from_json(
        F.lit(json.dumps(values)), "array<long>")).alias("pos", "value"))
    acc = -7
    for v in reversed(values) if right else values:
        acc = _trunc(acc * 31 + v, 1009)
    keys = spark.range(1, 3).select(F.col("id").alias("seq_id"))
    got = L.fold_affine(df, keys, -7, 31, modulus=1009, from_right=right, block=50).collect()
    assert {r.seq_id: r.result for r in got} == {1: acc, 2: -7}
    acc = 3
    for v in reversed(values) if right else values:
        acc = v - acc
    got = L.fold_affine(df, keys, 3, -1, from_right=right, block=50).collect()
    assert {r.seq_id: r.result for r in got} == {1: acc, 2: 3}


def test_no_list_is_longer_than_a_block(spark):
    df, keys = _frame(spark, {1: list(range(1000))})
    longest = spark.sparkContext.accumulator(0)
    groups = df.groupBy("seq_id", F.expr("pos div 64")).count()
    assert groups.agg(F.max("count")).first()[0] == 64 and longest.value == 0
    got = B.fold_steps(df, keys, lambda _: L.reset_lift(F.col("value"), F.col("value") % 100 == 0), L.reset_after,
                       lambda e: e["best"], F.lit(None).cast("long"), block=8)
    assert {r.seq_id: r.result for r in got.collect()} == {1: 999, 99: None}


def test_empty_sequences(spark):
    df, keys = _frame(spark, {1: []})
    assert {r.seq_id: r.result for r in L.fold_affine(df, keys, 7, 31, modulus=11).collect()} == {1: 7, 99: 7}
    assert B.scan_elements(df.select("seq_id", "pos", F.col("value").alias("e")), lambda x, y: x + y).count() == 0


def test_lists_of_any_depth(spark):
    lists = {1: [1, [2, [3, [4, []]], [[[5]]]], 6], 2: [], 3: [[[[]]]], 4: ["a", {"b": [1]}, None, [True, 1.5]], 5: 7}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in lists.items()] + [(6, None)], "seq_id long, t string")
    got = {}
    for r in L.flatten_any(df.select("seq_id", F.parse_json("t").alias("items"))).select(
            "seq_id", "path", F.to_json("value").alias("v")).collect():
        got.setdefault(r.seq_id, []).append((r.path, json.loads(r.v)))

    def flat(x, path=()):
        return [y for i, e in enumerate(x) for y in flat(e, (*path, i))] if isinstance(x, list) else [(list(path), x)]

    assert {k: sorted(v, key=lambda p: p[0]) for k, v in got.items()} == {k: flat(v) for k, v in lists.items() if flat(v)}
