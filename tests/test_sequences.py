"""Ordered-sequence questions on hand-made sequences: empty, single, all NULL, no match, more matches than n."""

from pyspark.sql import functions as F

from commitlens.operators import sequences as L
from fixtures import rows

SEQS = {1: [], 2: [7], 3: [None, None], 4: [30, 1, 40, 2, 50, 60, 26, 27, 28, 29, 31, 32, 33, 34],
        5: [10, 3, 4, 3], 6: [0]}


def _df(spark, seqs=SEQS):
    data = [(k, i, v) for k, vs in seqs.items() for i, v in enumerate(vs)]
    s = spark.createDataFrame(data, "seq_id long, pos long, value long")
    keys = spark.createDataFrame([(k,) for k in seqs], "seq_id long")
    return s, keys


def test_basic_sequence_ops(spark):
    s, k = _df(spark)
    assert rows(L.first_n(s, 1), "seq_id", "value") == [(2, 7), (3, None), (4, 30), (5, 10), (6, 0)]
    assert dict(rows(L.max_value(s, k))) == {1: -2147483648, 2: 7, 3: -2147483648, 4: 60, 5: 10, 6: 0}
    assert dict(rows(L.optional_sum(s, k))) == {1: 0, 2: 7, 3: 0, 4: 423, 5: 20, 6: 0}
    assert dict(rows(L.first_divisible(s, k, 2))) == {1: None, 2: None, 3: None, 4: 30, 5: 10, 6: 0}
    assert dict(rows(L.last_elem(s, k))) == {1: None, 2: 7, 3: None, 4: 34, 5: 3, 6: 0}
    assert dict(rows(L.for_all(s, k, lambda v: v > 0))) == {1: True, 2: True, 3: True, 4: True, 5: True, 6: False}


def test_positional_ops(spark):
    s, k = _df(spark)
    assert [r.value for r in L.every_other_match(s, lambda v: v > 25).where("seq_id = 4").orderBy("pos").collect()] == \
        [30, 50, 26, 28, 31, 33]
    assert dict(rows(L.first_n_above_sum(s, k, 25, 10))) == {1: 0, 2: 0, 3: 0, 4: 30 + 40 + 50 + 60 + 26 + 27 + 28 + 29 + 31 + 32, 5: 0, 6: 0}
    assert dict(rows(L.custom_average(s, 2, 2))) == {2: 7, 4: 35, 5: 6}
    assert rows(L.head_sums_tail(s)) == [(5, 4)]
    assert rows(L.only_even(s).where("seq_id = 5")) == [(5, 0, 10), (5, 1, 4)]
    assert [r.value for r in L.twice(s).where("seq_id = 5").orderBy("pos").collect()] == [10, 10, 3, 3, 4, 4, 3, 3]
    app = L.append(s.where("seq_id = 5"), s.where("seq_id in (2, 5)"))
    assert [(r.seq_id, r.value) for r in app.orderBy("seq_id", "pos").collect()] == [
        (2, 7), (5, 10), (5, 3), (5, 4), (5, 3), (5, 10), (5, 3), (5, 4), (5, 3)]
    z = L.zip_sequences(s, s.where("pos < 2"))
    assert rows(z.where("seq_id = 4")) == [(4, 0, 30, 30), (4, 1, 1, 1)]


def test_folds_ranges_strings(spark):
    s, k = _df(spark)
    left = dict(rows(L.fold_left(s, k, F.lit(0).cast("long"), lambda acc, x: acc * 10 + x)))
    assert left[5] == 10343 and left[1] == 0
    right = dict(rows(L.fold_right(s.where("seq_id = 5"), k.where("seq_id = 5"), F.lit(0).cast("long"),
                                   lambda x, acc: x - acc)))
    assert right[5] == 10 - (3 - (4 - (3 - 0)))
    r = spark.createDataFrame([(1, 2, 4), (2, 5, 5), (3, 6, 1)], "id long, a long, b long")
    assert rows(L.int_range(r, "a", "b"), "id", "value") == [(1, 2), (1, 3), (1, 4), (2, 5)]
    words = spark.createDataFrame([(1, 0, "abc"), (1, 1, "de")], "seq_id long, pos long, value string")
    assert rows(L.drunk_words(words)) == [(1, 0, "ed"), (1, 1, "cba")]
    nested = spark.createDataFrame([(1, [[1, 2], [], [3]])], "seq_id long, items array<array<long>>")
    assert rows(L.flatten_nested(nested), "pos", "value") == [(0, 1), (1, 2), (2, 3)]


def test_passing_students_d11(spark):
    g = {1: [6, 6, 5, 6], 2: [6, 6, 6, 5, 6, 6, 6, 6, 6, 6], 3: [10, 10, 3], 4: []}
    data = [(k, i, v) for k, vs in g.items() for i, v in enumerate(vs)]
    grades = spark.createDataFrame(data, "seq_id long, pos long, value long")
    # student 1: mean 5.75 exactly -> passes; 2: 5.9 -> passes; 3: a 3 among 10s -> fails; 4: no grades
    assert rows(L.passing_students(grades)) == [(2,)]


def test_affine_fold_equals_generic_fold(spark):
    import random

    import pytest
    random.seed(3)
    seqs = {1: [random.randint(-100, 100) for _ in range(500)], 2: [-5, 3, -9], 3: [], 4: [0] * 80, 5: [1, -1, 0, 0, 7]}
    s, k = _df(spark, seqs)
    for init in (7, -7, 0, -10 ** 9):
        start = F.lit(init).cast("long")
        left = dict(rows(L.fold_left(s, k, start, lambda acc, x: (acc * 31 + x) % 1003)))
        right = dict(rows(L.fold_right(s, k, start, lambda x, acc: (acc * -3 + x) % 1003)))
        minus = dict(rows(L.fold_right(s, k, start, lambda x, acc: x - acc)))
        for block in (1, 3, 64, L.BLOCK):
            assert dict(rows(L.fold_affine(s, k, init, 31, 1003, block=block))) == left
            assert dict(rows(L.fold_affine(s, k, init, -3, 1003, from_right=True, block=block))) == right
            assert dict(rows(L.fold_affine(s, k, init, -1, from_right=True, block=block))) == minus
    with pytest.raises(ValueError):
        L.fold_affine(s, k, 0, 3)
    with pytest.raises(ValueError):
        L.fold_affine(s, k, 0, 1 << 40, 1 << 30)


def test_flatten_depths_and_long_ranges(spark):
    deep = spark.createDataFrame([(1, [[[1], [2, 3]], [], [[], [4]]])], "seq_id long, items array<array<array<long>>>")
    assert rows(L.flatten_nested(deep, depth=3), "pos", "value") == [(0, 1), (1, 2), (2, 3), (3, 4)]
    levels = spark.createDataFrame([(1, 0, 0, 5, 9), (1, 0, 1, 0, 8), (1, 2, 0, 0, 7), (2, 0, 0, 0, 1)],
                                   "seq_id long, a long, b long, c long, value long")
    flat = L.flatten_levels(levels, ["a", "b", "c"], F.col("a"))
    assert rows(flat) == [(1, 0, 9), (1, 1, 8), (1, 2, 7), (2, 0, 1)]
    r = L.int_range(spark.createDataFrame([(1, -3, 200_000)], "id long, a long, b long"), "a", "b")
    assert r.agg(F.count("value"), F.min("value"), F.max("value"), F.countDistinct("value")).first()[:] == (
        200_004, -3, 200_000, 200_004)
