"""Quotient filters and collocations against plain counting."""

import random
from collections import Counter
from pathlib import Path

import brute
import numpy as np
import pytest

from commitlens.llm import collocations as S, quotient as Q

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def rows(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("width", [1, 2, 5, 20, 21, 22, 32])
def test_permutation_can_be_inverted(width):
    rng = np.random.default_rng(width)
    layout = Q.Layout(width, min(3, width))
    ids = [rng.integers(0, 1 << width, 500, dtype=np.uint64) for _ in range(3)]
    halves = layout.permute(*layout.pack(*ids))
    assert all(int(h.max()) < 1 << layout.half for h in halves)
    for got, want in zip(layout.unpack(*layout.restore(*halves)), ids):
        assert (got == want).all()


@pytest.mark.parametrize("width,bits", [(1, 0), (3, 2), (20, 4), (30, 5)])
def test_filters_are_lossless_and_merge(width, bits):
    rng = np.random.default_rng(7)
    layout = Q.Layout(width, bits)
    want, shards = Counter(), []
    for size in (3000, 1, 400):
        ids = [rng.integers(0, min(1 << width, 9), size, dtype=np.uint64) for _ in range(3)]
        counts = rng.choice([1, 2, 254, 255, 70000], size).astype(np.int64)
        for *g, c in zip(*(x.tolist() for x in ids), counts.tolist()):
            want[tuple(g)] += c
        left, right, counts = Q.add_up(*layout.permute(*layout.pack(*ids)), counts, layout.half)
        part = layout.ranges(left)
        shards.append({int(k): Q.encode(layout, left[part == k], right[part == k], counts[part == k])
                       for k in np.unique(part)})
    got = Counter()
    for k in {k for s in shards for k in s}:
        left, right, counts = Q.merge(layout, k, [s[k] for s in shards if k in s])
        order = list(zip(left.tolist(), right.tolist()))
        assert order == sorted(set(order))
        got.update(dict(zip(zip(*(x.tolist() for x in layout.unpack(*layout.restore(left, right)))), counts.tolist())))
    assert got == want


def test_filters_are_compact():
    """100,000 n-grams of 60 bits: 44 bits of remainder in 7 bytes, a counter, and three bits of structure."""
    rng = np.random.default_rng(1)
    layout = Q.Layout(20, 0)
    left, right = (rng.integers(0, 1 << 30, 100_000, dtype=np.uint64) for _ in range(2))
    left, right, counts = Q.add_up(left, right, np.ones(100_000, np.int64), 30)
    assert len(Q.encode(layout, left, right, counts)) < 7.5 * len(left)


def phrases(seed, n, vocabulary=12):
    rng = random.Random(seed)
    return "".join(f"W{int(vocabulary * rng.random() ** 2)}{rng.choice([' '] * 12 + ['  ', chr(9), '. ', ',', chr(10)])}"
                   for _ in range(n))


@pytest.mark.parametrize("limits", [(8 << 20, 1 << 22), (50, 64)])
def test_against_plain_counts(spark, monkeypatch, limits):
    """Several languages, a null one, long texts; small blocks and many ranges give the same rows."""
    monkeypatch.setattr(S, "BLOCK_BYTES", limits[0])
    monkeypatch.setattr(S, "RANGE_GRAMS", limits[1])
    docs = [("en", phrases(1, 1500)), ("en", phrases(2, 700)), (None, phrases(3, 800)), ("und", phrases(4, 10)),
            ("de", "Ärger über Öl " * 15), ("fr", "a b c. " * 9), ("fr", "a b c " * 3), ("xx", "")]
    want = sorted(brute.collocations(docs))
    got = rows(S.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(3)))
    assert got == want and len({r[0] for r in want}) == 4
    assert rows(S.collocations(spark.createDataFrame(docs, "lang string, text string"), top=5)) == sorted(
        brute.collocations(docs, top=5))


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_001
    row = spark.createDataFrame([(big, big + 1, big + 7)], "a long, l long, r long")
    got = row.select(S._score(*(row[c] for c in "alr")).alias("s")).first().s
    assert got == 1_000_000 * big * big // ((big + 1) * (big + 7))


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    docs = brute.odd_documents()
    assert rows(S.collocations(brute.frame(spark, docs, clash=clash))) == sorted(
        brute.collocations([(d[2], d[1]) for d in docs]))


def test_empty_tables(spark):
    for docs in ([], [(1, None, None, None, None)], [(1, "one. two", "en", "a", 1)]):
        assert rows(S.collocations(brute.frame(spark, docs))) == []


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")
def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(brute.collocations([(r.lang, r.text) for r in docs.select("lang", "text").collect()]))
    assert want and rows(S.collocations(docs)) == want
