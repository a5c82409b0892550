"""The external shuffle: law, slots, whole rows, reproducibility, uniformity and odd inputs."""

import zlib
from collections import Counter

import brute
import pytest

from commitlens.llm import sharding as S


def by_shard(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    return slots


def check_law(rows, shards):
    slots = by_shard(rows)
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows_and_digest(spark, clash):
    docs = brute.odd_documents()
    got = S.shard_rows(brute.frame(spark, docs, clash=clash)).collect()
    check_law(got, 8)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "rows", None) for i, t, *_ in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in got) == want


def test_empty_table_and_few_rows(spark):
    assert S.shard_rows(brute.frame(spark, [])).collect() == []
    few = S.shard_rows(brute.frame(spark, brute.odd_documents()[:3])).collect()
    check_law(few, 8)
    assert sorted(r.shard for r in few) == [0, 1, 2]


def test_many_buckets_keep_every_row_and_repeat(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text", "'all' as source")
    rows = [S.shuffled_shards(docs, 7, bucket_bytes=4000).select("doc.doc_id", "doc.source", "shard", "slot").collect()
            for _ in range(2)]
    check_law(rows[0], 7)
    assert sorted(r.doc_id for r in rows[0]) == list(range(5000))
    assert sorted(rows[0]) == sorted(rows[1])
    other = S.shuffled_shards(docs, 7, seed=1, bucket_bytes=4000).select("doc.doc_id", "doc.source", "shard", "slot")
    assert sorted(rows[0]) != sorted(other.collect())


def test_places_are_uniform(spark):
    """Where rows come from and where they go are independent, and neighbours part."""
    docs = spark.range(20_000).selectExpr("id as doc_id", "'' as text")
    order = [r.doc_id for r in S.shuffled_shards(docs, 1).orderBy("slot").select("doc.doc_id").collect()]
    tenths = Counter((p * 10 // 20_000, i * 10 // 20_000) for p, i in enumerate(order))
    chi = sum((tenths[a, b] - 200) ** 2 / 200 for a in range(10) for b in range(10))
    assert chi < 140                                      # 81 degrees of freedom: 99.99 % quantile is 138
    assert sum(b - a == 1 for a, b in zip(order, order[1:])) < 10


def test_written_shards(spark, tmp_path):
    docs = brute.frame(spark, brute.odd_documents())
    S.write_shards(docs, f"{tmp_path}/out", shards=3)
    back = spark.read.parquet(f"{tmp_path}/out")
    check_law(back.collect(), 3)
    assert Counter(r.doc for r in back.select("doc").collect()) == Counter(docs.collect())
