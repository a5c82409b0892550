"""The pipeline on the smallest tables: every stage against brute force or its own contract."""

import sys
from pathlib import Path

import pytest

import brute

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")


def test_stages(spark):
    import corpus_pipeline as P
    from commitlens.llm import decontaminate, pieces

    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "redact", "encode"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for name, stage in P.STAGES:
        steps.append(P.landed(stage(spark, steps[-1], SF), name))
        if name != "encode":
            assert steps[-1].columns == docs.columns
    texts = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in steps[:-1]]
    assert texts[1] == {i: t for i, t in texts[0].items() if not brute.quality(t)[5]}
    copies = brute.components(list(texts[1].items()), percent=P.NEAR_PERCENT)
    assert texts[2] == {i: t for i, t in texts[1].items() if copies[i][2]}
    leaked = {r.doc_id for r in decontaminate.leaks(steps[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaked and texts[3] == {i: t for i, t in texts[2].items() if i not in leaked}
    assert texts[4].keys() == texts[3].keys()
    changed = {i for i in texts[3] if texts[3][i] != texts[4][i]}
    assert changed >= {i for i, t in texts[3].items() if any(brute.personal(t)[:4])}
    assert not any(any(brute.personal(t)[:4]) for t in texts[4].values())
    import public_tokenizers
    back = pieces.decode_pieces(steps[5], public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: r.text for r in back.collect()} == texts[4]
    assert P.run(spark, SF).count() == len(texts[4])


def test_odd_rows_pass_through_every_stage(spark):
    import corpus_pipeline as P

    for docs in (brute.frame(spark, brute.odd_documents()), brute.frame(spark, [])):
        n = docs.count()
        for name, stage in P.STAGES:
            out = P.landed(stage(spark, docs, SF), name)
            assert out.count() <= n
            if name != "encode":
                assert out.columns == docs.columns
        assert out.count() == n


def test_near_copies_at_80_percent_go(spark):
    import corpus_pipeline as P

    words = brute.prose(200, 11, 10 ** 6).split()
    docs = [(1, " ".join(words)), (2, " ".join([*words[:180], *(f"n{i}" for i in range(20))])),
            (3, " ".join([*words[:172], *(f"m{i}" for i in range(28))]))]
    share = [len(brute.shingles(docs[0][1]) & brute.shingles(t)) / len(brute.shingles(docs[0][1]) | brute.shingles(t))
             for _, t in docs[1:]]
    assert 0.8 <= share[0] < 0.85 and share[1] < 0.8
    assert {r.doc_id for r in P.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), SF)
            .collect()} == {1, 3}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute.components([(r.doc_id, r.text) for r in table.collect()], percent=80)
    assert {r.doc_id for r in P.near_dedup(spark, table, SF).collect()} == {i for i, x in want.items() if x[2]}


def test_one_row_of_each_group_stays(spark):
    import corpus_pipeline as P

    copy, alone, other = (brute.prose(60, s, 10 ** 6) for s in (31, 32, 33))
    docs = [(4, copy, "first"), (4, copy, "again"), (None, copy, "x"), (9, copy, "x"), (9, alone, "own text"),
            (None, other, "p"), (None, other, "p"), (None, None, "empty"), (None, "", "empty")]
    df = spark.createDataFrame(docs, "doc_id long, text string, row string")
    got = [(r.doc_id, r.text, r.row) for r in P.near_dedup(spark, df.coalesce(1), SF).collect()]
    assert sorted(got, key=str) == sorted([docs[0], docs[4], docs[5], docs[7], docs[8]], key=str)


def test_leaks_are_judged_by_row(spark):
    """Null and repeated ids: a leaking row goes, a clean row of the same id stays."""
    import corpus_pipeline as P

    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(2).collect()
    clean = brute.prose(60, 41, 10 ** 6)
    docs = [(None, f"before {items[0].text} after", "leak"), (7, items[1].text, "leak"), (7, clean, "clean"),
            (None, clean, "clean"), (8, None, "clean"), (8, "", "clean")]
    df = spark.createDataFrame(docs, "doc_id long, text string, `ro.w` string")
    got = [tuple(r) for r in P.decontaminate(spark, df, SF).collect()]
    assert sorted(got, key=str) == sorted((d for d in docs if d[2] == "clean"), key=str)


def test_awkward_column_names_pass(spark):
    import corpus_pipeline as P

    docs = brute.frame(spark, brute.odd_documents()).selectExpr("*", "'x' as `a.b`", "'y' as `row.text`", "'z' as `c``d`")
    for name, stage in P.STAGES[:-1]:
        out = P.landed(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and {r["a.b"] for r in out.collect()} <= {"x"}
