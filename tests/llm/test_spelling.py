"""Spelling variants against a comparison of all pairs."""

import random
from pathlib import Path

import brute
import numpy as np
import pytest

from commitlens.llm import editscan, spelling as S

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def dense_words(seed, n=400, letters="abé", least=7, most=8):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))): rng.choice([2, 3, 25, 260, 2700])
            for _ in range(n)}


@pytest.mark.parametrize("letters", ["ab", "abcdefghéÿ"])
def test_scan_finds_all_pairs(letters):
    rng = random.Random(5)
    lists = [sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n)})
             for n in (60, 1, 0, 30, 90)]
    flat = [w for x in lists for w in x]
    first = np.array([k == 0 for x in lists for k in range(len(x))])
    number = [k for k, x in enumerate(lists) for _ in x]
    q, r = editscan.one_edit_pairs(*editscan.code_points(flat), first)
    want = {(a, b) for a in range(len(flat)) for b in range(len(flat))
            if number[a] == number[b] and brute.one_edit(flat[a], flat[b])}
    assert len(q) == len(want) and set(zip(q.tolist(), r.tolist())) == want


@pytest.mark.parametrize("bounds", [(2048, 1 << 18), (3, 1 << 18), (2048, 12)])
def test_forms_of_dense_words(spark, bounds):
    """Many neighbours, ties, insertions into runs of equal letters; with small lists every cut is taken."""
    counts = dense_words(3) | {"aaaaaaaa": 5, "aaaaaaa": 5, "aaaaaaaaa": 50, "baaaaaaa": 50, "x" * 300: 2, "x" * 301: 40}
    words = S.landed(spark.createDataFrame(list(counts.items()), "word string, n long"), "words")
    got = {r.word: (r.form, r.n, r.n_near, r.form_n) for r in S.nearest_forms(words, *bounds).collect()}
    want = {w: (f, n, k, fn) for w, (f, _, n, k, fn) in brute.variants(counts).items()}
    assert got == want and sum(k for _, _, k, _ in want.values()) > 500


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")
def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = brute.variant_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    want = brute.variants({w: counts[w] for w in sorted(counts)[:1500]})
    got = rows(S.spelling_variants(docs))
    assert {w: x[2] for w, x in got.items()} == counts
    part = S.landed(spark.createDataFrame([(w, x[2]) for w, x in want.items()], "word string, n long"), "words")
    assert {r.word: (r.form, r.n_near) for r in S.nearest_forms(part).collect()} == {
        w: (x[0], x[3]) for w, x in want.items()}
    assert any(x[0] for x in got.values()) and all(got[x[1]][0] is None for x in got.values())


def test_chains_of_forms(spark):
    """abcdefghi -> ...: four forms, each ten times its word."""
    chain = ["abcdefghijk", "abcdefghij", "abcdefghi", "abcdefgh", "abcdefg"]
    docs = [(None, " ".join([w] * (2 * 10 ** k))) for k, w in enumerate(chain)]
    got = rows(S.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute.variants(brute.variant_words(docs))
    assert {x[1] for x in got.values()} == {"abcdefg"}


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    docs = [*brute.odd_documents(), (20, "GrößeÄpfel größeÄpfel ××××××× " * 3, "de", "a", 1),
            (21, "straßenbahn1straßenbahn straßenbah", "de", "a", 1)]
    got = rows(S.spelling_variants(brute.frame(spark, docs, clash=clash)))
    assert got == brute.variants(brute.variant_words([(d[0], d[1]) for d in docs]))


def test_empty_table(spark):
    assert S.spelling_variants(brute.frame(spark, [])).collect() == []
