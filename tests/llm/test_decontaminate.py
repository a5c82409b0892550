"""Benchmark leaks: planted passages with substitutions are found, clean documents are left alone."""

import itertools
import random

import brute
from commitlens.llm import decontaminate

ITEMS = "item_id long, text string"


def planted(seed=3):
    rng = random.Random(seed)
    items = [(i, brute.prose(n, 1000 + i, 3000)) for i, n in enumerate([12, 16, 24, 40, 60, 300, 9, 8, 7, 1])]
    docs, truth = [], set()
    for d in range(120):
        body = brute.prose(rng.randrange(20, 400), 5000 + d, 3000).split()
        if d % 3 == 0:
            item, text = rng.choice(items[:8])
            words = text.split()
            if len(words) > 60:
                at = rng.randrange(len(words) - 40)
                words = words[at:at + 40]
            if d % 2 and len(words) >= 24:
                for at in rng.sample(range(len(words)), len(words) // 10):
                    words[at] = "swapped"
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in words]
            truth.add((d, item))
        docs.append((d, " ".join(body)))
    return docs, items, truth


def test_planted_passages(spark):
    docs, items, truth = planted()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    for bits in (decontaminate.FILTER_BITS, 8):
        got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench, bits=bits).collect()}
        assert got == truth


def test_verified_window(spark):
    item = brute.prose(40, 1, 9000)
    words = item.split()
    words[20] = "other"
    df = spark.createDataFrame([(1, "x y z " + " ".join(words)), (2, " ".join(words[::-1]))], "doc_id long, text string")
    r = decontaminate.leaks(df, spark.createDataFrame([(9, item)], ITEMS)).collect()
    assert [(x.doc_id, x.item_id, x.doc_at - x.item_at, x.n_window) for x in r] == [(1, 9, 3, 20)]
    assert r[0].n_equal >= 19


def test_odd_input(spark):
    odd = brute.odd_documents()
    bench = spark.createDataFrame([(1, brute.prose(120, 2)), (2, None), (3, ""), (None, "one two three four five six"),
                                   (4, brute.prose(120, 2))], ITEMS)
    plain = sorted(map(repr, decontaminate.leaks(brute.frame(spark, odd), bench).collect()))
    clash = decontaminate.leaks(brute.frame(spark, odd, clash=True).repartition(3), bench.selectExpr("*", "1 as words"))
    assert sorted(map(repr, clash.collect())) == plain and len(plain) == 8
    assert decontaminate.leaks(brute.frame(spark, []), bench).count() == 0
    assert decontaminate.leaks(brute.frame(spark, odd), bench.limit(0)).count() == 0


def test_case_and_punctuation_do_not_hide_a_leak(spark):
    item = "Éai éonleeau pour an éonqueê aivi ai, éenaitreoiaux. Straße èenreré le oueuxoi les laèèleré ouantre eauréon"
    df = spark.createDataFrame([(1, "x. " + "!! ".join(item.upper().split()) + " y"), (2, " | ".join(item.split()))],
                               "doc_id long, text string")
    got = decontaminate.leaks(df, spark.createDataFrame([(3, item)], ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 3), (2, 3)]


def test_passages_cut_off_by_the_document(spark):
    item = [f"i{n}" for n in range(40)]
    other = [f"o{n}" for n in range(60)]
    docs = [other + item[:19], item[-19:] + other, other + item[:13], item[-13:] + other,
            other[:5] + item[:13], item[10:29], item[10:22], item[3:16], other + item[:12], item[-12:] + other,
            other[:7] + item[:12], other[:30]]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: (r.doc_at, r.item_at, r.n_window, r.n_equal)
           for r in decontaminate.leaks(df, spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()}
    assert got == {0: (60, 0, 19, 19), 1: (0, 21, 19, 19), 2: (60, 0, 13, 13), 3: (0, 27, 13, 13), 4: (5, 0, 13, 13),
                   5: (0, 10, 19, 19), 6: (0, 10, 12, 12), 7: (0, 3, 13, 13)}


def test_every_pattern_that_verification_accepts_holds_a_seed():
    masks = [(int(m, 2), len(m)) for m in decontaminate.MASKS]
    for n in range(decontaminate.LEAST_WORDS, decontaminate.OVERLAP + 1):
        fits = [m << at for m, span in masks for at in range(n - span + 1)]
        for equal in itertools.combinations(range(n), -(-n * decontaminate.PERCENT // 100)):
            pattern = sum(1 << i for i in equal)
            assert any(pattern & m == m for m in fits), (n, equal)


def test_passages_at_the_threshold_are_found(spark):
    rng = random.Random(8)
    items, docs = [], []
    for i, n in enumerate([8, 9, 10, 11, 12, 13, 15, 17, 19] * 4 + [20] * 60):
        words = [f"i{i}x{j}" for j in range(n)]
        items.append((i, " ".join(words)))
        for at in rng.sample(range(n), n - -(-n * decontaminate.PERCENT // 100)):
            words[at] = f"s{i}x{at}"
        docs.append((i, " ".join([f"a{i}x{j}" for j in range(30)] + words + [f"b{i}x{j}" for j in range(30)])))
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i, _ in docs]


def test_short_items_and_documents_are_compared_exactly(spark):
    items = [(7, "Seven words that nobody else would say"), (5, "five words in this order"), (3, "just three words"),
             (1, "yes"), (40, " ".join(f"i{n}" for n in range(40)))]
    tail = " and then a clean text goes on for some more words than that"
    docs = [(1, "x y z SEVEN words, that nobody else would say" + tail), (2, "seven words that nobody other would say" + tail),
            (3, "Just three words!"), (4, "just three words" + tail), (5, "Yes."), (6, "yes" + tail), (7, "yes yes"),
            (8, "i7 i8 i9 i10 i11 i12"), (9, "i7 i8 i9 i10"), (10, "i7 i8 i9 x10 i11 i12"), (11, "five words in this order"),
            (12, "ah five words in this order"), (13, "words that nobody else would"), (14, "five words in that order")]
    want = {(1, 7): 7, (3, 3): 3, (5, 1): 1, (8, 40): 6, (11, 5): 5, (12, 5): 5, (13, 7): 5}
    assert brute.leaks(docs, items) == want
    bench = spark.createDataFrame(items, ITEMS)
    for bits in (decontaminate.FILTER_BITS, 8):
        got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench, bits=bits).collect()
        assert {(r.doc_id, r.item_id): r.n_equal for r in got} == want and len(got) == len(want)


def test_against_all_windows_of_all_pairs(spark):
    docs, items, _ = planted(9)
    docs = docs[:45] + [(1000 + i, " ".join(t.split()[:n])) for i, (_, t) in enumerate(items) for n in (3, 6, 11)]
    docs = list(dict(docs).items()) + [(2000 + i, brute.prose(60, 40 + i, 12)) for i in range(12)]
    items += [(100 + i, brute.prose(n, 70 + i, 12)) for i, n in enumerate([3, 6, 9, 30])]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id): r.n_equal for r in got} == brute.leaks(docs, items)
