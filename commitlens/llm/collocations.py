"""Collocations by language: phrases of two and three words whose parts occur together more often than apart.

1. Each task turns its texts into blocks of one language: the block's distinct words with their counts, and its tokens as
   numbers of these words (0 where a phrase must not go on). The blocks are written once.
2. The dictionary is the words of all blocks that occur at least ten times; only they can be part of a candidate. It is
   numbered without gaps, so ids are as narrow as they can be.
3. The dictionary's ids come to the blocks by a join on the word, and a block's n-grams of known words are counted in
   counting quotient filters (:mod:`quotient`), one for each range of permuted values.
4. The filters of a range are merged over all blocks; what occurs at least ten times is read back from them as ids. The
   number of ranges follows the number of words, so a merge handles a bounded number of slots whatever the corpus' size. A
   block sends no filter for a range it has nothing in, so there are never more filters than distinct n-grams.
5. Counts of the parts are joined to the candidates, scores are exact decimals, and each language's best are ranked.

A language that holds most rows is as many blocks as its texts fill. Ranges are spread by the permutation, whatever the
n-grams are. Memory of a task: one block, or one range.

Results for odd input: a null text is empty; a null language is ``und``; repeated rows count again; a text longer than a
block is cut where phrases end; an empty table gives an empty result; only ``lang`` and ``text`` are read. Ties are broken
by phrase, so the result is one and the same at every layout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.llm import quotient
from commitlens.llm.common import arrow_map, binary_texts, landed

LEAST, TOP = 10, 2000
#: Parts of a language that are ranked by themselves first, so that its last ranking sees ``TOP`` rows of each at most.
PARTS = 32
#: Bytes of text in a block, and in all unfinished blocks of a task.
BLOCK_BYTES, HELD_BYTES = 4 << 20, 12 << 20
#: n-gram occurrences that the merge of a range stands for.
RANGE_GRAMS = 1 << 21
#: Phrase ends become a byte that UTF-8 never uses, so that it can be a word of its own.
END = b"\xff"
MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", END * 10 + b" ")

BLOCK = "lang string, words array<string>, counts array<long>, tokens binary"


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _cut(text: bytes, limit: int) -> Iterator[bytes]:
    """Parts of about ``limit`` bytes that end with a phrase; longer where no phrase ends."""
    start = 0
    while len(text) - start > limit:
        at = text.rfind(END, start, start + limit)
        at = at if at >= 0 else text.find(END, start + limit)
        if at < 0:
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def out(lang: str) -> pa.RecordBatch:
        numbers = _Numbers({END: 0})
        words = (b" " + END + b" ").join(held.pop(lang)).replace(END, b" " + END + b" ").split()
        tokens = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        counts = np.bincount(tokens, minlength=len(numbers)).astype(np.int64)
        del sizes[lang]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([[w.decode() for w in list(numbers)[1:]]], pa.list_(pa.string())),
             pa.array([counts[1:]], pa.list_(pa.int64())), pa.array([tokens.tobytes()], pa.binary())],
            ["lang", "words", "counts", "tokens"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), binary_texts(batch.column("text"))):
            lang = "und" if lang is None else lang
            for part in _cut(text.lower().translate(MARKS), BLOCK_BYTES):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                if sizes[lang] >= BLOCK_BYTES:
                    yield out(lang)
        while sum(sizes.values()) > HELD_BYTES:
            yield out(max(sizes, key=sizes.get))
    for lang in list(held):
        yield out(lang)


def word_blocks(docs: DataFrame) -> DataFrame:
    """The written blocks, numbered: ``(block, lang, words, counts, tokens)``."""
    blocks = arrow_map(docs.select("lang", "text"), _blocks, BLOCK)
    return landed(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "blocks")


def _word_rows(blocks: DataFrame) -> DataFrame:
    pairs = F.arrays_zip("words", "counts")
    return blocks.select("lang", F.explode(pairs).alias("w")).select("lang", F.col("w.words").alias("word"),
                                                                      F.col("w.counts").alias("n"))


def dictionary(blocks: DataFrame, least: int = LEAST) -> DataFrame:
    """``(id, lang, word, f)`` of the words with at least ``least`` occurrences, ids from 1 without gaps.

    Rows are numbered inside the partitions of a written table, behind the rows of the partitions before; the broadcast
    holds one row for each of these partitions.
    """
    counts = _word_rows(blocks).groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = landed(counts.select("lang", "word", "f", F.spark_partition_id().alias("part"), inside.alias("at")), "words")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    starts = sizes.select("part", before.alias("before"))
    return landed(rows.join(F.broadcast(starts), "part").select(
        (F.col("before") + F.col("at") + 1).alias("id"), "lang", "word", "f"), "dictionary")


def _grams(tokens: np.ndarray, layout: quotient.Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted, counted, permuted pairs and triples of adjacent known words (ids from 1; 0 ends a phrase)."""
    first, second = tokens[:-1], tokens[1:]
    two = (first > 0) & (second > 0)
    third = np.append(tokens[2:], np.uint64(0))[:len(second)]
    three = two & (third > 0)
    a, b = np.concatenate([first[two], first[three]]), np.concatenate([second[two], second[three]])
    c = np.concatenate([np.zeros(int(two.sum()), np.uint64), third[three]])
    left, right = layout.permute(*layout.pack(a, b, c))
    return quotient.add_up(left, right, np.ones(len(left), np.int64), layout.half)


def _count_block(layout: quotient.Layout):
    def count(blocks: pa.Table, known: pa.Table) -> pa.Table:
        numbers, filters = [], []
        at, ids = known.column("at").to_numpy(), known.column("id").to_numpy()
        for tokens in blocks.column("tokens").to_pylist():
            local = np.frombuffer(tokens, np.int32)
            table = np.zeros(max(int(local.max(initial=0)), int(at.max(initial=0))) + 1, np.uint64)
            table[at] = ids
            left, right, counts = _grams(table[local], layout) if len(local) > 1 else (np.zeros(0, np.uint64),) * 3
            ranges = layout.ranges(left)
            edges = np.append(np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])[:len(ranges)]), len(ranges))
            for a, b in zip(edges[:-1], edges[1:]):
                numbers.append(int(ranges[a]))
                filters.append(quotient.encode(layout, left[a:b], right[a:b], counts[a:b]))
        return pa.table([pa.array(numbers, pa.int64()), pa.array(filters, pa.binary())], names=["range", "filter"])
    return count


def ngram_filters(blocks: DataFrame, words: DataFrame, layout: quotient.Layout) -> DataFrame:
    """``(range, filter)``: the counting quotient filters of every block."""
    places = blocks.select("block", "lang", F.posexplode("words").alias("at", "word"))
    known = places.join(words.select("id", "lang", "word"), ["lang", "word"]).select(
        F.col("block").alias("of"), (F.col("at") + 1).alias("at"), "id")
    tokens = blocks.select("block", "tokens")
    return tokens.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        _count_block(layout), "range long, filter binary")


def _merge_range(layout: quotient.Layout, least: int):
    def merged(filters: pa.Table) -> pa.Table:
        number = filters.column("range")[0].as_py()
        left, right, counts = quotient.merge(layout, number, filters.column("filter").to_pylist())
        often = counts >= least
        ids = layout.unpack(*layout.restore(left[often], right[often]))
        return pa.table([*(pa.array(x.astype(np.int64)) for x in ids), pa.array(counts[often], pa.int64())],
                        names=["id1", "id2", "id3", "a"])
    return merged


def frequent_grams(filters: DataFrame, layout: quotient.Layout, least: int = LEAST) -> DataFrame:
    """``(id1, id2, id3, a)`` of the n-grams with at least ``least`` occurrences over all filters; id3 is 0 for pairs."""
    return filters.groupBy("range").applyInArrow(_merge_range(layout, least), "id1 long, id2 long, id3 long, a long")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact up to counts of 10^15."""
    wide = [x.cast("decimal(15,0)") for x in (a, left, right)]
    top = (wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", top, (wide[1] * wide[2]).cast("decimal(38,0)"))


def scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the candidates that no longer candidate stands for."""
    def word(k: int) -> DataFrame:
        return words.select(F.col("id").alias(f"id{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"),
                            *(["lang"] if k == 1 else []))

    def pair(a: str, b: str, name: str) -> DataFrame:
        return grams.where("id3 = 0").select(F.col("id1").alias(a), F.col("id2").alias(b), F.col("a").alias(name))

    triples = grams.where("id3 > 0")
    longer = triples.select("a", F.explode(F.array(F.struct(F.col("id1").alias("x"), F.col("id2").alias("y")),
                                                   F.struct(F.col("id2").alias("x"), F.col("id3").alias("y")))).alias("p"))
    longer = longer.groupBy(F.col("p.x").alias("id1"), F.col("p.y").alias("id2")).agg(F.max("a").alias("within"))
    two = grams.where("id3 = 0").join(longer, ["id1", "id2"], "left").where(
        "within is null or 100 * within < 50 * a").drop("within", "id3")
    two = two.join(word(1), "id1").join(word(2), "id2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    # A candidate triple occurs at least as rarely as its pairs, so both pairs are among the frequent ones.
    three = (triples.join(pair("id2", "id3", "tail"), ["id2", "id3"]).join(pair("id1", "id2", "head"), ["id1", "id2"])
             .join(word(1), "id1").join(word(2), "id2").join(word(3), "id3"))
    a = F.col("a")
    cuts = F.array(F.struct(_score(a, F.col("f1"), F.col("tail")).alias("score"), F.lit(1).alias("k"),
                            F.col("f1").alias("l"), F.col("tail").alias("r")),
                   F.struct(_score(a, F.col("head"), F.col("f3")).alias("score"), F.lit(2).alias("k"),
                            F.col("head").alias("l"), F.col("f3").alias("r")))
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.array_min(cuts).alias("cut"))
    return two.union(three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` best collocations of every language."""
    blocks = word_blocks(docs)
    words = dictionary(blocks, least)
    totals = landed(_word_rows(blocks).groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    known, everything = words.agg(F.max("id")).first()[0] or 0, totals.agg(F.sum("n")).first()[0] or 0
    width = max(known.bit_length(), 1)
    ranges = max(-(-2 * everything // RANGE_GRAMS) - 1, 0).bit_length()
    layout = quotient.Layout(width, min(ranges, -(-3 * width // 2)))
    grams = landed(frequent_grams(ngram_filters(blocks, words, layout), layout, least), "grams")
    ranked = scored(grams, words).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              "n", "score")
