"""Operator 2, benchmark decontamination by spaced-seed hashing.

A mask selects some positions of a window of words and ignores the others, so a window with substituted words still
hashes alike under a mask that ignores them. All benchmark windows are hashed under every mask. A Bloom filter over
these hashes, of a fixed size whatever the benchmark's, tells each document's windows that may match; only those leave
the scan, with the stretch of word hashes around them. They are joined to the benchmark hashes exactly, hits are grouped
by (stretch, item, diagonal), and each diagonal is verified: the best window of ``overlap`` words (the whole item or the
whole document if that is shorter) must agree in at least ``percent`` of its positions. A window may hang over the
document's start or end; the words that are cut off count as different. Items and documents of fewer than ``LEAST_WORDS``
words allow no substitution: the whole of them must occur, word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import (arrow_map, binary_texts, byte_chunks, landed, odd_constants,
                                   stream_groups, word_hashes)

WORD = re.compile(r"\w+")
#: Masks of weight 5 (1: compared), found by a greedy search; tests go through every pattern that they must fit.
MASKS = ("111011", "11001011", "1101000101", "10000100111", "11111", "110100101", "110111", "11010101", "11100011",
         "101111", "110010011", "101001101", "101100011", "111101", "110001101", "1100001011", "101010101", "100011011")
SPAN = max(map(len, MASKS))
#: Items and documents shorter than a window are compared as a whole; below this many words they must agree exactly.
LEAST_WORDS = 8
#: An item of fewer words is a phrase that any text may use: it leaks only into a document that holds nothing else.
PHRASE_WORDS = 5
OVERLAP, PERCENT = 20, 65
FILTER_BITS = 26
#: Windows hashed at once; their products stay in the processor's cache.
BLOCK_WORDS = 1 << 14


def _normal(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words (runs of letters, digits and underscores, case folded), and each text's offsets.
    Punctuation, symbols and the case of any script make no difference."""
    words: list[str] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words += WORD.findall(t.decode().casefold())
        bounds[i + 1] = len(words)
    return word_hashes(words), bounds


def _seeds(h: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(at, span, hashes)`` of all windows of ``h`` under every mask, in blocks: hash ``i`` is of the window at
    ``at + i``. Sums of products with odd constants; word hashes are mixed already."""
    mult, marks = odd_constants(SPAN, 100), odd_constants(len(MASKS), 101)
    for at in range(0, len(h), BLOCK_WORDS):
        part = h[at:at + BLOCK_WORDS + SPAN - 1]
        each = [part * m for m in mult]
        for mask, mark in zip(MASKS, marks):
            n = min(BLOCK_WORDS, len(part) - len(mask) + 1)
            if n > 0:
                total = np.full(n, mark, np.uint64)
                for j, c in enumerate(mask):
                    if c == "1":
                        total += each[j][j:j + n]
                yield at, len(mask), total


def _whole(h: np.ndarray) -> np.ndarray:
    """The seed of a text of 1 to ``PHRASE_WORDS - 1`` words, taken as a whole; none for any other."""
    if not 0 < len(h) < PHRASE_WORDS:
        return np.zeros(0, np.uint64)
    return odd_constants(PHRASE_WORDS, 102)[len(h):len(h) + 1] + (h * odd_constants(len(h), 103)).sum(keepdims=True)


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """``(hash, item_id, at)``: every window of every item under every mask it can carry, or a short item's own seed."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), binary_texts(batch.column(1))
            for item, text in zip(ids, texts):
                h, _ = _normal([text])
                each = [(at, s) for at, _, s in _seeds(h)] if len(h) >= PHRASE_WORDS else [(0, _whole(h))]
                if len(h):
                    s = np.concatenate([s for _, s in each]).view(np.int64)
                    spots = np.concatenate([np.arange(at, at + len(s)) for at, s in each])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s), pa.array([item] * len(s), pa.int64()), pa.array(spots)],
                        names=["hash", "item_id", "at"])
    return arrow_map(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")),
        run, "hash long, item_id long, at long")


def _item_words(items: DataFrame) -> DataFrame:
    """``(item_id, n_words, words)``; words as packed hashes."""
    def run(batches):
        for batch in batches:
            each = [_normal([t])[0] for t in binary_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(h) for h in each], pa.int64()),
                 pa.array([h.tobytes() for h in each], pa.binary())], names=["item_id", "n_words", "words"])
    return arrow_map(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")),
        run, "item_id long, n_words long, words binary")


def bloom_bytes(seeds: DataFrame, bits: int) -> bytes:
    """A Bloom filter with two bits per hash; the driver gets at most ``2^bits / 64`` rows, however many hashes."""
    low = F.shiftrightunsigned("hash", 64 - bits)
    spots = seeds.select(F.explode(F.array(low, F.pmod("hash", F.lit(1 << bits)))).alias("b"))
    words = spots.groupBy(F.shiftright("b", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(b & 63))")).alias("v"))
    table = np.zeros((1 << bits) // 64, np.int64)
    rows = words.toArrow()
    table[rows.column("w").to_numpy()] = rows.column("v").to_numpy()
    return table.tobytes()


def _maybe(hashes: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    def bit(b):
        return (table[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1)
    first = bit(hashes >> np.uint64(64 - bits)) == 1
    hit = np.flatnonzero(first)
    return hit[bit(hashes[hit] & np.uint64((1 << bits) - 1)) == 1]


def stretches(docs: DataFrame, bloom: bytes, bits: int, reach: int) -> DataFrame:
    """``(row, doc_id, begin, words, hits)`` for the parts of documents where windows pass the filter; hits are
    ``(hash, at)`` with ``at`` the position in the document. Overlapping surroundings of hits are one stretch."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        table = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), binary_texts(batch.column(1))
            rows = []
            for a, b in byte_chunks(texts):
                h, bounds = _normal(texts[a:b])
                if not len(h):
                    continue
                at, seed, span = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for first, width, s in _seeds(h):
                    hit = _maybe(s, table, bits)
                    at.append(first + hit)
                    seed.append(s[hit])
                    span.append(np.full(len(hit), width))
                for d in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < PHRASE_WORDS)):
                    s = _whole(h[bounds[d]:bounds[d + 1]])
                    hit = _maybe(s, table, bits)
                    at.append(bounds[d] + hit)
                    seed.append(s[hit])
                    span.append(np.ones(len(hit), np.int64))
                at, seed, span = np.concatenate(at), np.concatenate(seed), np.concatenate(span)
                doc = np.searchsorted(bounds, at, "right") - 1
                inside = at + span <= bounds[doc + 1]
                order = np.lexsort((at[inside], doc[inside]))
                at, seed, span, doc = (x[inside][order] for x in (at, seed, span, doc))
                if not len(at):
                    continue
                begin = np.maximum(at - reach, bounds[doc])
                end = np.minimum(at + SPAN + reach, bounds[doc + 1])
                new = np.append(True, (doc[1:] != doc[:-1]) | (begin[1:] > np.maximum.accumulate(end)[:-1]))
                cuts = np.append(np.flatnonzero(new), len(at))
                for i, j in zip(cuts[:-1], cuts[1:]):
                    start, d = bounds[doc[i]], int(doc[i])
                    rows.append((ids[a + d], int(begin[i] - start), h[begin[i]:end[i:j].max()].tobytes(),
                                 [{"hash": int(x), "at": int(y - start)}
                                  for x, y in zip(seed[i:j].view(np.int64), at[i:j])]))
            if rows:
                doc_id, begin, words, hits = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id, pa.int64()), pa.array(begin, pa.int64()), pa.array(words, pa.binary()),
                     pa.array(hits, pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64())])))],
                    names=["doc_id", "begin", "words", "hits"])

    found = arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        run, "doc_id long, begin long, words binary, hits array<struct<hash:long,at:long>>")
    return found.select(F.monotonically_increasing_id().alias("row"), "*")


def _verify(group: pa.Table, overlap: int, percent: int) -> pa.RecordBatch | None:
    """Diagonals of one stretch against their items."""
    out = []
    doc = np.frombuffer(group.column("words")[0].as_py(), np.uint64)
    begin, doc_id = group.column("begin")[0].as_py(), group.column("doc_id")[0].as_py()
    for item, diagonal, raw in zip(*(group.column(c).to_pylist() for c in ("item_id", "diagonal", "item_words"))):
        words = np.frombuffer(raw, np.uint64)
        shift = diagonal - begin
        a, b = max(0, -shift), min(len(words), len(doc) - shift)
        # A stretch shorter than the window is a whole document.
        need = min(overlap, len(words), len(doc))
        if b <= a or (need < PHRASE_WORDS and len(words) != len(doc)):
            continue
        same = np.concatenate([[0], np.cumsum(words[a:b] == doc[a + shift:b + shift])])
        # Cut short by the document's start or end, the window's missing words count as different.
        width = min(need, b - a)
        runs = same[width:] - same[:-width]
        best = int(runs.argmax())
        if 100 * runs[best] >= (percent if need >= min(overlap, LEAST_WORDS) else 100) * need:
            out.append((doc_id, item, begin + shift + a + best, a + best, width, int(runs[best]), int(same[-1])))
    if not out:
        return None
    names = ["doc_id", "item_id", "doc_at", "item_at", "n_window", "n_equal", "n_diagonal"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def leaks(docs: DataFrame, items: DataFrame, overlap: int = OVERLAP, percent: int = PERCENT,
          bits: int = FILTER_BITS) -> DataFrame:
    """``(doc_id, item_id, doc_at, item_at, n_window, n_equal, n_diagonal)``: one row per document and item it leaks.

    The row is the best verified window (ties: earliest in the document, then in the item), positions in words.
    ``n_window`` counts the window's words that lie in the document, ``n_diagonal`` equal words on its diagonal near the
    hit. Null or empty texts leak nothing; an item or a document shorter than a window is compared whole, one of fewer than
    ``LEAST_WORDS`` words without substitutions, and one of fewer than ``PHRASE_WORDS`` only with a text that is as short.
    Repeated document rows give one result; a null ``doc_id`` is kept as such, a null ``item_id`` is ignored. Other columns
    are ignored; empty tables give an empty result.
    """
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null")
    words = landed(_item_words(items), "items")
    seeds = landed(benchmark_seeds(items), "seeds")
    found = landed(stretches(docs, bloom_bytes(seeds, bits), bits, overlap), "stretches")
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.hash", F.col("h.at").alias("doc_at"))
    lines = (hits.join(seeds, "hash").select("row", "item_id", (F.col("doc_at") - F.col("at")).alias("diagonal"))
             .distinct())
    pairs = (lines.join(words.select("item_id", F.col("words").alias("item_words")), "item_id")
             .join(found.select("row", "doc_id", "begin", "words"), "row")
             .select("row", "doc_id", "begin", "words", "item_id", "diagonal", "item_words")
             .repartition("row", "item_id").sortWithinPartitions("row", "item_id"))
    fields = "doc_id long, item_id long, doc_at long, item_at long, n_window long, n_equal long, n_diagonal long"
    checked = arrow_map(pairs, lambda batches: stream_groups(
        batches, ["row", "item_id"], lambda _, g: _verify(g, overlap, percent)), fields)
    best = checked.groupBy("doc_id", "item_id").agg(F.min(F.struct(
        (-F.col("n_equal")).alias("k"), "doc_at", "item_at", "n_window", "n_equal", "n_diagonal")).alias("b"))
    return best.select("doc_id", "item_id", "b.doc_at", "b.item_at", "b.n_window", "b.n_equal", "b.n_diagonal")
